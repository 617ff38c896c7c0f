"""Bounded-space online packing of token sequences.

Each task packs the documents it reads. It keeps a fixed number of open windows; a document's rest
goes into the window with the least room that takes it whole. When none does, the fullest window
is topped up with the head of the rest and emitted without padding. What stays open is merged: a
round packs the leftovers of up to ``FAN_IN`` tasks again, and a round over the leftovers of those,
until one group is left, whose tail is cut at powers of two. No task holds more than ``FAN_IN``
times the open windows, and ids travel only with leftovers.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockmart.llm.common import stored
from stockmart.llm.token_ids import VOCABULARY, encoder
from stockmart.llm.words import slices, texts_of

LENGTH = 2048
OPEN = 32
FAN_IN = 64
END = 1
OUT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
OPEN_OUT = f"{OUT}, ids binary, task long"


class Packer:
    """The open windows of one task. Emitted pieces are tuples in the order of ``OPEN_OUT``."""

    def __init__(self, first_sequence: int, length: int = LENGTH, most_open: int = OPEN):
        self.length, self.most_open, self.next = length, most_open, first_sequence
        self.rooms: list[tuple[int, int]] = []  # (room, window), sorted
        self.open: dict[int, list[tuple]] = {}
        self.out: list[tuple] = []

    def _sequence(self) -> int:
        self.next += 1
        return self.next - 1

    def _put(self, window: int, room: int, piece: tuple) -> None:
        doc, start, ids, total = piece
        at = self.length - room
        self.open[window].append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, window, at, ids))
        if room > len(ids):
            bisect.insort(self.rooms, (room - len(ids), window))
        else:
            self._emit(window)

    def _emit(self, window: int) -> None:
        self.out += [(*p[:-1], None) for p in self.open.pop(window)]

    def add(self, doc, start: int, ids: np.ndarray, total: int) -> None:
        while len(ids):
            n = len(ids)
            if n >= self.length:
                k = self.length
                window, room = self._sequence(), k
                self.open[window] = []
            else:
                k = n
                fit = bisect.bisect_left(self.rooms, (n, -1))
                if fit < len(self.rooms):
                    room, window = self.rooms.pop(fit)
                elif len(self.rooms) < self.most_open:
                    window, room = self._sequence(), self.length
                    self.open[window] = []
                else:
                    room, window = self.rooms.pop(0)
                    k = room
            self._put(window, room, (doc, start, ids[:k], total))
            ids, start = ids[k:], start + k

    def pour(self) -> None:
        """Ends the open windows: their pieces fill windows in a row, the tail in powers of two."""
        pieces = [p for _, w in sorted(self.rooms) for p in self.open[w]]
        self.rooms, self.open = [], {}
        left = sum(p[2] for p in pieces)
        window, at, size = None, 0, 0
        for doc, start, _, _, total, _, _, ids in pieces:
            while len(ids):
                if at == size:
                    size = min(self.length, 1 << (left.bit_length() - 1))
                    window, at = self._sequence(), 0
                head = ids[: size - at]
                n = len(head)
                self.out.append((doc, start, n, zlib.crc32(head.tobytes()), total, window, at, None))
                ids, start, at, left = ids[n:], start + n, at + n, left - n

    def leftovers(self) -> None:
        for _, window in self.rooms:
            self.out += [(*p[:-1], p[-1].tobytes()) for p in self.open[window]]


def _first(step: int, task: int) -> int:
    """Sequence numbers of a task begin here: 2^27 for each of 2^32 tasks of a round."""
    return ((step << 32) + task) << 27


def pack(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    vocabulary: str = VOCABULARY,
    end: int = END,
    length: int = LENGTH,
    most_open: int = OPEN,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``length`` must be a power of two. A null text is empty and has the end id alone. Null or
    repeated ids stay as they are: each row is a document of its own. An empty table gives no
    rows; other columns are ignored. Very long texts fill windows of their own.
    """
    if length & (length - 1):
        raise ValueError("the sequence length must be a power of two")

    def first_step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        packer, words = Packer(_first(0, task), length, most_open), encoder(vocabulary)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, bounds = words.of(texts_of(part, "text"), end)
                names = part.column("doc_id").to_pylist()
                for doc, a, b in zip(names, bounds[:-1].tolist(), bounds[1:].tolist()):
                    packer.add(doc, 0, ids[a:b].copy(), b - a)
                yield taken(packer, task)
        packer.leftovers()
        yield taken(packer, task)

    def taken(packer: Packer, task: int) -> pa.RecordBatch:
        rows, packer.out = packer.out, []
        columns = list(zip(*rows)) or [()] * 8
        kinds = [pa.int64()] * 7 + [pa.binary()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)] + [pa.array([task] * len(rows), pa.int64())]
        names = [field.split()[0] for field in OPEN_OUT.split(", ")]
        return pa.RecordBatch.from_arrays(arrays, names)

    def merge(step: int, last: bool):
        def merged(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values(["task", "sequence_id", "offset"])
            packer = Packer(_first(step, key[0]), length, most_open)
            for doc, start, total, ids in zip(rows["doc_id"], rows["start"], rows["doc_tokens"], rows["ids"]):
                packer.add(None if pd.isna(doc) else int(doc), start, np.frombuffer(ids, np.uint32), total)
            packer.pour() if last else packer.leftovers()
            return taken(packer, key[0]).to_pandas(integer_object_nulls=True)

        return merged

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    packed = stored(source.mapInArrow(first_step, OPEN_OUT), "packed")
    done, step = [packed.where("ids is null")], 0
    while True:
        rest = packed.where("ids is not null")
        tasks = rest.agg(F.max("task")).first()[0]
        if tasks is None:
            break
        step, last = step + 1, tasks < fan_in
        group = F.floor(F.col("task") / fan_in).alias("group")
        packed = stored(rest.groupBy(group).applyInPandas(merge(step, last), OPEN_OUT), "packed")
        done.append(packed.where("ids is null"))
        if last:
            break
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result.drop("ids", "task")
