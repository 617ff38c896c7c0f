"""Removal of repeated word windows by super-k-mer partitioning.

The minimiser of a window of ``WINDOW`` words is the least hash of the ``PIECE``-word runs inside
it; consecutive windows with their minimiser at the same place form a super-k-mer. Equal windows
have equal minimisers, so they meet in the minimiser's bucket, where sorting finds every window's
first place exactly, by its text.

Only super-k-mers whose minimiser occurs again are packed and sent. Which minimisers those are is
counted first, and kept in a bit filter of a fixed size: a bit that stands for several minimisers
lets some strings through that no other meets, and holds none back. With very many repeated
minimisers the filter lets more through, at worst everything; results do not depend on it.

A packed string that occurs many times is combined before its bucket: its first place stands for
all, and at the other places every window is a repeat. A minimiser with very many super-k-mers is
split: there each window travels alone, in a bucket of its own text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockmart.llm.common import stored, text_of
from stockmart.llm.words import Words, slices, texts_of

WINDOW = 20
PIECE = 5
#: Super-k-mers of one minimiser from which on its windows travel alone.
CROWD = 5_000
#: Bits of the filter, and the parts in which tasks make it. The driver holds all bits, 32 MB.
FILTER_BITS, FILTER_PARTS = 1 << 28, 256


def _words(texts: pa.Array) -> Words:
    """Words without the empty ones that leading or trailing white space leaves."""
    words = Words(pc.ascii_split_whitespace(texts))
    empty = np.array([not w for w in words.distinct], bool)
    if empty.any():
        full = ~empty[words.index]
        words.bounds = np.concatenate(([0], np.cumsum(full)))[words.bounds]
        words.index = words.index[full]
    return words


def super_kmers(words: Words, window: int, piece: int) -> tuple[np.ndarray, ...]:
    """Text number, first window, number of windows and minimiser of each super-k-mer."""
    n = len(words.index)
    if n < window:
        none = np.empty(0, np.int64)
        return none, none, none, none
    hashes = pd.util.hash_array(np.array(words.distinct, object), categorize=False)[words.index]
    m = n - piece + 1
    grams = np.zeros(m, np.uint64)
    for i in range(piece):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + m]
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    grams ^= grams >> np.uint64(32)
    # Leftmost least gram of the ``wide`` grams from each place on, by doubling spans.
    wide = window - piece + 1
    place, span = np.arange(m), 1
    while span < wide:
        step = min(span, wide - span)
        left, right = place[: len(place) - step], place[step:]
        place = np.where(grams[left] <= grams[right], left, right)
        span += step
    starts = np.arange(len(place))
    owner = np.repeat(np.arange(len(words.bounds) - 1), np.diff(words.bounds))[starts]
    inside = starts + window <= words.bounds[1:][owner]
    starts, owner, place = starts[inside], owner[inside], place[inside]
    if not len(starts):
        return starts, starts, starts, starts
    new = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    counts = np.diff(np.append(new, len(starts)))
    return owner[new], starts[new] - words.bounds[:-1][owner[new]], counts, grams[place[new]].view(np.int64)


def _digest(kept: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(kept)).hexdigest()


def _keyed(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """Rows by id and a 64-bit hash of the text, as ids may be null or repeated."""
    doc = F.struct(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_of(text_col)).alias("digest"))
    return docs.select(doc.alias("doc"), text_of(text_col).alias("text"))


DOC = "doc struct<id: bigint, digest: bigint>"


def minimisers(rows: DataFrame, window: int, piece: int) -> DataFrame:
    """One row per super-k-mer: ``least``, its minimiser."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                least = super_kmers(_words(texts_of(part, "text")), window, piece)[3]
                yield pa.RecordBatch.from_arrays([pa.array(least)], ["least"])

    return rows.select("text").mapInArrow(scanned, "least long")


def _bit(least: np.ndarray, bits: int) -> np.ndarray:
    return least & (bits - 1)


def bit_filter(least: DataFrame, bits: int = FILTER_BITS, parts: int = FILTER_PARTS) -> np.ndarray:
    """Both numbers are powers of two. A filter of ``bits`` bits with those of ``least`` set, as bytes; each part is made by a task."""
    size = bits // parts

    def made(rows: pd.DataFrame) -> pd.DataFrame:
        flags = np.zeros(size, bool)
        flags[rows["bit"].to_numpy() % size] = True
        return pd.DataFrame({"part": rows["bit"][:1] // size, "bytes": [np.packbits(flags).tobytes()]})

    found = least.select(F.col("least").bitwiseAND(F.lit(bits - 1)).alias("bit")).distinct()
    segments = found.groupBy(F.floor(F.col("bit") / size)).applyInPandas(made, "part long, bytes binary").collect()
    out = np.zeros(bits // 8, np.uint8)
    for row in segments:
        out[row["part"] * size // 8 : (row["part"] + 1) * size // 8] = np.frombuffer(row["bytes"], np.uint8)
    return out


def holds(filter_bytes: np.ndarray, least: np.ndarray) -> np.ndarray:
    bit = _bit(least, 8 * len(filter_bytes))
    return (filter_bytes[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1 > 0


def pack(rows: DataFrame, again: np.ndarray, crowded: np.ndarray, window: int, piece: int) -> DataFrame:
    """The super-k-mers that may meet an equal one, as packed strings with their bucket.

    In its bucket a string is known by ``mark``, a hash of its own beside the bucket's.

    ``again`` and ``crowded`` are bit filters of minimisers that occur more than once, and very
    often. Both look at the minimiser only, so equal windows are treated alike.
    """
    context = rows.sparkSession.sparkContext
    sent = context.broadcast((again, crowded))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                texts = texts_of(part, "text")
                owner, first, windows, least = super_kmers(_words(texts), window, piece)
                may = holds(sent.value[0], least)
                owner, first, windows, least = owner[may], first[may], windows[may], least[may]
                alone = holds(sent.value[1], least)
                which, bucket, text, start, count = [], [], [], [], []
                words, of = [], -1
                for i, s, n, key, single in zip(
                    owner.tolist(), first.tolist(), windows.tolist(), least.tolist(), alone.tolist()
                ):
                    if i != of:
                        words, of = texts[i].as_py().encode().split(), i
                    size = 1 if single else n
                    for at in range(s, s + n, size):
                        string = b" ".join(words[at : at + size + window - 1])
                        text.append(string)
                        which.append(i)
                        start.append(at)
                        count.append(size)
                        bucket.append(_hash(string) if single else key)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc").take(pa.array(which, pa.int64())),
                        pa.array(bucket, pa.int64()),
                        pa.array([_hash(t, b"mark") for t in text], pa.int64()),
                        pa.array(text, pa.binary()).cast(pa.string()),
                        pa.array(start, pa.int32()),
                        pa.array(count, pa.int32()),
                    ],
                    ["doc", "bucket", "mark", "string", "start", "n"],
                )

    return rows.mapInArrow(packed, f"{DOC}, bucket long, mark long, string string, start int, n int")


def _hash(string: bytes, kind: bytes = b"") -> int:
    """A long of 64 hashed bits; ``kind`` makes independent ones."""
    found = hashlib.blake2b(string, digest_size=8, person=kind).digest()
    return int.from_bytes(found, "big", signed=True)


def repeats_in(strings: list[tuple[tuple, bytes]], window: int) -> list[tuple]:
    """Windows of a bucket that begin earlier elsewhere, as (place in ``strings``, window).

    ``strings`` has the first place (doc..., start) and the text of each different string.
    """
    windows = []
    for i, (place, string) in enumerate(strings):
        words = string.split(b" ")
        ends = np.cumsum([len(w) + 1 for w in words]).tolist()
        begins = [0, *ends]
        for k in range(len(words) - window + 1):
            windows.append((string[begins[k] : ends[k + window - 1] - 1], *place[:-1], place[-1] + k, i, k))
    windows.sort()
    return [(w[-2], w[-1]) for before, w in zip(windows, windows[1:]) if before[0] == w[0]]


def first_repeats(firsts: DataFrame, window: int) -> DataFrame:
    """(doc, start, n): windows at first places of strings that begin earlier in other strings."""

    def sorted_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, strings, found = None, [], []

        def close() -> None:
            for i, k in repeats_in(strings, window):
                place = strings[i][0]
                found.append((place[1] if place[0] else None, place[2], place[3] + k))

        for batch in batches:
            ids = batch.column("first").field("doc").field("id").to_pylist()
            digests = batch.column("first").field("doc").field("digest").to_pylist()
            starts = batch.column("first").field("start").to_pylist()
            texts = batch.column("string").cast(pa.binary()).to_pylist()
            for b, i, d, s, t in zip(batch.column("bucket").to_pylist(), ids, digests, starts, texts):
                if b != bucket:
                    close()
                    bucket, strings = b, []
                strings.append(((i is not None, i or 0, d, s), t))
            yield taken(found)
            found = []
        close()
        yield taken(found)

    def taken(found: list[tuple]) -> pa.RecordBatch:
        doc = pa.StructArray.from_arrays(
            [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], ["id", "digest"]
        )
        return pa.RecordBatch.from_arrays(
            [doc, pa.array([f[2] for f in found], pa.int32()), pa.array([1] * len(found), pa.int32())],
            ["doc", "start", "n"],
        )

    dealt = firsts.select("bucket", "string", "first").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(sorted_out, f"{DOC}, start int, n int")


def kept_words(texts: DataFrame, window: int) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept text of rows with ``spans`` of repeats."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield cut(part)

    def cut(part: pa.RecordBatch) -> pa.RecordBatch:
        total, removed, digests, left = [], [], [], []
        for text, spans in zip(part.column("text").to_pylist(), part.column("spans").to_pylist()):
            words = text.encode().split()
            total.append(len(words))
            if spans:
                edges = np.zeros(len(words) + 1, np.int32)
                for s in spans:
                    edges[s["start"]] += 1
                    edges[s["start"] + s["n"] + window - 1] -= 1
                words = [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]
            removed.append(total[-1] - len(words))
            digests.append(_digest(words))
            left.append(b" ".join(words).decode())
        return pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                pa.array(total, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(digests, pa.string()),
                pa.array(left, pa.string()),
            ],
            ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
        )

    return texts.select("doc_id", "text", "spans").mapInArrow(
        kept, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    )


def repeated_windows(rows: DataFrame, window: int, piece: int, crowd: int) -> DataFrame:
    """doc and its ``spans`` (start, n) of windows that begin earlier elsewhere."""
    times = stored(
        minimisers(rows, window, piece).groupBy("least").agg(F.count(F.lit(1)).alias("times")).where("times > 1"),
        "repeated-minimisers",
    )
    again = bit_filter(times.select("least"))
    crowded = bit_filter(times.where(F.col("times") > crowd).select("least"), FILTER_BITS >> 6)
    strings = stored(pack(rows, again, crowded, window, piece), "packed-strings")
    firsts = stored(
        strings.groupBy("bucket", "mark").agg(
            F.min(F.struct("doc", "start")).alias("first"),
            F.first("string").alias("string"),
            F.count(F.lit(1)).alias("times"),
        ),
        "first-places",
    )
    later = (
        strings.select("bucket", "mark", "doc", "start", "n")
        .join(firsts.where("times > 1").select("bucket", "mark", "first"), ["bucket", "mark"])
        .where(F.struct("doc", "start") != F.col("first"))
        .select("doc", "start", "n")
    )
    # A row given twice has its spans twice, which changes nothing.
    return later.unionByName(first_repeats(firsts, window)).groupBy("doc").agg(
        F.collect_set(F.struct("start", "n")).alias("spans")
    )


def substring_dedup(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    window: int = WINDOW,
    piece: int = PIECE,
    crowd: int = CROWD,
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the kept words as a text of each row.

    Earlier means a smaller id, then, in one document, an earlier start; null ids come before all
    others. Rows that share an id but not their text are documents of their own, ordered by a hash
    of the text; rows that repeat both are one document and get equal results, as if it were there
    once. A null text has no words; texts shorter than a window lose none. An empty table gives no
    rows; other columns are ignored.
    """
    rows = _keyed(docs, text_col, id_col)
    spans = stored(repeated_windows(rows, window, piece, crowd), "repeated-spans")
    found = rows.join(spans, "doc", "left").select(F.col("doc.id").alias("doc_id"), "text", "spans")
    return kept_words(found, window)
