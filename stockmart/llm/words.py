"""Work per distinct word instead of per word: Arrow splitting and a bounded cache.

Each batch of texts is split and dictionary-encoded by Arrow, Python looks at the distinct words
only, and numpy spreads the answers over the words again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 6 << 20


class WordCache:
    """What is known of recent words; holds at most twice ``limit`` words.

    When the young generation is full it becomes the old one. Words in use move on, so frequent
    words stay. Forgetting a word costs time only.
    """

    def __init__(self, compute: Callable[[list[str]], list], limit: int = 300_000):
        self.compute, self.limit = compute, limit
        self.young: dict = {}
        self.old: dict = {}

    def look_up(self, words: list[str]) -> list:
        """A value for each of the words, which are all different."""
        found = list(map(self.young.get, words))
        missed = [i for i, value in enumerate(found) if value is None]
        new: list[int] = []
        for i in missed:
            value = self.old.get(words[i])
            if value is None:
                new.append(i)
            else:
                found[i] = self.young[words[i]] = value
        for i, value in zip(new, self.compute([words[i] for i in new]) if new else []):
            found[i] = self.young[words[i]] = value
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        return found


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most`` bytes of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    row = 0
    while row < batch.num_rows:
        done = ends[row - 1] if row else 0
        stop = max(row + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield batch.slice(row, stop - row)
        row = stop


def texts_of(batch: pa.RecordBatch, text: str) -> pa.Array:
    """The texts with null as empty, in an array of its own that starts at offset zero."""
    return pa.concat_arrays([pc.fill_null(batch.column(text).cast(pa.large_string()), "")])


class Words:
    """The words of each text: ``bounds`` of the texts in ``index``, which points into ``distinct``."""

    def __init__(self, lists: pa.Array):
        encoded = lists.flatten().dictionary_encode()
        self.bounds = (lists.offsets.to_numpy() - lists.offsets[0].as_py()).astype(np.int64)
        self.index = encoded.indices.to_numpy(zero_copy_only=False)
        self.distinct: list[str] = encoded.dictionary.to_pylist()

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Per text the sum of a value of its words, as differences of one running sum."""
        running = np.concatenate(([0], np.cumsum(values[self.index])))
        return running[self.bounds[1:]] - running[self.bounds[:-1]]

    def greatest(self, values: np.ndarray, empty: float) -> np.ndarray:
        """Per text the greatest value of its words."""
        out = np.full(len(self.bounds) - 1, empty)
        full = self.bounds[1:] > self.bounds[:-1]
        if full.any():
            out[full] = np.maximum.reduceat(values[self.index], self.bounds[:-1][full])
        return out
