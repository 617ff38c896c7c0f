"""Token ids of whole texts, as the tokenizers library gives them.

The vocabulary file's normaliser drops white space and its pre-tokenizer never joins across it, so
the ids of a text are the ids of its words in a row. Each distinct word goes through the library
once. Texts with ``<|`` may hold strings of added tokens, which are told apart by case; their
words are not lower-cased before.
"""

from __future__ import annotations

import os
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from stockmart.llm.words import WordCache, Words

VOCABULARY = "word_bpe_49k.json"


LETTERS = np.isin(np.arange(256), [*range(65, 91), *range(97, 123)])
BLANKS = np.isin(np.arange(256), [32, *range(9, 14)])


def _marks_apart(texts: pa.Array) -> pa.Array:
    """The texts with a space before a stop or comma that ends a word after an ASCII letter.

    Such a mark is a token of its own, so the ids stay the same, and fewer words differ.
    """
    if not texts.buffers()[2]:
        return texts
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    marks = np.flatnonzero((data == ord(".")) | (data == ord(",")))
    marks = marks[marks > 0]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    ends = edge[marks + 1] | BLANKS[data[np.minimum(marks + 1, len(data) - 1)]]
    marks = marks[LETTERS[data[marks - 1]] & ~edge[marks] & ends]
    shifted = bounds + np.searchsorted(marks, bounds)
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(shifted), pa.py_buffer(np.insert(data, marks, 32)))


class WordIds:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.cache = WordCache(self._encode)

    def _encode(self, words: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def of(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, ``end`` after each, and the bounds of the texts."""
        special = pc.match_substring(texts, "<|")
        lower = pc.if_else(special, texts, pc.ascii_lower(texts))
        words = Words(pc.ascii_split_whitespace(_marks_apart(pc.cast(lower, pa.large_string()))))
        known = self.cache.look_up(words.distinct)
        # One more word, the end mark, after the words of each text.
        mark = len(known)
        known.append(array("I", [end]).tobytes())
        index = np.insert(words.index, words.bounds[1:], mark)
        bounds = words.bounds + np.arange(len(words.bounds))
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        flat = np.frombuffer(b"".join(known), np.uint32)
        lists = pa.LargeListArray.from_arrays(
            pa.array(np.concatenate(([0], np.cumsum(sizes)))), pa.array(flat)
        )
        ids = lists.take(pa.array(index)).flatten().to_numpy(zero_copy_only=False)
        running = np.concatenate(([0], np.cumsum(sizes[index])))
        return ids, running[bounds]


@cache
def encoder(vocabulary: str = VOCABULARY) -> WordIds:
    """One per Python worker; ``vocabulary`` is a path, or a file of the installed tokenizers."""
    if not os.path.isabs(vocabulary):
        import public_tokenizers

        vocabulary = public_tokenizers.path(vocabulary)
    return WordIds(vocabulary)
