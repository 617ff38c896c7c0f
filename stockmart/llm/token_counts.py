"""Token counts by a compiled finite-state transducer.

A byte-pair vocabulary is compiled, as far as texts need it, into a deterministic transducer over
characters. Each transition is annotated with the tokens it emits: by how much the count of the
text so far changes (joining characters to a longer token can take tokens back). Two facts make a
finite state enough: the tokens of a prefix up to a token border are the tokens of that prefix
alone, and a sequence of tokens is the right one if each two neighbours are right by themselves. A
state is thus the set of token starts that can still grow, each with its place in the vocabulary's
trie, the token before it, and its count relative to the current one.

Two characters that no vocabulary piece holds side by side synchronise: after them the state is
the same whatever came before. A chunk of text is summarised as a state map: the part before its
first synchronising place, which waits for an entry state, then a fixed count and exit state.
State maps compose associatively. Words that begin at synchronising places have constant maps,
which compose by addition, so a batch of texts is counted with one parallel prefix sum over its
words; longer runs are cut into chunks whose maps are composed by a prefix scan.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockmart.llm.words import WordCache, Words, slices, texts_of

VOCABULARY = "piece_bpe_32k.model"
SPACE = "▁"
CHUNK = 4096
MOST_STATES = 200_000
#: Stand for "no token before that matters".
NONE = -1
RUN = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


@dataclass(frozen=True)
class StateMap:
    """What a chunk does: ``head`` waits for an entry state; ``exit`` is None if all of it waits."""

    head: str
    count: int
    exit: int | None


class Transducer:
    """``ranks``: piece -> priority, lower joins first; ties join from the left."""

    def __init__(self, ranks: dict[str, float]):
        self.ranks = ranks
        self.pieces = list(ranks)
        self.singles = {p for p in ranks if len(p) == 1}
        lacking = {c for p in ranks for c in p} - self.singles
        if lacking:
            raise ValueError(f"characters without a piece of their own: {sorted(lacking)[:5]}")
        self.pairs = {p[i : i + 2] for p in ranks for i in range(len(p) - 1)}
        self.nodes: list[dict[str, int]] = [{}]
        self.token: list[int] = [NONE]
        for token, piece in enumerate(self.pieces):
            node = 0
            for c in piece:
                if c not in self.nodes[node]:
                    self.nodes[node][c] = len(self.nodes)
                    self.nodes.append({})
                    self.token.append(NONE)
                node = self.nodes[node][c]
            self.token[node] = token
        self.right: dict[tuple[int, int], bool] = {}
        self._forget()

    def _forget(self) -> None:
        """Starts the table of states anew; only the time to find them again is lost."""
        self.states: list[tuple] = [("", ((0, NONE, 0),))]
        self.number: dict[tuple, int] = {self.states[0]: 0}
        self.steps: list[dict[str, tuple[int, int]]] = [{}]

    def joined(self, text: str) -> list[str]:
        """The tokens of a short text by joining pairs, as the vocabulary defines it."""
        parts = list(text)
        while True:
            ranked = [(self.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.ranks]
            if not ranked:
                return parts
            _, i = min(ranked)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def fits(self, before: int, token: int) -> bool:
        """Whether ``token`` stands right after ``before``."""
        known = self.right.get((before, token))
        if known is None:
            left = [] if before == NONE else [self.pieces[before]]
            known = self.joined("".join(left) + self.pieces[token]) == [*left, self.pieces[token]]
            self.right[before, token] = known
        return known

    def synchronises(self, a: str, b: str) -> bool:
        return a + b not in self.pairs

    def _compile(self, state: int, c: str) -> tuple[int, int]:
        last, starts = self.states[state]
        if last and self.synchronises(last, c):
            starts = ((0, NONE, 0),)
        if c not in self.singles:
            # Its bytes are tokens, and nothing joins with them.
            emitted, new = len(c.encode()), (c, ((0, NONE, 0),))
        else:
            grown = [
                (child, before, count)
                for node, before, count in starts
                if (child := self.nodes[node].get(c)) is not None
            ]
            token, emitted = next(
                (self.token[node], count + 1)
                for node, before, count in grown
                if self.token[node] != NONE and self.fits(before, self.token[node])
            )
            open_ones = [(node, before, count - emitted) for node, before, count in grown if self.nodes[node]]
            new = (c, tuple([*open_ones, (0, token, 0)]))
        number = self.number.get(new)
        if number is None:
            number = self.number[new] = len(self.states)
            self.states.append(new)
            self.steps.append({})
        step = self.steps[state][c] = (number, emitted)
        return step

    def run(self, state: int, text: str) -> tuple[int, int]:
        """Exit state and tokens emitted. States keep their numbers until the next ``count``."""
        count, steps = 0, self.steps
        for c in text:
            step = steps[state].get(c)
            if step is None:
                step = self._compile(state, c)
            state = step[0]
            count += step[1]
        return state, count

    def state_map(self, chunk: str) -> StateMap:
        for i in range(1, len(chunk)):
            if self.synchronises(chunk[i - 1], chunk[i]):
                exit_state, count = self.run(0, chunk[i:])
                return StateMap(chunk[:i], count, exit_state)
        return StateMap(chunk, 0, None)

    def compose(self, f: StateMap, g: StateMap) -> StateMap:
        if f.exit is None:
            # Where they meet may itself synchronise; the head is run through from its entry then.
            return StateMap(f.head + g.head, g.count, g.exit)
        state, count = self.run(f.exit, g.head)
        return StateMap(f.head, f.count + count + g.count, state if g.exit is None else g.exit)

    def scan(self, maps: list[StateMap]) -> list[StateMap]:
        """All prefixes composed, by halves: each level composes neighbours, in any order."""
        if len(maps) < 2:
            return maps
        pairs = [self.compose(a, b) for a, b in zip(maps[::2], maps[1::2])]
        inner = self.scan(pairs)
        out = [maps[0]]
        for i in range(1, len(maps)):
            out.append(inner[i // 2] if i % 2 else self.compose(inner[i // 2 - 1], maps[i]))
        return out

    def count(self, text: str, chunk: int = CHUNK) -> int:
        """Tokens of a text that starts at a synchronising place."""
        if len(self.states) > MOST_STATES:
            self._forget()
        if len(self.right) > 2 * MOST_STATES:
            self.right.clear()
        if len(text) <= chunk:
            return self.run(0, text)[1]
        maps = [self.state_map(text[i : i + chunk]) for i in range(0, len(text), chunk)]
        whole = self.scan(maps)[-1]
        return self.run(0, whole.head)[1] + whole.count


class Counter:
    """Counts of whole texts: a space goes before each, and spaces are pieces' first characters."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ranks = {
            model.id_to_piece(i): -model.get_score(i)
            for i in range(model.get_piece_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        }
        self.transducer = Transducer(ranks)
        if any(p[1] == SPACE and p[0] != SPACE for p in self.transducer.pairs):
            raise ValueError("pieces go on after a space, so words do not synchronise")
        self.cache = WordCache(self._count_words)

    def _count_words(self, words: list[str]) -> list[int]:
        return [self.transducer.count(SPACE + w) for w in words]

    def of(self, texts: pa.Array) -> np.ndarray:
        """Texts with single spaces only are split there; others go through their runs."""
        odd = pc.match_substring_regex(texts, f"^ |  | $|{SPACE}").to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(odd), "", texts)
        words = Words(pc.split_pattern(plain, " "))
        counts = np.array(self.cache.look_up(words.distinct), np.int64)
        counts[[i for i, w in enumerate(words.distinct) if not w]] = 0
        totals = words.sums(counts)
        for i in np.flatnonzero(odd):
            runs = RUN.findall(SPACE + texts[i].as_py().replace(" ", SPACE))
            totals[i] = self._runs(runs)
        return totals

    def _runs(self, runs: list[str]) -> int:
        plain = [r[1:] for r in runs if r[:1] == SPACE and r[1:2] not in ("", SPACE)]
        distinct = list(dict.fromkeys(plain))
        known = dict(zip(distinct, self.cache.look_up(distinct)))
        rest = sum(self.transducer.count(r) for r in runs if r[:1] != SPACE or r[1:2] in ("", SPACE))
        return sum(map(known.__getitem__, plain)) + rest


@cache
def counter(vocabulary: str = VOCABULARY) -> Counter:
    """One per Python worker; ``vocabulary`` is a path, or a file of the installed tokenizers."""
    if not os.path.isabs(vocabulary):
        import public_tokenizers

        vocabulary = public_tokenizers.path(vocabulary)
    return Counter(vocabulary)


def token_counts(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", vocabulary: str = VOCABULARY
) -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of each row's whole text, without special tokens.

    A null text is empty and has no tokens. Null and repeated ids stay as they are; an empty table
    gives no rows; other columns are ignored. Nothing is shuffled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(vocabulary)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = texts_of(part, "text")
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pc.binary_length(texts).cast(pa.int64()),
                        pa.array(counts.of(texts)),
                    ],
                    ["doc_id", "n_bytes", "n_tokens"],
                )

    kind = dict(docs.dtypes)[id_col]
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
