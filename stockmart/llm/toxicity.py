"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

The kernel of two strings sums over their common subsequences of four characters, each weighted by ``DECAY`` to the power of the stretch it takes in either string, up to ``STRETCH`` characters; it
is normalised by the strings' own stretches. End marks stand at the ends of a string. Inserted
characters and gaps weaken a match and do not end it, so `st*upid` stays close to `stupid`. The
stretch covers three inserted characters after each letter. Punctuation inside a string takes part
in no match; the string without it is decided as well, and the more toxic of the two counts, so
any filling with marks is met.

Landmarks are a bounded set of training strings; K(., Z) K(Z, Z)^-1/2 are the machine's features.
As the machine is linear in them, its decision for a string is a sum of one weight per
subsequence, divided by the string's norm: the landmarks collapse into a table that is looked up
in vectorised form, once per distinct string.

The labels belong to whole texts, so the machine is trained as on bags: strings of the sentences
that occur in toxic training texts far more often than by chance are positive, strings that do not
are negative, and clean strings that look toxic join them in rounds. A logistic curve on the
training texts turns the decisions of a text's strings into a probability: the greatest one, how
much of them is above the border, and that in proportion to the text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, cached_property
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockmart.llm.common import row_key, stored, text_of, unused
from stockmart.llm.words import WordCache, Words, slices, texts_of

DECAY = 0.6
STRETCH = 13
#: Offsets of the second to fourth character of a subsequence.
SHAPES = tuple(combinations(range(1, STRETCH), 3))
#: Characters of their own; all others count as one.
ALPHABET = 48
#: Bounds of the training sample: labelled texts, strings of either class, landmarks.
MOST_TEXTS, MOST_STRINGS, LANDMARKS = 20_000, 3_000, 128
#: Least hashes in which near copies agree.
MINIMA = 4
#: Rounds in which clean strings that look toxic join the negative ones.
MINING = 3
#: Marks do not count at the ends of a string, and are gaps inside.
MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
_NO_MARKS = str.maketrans("", "", MARKS)
#: Three or more characters that stand apart, in Arrow's and in Python's syntax.
_APART = r"(?:^|[\t-\r ])[^\t-\r ](?:[\t-\r ]+[^\t-\r ]){2,}(?:[\t-\r ]|$)"
_RUN = re.compile(r"(?<![^\t-\r ])[^\t-\r ](?:[\t-\r ]+[^\t-\r ]){2,}(?![^\t-\r ])")
#: Longer strings are cut into overlapping pieces; the most toxic piece counts.
PIECE, OVERLAP = 32, 12
#: Strings whose subsequences are listed together, about 50 MB for the longest pieces.
BATCH = 500
#: Subsequences that are looked up together, about 1 MB of keys.
CELLS = 1 << 18


@dataclass
class Machine:
    """``used`` and ``weights``: the subsequences with a weight; ``table`` spreads them out."""

    alphabet: dict[str, int]
    used: np.ndarray
    weights: np.ndarray
    bias: float
    curve: np.ndarray | None = None
    lowest: float = -4.0

    @cached_property
    def table(self) -> np.ndarray:
        table = np.zeros(ALPHABET**4, np.float32)
        table[self.used] = self.weights
        return table

    @cached_property
    def code_of(self) -> np.ndarray:
        """The code of each code point."""
        codes = np.zeros(0x110000, np.uint8)
        codes[[ord(c) for c in self.alphabet]] = list(self.alphabet.values())
        return codes

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("table", "code_of")}

    def codes(self, strings: list[str], n: int) -> np.ndarray:
        """The codes of strings of ``n`` characters each, between end marks: a column per string."""
        points = np.frombuffer("".join(strings).encode("utf-32-le"), np.uint32)
        codes = np.ones((n + 2, len(strings)), np.int32)
        codes[1:-1] = self.code_of[points].reshape(len(strings), n).T
        return codes

    def decide(self, strings: list[str]) -> list[float]:
        """Decision of each string; pieces of long ones count by their greatest."""
        pieces, owner = [], []
        for i, s in enumerate(strings):
            parts = pieces_of(s)
            if not s.isalnum() and (bare := s.translate(_NO_MARKS)) != s.strip(MARKS):
                parts += pieces_of(bare)
            pieces += parts
            owner += [i] * len(parts)
        out = np.full(len(strings), self.lowest)
        sizes, owner = np.array([len(p) for p in pieces], np.int64), np.array(owner, np.int64)
        for n in np.unique(sizes):
            pairs, halves, weights = places_of(int(n) + 2)
            rows = np.flatnonzero(sizes == n)
            step = max(1, CELLS // max(1, len(weights)))
            for a in range(0, len(rows) if len(weights) else 0, step):
                some = rows[a : a + step]
                codes = self.codes([pieces[i] for i in some], int(n))
                pair = codes[pairs[0]] * ALPHABET + codes[pairs[1]]
                keys = (pair * ALPHABET**2)[halves[0]]
                keys += pair[halves[1]]
                value = weights @ self.table.take(keys)
                norm = np.full(len(some), np.sqrt(weights @ weights))
                # Subsequences with a character outside the alphabet count for nothing.
                if len(odd := np.flatnonzero((codes == 0).any(0))):
                    known = codes[:, odd] > 0
                    known = known[pairs[0]] & known[pairs[1]]
                    norm[odd] = np.sqrt((weights * weights) @ (known[halves[0]] & known[halves[1]]))
                value = np.where(norm > 0, value / np.maximum(norm, 1e-12) - self.bias, self.lowest)
                np.maximum.at(out, owner[some], value)
        return out.tolist()

    def traits(self, words: Words, cache: WordCache) -> np.ndarray:
        """What the curve takes of each text, from the decisions of its strings."""
        values = np.array(cache.look_up(words.distinct), np.float64)
        above = np.log1p(words.sums(np.maximum(values + 0.25, 0)))
        size = np.log1p(np.diff(words.bounds))
        return np.stack([words.greatest(values, self.lowest), above, above / (1 + size), size], axis=1)

    def probability(self, traits: np.ndarray) -> np.ndarray:
        margin = traits @ self.curve[:-1] + self.curve[-1]
        return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))


def pieces_of(string: str) -> list[str]:
    """The string without marks at its ends, cut into overlapping pieces where it is long."""
    string = string.strip(MARKS)
    if len(string) <= PIECE:
        return [string]
    return [string[a : a + PIECE] for a in range(0, len(string) - OVERLAP, PIECE - OVERLAP)]


@cache
def places_of(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The subsequences of ``n`` characters, end marks among them: pairs of places, which two pairs make each, and its weight."""
    pairs = [(i, j) for i in range(n) for j in range(i + 1, min(n, i + STRETCH))]
    number = {p: k for k, p in enumerate(pairs)}
    # One after the other they share their first pair.
    at = sorted((a, a + b, a + c, a + d) for b, c, d in SHAPES for a in range(n - d))
    halves = np.array([(number[w, x], number[y, z]) for w, x, y, z in at], np.int32).reshape(-1, 2).T
    weights = np.array([DECAY ** (z - w + 1) for w, _, _, z in at], np.float32)
    return np.array(pairs, np.int32).reshape(-1, 2).T, halves, weights


def subsequences(strings: list[str], alphabet: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and weights of all subsequences of each string, padded with weight zero."""
    n = max(map(len, strings), default=0) + 2
    codes = np.zeros((len(strings), n), np.int32)
    get = alphabet.get
    for row, s in zip(codes, strings):
        row[0] = row[len(s) + 1] = 1
        row[1 : len(s) + 1] = [get(c, 0) for c in s]
    # Only places that the longest string has: short strings fit few of the shapes.
    shapes = [shape for shape in SHAPES if shape[2] < n]
    keys = np.empty((len(strings), sum(n - d for _, _, d in shapes)), np.int32)
    weights = np.empty(keys.shape, np.float32)
    known = codes > 0
    done = 0
    for b, c, d in shapes:
        part = slice(done, done + n - d)
        done = part.stop
        at = [slice(x, x + n - d) for x in (0, b, c, d)]
        w, x, y, z = (codes[:, a] for a in at)
        keys[:, part] = ((w * ALPHABET + x) * ALPHABET + y) * ALPHABET + z
        # Characters outside the alphabet stand for many, so they take part in no match.
        full = known[:, at[0]] & known[:, at[1]] & known[:, at[2]] & known[:, at[3]]
        weights[:, part] = np.where(full, np.float32(DECAY ** (d + 1)), np.float32(0))
    return keys, weights


def packed(strings: list[str], alphabet: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The subsequences of all strings in a row, normalised, and the bounds of the strings."""
    keys: list[np.ndarray] = [np.empty(0, np.int32)] * len(strings)
    weights: list[np.ndarray] = [np.empty(0, np.float32)] * len(strings)
    order = sorted(range(len(strings)), key=lambda i: len(strings[i]))
    for a in range(0, len(order), BATCH):
        some = order[a : a + BATCH]
        k, w = subsequences([strings[i] for i in some], alphabet)
        w = w / np.maximum(np.sqrt(np.einsum("ij,ij->i", w, w)), 1e-12)[:, None]
        for row, i in enumerate(some):
            full = w[row] > 0
            keys[i], weights[i] = k[row, full], w[row, full]
    bounds = np.concatenate(([0], np.cumsum([len(k) for k in keys])))
    return np.concatenate([*keys, np.empty(0, np.int32)]), np.concatenate([*weights, np.empty(0, np.float32)]), bounds


def train_machine(positive: list[str], negative: list[str]) -> Machine:
    """A linear support vector machine on Nyström features of the strings, as ``pieces_of`` gives them."""
    strings = positive + negative
    common: dict[str, int] = {}
    for s in strings:
        for c in set(s) - set(MARKS):
            common[c] = common.get(c, 0) + 1
    # Code 0 is any other character and code 1 the end mark.
    chosen = sorted(common, key=lambda c: (-common[c], c))[: ALPHABET - 2]
    alphabet = {c: i + 2 for i, c in enumerate(chosen)}
    keys, weights, bounds = packed(strings, alphabet)
    own = [slice(a, b) for a, b in zip(bounds[:-1], bounds[1:])]
    owner = np.repeat(np.arange(len(strings)), np.diff(bounds))
    table = np.zeros(ALPHABET**4, np.float32)

    def kernel(z: int) -> np.ndarray:
        """Of all strings with string ``z``."""
        np.add.at(table, keys[own[z]], weights[own[z]])
        found = np.bincount(owner, table[keys] * weights, len(strings))
        table[keys[own[z]]] = 0
        return found

    landmarks, columns = [], []
    for first, last, count in ((0, len(positive), LANDMARKS * 3 // 4), (len(positive), len(strings), LANDMARKS // 4)):
        # The next landmark is the string that is least like those before.
        nearest = np.full(last - first, -1.0)
        for _ in range(min(count, last - first)):
            landmarks.append(first + int(np.argmin(nearest)))
            columns.append(kernel(landmarks[-1]))
            nearest = np.maximum(nearest, columns[-1][first:last])
    cross = np.stack(columns, axis=1).astype(np.float64)
    values, axes = np.linalg.eigh(cross[landmarks])
    root = axes[:, values > 1e-6] / np.sqrt(values[values > 1e-6])
    features = cross @ root
    sign = np.where(np.arange(len(strings)) < len(positive), 1.0, -1.0)
    share = np.where(sign > 0, 0.5 / max(1, len(positive)), 0.5 / max(1, len(negative)))
    w = _squared_hinge(np.hstack([features, -np.ones((len(strings), 1))]), sign, share)
    for z, beta in zip(landmarks, root @ w[:-1]):
        np.add.at(table, keys[own[z]], np.float32(beta) * weights[own[z]])
    used = np.flatnonzero(table)
    return Machine(alphabet, used, table[used], float(w[-1]))


def _squared_hinge(x: np.ndarray, sign: np.ndarray, share: np.ndarray, penalty: float = 1e-4) -> np.ndarray:
    """Weights of the linear machine with squared hinge loss, by Newton steps on its active rows."""
    w = np.zeros(x.shape[1])
    loss = lambda w: penalty * w @ w / 2 + share @ np.maximum(0, 1 - sign * (x @ w)) ** 2
    for _ in range(50):
        active = sign * (x @ w) < 1
        xa, sa = x[active], share[active]
        gradient = penalty * w - 2 * xa.T @ (sa * (sign[active] - xa @ w))
        step = np.linalg.solve(penalty * np.eye(len(w)) + 2 * (xa.T * sa) @ xa, gradient)
        size, now = 1.0, loss(w)
        while size > 1e-4 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-7:
            break
    return w


def strings_of(texts: pa.Array) -> Words:
    """The strings of the texts' sentences: words, and letters that stand apart as one string."""
    lower = pc.utf8_lower(texts)
    some = pc.match_substring_regex(lower, _APART)
    if some.true_count:
        joined = [_RUN.sub(lambda m: "".join(m[0].split()), x) for x in lower.filter(some).to_pylist()]
        lower = pc.replace_with_mask(lower, some, pa.array(joined, lower.type))
    return Words(pc.ascii_split_whitespace(lower))


def _fit_curve(traits: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Slopes and offset of a logistic curve, by damped Newton steps with smoothed targets."""
    n1, n0 = labels.sum(), (1 - labels).sum()
    target = np.where(labels > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.hstack([traits, np.ones((len(labels), 1))])
    at = np.zeros(x.shape[1])

    def loss(at: np.ndarray) -> float:
        z = x @ at
        return float((np.logaddexp(0, z) - target * z).sum() + 0.05 * at @ at)

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        gradient = x.T @ (p - target) + 0.1 * at
        curvature = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(at))
        step, size = np.linalg.solve(curvature, gradient), 1.0
        while size > 1e-6 and loss(at - size * step) > loss(at):
            size /= 2
        at = at - size * step
    return at


def without_near_copies(sample: DataFrame, words: Column) -> DataFrame:
    """text and label of one text for all that share a label and ``MINIMA`` least hashes of word triples.

    Copies of one text must not make its words look like a habit. Texts that only share a passage
    differ in some of the hashes. The least text of the copies stays.
    """

    def least(seed: int) -> Column:
        return F.array_min(F.transform(
            F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("words") - 3)),
            lambda i: F.xxhash64(F.lit(seed), F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)),
        ))

    return (
        sample.withColumn("words", F.explode(F.array(words)))
        .groupBy("label", *[least(seed).alias(f"least{seed}") for seed in range(MINIMA)])
        .agg(F.min("text").alias("text"))
        .select("text", "label")
    )


def labelled_strings(alone: DataFrame) -> DataFrame:
    """label and the different strings of each row's ``words``, trimmed and cut as ``pieces_of`` does."""

    def pieces(word: Column) -> Column:
        bare = F.btrim(word, F.lit(MARKS))
        last = F.greatest(F.lit(0), F.length(bare) - OVERLAP - 1)
        cut = F.transform(
            F.sequence(F.lit(0), last, F.lit(PIECE - OVERLAP)),
            lambda a: F.substring(bare, a + 1, F.lit(PIECE)),
        )
        return F.when(F.length(bare) <= PIECE, F.array(bare)).otherwise(cut)

    found = F.array_distinct(F.flatten(F.transform("words", pieces)))
    return alone.select("label", F.explode(found).alias("string")).where("string != ''")


def train(
    docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", label_col: str = "toxic"
) -> Machine:
    """A machine from the labelled rows of ``docs`` whose fold is not held out.

    The sample is bounded: about ``MOST_TEXTS`` labelled texts by a hash of the id, and of their
    strings ``MOST_STRINGS`` of either class. Without any positive or negative text all scores
    follow the base rate.
    """
    sample = stored(training_sample(docs, labels, text_col, id_col, label_col), "labelled-texts")
    words = F.split(F.lower("text"), r"\s+")
    alone = without_near_copies(sample, words).withColumn("words", words)
    strings = stored(
        labelled_strings(alone).groupBy("string").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic")),
        "labelled-strings",
    )
    rates = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic")).first()
    if not rates["n"] or not rates["toxic"] or rates["toxic"] == rates["n"]:
        rate = (rates["toxic"] + 1) / (rates["n"] + 2) if rates["n"] else 0.0
        machine = Machine({}, np.empty(0, np.int64), np.empty(0, np.float32), 0.0)
        machine.curve = np.array([0, 0, 0, 0, np.log(max(rate, 1e-6) / (1 - min(rate, 1 - 1e-6)))])
        return machine
    base = rates["toxic"] / rates["n"]
    # By chance alone, less than a tenth of a string in all would be toxic that often.
    least = np.log(10 * max(1, strings.count())) / np.log(1 / base)
    positive = (
        strings.where((F.col("toxic") >= least) & (F.col("toxic") > 0.6 * F.col("n")))
        .orderBy(F.desc("toxic"), "string").limit(MOST_STRINGS)
    )
    negative = strings.where(F.col("toxic") <= 2.0 * base * F.col("n"))
    # Frequent strings and strings by chance, half of each.
    often = negative.orderBy(F.desc("n"), "string").limit(MOST_STRINGS // 2)
    chance = negative.orderBy(F.xxhash64("string"), "string").limit(MOST_STRINGS // 2)
    good = [r["string"] for r in positive.collect()]
    bad = [r["string"] for r in often.collect()] + [r["string"] for r in chance.collect()]
    machine = train_machine(good, list(dict.fromkeys(bad)))
    for _ in range(MINING):
        looks = read_texts(negative.select(F.col("string").alias("text")), machine, "text")
        decision = F.col("traits")[0]
        worst = looks.where(decision > -0.5).orderBy(F.desc(decision), "text").limit(MOST_STRINGS)
        bad += [r["text"] for r in worst.collect()]
        machine = train_machine(good, list(dict.fromkeys(bad)))
    decided = read_texts(alone, machine, "label").toPandas()
    traits, answers = np.array(decided["traits"].tolist()), decided["label"].to_numpy(float)
    order = np.lexsort((answers, *traits.T))
    machine.curve = _fit_curve(traits[order], answers[order])
    return machine


def held_out(id_col: str):
    """The fold: crc32 of the id as text, modulo 5, is 0. A null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def training_sample(
    docs: DataFrame, labels: DataFrame, text_col: str, id_col: str, label_col: str, most: int = MOST_TEXTS
) -> DataFrame:
    """text and label of about ``most`` labelled texts at most, outside of the held-out fold.

    An id with several labels has the one that most of them say, 1 for ties. Rows that share id
    and text count once.
    """
    known = labels.where(F.col(label_col).isNotNull()).select(
        F.col("doc_id").alias("labelled"), F.col(label_col).cast("int").alias("label")
    ).where(~held_out("labelled"))
    known = known.groupBy("labelled").agg(F.round(F.avg("label")).cast("int").alias("label"))
    keys = docs.select(row_key(id_col, text_col).alias("key")).distinct()
    keys = stored(keys.join(known, F.col("key.id") == F.col("labelled")).select("key", "label"), "labelled-keys")
    share = min(1.0, most / max(1, keys.count()))
    picked = keys.where(F.pmod(F.xxhash64("key.id", "key.digest"), F.lit(1 << 20)) < share * (1 << 20))
    texts = docs.select(row_key(id_col, text_col).alias("doc"), text_of(text_col).alias("text"))
    found = texts.join(picked, F.col("doc") == F.col("key"))
    return found.dropDuplicates(["doc"]).select("text", "label")


def read_texts(rows: DataFrame, machine: Machine, *keep: str) -> DataFrame:
    """``keep`` columns, and the ``traits`` of each text or, once the curve is fitted, its score."""
    sent = rows.sparkSession.sparkContext.broadcast(machine)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordCache(sent.value.decide)
        for batch in batches:
            for part in slices(batch, "text"):
                traits = sent.value.traits(strings_of(texts_of(part, "text")), cache)
                if sent.value.curve is None:
                    bounds = np.arange(0, traits.size + 1, traits.shape[1], dtype=np.int32)
                    found, name = pa.ListArray.from_arrays(pa.array(bounds), pa.array(traits.ravel())), "traits"
                else:
                    found, name = pa.array(sent.value.probability(traits)), "score"
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), found], [*keep, name])

    kinds = dict(rows.dtypes)
    out = "traits array<double>" if machine.curve is None else "score double"
    schema = ", ".join([*(f"{k} {kinds[k]}" for k in keep), out])
    return rows.select(*dict.fromkeys([*keep, "text"])).mapInArrow(read, schema)


def score(
    docs: DataFrame, machine: Machine, text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """doc_id, score and predicted of each row's whole text; nothing is shuffled.

    A null text is empty; texts without strings get the lowest decision. Null and repeated ids
    stay as they are; an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return read_texts(rows, machine, "doc_id").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(
    docs: DataFrame, machine: Machine, text_col: str = "text", limit: float = 0.5
) -> DataFrame:
    """The rows that score below ``limit``, with all their columns; nothing is shuffled."""
    sent = docs.sparkSession.sparkContext.broadcast(machine)
    name = unused(docs, "text_in")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordCache(sent.value.decide)
        for batch in batches:
            for part in slices(batch, name):
                traits = sent.value.traits(strings_of(texts_of(part, name)), cache)
                stay = pa.array(sent.value.probability(traits) < limit)
                yield part.filter(stay).drop_columns([name])

    return docs.withColumn(name, text_of(text_col)).mapInArrow(keep, docs.schema)


def fold_of(doc_id) -> int:
    """The fold in plain Python, for tests."""
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5
