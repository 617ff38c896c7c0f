"""Toxicity and quality: kernel and tables by brute force, held-out accuracy, odd tables."""

import math
import random
from itertools import combinations

import numpy as np
import pytest

from stockmart.llm import quality, toxicity

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")


def brute_kernel(a, b):
    """Gap-weighted kernel over subsequences of four characters, with end marks, normalised."""

    def stretches(s):
        out = {}
        marked = ["^", *s, "^"]
        for at in combinations(range(len(marked)), 4):
            if at[-1] - at[0] < toxicity.STRETCH:
                u = tuple(marked[i] for i in at)
                out.setdefault(u, []).append(toxicity.DECAY ** (at[-1] - at[0] + 1))
        return out

    x, y = stretches(a), stretches(b)
    norm = lambda s: math.sqrt(sum(w * w for ws in s.values() for w in ws))
    return sum(sum(ws) * sum(y.get(u, [])) for u, ws in x.items()) / (norm(x) * norm(y))


def test_kernel_equals_brute_force():
    strings = ["stupid", "st*upid", "s.t.u.p.i.d", "banana", "the", "ü"]
    alphabet = {c: i + 2 for i, c in enumerate(sorted(set("".join(strings))))}
    keys, weights = toxicity.subsequences(strings, alphabet)
    norm = np.sqrt((weights**2).sum(axis=1))
    for i, j in combinations(range(5), 2):
        table = np.zeros(toxicity.ALPHABET**4, np.float32)
        np.add.at(table, keys[j], weights[j])
        got = (table[keys[i]] * weights[i]).sum() / norm[i] / norm[j]
        assert got == pytest.approx(brute_kernel(strings[i], strings[j]), rel=1e-4, abs=1e-6)
    assert norm[5] == 0


def toxic_table(spark):
    rng = random.Random(9)
    clean = ["".join(rng.choice(["ba", "lo", "mi", "ter", "on", "sa"]) for _ in range(rng.randint(1, 4))) for _ in range(400)]
    rows, labels = [], []
    for i in range(700):
        words = [rng.choice(clean) for _ in range(rng.randint(20, 90))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["grumblefritz", "snotwuzzle", "krankpiffel"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic), int(i % 3 > 0)))
    return (
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, toxic int, quality int"),
        clean,
    )


def test_gapped_and_inserted_insults(spark):
    docs, labels, clean = toxic_table(spark)
    machine = toxicity.train(docs, labels)
    odd = ["grumble-fritz", "grumbblefritz!!", "sn*otwuzzle", "Krankpiffel", "krannkpiffeln"]
    texts = [(i, " ".join([*clean[i * 20 : i * 20 + 20], w, w])) for i, w in enumerate(odd)]
    texts += [(100 + i, " ".join(clean[i * 30 : i * 30 + 30])) for i in range(10)]
    texts += [(None, None), (200, ""), (201, "word " * 20_000), (201, "word " * 20_000)]
    frame = spark.createDataFrame([(d, t, 1.0) for d, t in texts], "doc_id long, text string, score double")
    got = toxicity.score(frame, machine).collect()
    assert len(got) == len(texts)
    by = {r.doc_id: r.predicted for r in got}
    assert [by[i] for i in range(len(odd))] == [1] * len(odd)
    assert [by[100 + i] for i in range(10)] == [0] * 10
    assert all(0 <= r.score <= 1 for r in got)
    kept = toxicity.drop_toxic(frame, machine)
    assert kept.schema == frame.schema
    assert kept.count() == len(texts) - len(odd)
    assert toxicity.score(frame.where("false"), machine).count() == 0


@pytest.mark.parametrize("fill", ["*", "..", "___", "-.-.-"])
def test_interleaved_insults(spark, fill):
    docs, labels, clean = toxic_table(spark)
    machine = toxicity.train(docs, labels)
    odd = [fill.join(w) for w in ("grumblefritz", "snotwuzzle", "krankpiffel")]
    texts = [(i, " ".join([*clean[i * 20 : i * 20 + 20], w, w])) for i, w in enumerate(odd)]
    texts += [(100 + i, " ".join([*clean[i * 20 : i * 20 + 19], fill.join(clean[i])])) for i in range(10)]
    got = toxicity.score(spark.createDataFrame(texts, "doc_id long, text string"), machine).collect()
    assert {r.doc_id: r.predicted for r in got} == {r[0]: int(r[0] < 100) for r in texts}


def test_letters_that_stand_apart_are_one_string():
    texts = ["so w o r t h l e s s you", "i  d\t i\no   t", "a b", "ab c d e fg", "x y z"]
    words = toxicity.strings_of(toxicity.pa.array(texts, toxicity.pa.large_string()))
    got = [[words.distinct[i] for i in words.index[a:b]] for a, b in zip(words.bounds, words.bounds[1:])]
    assert got == [["so", "worthless", "you"], ["idiot"], ["a", "b"], ["ab", "cde", "fg"], ["xyz"]]


def test_training_strings_are_the_pieces_that_are_decided(spark):
    words = ["stupid!", "stupid", "", "**", "é" * 32, "x" * 33 + "hidden" + "y" * 40, "https://" + "ab" * 500]
    rows = spark.createDataFrame([(1, words)], "label int, words array<string>")
    got = [r.string for r in toxicity.labelled_strings(rows).collect()]
    want = {piece for w in words for piece in toxicity.pieces_of(w)} - {""}
    assert len(got) == len(set(got)) and set(got) == want
    assert any("hidden" in g for g in got)


def test_texts_that_share_a_passage_all_teach(spark):
    rng = random.Random(4)
    text = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passage = text(200)
    bodies = [(f"{text(100)} {passage}", i % 2) for i in range(40)]
    copies = [(bodies[0][0], 0)] * 5
    frame = spark.createDataFrame(bodies + copies, "text string, label int").repartition(4)
    words = toxicity.F.split(toxicity.F.lower("text"), r"\s+")
    got = [tuple(r) for r in toxicity.without_near_copies(frame, words).collect()]
    assert len(got) == len(set(got)) and set(got) <= set(bodies)
    assert len(got) >= 20 and {label for _, label in got} == {0, 1}


def test_sample_stays_bounded_where_ids_repeat(spark):
    rows = [(1, f"text {i}") for i in range(400)] + [(1, "text 0")] * 50 + [(None, "x"), (2, "two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)] * 20 + [(1, 0)] * 9 + [(2, 0), (None, 1)], "doc_id long, toxic int")
    sample = lambda most: toxicity.training_sample(docs, labels, "text", "doc_id", "toxic", most).collect()
    assert 10 <= len(sample(40)) <= 100
    known = {i for i in (1, 2) if toxicity.fold_of(i)}
    want = [(t, int(d == 1)) for d, t in {*rows} if d in known]
    assert 1 in known and sorted(map(tuple, sample(10_000))) == sorted(want)


def test_folds_are_those_of_crc32(spark):
    ids = spark.createDataFrame([(i,) for i in range(200)] + [(None,)], "doc_id long")
    for r in ids.select("doc_id", toxicity.held_out("doc_id").alias("out")).collect():
        assert r.out == (toxicity.fold_of(r.doc_id) == 0)


def test_tables_without_labels_or_with_one_class(spark, tables):
    docs, labels = tables
    few = docs.limit(20)
    for some in (labels.where("false"), labels.where("toxic = 0"), labels.where("toxic = 1")):
        scores = toxicity.score(few, toxicity.train(docs, some)).collect()
        assert all(0 <= r.score <= 1 for r in scores)
    for some in (labels.where("false"), labels.where("quality = 1")):
        scores = quality.score(few, quality.train(docs, some)).collect()
        assert all(0 <= r.score <= 1 for r in scores)


def accuracy(scores, labels, label):
    rows = scores.join(labels, "doc_id").where(toxicity.held_out("doc_id")).collect()
    return sum(r.predicted == r[label] for r in rows) / len(rows)


def test_held_out_toxicity(tables):
    docs, labels = tables
    assert accuracy(toxicity.score(docs, toxicity.train(docs, labels)), labels, "toxic") >= 0.9


def test_held_out_quality(tables):
    docs, labels = tables
    assert accuracy(quality.score(docs, quality.train(docs, labels)), labels, "quality") >= 0.95


def test_labels_of_held_out_rows_change_nothing(tables):
    docs, labels = tables
    swapped = labels.withColumn(
        "quality", quality.F.when(toxicity.held_out("doc_id"), 1 - quality.F.col("quality")).otherwise(quality.F.col("quality"))
    )
    x = np.random.default_rng(0).random((5, len(quality.FEATURES)))
    assert np.allclose(quality.train(docs, labels).margins(x), quality.train(docs, swapped).margins(x))


def test_model_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x, y)
    assert (0, 1) in model.pairs
    assert ((model.probability(x) > 0.5) == (y > 0)).mean() > 0.95


def test_margin_is_the_sum_of_table_entries():
    rng = np.random.default_rng(2)
    x = rng.random((300, 3))
    model = quality.fit(x, (x[:, 0] + x[:, 1] * x[:, 2] > 0.8).astype(float))
    for row, margin in zip(x[:20], model.margins(x[:20])):
        total = model.base + sum(t[np.searchsorted(c, v, side="right")] for c, t, v in zip(model.cuts, model.tables, row))
        for (i, j), t in model.pairs.items():
            a, b = (np.searchsorted(model.pair_cuts[k], row[k], side="right") for k in (i, j))
            total += t[a, b]
        assert margin == pytest.approx(total)


def test_quality_of_odd_texts(spark):
    model = quality.fit(np.random.default_rng(3).random((50, len(quality.FEATURES))), np.arange(50) % 2.0)
    rows = [(1, None, 1), (None, "", 1), (2, "x " * 50_000, 1), (2, "x " * 50_000, 1), (3, "\x00|é\n\n", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score int")
    assert quality.score(frame, model).count() == 5
    assert quality.score(frame.where("false"), model).count() == 0
