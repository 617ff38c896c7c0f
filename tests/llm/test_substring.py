"""Removal of repeated windows against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from stockmart.llm import substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, window):
    """docs: (id, text); ids differ here but for rows that repeat id and text."""
    first = {}
    split = {}
    for doc, text in docs:
        split[doc] = WORD.findall(text or "")
    order = sorted(split, key=lambda d: (d is not None, d or 0))
    gone = {d: set() for d in split}
    for doc in order:
        w = split[doc]
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            if key in first:
                gone[doc] |= set(range(s, s + window))
            else:
                first[key] = (doc, s)
    out = []
    for doc, _ in docs:
        kept = [x for i, x in enumerate(split[doc]) if i not in gone[doc]]
        out.append((doc, len(split[doc]), len(gone[doc]), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def documents():
    rng = random.Random(4)
    vocabulary = ["a", "b", "The", "été", "日", "x\xa0y", "c", "d"]
    make = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    shared = [make(rng.randint(20, 60)) for _ in range(4)]
    docs = [(None, "a b " * 40), (0, None), (1, ""), (2, " \t\n"), (3, "be " * 100), (4, "be " * 30), (5, "x " * 19), (6, "x " * 20)]
    for i in range(10, 50):
        parts = make(rng.randint(0, 25))
        for _ in range(rng.randint(0, 3)):
            whole = rng.choice(shared)
            a = rng.randrange(len(whole))
            parts += whole[a : a + rng.randint(5, 60)] + make(rng.randint(0, 9))
        docs.append((i, rng.choice([" ", "  ", "\n"]).join(parts)))
    return docs + [docs[-1], docs[-2], (60, docs[-1][1])]


@pytest.mark.parametrize("window,piece,crowd", [(20, 5, 5000), (20, 5, 2), (6, 3, 4), (4, 4, 5000)])
def test_repeats_equal_brute_force(spark, window, piece, crowd):
    rows = [(d, t, "x") for d, t in documents()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bucket string").repartition(5)
    got = substring_dedup.substring_dedup(docs, window=window, piece=piece, crowd=crowd).drop("kept")
    assert sorted(map(tuple, got.collect()), key=str) == brute(documents(), window)


def test_rows_that_share_an_id_only(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text), (1, text + " more"), (2, text)], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_removed) for r in substring_dedup.substring_dedup(docs).collect())
    # One of the two rows of document 1 keeps the passage, whichever hash is less.
    assert got == [(1, 0), (1, 30), (2, 30)]


def test_super_kmers_cover_each_window_once():
    import pyarrow as pa

    texts = pa.array([t or "" for _, t in documents()], pa.large_string())
    words = substring_dedup._words(texts)
    owner, start, n, _ = substring_dedup.super_kmers(words, 20, 5)
    covered = sorted((o, s + k) for o, s, c in zip(owner, start, n) for k in range(c))
    sizes = words.bounds[1:] - words.bounds[:-1]
    assert covered == [(i, s) for i, size in enumerate(sizes) for s in range(max(0, size - 19))]
    assert n.max() <= 16


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert substring_dedup.substring_dedup(docs).count() == 0


def test_null_ids_with_texts_of_one_short_hash(spark):
    """Texts that a 32-bit hash takes for one are documents of their own."""
    shared = " ".join(f"shared{i}" for i in range(25))
    texts = spark.range(300_000).select(F.concat(F.lit(shared + " end"), F.col("id").cast("string")).alias("text"))
    alike = texts.groupBy(F.hash("text")).agg(F.collect_list("text").alias("texts")).where("size(texts) > 1")
    pair = alike.orderBy(F.col("texts")[0]).first()["texts"][:2]
    docs = spark.createDataFrame([(None, t) for t in pair], "doc_id long, text string")
    got = substring_dedup.substring_dedup(docs).collect()
    assert sorted(r.n_removed for r in got) == [0, 25]
    assert {r.doc_id for r in got} == {None}
