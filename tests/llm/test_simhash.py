"""SimHash classes against brute force."""

import random

import numpy as np
import pytest
import xxhash

from stockmart.llm import simhash


def brute_fingerprint(text, size=4):
    words = [w for w in (text or "").translate(str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}))
             .replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, most=4):
    prints = [(doc, brute_fingerprint(text)) for doc, text in rows]
    up = list(range(len(prints)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i][1] ^ prints[j][1]).count("1") <= most:
                up[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(prints):
        known = least.get(root(i))
        least[root(i)] = doc if known is None else known if doc is None else min(known, doc)
    return sorted(((doc, f"{p:016x}", least[root(i)]) for i, (doc, p) in enumerate(prints)), key=str)


def rows():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(300)] + ["Ünd", "É", "x\xa0y"]
    out = [(None, None), (1, ""), (2, " \t\n"), (3, "one"), (3, "one"), (4, "One  TWO"), (5, "a b c d"), (6, "a b c d e" * 3000)]
    doc = 10
    for _ in range(25):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(3, 200))]
        for _ in range(rng.randint(1, 6)):
            out.append((doc, " ".join(words)))
            doc += 1
            words = list(words)
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
    return out


@pytest.mark.parametrize("part", [20_000, 3])
def test_components_equal_brute_force(spark, part):
    data = [(d, t, "s") for d, t in rows()]
    docs = spark.createDataFrame(data, "doc_id long, text string, fingerprint string").repartition(5)
    got = simhash.near_duplicates(docs, part=part).collect()
    assert sorted(map(tuple, got), key=str) == brute_components(rows())


def test_dense_buckets_equal_brute_force(spark):
    """Chains and clusters of fingerprints, connected through different buckets."""
    rng = random.Random(2)
    values = set()
    for _ in range(6):
        at = rng.getrandbits(64)
        for _ in range(120):
            for b in rng.sample(range(64), rng.randint(1, 5)):
                at ^= 1 << b
            values.add(at)
        centre = rng.getrandbits(64)
        values |= {centre ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(20)}
    values = np.array(sorted(values), np.uint64)
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fingerprint long")
    got = {r.node: r.root for r in simhash.components(simhash.near_links(frame, part=150)).collect()}
    up = {int(v): int(v) for v in values.view(np.int64)}

    def root(v):
        while up[v] != v:
            v = up[v]
        return v

    near = np.argwhere(np.bitwise_count(values[:, None] ^ values[None, :]) <= 4)
    for i, j in near[near[:, 0] < near[:, 1]]:
        a, b = root(int(values.view(np.int64)[i])), root(int(values.view(np.int64)[j]))
        up[max(a, b)] = min(a, b)
    assert {v: got.get(v, v) for v in up} == {v: root(v) for v in up}


def test_pivots_never_discard_near_pairs():
    rng = np.random.default_rng(0)
    pivots = rng.integers(0, 2**63, 16, dtype=np.uint64)
    a = rng.integers(0, 2**63, 500, dtype=np.uint64)
    b = a ^ (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64))
    difference = np.abs(simhash.distance_table(a, pivots) - simhash.distance_table(b, pivots)).max(axis=1)
    assert (difference <= np.bitwise_count(a ^ b)).all()


def test_one_row_of_each_component_stays(spark):
    docs = spark.createDataFrame([(d, t, None) for d, t in rows()], "doc_id long, text string, stay string")
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    want = {c for _, _, c in brute_components(rows())}
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(want, key=str)


def test_shared_and_null_ids_lose_no_document(spark):
    """Rows that share an id, or have none, stay unless they are near copies of one that stays."""
    rng = random.Random(5)
    text = lambda: " ".join(f"w{rng.randrange(5000)}" for _ in range(300))
    a, b = text(), text()
    near = a.rsplit(" ", 1)[0] + " other"
    assert bin(brute_fingerprint(a) ^ brute_fingerprint(near)).count("1") <= simhash.MOST_BITS
    lone = [text() for _ in range(6)]
    data = [(3, near), (7, a), (7, b), (None, a), (None, None), (8, None), *[(None, t) for t in lone], (None, lone[0]), (9, lone[1])]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in simhash.drop_near_duplicates(docs).collect()]
    want = [(3, near), (7, b), (8, None), (9, lone[1]), *[(None, t) for i, t in enumerate(lone) if i != 1]]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.drop_near_duplicates(docs).count() == 0
