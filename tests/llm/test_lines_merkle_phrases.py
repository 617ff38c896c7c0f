"""Line dedup, the Merkle manifest and collocations against brute force, on odd tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from stockmart.llm import collocations, line_dedup, merkle

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Line dedup ----------------------------------------------------------------------------------


def line_rows():
    rng = random.Random(5)
    common = [f"a line that many documents share, number {i}" for i in range(12)]
    odd = ["", "short", " \t", "É" * 19, "É" * 20, "x" * 19, "x" * 20, "Straße und İstanbul, lang genug"]
    rows = []
    for doc in range(60):
        lines = [rng.choice(common + odd) for _ in range(rng.randint(0, 12))]
        lines = [rng.choice(["", " ", "\t", "\x0b"]) + rng.choice([x, x.upper()]) + rng.choice(["", " ", "\r"]) for x in lines]
        rows.append((doc, "\n".join(lines)))
    rows += [(70, None), (71, ""), (72, "\n"), (73, "only " + common[0]), (74, "\n".join(common * 3000))]
    rows += [(75, common[1]), (75, common[1]), (75, common[1] + "\nother"), (None, common[2]), (None, common[2])]
    return rows + [(None, "a line of rows without an id, twenty and more")] * 3


def brute_lines(rows):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    held = defaultdict(list)
    for doc, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= 20:
                held[k].append(doc)
    keeper = {k: max((d for d in docs if d is not None), default=None) for k, docs in held.items() if len(docs) >= 3}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in keeper or keeper[key(x)] == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept), sha("\n".join(kept))))
    return sorted(out, key=str)


@pytest.mark.parametrize("batches, fan_in", [(4, 2), (5, 3), (1, 2)])
def test_lines_equal_brute_force(spark, batches, fan_in):
    rows = line_rows()
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, hash int, gone string")
    got = line_dedup.line_dedup(docs.repartition(5), batches=batches, fan_in=fan_in)
    assert sorted(map(tuple, got.collect()), key=str) == brute_lines(rows)


def test_lines_where_no_hash_is_heavy(spark, monkeypatch):
    rows = line_rows()
    monkeypatch.setattr(line_dedup, "HEAVY", 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, line_dedup.line_dedup(docs).collect()), key=str) == brute_lines(rows)


def test_lines_of_no_rows_and_text_ids(spark):
    assert line_dedup.line_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    line = "the very same line in three documents"
    docs = spark.createDataFrame([("a", line), ("b", line), ("c", line)], "doc_id string, text string")
    assert {r.doc_id: r.n_dropped for r in line_dedup.line_dedup(docs).collect()} == {"a": 1, "b": 1, "c": 0}


def test_runs_are_levelled_and_hold_each_hash_once(spark):
    runs = line_dedup.LineRuns(spark, fan_in=2, buckets=3)
    batches = [[(b"a", 9), (b"b", 9), (b"a", 8)], [(b"b", 7), (b"c", 7)], [(b"a", 6), (b"d", 5)]]
    fresh = []
    for batch in batches:
        new = runs.add(spark.createDataFrame([(bytearray(h), i) for h, i in batch], "hash binary, id long"))
        fresh.append({bytes(r.hash): r.keeper for r in new.collect()})
    assert fresh == [{b"a": 9, b"b": 9}, {b"c": 7}, {b"d": 5}]
    assert [len(level) for level in runs.levels] == [1, 1]
    got = {bytes(r.hash): (r.n, r.keeper) for r in runs.whole().collect()}
    assert got == {b"a": (3, 9), b"b": (2, 9), b"c": (1, 7), b"d": (1, 5)}
    runs.drop()


# Merkle manifest -----------------------------------------------------------------------------


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def brute_tree(nodes):
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, path in enumerate(paths):
            other = at[i] ^ 1
            path.append((at[i] & 1, nodes[other] if other < len(nodes) else None))
            at[i] >>= 1
        nodes = [sha("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
    return nodes[0], paths


def brute_manifest(rows):
    leaf = lambda r, add=0: sha("".join(map(field, (*r[:3], None if r[3] is None else r[3] + add, r[4]))))
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        held = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((held, *brute_tree([leaf(r) for r in held])))
    root, upper = brute_tree([t[1] for t in trees])
    out = []
    for (held, subroot, paths), above in zip(trees, upper):
        for r, path in zip(held, paths):
            touched = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            now = leaf(r, 1 if touched else 0)
            for side, other in path + above:
                now = sha(now) if other is None else sha(other + now if side else now + other)
            proof = sha("".join(o for _, o in path + above if o))
            out.append((r[0], leaf(r), subroot, root, proof, now, now == root))
    return sorted(out, key=str)


def manifest_rows():
    rng = random.Random(2)
    rows = [(i, rng.choice("ab"), rng.choice(["en", "de", None, "", "É"]), rng.choice([None, 5]), rng.choice([None, "", "É" * 9])) for i in range(150)]
    rows += [(i, None, "en", 1, "x") for i in range(200, 340)] + [(500, "s", "one", 3, "alone")]
    rows += [(501, "s", "two", 3, "same")] * 2 + [(None, None, None, None, None), (None, "b", "en", 7, "long " * 50_000)]
    return rows


@pytest.mark.parametrize("span, block", [(1, 2), (2, 3), (3, 2), (8, 12)])
def test_manifest_equals_brute_force(spark, span, block):
    rows = manifest_rows()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, tree string, pos int")
    got = merkle.verify(docs.repartition(4), span, block)
    assert sorted(map(tuple, got.collect()), key=str) == brute_manifest(rows)


def test_manifest_of_small_tables(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    assert merkle.verify(spark.createDataFrame([], schema)).count() == 0
    one = [(3, "s", "en", 1, "t")]
    assert [tuple(r) for r in merkle.verify(spark.createDataFrame(one, schema)).collect()] == brute_manifest(one)


# Collocations --------------------------------------------------------------------------------


def phrase_rows():
    rng = random.Random(4)
    vocabulary = ["the", "of", "Été", "x1", "it's", "日本", "w" * 300, "\x01", "a\x1cb"] + [f"v{i}" for i in range(8)]
    rows = []
    for i in range(120):
        words = [rng.choice(vocabulary[: rng.randint(2, len(vocabulary))]) for _ in range(rng.randint(0, 40))]
        glue = [rng.choice([" ", " ", " ", "\t ", ", ", ".", "\n", " "]) for _ in words]
        rows.append((i, rng.choice(["en", "de", None]), "".join(w + g for w, g in zip(words, glue)).upper()))
    rows += [(200, "en", None), (201, "en", ""), (202, None, "...!?"), (203, "und", "new york city " * 15), (204, "en", "of of of of " * 40)]
    return rows + [(205, "xx", "rare words here")] * 2 + [(206, "yy", "a b c d " * 20_000)]


def brute_phrases(rows, least, longest, top):
    n, f = Counter(), Counter()
    for _, lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for s in range(len(words) - k + 1):
                    f[lang, tuple(words[s : s + k])] += 1
    out = []
    for lang in n:
        best = []
        for (held, p), a in f.items():
            if held != lang or len(p) < 2 or a < least:
                continue
            cuts = [(1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            longer = (
                b for (o, q), b in f.items()
                if o == lang and len(q) > len(p) and b >= least and any(q[s : s + len(p)] == p for s in range(len(q)))
            )
            if not any(100 * b >= 50 * a for b in longer):
                best.append((-score, -a, " ".join(p).encode(), " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
        out += [(lang, i + 1, *b[3:]) for i, b in enumerate(sorted(best)[:top])]
    return sorted(out, key=str)


@pytest.mark.parametrize("longest, top, shard, tries", [(3, 2000, 1 << 19, 4), (3, 5, 7, 2), (4, 2000, 50, 3), (2, 2000, 20, 1)])
def test_collocations_equal_brute_force(spark, longest, top, shard, tries):
    rows = phrase_rows()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, lang string, text string, n int").repartition(5)
    got = collocations.collocations(docs, least=6, longest=longest, top=top, shard=shard, tries=tries)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_phrases(rows, 6, longest, top)


def test_collocations_of_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert collocations.collocations(none).count() == 0
    rare = spark.createDataFrame([(1, "en", "one two"), (2, None, None)], "doc_id long, lang string, text string")
    assert collocations.collocations(rare).count() == 0


def test_scores_pass_64_bits(spark):
    rows = [("en", "a", 3 * 10**12), ("en", "b", 2 * 10**12), ("en", "a b", 10**12), ("en", "c", 10**12), ("en", "b c", 10**12), ("en", "a b c", 10**12)]
    counts = spark.createDataFrame(rows, "lang string, phrase string, n long")
    got = {r.phrase: (r.l, r.r, r.score) for r in collocations.scored(counts).collect()}
    assert got["a b"] == (3 * 10**12, 2 * 10**12, 166666)
    assert got["a b c"] == (3 * 10**12, 10**12, 333333)
    assert {r.phrase for r in collocations.uncovered(collocations.scored(counts), 3, 50).collect()} == {"a b c"}


def test_tries_hold_what_they_are_given():
    import pyarrow as pa

    rng = random.Random(8)
    phrases = sorted({(rng.choice(["en", "de"]), " ".join(f"w{rng.randint(0, 400)}" for _ in range(rng.randint(1, 3)))) for _ in range(4000)})
    trie = collocations.Trie([x for x, _ in phrases], [p for _, p in phrases])
    texts = [p for _, p in phrases] + ["w1 w2 w3 w4 unknown w5"]
    langs = [x for x, _ in phrases] + ["fr"]
    tokens = collocations.Tokens(pa.array(texts, pa.large_string()), pa.array(langs))
    want = Counter()
    known = {k: i for i, k in enumerate(phrases)}
    for lang, text in zip(langs, texts):
        words = text.split()
        for k in (1, 2, 3):
            for s in range(len(words) - k + 1):
                if (lang, " ".join(words[s : s + k])) in known:
                    want[known[lang, " ".join(words[s : s + k])]] += 1
    assert np.array_equal(trie.count(tokens, len(phrases)), [want[i] for i in range(len(phrases))])


def test_phrase_counts_are_handed_over_once_per_core(spark):
    phrases = ["alpha beta", "beta gamma", "alpha beta gamma"]
    trie = collocations.Trie(["en"] * len(phrases), phrases)
    cores = spark.sparkContext.defaultParallelism
    texts = spark.range(0, 400, 1, 10 * cores).selectExpr("'en' as lang", "'alpha beta gamma' as text")
    shared = spark.sparkContext.broadcast({0: (trie, len(phrases))})
    rows = collocations.walked(texts, shared).collect()
    shared.destroy()
    assert len(rows) <= len(phrases) * cores
    found = Counter()
    for row in rows:
        found[row.shard, row.id] += row.n
    assert found == {(0, i): 400 for i in range(len(phrases))}
