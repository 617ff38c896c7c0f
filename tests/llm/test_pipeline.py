"""The pipeline against a brute-force version of its stages, and on odd tables."""

import os

import corpus_pipeline
from stockmart.llm import toxicity
from test_native import brute_contamination
from test_simhash import brute_components
from test_tokens import pieces_are_whole
from tokenizers import Tokenizer

import public_tokenizers

SMALL = "/root/testdata/sf0.001"


def brute(docs, items, machine_scores):
    docs = [d for d in docs if machine_scores[d] < 0.5]
    best = {}
    for doc, text in docs:
        best[text or ""] = max(doc, best.get(text or "", doc))
    docs = [d for d in docs if best[d[1] or ""] == d[0]]
    stay = {c for _, _, c in brute_components(docs)}
    docs = [d for d in docs if d[0] in stay]
    clean = {r[0] for r in brute_contamination(docs, items) if not r[2]}
    return [d for d in docs if d[0] in clean]


def test_pipeline_equals_brute_force(spark):
    read = lambda name: spark.read.parquet(f"{SMALL}/{name}.parquet")
    docs = [(r.doc_id, r.text) for r in read("documents").collect()]
    machine = toxicity.train(read("documents"), read("labels"))
    scores = {r.doc_id: r.score for r in toxicity.score(read("documents"), machine).collect()}
    left = brute(docs, [tuple(r) for r in read("benchmark").collect()], {d: scores[d[0]] for d in docs})
    assert 0 < len(left) < len(docs)
    encode = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode
    want = {doc: [*encode(text or "", add_special_tokens=False).ids, 1] for doc, text in left}
    pieces_are_whole(corpus_pipeline.run(spark, SMALL).collect(), want, 2048)


def test_stages_keep_the_columns_and_take_odd_tables(spark, tmp_path):
    folder = str(tmp_path)
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    rows = [(1, None, None, "s", 0, 7), (None, "", "en", None, None, 7), (2, "a b", "en", "s", 3, 7), (2, "a b", "en", "s", 3, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, digest int")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.where("false"), folder).count() == 0
        docs = corpus_pipeline.stored(stage(spark, docs, folder), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "digest"]
    # Both blank rows are equal, and one of the repeated rows stays.
    assert sorted((r.doc_id, r.text) for r in docs.collect()) == [(1, None), (2, "a b")]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == 2
    assert os.path.exists(f"{folder}/labels.parquet")
