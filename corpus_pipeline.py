"""The pipeline over ``documents``: clean, deduplicate, decontaminate, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet to
the shared folder and reads again as the next stage's docs. All but the last return the columns of
``documents``. SQL can't express the toxicity score or the token ids, so there is no SQL twin;
tests/llm/test_pipeline.py compares the rows with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stockmart.llm import decontaminate, exact_dedup, packing, simhash, toxicity
from stockmart.llm.common import stored

ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string-kernel machine scores 0.5 or more go."""
    machine = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, machine)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id stays."""
    return simhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten words in a row of a benchmark item, or a whole shorter item, go."""
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all that is left, in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = (
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
