"""Exact deduplication by skew-safe combining.

Rows are first deduplicated where they are read, then salted digest groups are merged, and at
last the winners of the salts are combined. Each of the three compares full texts: the grouping
key holds the text itself, and the digest only deals out the rows. The first step is the partial
aggregation of the second, so a text repeated in a third of all rows leaves each task once, and
its salts meet as at most ``salts`` rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockmart.llm.common import stored, text_of

SALTS = 8


def _keyed(docs: DataFrame, text_col: str, id_col: str, salts: int) -> DataFrame:
    text = text_of(text_col)
    return docs.select(
        F.col(id_col).alias("doc"),
        text.alias("content"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.pmod(F.xxhash64(id_col), F.lit(salts)).alias("salt"),
    )


def copy_groups(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", salts: int = SALTS
) -> DataFrame:
    """One row per distinct text: digest, keep_id, group_size, and how many texts share the digest.

    ``content`` is null but for digests that several texts share.
    """
    local = (
        _keyed(docs, text_col, id_col, salts)
        .groupBy("digest", "salt", "content")
        .agg(F.max("doc").alias("doc"), F.count(F.lit(1)).alias("n"))
    )
    # Dealt by digest alone, so that different texts of one digest are seen together.
    whole = (
        local.repartition("digest")
        .groupBy("digest", "content")
        .agg(F.max("doc").alias("keep_id"), F.sum("n").alias("group_size"))
        .withColumn("texts", F.count(F.lit(1)).over(Window.partitionBy("digest")))
        .withColumn("content", F.when(F.col("texts") > 1, F.col("content")))
    )
    return whole


def mark_copies(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", salts: int = SALTS
) -> DataFrame:
    """For each row: its id as ``doc_id``, keep_id, group_size, kept and text_sha256.

    A null text counts as empty. The largest id of a group stays; null ids are smaller than all
    others, and a group of null ids only has a null ``keep_id``, which equals them. Rows that
    repeat both id and text are one document given more than once: all of them carry its flag
    (``drop_copies`` leaves one). An empty table gives no rows; other columns are ignored.
    """
    groups = stored(copy_groups(docs, text_col, id_col, salts), "copy-groups")
    rows = _keyed(docs, text_col, id_col, salts).select("doc", "digest", "content")
    single = groups.where("texts = 1").drop("content", "texts")
    marked = rows.drop("content").join(single, "digest")
    shared = groups.where("texts > 1").drop("texts")
    if not shared.isEmpty():
        # Only for digests that different texts share are the texts themselves joined.
        marked = marked.unionByName(rows.join(shared, ["digest", "content"]).drop("content"))
    return marked.select(
        F.col("doc").alias("doc_id"),
        "keep_id",
        "group_size",
        F.col("doc").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", salts: int = SALTS
) -> DataFrame:
    """The rows that stay, one per distinct text, with all their columns.

    The winner of a group is carried along as a whole row, so exactly one row stays even where ids
    repeat or are null.
    """
    text = text_of(text_col)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    order = F.struct(F.col(id_col).isNotNull(), F.col(id_col))
    local = (
        docs.select(
            F.unhex(F.sha2(text, 256)).alias("digest"),
            F.pmod(F.xxhash64(id_col), F.lit(salts)).alias("salt"),
            text.alias("content"),
            row.alias("row"),
            order.alias("order"),
        )
        .groupBy("digest", "salt", "content")
        .agg(F.max_by("row", "order").alias("row"), F.max("order").alias("order"))
    )
    winners = local.groupBy("digest", "content").agg(F.max_by("row", "order").alias("row"))
    return winners.select("row.*")
