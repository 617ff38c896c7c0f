"""What several of these operators need: the shared folder, row keys, and text columns."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting, as in tests, gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="llm-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/llm-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """``df`` written to the shared folder, in a folder per value of ``by``, and read back.

    What is read several times is computed once, the lineage is cut, and a lost executor takes
    nothing with it.
    """
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path, partitionBy=by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str) -> Column:
    """The text, or an empty one for null."""
    return F.coalesce(F.col(column), F.lit(""))


def row_key(id_col: str, text_col: str) -> Column:
    """Key of a document row: its id, which may be null or repeated, and a digest of its text.

    Rows that agree in id and text agree in everything these operators say about them.
    """
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("digest"))


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def lower_ascii(word: Column) -> Column:
    """A-Z lower-cased and nothing else. Most words need nothing, and plain ASCII the short way."""
    plain = F.octet_length(word) == F.length(word)
    full = F.translate(word, UPPER, UPPER.lower())
    return F.when(F.lower(word) == word, word).otherwise(F.when(plain, F.lower(word)).otherwise(full))
