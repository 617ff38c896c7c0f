"""Token ids in Parquet files: list columns with dictionary encoding, small pages and page indexes.

Documents are dealt out by ranges of their id, sorted, encoded and written, so the files in order
hold the ids of all documents in ascending order. Row groups, pages and dictionary pages have set
sizes, and the writer adds column and offset indexes: a read of some ids or of the metadata
columns touches those pages only.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockmart.llm.token_ids import VOCABULARY, encoder
from stockmart.llm.words import slices, texts_of

END = 2
FILE_SCHEMA = "shard int, row long, doc_id long, n_tokens long, ids array<int>"
#: The dictionary page takes the whole vocabulary, so lists stay dictionary-encoded; columns for
#: which a dictionary does not pay, as ids of documents, turn to delta encoding in format version 2.
LAYOUT = {
    "parquet.writer.version": "v2",
    "parquet.enable.dictionary": "true",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "1000",
    "compression": "zstd",
}


def write_tokens(
    docs: DataFrame,
    path: str,
    text_col: str = "text",
    id_col: str = "doc_id",
    vocabulary: str = VOCABULARY,
    end: int = END,
) -> None:
    """Writes the ids of whole texts to ``path``, one row per document, in ascending id order.

    Null texts are empty and have the end id alone. Null ids come first; rows that repeat an id
    are in the order of their texts. Other columns are ignored. An empty table gives files without
    rows.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, row, words = TaskContext.get().partitionId(), 0, encoder(vocabulary)
        for batch in batches:
            for part in slices(batch, "text"):
                n = part.num_rows
                ids, bounds = words.of(texts_of(part, "text"), end)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, shard, np.int32)),
                        pa.array(np.arange(row, row + n)),
                        part.column("doc_id"),
                        pa.array(np.diff(bounds)),
                        pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.view(np.int32))),
                    ],
                    ["shard", "row", "doc_id", "n_tokens", "ids"],
                )
                row += n

    (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(encode, FILE_SCHEMA)
        .write.options(**LAYOUT)
        .parquet(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files; filters on ``doc_id`` skip row groups and pages, selections skip columns."""
    return spark.read.schema(FILE_SCHEMA).parquet(path)


def verify_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the ids read back.

    ``start`` counts the ids of all documents before: a running sum inside a file, and one over
    the files' totals, of which there is one row per file.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            crcs = [zlib.crc32(ids[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("shard", "row", "doc_id")),
                    pa.array(np.diff(bounds).astype(np.int64)),
                    pa.array(crcs, pa.int64()),
                ],
                ["shard", "row", "doc_id", "n_tokens", "ids_crc32"],
            )

    files = read_tokens(spark, path)
    found = files.select("shard", "row", "doc_id", "ids").mapInArrow(
        sums, "shard int, row long, doc_id long, n_tokens long, ids_crc32 long"
    )
    totals = files.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return (
        found.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(starts, "shard")
        .select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
    )
