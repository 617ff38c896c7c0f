"""Long plans in steps, so that the disk never holds the shuffle files of a whole job."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from stockmart.session import freeing_shuffles


def file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a work folder made by a merge or a step."""
    folder, files = file_system(spark, path)
    files.delete(folder, True)


def write(rows: DataFrame, path: str) -> None:
    """Write a new folder without leaving shuffle files behind."""
    with freeing_shuffles(rows.sparkSession):
        rows.write.mode("error").option("compression", "zstd").parquet(path)


class Steps:
    """Writes what it is called with below ``root`` and reads it back.

    A step reads the one before it and no older one, which goes as soon as the next is written. So
    the disk holds the shuffle files of one step beside what that step reads and writes.
    ``branch`` starts a chain of its own, whose steps leave those of other chains alone. Whoever
    names ``root`` removes it at the end.
    """

    def __init__(self, root: str):
        self._root = root
        self._last: str | None = None

    def __call__(self, rows: DataFrame) -> DataFrame:
        spark = rows.sparkSession
        path = f"{self._root}/step-{uuid.uuid4().hex}"
        write(rows, path)
        before, self._last = self._last, path
        if before is not None:
            remove_folder(spark, before)
        return spark.read.schema(rows.schema).parquet(path)

    def branch(self) -> Steps:
        return Steps(self._root)
