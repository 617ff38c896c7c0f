"""Named tables and the scan filters of the loads."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockmart.params import EnumSet, NaParams


class TableSet(Mapping[str, DataFrame]):
    """Tables by name, opened on first use so that a job touches only what it reads."""

    def __init__(self, openers: Mapping[str, Callable[[], DataFrame]]):
        self._openers = dict(openers)
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self._openers[name]()
        return self._open[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._openers)

    def __len__(self) -> int:
        return len(self._openers)

    def replacing(self, **frames: DataFrame) -> TableSet:
        """The same tables with some of them exchanged, e.g. for one micro-batch."""
        openers = dict(self._openers)
        for name, frame in frames.items():
            openers[name] = lambda frame=frame: frame
        return TableSet(openers)

    def na_params(self) -> NaParams:
        return NaParams.load(self["etl_params"])

    def enums(self, *names: str) -> EnumSet:
        return EnumSet.load(self["enum_values"], names)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def folder_tables(spark: SparkSession, root: str, names: list[str]) -> TableSet:
    """Parquet tables ``<root>/<name>.parquet``."""
    return TableSet({n: (lambda n=n: read_table(spark, root, n)) for n in names})


def frame_tables(**frames: DataFrame) -> TableSet:
    return TableSet({n: (lambda f=f: f) for n, f in frames.items()})


def incremental(
    df: DataFrame,
    execution_id: str | None,
    enabled: bool,
    tag: Column | None = None,
    null_id_means_all: bool = False,
) -> DataFrame:
    """Rows of one batch, or all rows of a full load.

    With ``null_id_means_all`` a missing batch id also reads everything; without it an incremental
    load lacking an id reads nothing, as an equality with NULL would.
    """
    if not enabled or (execution_id is None and null_id_means_all):
        return df
    if execution_id is None:
        return df.filter(F.lit(False))
    return df.filter((F.col("execution_id") if tag is None else tag) == F.lit(execution_id))


def live(df: DataFrame, marker: str = "data_lake_modified") -> DataFrame:
    """Rows that carry a data lake modification time."""
    return df.filter(F.col(marker).isNotNull())
