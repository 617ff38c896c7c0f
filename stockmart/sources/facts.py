"""Fact tables as partitioned parquet, and the merge that rewrites only touched partitions."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockmart.operators import merge
from stockmart.schemas import empty
from stockmart.session import freeing_shuffles, work_dir
from stockmart.steps import Steps, file_system, remove_folder, write

_TAGS = (merge.ACTION, merge.ROW_ID)


@dataclass(frozen=True)
class LoadResult:
    inserted: int = 0
    updated: int = 0
    unchanged: int = 0
    deleted: int = 0
    #: Partition values that were rewritten; no part of what two results are compared by.
    partitions: frozenset = field(default=frozenset(), compare=False)

    @property
    def rows(self) -> int:
        """Affected rows of the merge; removed orphans are not counted."""
        return self.inserted + self.updated

    def __add__(self, other: LoadResult) -> LoadResult:
        return LoadResult(
            self.inserted + other.inserted, self.updated + other.updated,
            self.unchanged + other.unchanged, self.deleted + other.deleted,
            self.partitions | other.partitions,
        )


def month_of(column: str) -> Column:
    """Partition value of a date: 199806. Undated rows share partition 0."""
    return F.coalesce(F.year(column) * 100 + F.month(column), F.lit(0))


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a job has finished writing the folder."""
    done, files = file_system(spark, f"{path}/_SUCCESS")
    return files.exists(done)


@dataclass(frozen=True)
class FactTable:
    """A parquet folder partitioned by ``partition_columns``.

    ``partition_by`` derives partition columns that are not part of the schema from a row.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    surrogate: str | None
    partition_columns: tuple[str, ...]
    partition_by: dict[str, Column] = field(default_factory=dict)

    def create(self) -> None:
        """Write the empty table; an existing one is an error."""
        self._placed(empty(self.spark, self.schema)).write.mode("error").partitionBy(
            *self.partition_columns
        ).parquet(self.path)

    def replace(self, rows: DataFrame) -> None:
        """Write the whole table anew, without surrogate keys; for facts that are rebuilt."""
        full = empty(self.spark, self.schema).unionByName(rows, allowMissingColumns=True)
        with freeing_shuffles(self.spark):
            self._placed(full).hint("rebalance", *self.partition_columns).write.mode(
                "overwrite"
            ).option("compression", "zstd").partitionBy(*self.partition_columns).parquet(self.path)

    def stored_schema(self) -> T.StructType:
        derived = [T.StructField(c, T.IntegerType()) for c in self.partition_by]
        return T.StructType([*self.schema.fields, *derived])

    def read(self) -> DataFrame:
        """All rows with the declared schema plus derived partition columns."""
        return self.spark.read.schema(self.stored_schema()).parquet(self.path)

    def rows(self) -> DataFrame:
        return self.read().select(*self.schema.names)

    def _placed(self, df: DataFrame) -> DataFrame:
        return df.withColumns(self.partition_by) if self.partition_by else df

    def _folder(self, values: Sequence) -> str:
        parts = [f"{c}={v}" for c, v in zip(self.partition_columns, values)]
        return "/".join([self.path, *parts])

    def _scratch(self) -> str:
        base = work_dir(self.spark, self.path.rstrip("/") + "__work")
        return f"{base}/merge-{uuid.uuid4().hex}"

    @contextmanager
    def steps(self) -> Iterator[Steps]:
        """Steps of a load into this table; their folder goes at the end, also when it fails."""
        root = self._scratch()
        try:
            yield Steps(root)
        finally:
            remove_folder(self.spark, root)

    def _partitions(self, df: DataFrame) -> set[tuple]:
        """Distinct partition values; the driver lists the folders of a table in any case."""
        found = df.select(*self.partition_columns).distinct().collect()
        return {tuple(r) for r in found}

    def _only(self, df: DataFrame, values: set[tuple]) -> DataFrame:
        """Rows of the given partitions, as a filter on partition columns that prunes the scan."""
        return df.filter(self._held(values))

    def _held(self, values: set[tuple]) -> Column:
        if len(self.partition_columns) == 1:
            return F.col(self.partition_columns[0]).isin([v[0] for v in values])
        test = F.lit(False)
        for value in values:
            same = F.lit(True)
            for c, v in zip(self.partition_columns, value):
                same = same & (F.col(c) == F.lit(v))
            test = test | same
        return test

    def merge(
        self,
        source: DataFrame,
        keys: Sequence[str],
        compare: Sequence[str] | None = None,
        on_update: dict[str, Column] | None = None,
        on_insert: dict[str, Column] | None = None,
        update_columns: Sequence[str] | None = None,
        insert: bool = True,
        gone: Callable[[DataFrame], DataFrame] | None = None,
        archive: FactTable | None = None,
        on_touch: Callable[[set[tuple]], None] | None = None,
    ) -> LoadResult:
        """Merge ``source`` and rewrite the partitions that hold touched rows.

        ``gone`` returns the rows of a frame whose source record no longer exists; with it these
        orphans are removed in the same rewrite. Source rows whose key ``archive`` holds are merged
        there, without inserts, so that an archived record does not come back, and orphans are
        removed there as well. A move to the archive that was interrupted is finished first.
        ``on_touch`` is told the partitions before they change. The steps read and write shared
        storage, so lost executors only repeat tasks:

        1. the source is written once, since several steps read it;
        2. touched partitions are those of source rows, of their old rows, and of orphans;
        3. the merged partitions are written to the work folder, because the table is still read;
        4. new surrogate keys are added and the partitions are overwritten from there.
        """
        if archive is not None:
            archive.finish_move(self)
        scratch = self._scratch()
        try:
            return self._merge(scratch, source, keys, compare, on_update, on_insert,
                               update_columns, insert, gone, archive, on_touch)
        finally:
            remove_folder(self.spark, scratch)

    def _merge(self, scratch, source, keys, compare, on_update, on_insert, update_columns, insert,
               gone, archive, on_touch) -> LoadResult:
        placed = self._placed(source) if set(self.partition_by) - set(source.columns) else source
        write(placed, f"{scratch}/source")
        staged = self.spark.read.parquet(f"{scratch}/source")
        merge.assert_unique(staged, keys)
        archived = LoadResult()
        if archive is not None:
            # Stored, as the archive's files change before the other rows are read.
            known = archive.read().select(*keys)
            write(staged.join(known, list(keys), "left_semi"), f"{scratch}/archived")
            cold = self.spark.read.schema(staged.schema).parquet(f"{scratch}/archived")
            archived = archive.merge(
                cold, keys, compare, on_update, update_columns=update_columns, insert=False,
                gone=gone, on_touch=on_touch,
            )
            staged = staged.join(cold.select(*keys), list(keys), "left_anti")

        current = self.read()
        old = current.select(*dict.fromkeys([*keys, *self.partition_columns]))
        hit = old.join(staged.select(*keys), list(keys), "left_semi")
        touched = self._partitions(hit)
        if insert:
            touched |= self._partitions(staged)
        orphans = None
        if gone is not None:
            lost = gone(current).select(self.surrogate, *self.partition_columns)
            write(lost, f"{scratch}/orphans")
            orphans = self.spark.read.parquet(f"{scratch}/orphans")
            touched |= self._partitions(orphans)
        if not touched:
            return archived
        if on_touch is not None:
            on_touch(touched)

        before = self._only(current, touched)
        deleted = 0
        target = before.select(*self.schema.names)
        if orphans is not None:
            deleted = orphans.count()
            target = target.join(orphans.select(self.surrogate), self.surrogate, "left_anti")
        fields = [c for c in staged.columns if c in self.schema.names]
        if insert:
            merged = merge.upsert(target, staged.select(*fields), keys, compare, on_update,
                                  on_insert, update_columns)
        else:
            merged = merge.update_only(target, staged.select(*fields), keys, compare, on_update,
                                       update_columns)
        write(merge.tag_rows(merged), f"{scratch}/merged")
        for read in ("source", "archived", "orphans"):
            remove_folder(self.spark, f"{scratch}/{read}")
        written = self.spark.read.parquet(f"{scratch}/merged")
        counts = {r[merge.ACTION]: r["rows"] for r in merge.action_counts(written).collect()}
        final = written
        if self.surrogate:
            start = merge.next_start(current, self.surrogate)
            final = merge.assign_surrogate_keys(
                written, self.surrogate, F.col(merge.ACTION) == merge.INSERT, start
            )
        self._overwrite(final.drop(*_TAGS), touched, self._partitions(self._placed(written)))
        return archived + LoadResult(
            counts.get(merge.INSERT, 0), counts.get(merge.UPDATE, 0),
            counts.get(merge.UNCHANGED, 0), deleted, frozenset(touched),
        )

    def _overwrite(self, rows: DataFrame, touched: set[tuple], filled: set[tuple]) -> None:
        """Replace the touched partitions. One that lost all its rows is overwritten as empty."""
        placed = self._placed(rows)
        # Rebalancing spreads a large partition over several tasks and merges small ones.
        with freeing_shuffles(self.spark):
            placed.hint("rebalance", *self.partition_columns).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).option("compression", "zstd").partitionBy(*self.partition_columns).parquet(self.path)
        self._empty(touched - filled)

    def _empty(self, partitions: set[tuple]) -> None:
        inner = [f for f in self.schema.fields if f.name not in self.partition_columns]
        for values in sorted(partitions):
            empty(self.spark, T.StructType(inner)).write.mode("overwrite").parquet(
                self._folder(values)
            )

    def replace_partitions(self, rows: DataFrame, values: set[tuple]) -> None:
        """The given partitions hold ``rows`` and nothing else from now on."""
        scratch = self._scratch()
        try:
            write(rows, scratch)
            staged = self.spark.read.schema(rows.schema).parquet(scratch)
            self._overwrite(staged, values, self._partitions(self._placed(staged)))
        finally:
            remove_folder(self.spark, scratch)

    # Moving old partitions to an archive --------------------------------------------------------

    @property
    def _move(self) -> str:
        """Folder of a move into this table: its ``rows``, and then ``partitions``, its commit."""
        return self.path.rstrip("/") + "__move"

    def moving(self) -> set[tuple]:
        """Partitions of a move into this table that is committed and not finished."""
        if not is_written(self.spark, f"{self._move}/partitions"):
            return set()
        return {tuple(r) for r in self.spark.read.parquet(f"{self._move}/partitions").collect()}

    def _moved_rows(self) -> DataFrame:
        return self.spark.read.schema(self.stored_schema()).parquet(f"{self._move}/rows")

    def archive_before(
        self, archive: FactTable, limit: dt.date, keys: Sequence[str], undated: dt.date
    ) -> int:
        """Move whole months before ``limit`` to another table of the same layout.

        The month of ``undated``, the date that stands for no date, stays. Rows that the archive
        has of those months are kept, but for records that the detail holds as well. Returns the
        rows those months now have in the archive.

        The new content of the archive's months is staged beside it, and then committed by a list
        of the months. Until that list is complete nothing has happened. From then on
        :func:`history` reads the staged rows for those months, and the move is finished by
        whichever load or move comes next, by steps that can be repeated.
        """
        archive.finish_move(self)
        (column,) = self.partition_columns
        first_kept, no_date = (d.year * 100 + d.month for d in (limit, undated))
        month = F.col(column)
        old = self.read().filter((month < first_kept) & (month > 0) & (month != no_date))
        moved = self._partitions(old)
        if not moved:
            return 0
        remove_folder(self.spark, archive._move)  # what is left of a move without a commit
        earlier = archive._only(archive.read(), moved)
        kept = earlier.join(old.select(*keys), list(keys), "left_anti")
        write(old.unionByName(kept), f"{archive._move}/rows")
        rows = archive._moved_rows().count()
        listed = self.spark.createDataFrame(sorted(moved), ", ".join(f"{c} int" for c in self.partition_columns))
        listed.write.parquet(f"{archive._move}/partitions")
        archive.finish_move(self)
        return rows

    def finish_move(self, source: FactTable) -> None:
        """Finish a committed move of partitions from ``source`` into this table, if there is one."""
        moved = self.moving()
        if not moved:
            return
        rows = self._moved_rows()
        self._overwrite(rows.select(*self.schema.names), moved, self._partitions(rows))
        source._empty(moved)
        # The commit goes first, so that the rows are never read without it.
        remove_folder(self.spark, f"{self._move}/partitions")
        remove_folder(self.spark, self._move)


def history(fact: FactTable, archive: FactTable | None = None) -> DataFrame:
    """All rows of detail and archive, each once, also in the middle of a move between them."""
    if archive is None:
        return fact.read()
    moved = archive.moving()
    if not moved:
        return fact.read().unionByName(archive.read())
    detail, cold = (t.read().filter(~t._held(moved)) for t in (fact, archive))
    return detail.unionByName(cold).unionByName(archive._moved_rows())


# Derived partition column of the transaction facts.
MONTH = "transaction_month"


def monthly_fact(
    spark: SparkSession, path: str, schema: T.StructType, surrogate: str
) -> FactTable:
    """A transaction fact partitioned by the month of its transaction date."""
    return FactTable(spark, path, schema, surrogate, (MONTH,), {MONTH: month_of("transaction_date")})
