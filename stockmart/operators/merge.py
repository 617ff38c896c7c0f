"""Upserts, orphan removal and surrogate keys on plain tables.

An upsert is one full outer join on the merge key that yields the new table content plus an
``_action`` column. Both sides are hash partitioned by the merge key, so orphan removal, duplicate
check and upsert planned together shuffle each side once. Merge keys are record ids or full
dimension tuples and therefore spread evenly.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACTION = "_action"
INSERT = "insert"
UPDATE = "update"
UNCHANGED = "unchanged"  # matched, but equal in every compared column
KEEP = "keep"  # no source row


class DuplicateKeyError(ValueError):
    """Several source rows claim the same target row."""


def row_changed(columns: Sequence[str], source: str = "s", target: str = "t") -> Column:
    """True when any column differs; two NULLs count as equal."""
    left = F.struct(*[F.col(f"{source}.{c}") for c in columns])
    right = F.struct(*[F.col(f"{target}.{c}") for c in columns])
    return ~left.eqNullSafe(right)


def _matched_on(keys: Sequence[str]) -> Column:
    test = None
    for k in keys:
        part = F.col(f"t.{k}") == F.col(f"s.{k}")
        test = part if test is None else test & part
    return test


def _merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    how: str,
    compare: Sequence[str] | None,
    on_update: Mapping[str, Column],
    on_insert: Mapping[str, Column],
    update_columns: Sequence[str] | None,
) -> DataFrame:
    t = target.withColumn("_in_target", F.lit(True)).alias("t")
    s = source.withColumn("_in_source", F.lit(True)).alias("s")
    in_target = F.col("t._in_target").isNotNull()
    in_source = F.col("s._in_source").isNotNull()
    changed = row_changed(compare) if compare is not None else F.lit(True)
    action = (
        F.when(in_source & ~in_target, F.lit(INSERT))
        .when(in_source & changed, F.lit(UPDATE))
        .when(in_source, F.lit(UNCHANGED))
        .otherwise(F.lit(KEEP))
    )
    joined = t.join(s, _matched_on(keys), how).withColumn(ACTION, action)
    inserting = F.col(ACTION) == INSERT
    updating = F.col(ACTION) == UPDATE
    updatable = set(source.columns if update_columns is None else update_columns) - set(keys)

    def value(column: str) -> Column:
        mine = F.col(f"t.{column}")
        theirs = F.col(f"s.{column}") if column in source.columns else None
        data_type = target.schema[column].dataType
        if column in on_update or column in on_insert:
            new = on_insert.get(column, theirs if theirs is not None else F.lit(None))
            out = F.when(inserting, new.cast(data_type))
            if column in on_update:
                out = out.when(updating, on_update[column].cast(data_type))
            return out.otherwise(mine)
        if theirs is None:
            return mine
        if column in updatable:
            return F.when(inserting | updating, theirs.cast(data_type)).otherwise(mine)
        return F.when(inserting, theirs.cast(data_type)).otherwise(mine)

    return joined.select(*[value(c).alias(c) for c in target.columns], ACTION)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str] | None = None,
    on_update: Mapping[str, Column] | None = None,
    on_insert: Mapping[str, Column] | None = None,
    update_columns: Sequence[str] | None = None,
) -> DataFrame:
    """New target content with the action taken per row.

    Matched rows take the source values: always, or with ``compare`` only when one of those
    columns differs. Unmatched source rows are inserted, unmatched target rows stay. ``on_update``
    and ``on_insert`` set audit columns; ``update_columns`` limits what an update overwrites.
    Source rows with a NULL in the key match nothing and are inserted.
    """
    return _merge(target, source, keys, "full_outer", compare, on_update or {}, on_insert or {},
                  update_columns)


def update_only(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str] | None = None,
    on_update: Mapping[str, Column] | None = None,
    update_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Like :func:`upsert` without inserts."""
    return _merge(target, source, keys, "left", compare, on_update or {}, {}, update_columns)


def duplicate_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge keys that occur more than once. Keys containing NULL never match and are skipped."""
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    counted = source.filter(complete).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return counted.filter(F.col("rows") > 1)


def assert_unique(source: DataFrame, keys: Sequence[str]) -> None:
    """Stop when several source rows share a merge key, as one target row cannot take both."""
    examples = duplicate_keys(source, keys).limit(5).collect()
    if examples:
        shown = "; ".join(str(r.asDict()) for r in examples)
        raise DuplicateKeyError(f"merge source is not unique on {list(keys)}: {shown}")


def _alive_ids(source: DataFrame, source_key: str, alive: Column | None) -> DataFrame:
    test = F.col("data_area_id").isNotNull() if alive is None else alive
    return source.filter(test).select(F.col(source_key).alias("_alive_id"))


def delete_orphans(
    target: DataFrame,
    source: DataFrame,
    key: str,
    surrogate: str,
    source_key: str = "rec_id",
    alive: Column | None = None,
) -> DataFrame:
    """Target rows whose record still exists in the source.

    A source row without a company counts as gone. Rows with a surrogate key of 0 or less (the
    unknown members) always stay.
    """
    ids = _alive_ids(source, source_key, alive)
    found = ids.where(F.col("_alive_id") == F.col(key).outer()).exists()
    return target.where(~F.coalesce(F.col(surrogate) > 0, F.lit(False)) | found)


def orphans(
    target: DataFrame,
    source: DataFrame,
    key: str,
    surrogate: str,
    source_key: str = "rec_id",
    alive: Column | None = None,
) -> DataFrame:
    """The rows :func:`delete_orphans` removes."""
    ids = _alive_ids(source, source_key, alive)
    return target.where(F.col(surrogate) > 0).join(ids, F.col(key) == F.col("_alive_id"), "left_anti")


def action_counts(merged: DataFrame) -> DataFrame:
    """Rows per action; inserts plus updates are the affected rows."""
    return merged.groupBy(ACTION).agg(F.count(F.lit(1)).alias("rows"))


# monotonically_increasing_id() puts the partition number above this many bits of row number.
_ROW_BITS = 33
ROW_ID = "_row_id"


def tag_rows(df: DataFrame) -> DataFrame:
    """Tag rows with partition and row number; write the result before assigning keys."""
    return df.withColumn(ROW_ID, F.monotonically_increasing_id())


def assign_surrogate_keys(
    written: DataFrame, column: str, needs_key: Column, start: int
) -> DataFrame:
    """Fill ``column`` above ``start`` on the rows that need a key, and drop the row tags.

    ``written`` is read back from storage after :func:`tag_rows`, so a retried task cannot change
    the tags. Every writing partition gets its own number range behind the one before it: keys are
    unique and rising, with gaps where a partition holds rows that already had one.
    """
    part = F.shiftright(F.col(ROW_ID), _ROW_BITS)
    row = F.col(ROW_ID) - F.shiftleft(part, _ROW_BITS)
    sizes = written.filter(needs_key).groupBy(part.alias("_part")).agg(
        (F.max(row) + 1).alias("_size")
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One small row per writing task: safe to order in one place.
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset")
    )
    joined = written.join(offsets, part == F.col("_part"), "left")
    key = F.when(needs_key, F.lit(start) + F.col("_offset") + row + 1).otherwise(F.col(column))
    return joined.withColumn(column, key.cast("bigint")).drop("_part", "_offset", ROW_ID)


def next_start(target: DataFrame, column: str) -> int:
    """Largest key in use, or 0."""
    top = target.agg(F.max(column)).first()[0]
    return max(int(top or 0), 0)
