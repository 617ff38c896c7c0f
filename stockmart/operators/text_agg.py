"""Ordered string aggregation that never gathers the rows of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = ", "


FORMS = ("counted", "distinct", "all")


def join_counted(entries: Column, form: str = "counted") -> Column:
    """Text of an array of (v, n) structs, sorted and comma separated; NULL if there are none.

    ``counted`` has each value with its count (`Sales Order x12`), ``distinct`` each value once:
    both are as long as there are values. ``all`` repeats each value, so its text grows with the
    rows of a group; it is for groups of few rows.
    """
    if form not in FORMS:
        raise ValueError(f"the form of a list must be one of {FORMS}")
    ordered = F.sort_array(entries)
    if form == "counted":
        items = F.transform(ordered, lambda e: F.concat(e["v"], F.lit(" x"), e["n"].cast("string")))
    elif form == "distinct":
        items = F.transform(ordered, lambda e: e["v"])
    else:
        items = F.flatten(
            F.transform(ordered, lambda e: F.array_repeat(e["v"], e["n"].cast("int")))
        )
    return F.when(F.size(entries) > 0, F.array_join(items, SEPARATOR))


def sorted_list(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    name: str,
    form: str = "counted",
) -> DataFrame:
    """Values of ``column`` per key, sorted and joined by a comma, with their counts.

    Occurrences are counted per value first (combined on the map side); only the distinct values
    and their counts of a key meet, so memory follows the number of labels and not of rows. NULLs
    are skipped. See :func:`join_counted` for ``form``.
    """
    counts = df.groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_n"))
    entry = F.struct(F.col(column).alias("v"), F.col("_n").alias("n"))
    lists = counts.groupBy(*keys).agg(
        F.collect_list(F.when(F.col(column).isNotNull(), entry)).alias("_entries")
    )
    text = join_counted(F.col("_entries"), form)
    return lists.select(*keys, text.alias(name))
