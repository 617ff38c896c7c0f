"""Days without stock, from balances that stand until the next movement.

A balance at or below zero is out of stock from its day until the day of the next movement. Rows
that follow each other in that state form one spell. Spells are cut at month borders by date
arithmetic, so a key costs its movements plus the months it is out of stock, and no calendar is
joined. A window holds the days with movements of one key, at most as many as the calendar has.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SPELL_START = "out_from"
SPELL_END = "out_until"  # the day after the last day without stock


def spells(
    balances: DataFrame,
    keys: Sequence[str],
    date: str,
    level: str,
    until: dt.date,
    undated: dt.date | None = None,
) -> DataFrame:
    """One row per key and longest run of days without stock, up to and including ``until``.

    ``balances`` has one row per key and date (see :func:`stockmart.operators.asof.running_level`).
    The last balance of a day counts for the day. Nothing is known before the first row of a key
    and such days never count; a row of the day ``undated`` gives no days either. A NULL balance is
    not out of stock. Key parts may be NULL. No balances give no rows.
    """
    day = F.to_date(date)
    rows = balances.filter(day <= F.lit(until))
    if undated is not None:
        rows = rows.filter(day != F.lit(undated))
    in_order = Window.partitionBy(*keys).orderBy(date)
    end = F.lit(until + dt.timedelta(days=1))
    rows = rows.select(
        *keys, date, day.alias("_from"),
        F.coalesce(F.to_date(F.lead(date).over(in_order)), end).alias("_to"),
        F.coalesce(F.col(level) <= 0, F.lit(False)).alias("_out"),
    ).filter(F.col("_from") < F.col("_to"))
    begins = F.col("_out") & ~F.lag("_out", 1, False).over(in_order)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_begins", begins.cast("int"))
    rows = rows.withColumn("_spell", F.sum("_begins").over(so_far))
    return rows.filter("_out").groupBy(*keys, "_spell").agg(
        F.min("_from").alias(SPELL_START), F.max("_to").alias(SPELL_END)
    ).drop("_spell")


def by_month(found: DataFrame, keys: Sequence[str], month: str = "month") -> DataFrame:
    """Days without stock per key and month (its first day), and the spells that touch the month.

    Months without such a day have no row.
    """
    first = F.trunc(SPELL_START, "month")
    last = F.trunc(F.date_sub(SPELL_END, 1), "month")
    months = F.sequence(first, last, F.expr("interval 1 month"))
    cut = found.withColumn(month, F.explode(months))
    days = F.date_diff(
        F.least(F.col(SPELL_END), F.add_months(month, 1)),
        F.greatest(F.col(SPELL_START), F.col(month)),
    )
    return cut.groupBy(*keys, month).agg(
        F.sum(days).cast("int").alias("stockout_days"),
        F.count(F.lit(1)).alias("stockout_spells"),
    )
