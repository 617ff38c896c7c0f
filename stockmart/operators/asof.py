"""As-of levels, running balances and validity intervals.

History is always reduced by hash aggregation before anything is sorted or joined, so a key that
holds a large part of all rows is combined on the map side and never gathered in one task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockmart.functions.scalar import moment as moment_of
from stockmart.functions.scalar import qty


def daily_totals(
    history: DataFrame, keys: Sequence[str], date: str, measures: Sequence[str]
) -> DataFrame:
    """One row per key and date with summed measures: the combined rows of a date."""
    return history.groupBy(*keys, date).agg(*[qty(F.sum(m)).alias(m) for m in measures])


def _equal(left: str, right: str, columns: Sequence[str]) -> Column:
    test = None
    for c in columns:
        part = F.col(f"{left}.{c}") == F.col(f"{right}.{c}")
        test = part if test is None else test & part
    return test


def _before(date: str, bound: dt.date | Column, inclusive: bool) -> Column:
    limit = bound if isinstance(bound, Column) else F.lit(bound)
    return F.col(date) <= limit if inclusive else F.col(date) < limit


def latest(
    base: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    date: str,
    measures: Sequence[str],
    bound: dt.date | Column,
    inclusive: bool,
    ties: str = "all",
    default=0,
) -> DataFrame:
    """Each base row with the measures of its key's latest date before (or on) ``bound``.

    ``ties='all'`` returns every history row of that date, ``ties='sum'`` adds them up. Keys
    compare with plain equality, so a NULL key part matches nothing; measures without a match
    become ``default``. The as-of date is returned as ``as_of_date``.
    """
    if ties not in ("all", "sum"):
        raise ValueError("ties must be 'all' or 'sum'")
    past = history.filter(_before(date, bound, inclusive))
    if ties == "sum":
        days = daily_totals(past, keys, date, measures)
        found = days.groupBy(*keys).agg(
            F.max(date).alias("as_of_date"),
            *[F.max_by(m, F.col(date)).alias(m) for m in measures],
        )
        joined = base.alias("b").join(found.alias("h"), _equal("b", "h", keys), "left")
        as_of = F.col("h.as_of_date")
    else:
        last = past.groupBy(*keys).agg(F.max(date).alias("as_of_date"))
        dated = base.alias("b").join(last.alias("l"), _equal("b", "l", keys), "left")
        dated = dated.select("b.*", F.col("l.as_of_date"))
        rows = past.select(*keys, F.col(date).alias("as_of_date"), *measures)
        joined = dated.alias("b").join(
            rows.alias("h"), _equal("b", "h", [*keys, "as_of_date"]), "left"
        )
        as_of = F.col("b.as_of_date")
    kept = [c for c in base.columns if c not in measures]
    return joined.select(
        *[F.col(f"b.{c}").alias(c) for c in kept],
        as_of.alias("as_of_date"),
        *[F.coalesce(F.col(f"h.{m}"), F.lit(default).cast("decimal(18,4)")).alias(m)
          for m in measures],
    )


def latest_before(base, history, keys, date, measures, bound, ties="all", default=0) -> DataFrame:
    return latest(base, history, keys, date, measures, bound, False, ties, default)


def latest_on_or_before(
    base, history, keys, date, measures, bound, ties="all", default=0
) -> DataFrame:
    return latest(base, history, keys, date, measures, bound, True, ties, default)


def running_level(
    history: DataFrame, keys: Sequence[str], date: str, measures: Sequence[str]
) -> DataFrame:
    """Balance since the start of time at the end of every date with movements.

    The window runs over daily totals, so its partitions are as long as the calendar.
    """
    over = (
        Window.partitionBy(*keys).orderBy(date)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    days = daily_totals(history, keys, date, measures)
    return days.select(*keys, date, *[qty(F.sum(m).over(over)).alias(m) for m in measures])


OPEN_END = dt.datetime(9999, 12, 31)


def validity_intervals(
    prices: DataFrame,
    keys: Sequence[str],
    activation: str = "activation_date",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Add ``next_activation`` and ``expiry_date`` (a day before it, or the open end) per key.

    The following activation is looked up first inside the same calendar month and else at the
    first later month, so that a key with very many prices is sorted month by month in parallel.
    ``tiebreak`` orders rows of one key that start on the same day; without it their order is
    not defined and all but one of them get an empty interval.
    """
    month = F.trunc(F.col(activation), "month")
    rows = prices.withColumn("_month", month)
    starts = rows.groupBy(*keys, "_month").agg(F.min(activation).alias("_first"))
    months = Window.partitionBy(*keys).orderBy("_month")
    starts = starts.select(*keys, "_month", F.lead("_first").over(months).alias("_later"))
    inside = Window.partitionBy(*keys, "_month").orderBy(activation, *tiebreak)
    rows = rows.withColumn("_next", F.lead(activation).over(inside))
    joined = rows.alias("p").join(
        starts.alias("m"),
        F.expr(" and ".join(f"p.`{c}` <=> m.`{c}`" for c in [*keys, "_month"])),
        "left",
    )
    following = F.coalesce(F.col("p._next"), F.col("m._later"))
    expiry = F.coalesce(
        following.cast("timestamp_ntz") - F.expr("interval 1 day"),
        moment_of(OPEN_END),
    )
    return joined.select(
        *[F.col(f"p.{c}").alias(c) for c in prices.columns],
        following.alias("next_activation"),
        expiry.alias("expiry_date"),
    )


def _month_number(column: Column) -> Column:
    return F.year(column) * 12 + F.month(column)


def by_month(
    intervals: DataFrame, spans: DataFrame, keys: Sequence[str], start: str, end: str
) -> DataFrame:
    """One row per interval and calendar month that it touches, numbered as ``_v_month``.

    ``spans`` has the first and last month with events per key (``_first``, ``_last``): intervals
    are cut to it, so one without an end gives no more rows than its key has months with events
    between, and keys without events give none. Intervals of one key that follow each other give at
    most their number plus the number of months. One that ends before it starts gives no row.
    """
    cut = intervals.join(spans, list(keys), "inner").withColumns({
        "_from": F.greatest(_month_number(F.col(start)), F.col("_first")),
        "_until": F.least(_month_number(F.col(end)), F.col("_last")),
    })
    kept = cut.filter((F.col(start) <= F.col(end)) & (F.col("_from") <= F.col("_until")))
    month = F.explode(F.sequence("_from", "_until")).alias("_v_month")
    return kept.select(*intervals.columns, month)


def valid_at(
    events: DataFrame,
    intervals: DataFrame,
    on: dict[str, str],
    moment: str,
    carry: dict[str, str],
    activation: str = "activation_date",
    half_open: bool = False,
    spans_of: DataFrame | None = None,
) -> DataFrame:
    """Left join of the intervals valid at each event's moment.

    ``on`` maps event columns to interval columns. Intervals are spread over the calendar months
    they touch (see :func:`by_month`) and join on the key and the event's month, so an event meets
    the intervals of its month only: work per key is its events plus matches, not events times
    intervals, and a key with very many events is spread over its months. The exact range is checked
    on the matches. The closed form ends at midnight of the expiry date, so a later moment on that
    day matches nothing; ``half_open`` ends at the next activation instead. Events with a NULL key
    or moment match nothing.

    ``spans_of`` may name a cheaper frame than ``events`` that holds at least the same keys and
    moments; the months with events are read from it.
    """
    names = {column: f"_v_{column}" for column in on.values()}
    known = events if spans_of is None else spans_of
    number = _month_number(F.col(moment))
    spans = known.groupBy(*[F.col(mine).alias(names[theirs]) for mine, theirs in on.items()]).agg(
        F.min(number).alias("_first"), F.max(number).alias("_last")
    )
    next_start = F.col("next_activation").cast("timestamp_ntz")
    end = F.coalesce(next_start, moment_of(OPEN_END)) if half_open else F.col("expiry_date")
    right = intervals.select(
        *[F.col(c).alias(name) for c, name in names.items()],
        F.col(activation).cast("timestamp_ntz").alias("_v_from"), end.alias("_v_to"),
        next_start.alias("_v_next"),
        *[F.col(source).alias(name) for name, source in carry.items()],
    )
    right = by_month(right, spans, list(names.values()), "_v_from", "_v_to")
    at = F.col(moment)
    upper = at <= F.col("_v_to")
    if half_open:
        upper = F.col("_v_next").isNull() | (at < F.col("_v_next"))
    test = (number == F.col("_v_month")) & (at >= F.col("_v_from")) & upper
    for event_column, interval_column in on.items():
        test = test & (F.col(event_column) == F.col(names[interval_column]))
    return events.join(right, test, "left").drop(
        "_v_from", "_v_to", "_v_next", "_v_month", *names.values()
    )
