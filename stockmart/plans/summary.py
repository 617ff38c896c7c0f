"""Monthly movement summary: opening and closing levels, movements and stock health."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockmart import schemas
from stockmart.functions import kpi
from stockmart.functions.period import Period, month_start
from stockmart.functions.scalar import constant, moment, qty, typed_null
from stockmart.functions.status import INBOUND_MOVEMENTS, OUTBOUND_MOVEMENTS
from stockmart.operators import dims, stockout
from stockmart.operators.asof import (
    daily_totals,
    latest_before,
    latest_on_or_before,
    running_level,
)
from stockmart.operators.text_agg import join_counted
from stockmart.params import NaParams
from stockmart.steps import Steps

DATE = "transaction_date"
LEVELS = schemas.LEVELS
FACT_KEYS = ("company_key", "product_key", "product_inventory_key", "inventory_dimension_key",
             "warehouse_key")
SIZE_KEY = "inventory_size_key"
KEYS = (*FACT_KEYS[:4], SIZE_KEY, FACT_KEYS[4])

#: What movements read beside the keys, the date and the level on hand.
MOVEMENT = ("movement_type", "inventory_transaction_id", "transaction_type")

_DIMENSIONS = {
    "company_key": "dim_company", "product_key": "dim_product",
    "product_inventory_key": "dim_product_inventory",
    "inventory_dimension_key": "dim_inventory_dimension", "warehouse_key": "dim_warehouse",
}


def confirm_keys(
    df: DataFrame, tables: Mapping[str, DataFrame], step: Steps | None = None
) -> DataFrame:
    """Check all fact keys against their dimensions and add the size key; a miss becomes NULL."""
    carry = {"dim_inventory_dimension": {SIZE_KEY: SIZE_KEY}}
    return dims.confirm_keys(df, tables, _DIMENSIONS, carry, step)


def _unknown_for_null(df: DataFrame, params: NaParams) -> DataFrame:
    return df.withColumns({k: F.coalesce(F.col(k), params.key()) for k in KEYS})


def movements(fact: DataFrame, keys: tuple[str, ...], types: str = "counted") -> DataFrame:
    """Inbound and outbound quantities, distinct transaction counts and types per key.

    Every row is combined per key twice in one shuffle: under its transaction id, which spreads a
    hot key over its transactions and turns three distinct counts into sums of flags, and under
    its transaction type, where only counts of the few types remain.
    """
    zero = F.lit(0).cast("decimal(18,4)")
    moved = F.coalesce(F.col("physical_stock_quantity"), zero)
    rows = fact.select(
        *keys, moved.alias("_moved"),
        F.col("movement_type").isin(*INBOUND_MOVEMENTS).alias("_is_in"),
        F.col("movement_type").isin(*OUTBOUND_MOVEMENTS).alias("_is_out"),
        F.explode(F.array(
            F.struct(F.lit(True).alias("id"), F.col("inventory_transaction_id").alias("v")),
            F.struct(F.lit(False).alias("id"), F.col("transaction_type").alias("v")),
        )).alias("_by"),
    )
    inbound, outbound = F.col("_is_in"), F.col("_is_out")
    combined = rows.groupBy(*keys, F.col("_by.id").alias("_id"), F.col("_by.v").alias("_v")).agg(
        F.sum(F.when(inbound, F.col("_moved")).otherwise(zero)).alias("_in"),
        F.sum(F.when(outbound, F.abs("_moved")).otherwise(zero)).alias("_out"),
        F.max(F.when(inbound, 1).otherwise(0)).alias("_has_in"),
        F.max(F.when(outbound, 1).otherwise(0)).alias("_has_out"),
        F.count(F.lit(1)).alias("_n"),
    )
    is_id, named = F.col("_id"), F.col("_v").isNotNull()
    entry = F.struct(F.col("_v").alias("v"), F.col("_n").alias("n"))
    totals = combined.groupBy(*keys).agg(
        qty(F.sum(F.when(is_id, F.col("_in")))).alias("total_inbound_quantity"),
        qty(F.sum(F.when(is_id, F.col("_out")))).alias("total_outbound_quantity"),
        F.sum(F.when(is_id & named, F.col("_has_in")).otherwise(0))
        .alias("inbound_transaction_count"),
        F.sum(F.when(is_id & named, F.col("_has_out")).otherwise(0))
        .alias("outbound_transaction_count"),
        F.count_if(is_id & named).alias("total_transaction_count"),
        F.collect_list(F.when(~is_id & named, entry)).alias("_types"),
    )
    text = join_counted(F.col("_types"), types)
    return totals.withColumn("transaction_types", text).drop("_types")


MOVED = ("total_inbound_quantity", "total_outbound_quantity", "inbound_transaction_count",
         "outbound_transaction_count", "total_transaction_count")
# NULL unless a summary is built with ``health_until``.
HEALTH = ("stockout_days", "product_count")
ON_HAND = LEVELS[0]


def with_health(
    months: DataFrame, days: DataFrame, params: NaParams, until: dt.date
) -> DataFrame:
    """Add days without stock and the number of products of the warehouse to rows of KEYS, _month.

    ``days`` has the summed quantities per key and date since the start of time, or the balance
    before a month as the quantity of its first day. Stock is the balance on hand. Products are
    those with activity in the warehouse in that month.
    """
    balances = running_level(days, KEYS, DATE, [ON_HAND])
    found = stockout.spells(balances, KEYS, DATE, ON_HAND, until, params.na_datetime.date())
    out = stockout.by_month(found, KEYS, "_month").drop("stockout_spells")
    place = ["company_key", "warehouse_key", "_month"]
    products = months.groupBy(*place).agg(F.countDistinct("product_key").alias("product_count"))
    joined = months.join(out, [*KEYS, "_month"], "left").join(products, place, "left")
    return joined.withColumn("stockout_days", F.coalesce("stockout_days", F.lit(0)))


def with_indicators(df: DataFrame, params: NaParams, now: dt.datetime) -> DataFrame:
    """Final columns from keys, levels, movements, ``year``, ``month`` and ``date_key``."""
    def amount(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0).cast("decimal(18,4)")).cast("decimal(18,4)")

    df = df.withColumns({
        **{k: F.coalesce(F.col(k), params.key()) for k in KEYS},
        **{c: amount(c) for c in (*schemas.BOM_LEVELS, *schemas.EOM_LEVELS, *MOVED[:2])},
        **{c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in MOVED[2:]},
        "period_start_date": month_start(F.col("year"), F.col("month")),
    })
    bom, eom = F.col("bom_physical_stock_quantity"), F.col("eom_physical_stock_quantity")
    inbound, outbound = F.col("total_inbound_quantity"), F.col("total_outbound_quantity")
    average = kpi.average_level(bom, eom)
    end = F.last_day(F.col("period_start_date"))
    stamp = moment(now)
    df = df.withColumns({
        "period_end_date": end,
        "net_movement_quantity": kpi.net_movement(inbound, outbound),
        "quantity_change": kpi.quantity_change(bom, eom),
        "average_physical_stock_quantity": average,
        "average_available_stock_quantity": kpi.average_level(
            F.col("bom_available_stock_quantity"), F.col("eom_available_stock_quantity")
        ),
        "days_inventory_outstanding": kpi.days_inventory_outstanding(
            eom, outbound, F.dayofmonth(end)
        ),
        "stock_turnover_ratio": kpi.stock_turnover(outbound, average),
        **{c: F.col(c).cast("int") if c in df.columns else typed_null("int") for c in HEALTH},
        "ea_process_datetime": stamp,
        "ea_last_update_datetime": typed_null("timestamp_ntz"),
        "is_current_month": F.col("period_start_date") == F.lit(now.date().replace(day=1)),
    })
    return schemas.conform(df, schemas.MOVEMENT_SUMMARY, skip=("summary_key",))


def _within(
    fact: DataFrame, first: Period | None, last: Period | None, month_column: str | None
) -> DataFrame:
    """Rows from the first to the last period; a stored month column prunes partitions as well."""
    if first is not None:
        fact = fact.filter(F.col(DATE) >= F.lit(first.start))
        if month_column:
            fact = fact.filter(F.col(month_column) >= first.year * 100 + first.month)
    if last is not None:
        fact = fact.filter(F.col(DATE) <= F.lit(last.end))
        if month_column:
            fact = fact.filter(F.col(month_column) <= last.year * 100 + last.month)
    return fact


def _levels(base, fact, period, prefix, ties, tables) -> DataFrame:
    find = latest_before if prefix == "bom" else latest_on_or_before
    bound = period.start if prefix == "bom" else period.end
    found = find(base, fact, FACT_KEYS, DATE, LEVELS, bound, ties=ties).drop("as_of_date")
    found = found.withColumnsRenamed({m: f"{prefix}_{m}" for m in LEVELS})
    return confirm_keys(found, tables)


def build(
    fact: DataFrame,
    tables: Mapping[str, DataFrame],
    params: NaParams,
    period: Period,
    now: dt.datetime,
    ties: str = "all",
    types: str = "counted",
    month_column: str | None = None,
) -> DataFrame:
    """Summary of one month, keeping the definitions that create odd rows.

    Keys active in the month get the levels of their latest date before its start and on or before
    its end. With ``ties='all'`` several rows of that date are all kept and the rows of both
    sides combine per key; ``ties='sum'`` adds them up. A key with a NULL part matches neither
    history nor its other half and leaves two rows, the closing one under the unknown member.
    Use :func:`build_history` for one well-defined row per key.
    """
    fact = _within(fact, None, period, month_column)
    in_period = _within(fact, period, None, month_column)
    base = in_period.select(*FACT_KEYS).distinct()
    bom = _levels(base, fact, period, "bom", ties, tables).alias("b")
    eom = _levels(base, fact, period, "eom", ties, tables).alias("e")
    same = F.expr(" and ".join(f"e.{k} = b.{k}" for k in KEYS))
    both = bom.join(eom, same, "full_outer").select(
        *[F.col(f"b.{k}").alias(k) for k in KEYS],
        *[F.coalesce(F.col(f"e.{k}"), F.col(f"b.{k}")).alias(f"_{k}") for k in KEYS],
        *schemas.BOM_LEVELS, *schemas.EOM_LEVELS,
    )
    moved = movements(
        _unknown_for_null(confirm_keys(in_period, tables), params), KEYS, types
    ).withColumnsRenamed({k: f"_m_{k}" for k in KEYS})
    found = F.expr(" and ".join(f"_m_{k} = _{k}" for k in KEYS))
    df = both.join(moved, found, "left").withColumns({
        "year": F.lit(period.year), "month": F.lit(period.month),
        "date_key": constant(
            dims.constant_key(tables["dim_date"], "calendar_date", period.end, "date_id"), "bigint"
        ),
    })
    return with_indicators(df, params, now)


def build_history(
    fact: DataFrame,
    tables: Mapping[str, DataFrame],
    params: NaParams,
    now: dt.datetime,
    first: Period | None = None,
    last: Period | None = None,
    level: str = "latest",
    types: str = "counted",
    month_column: str | None = None,
    health_until: dt.date | None = None,
    step: Steps | None = None,
) -> DataFrame:
    """Summaries of all months with activity in one pass, one row per month and key.

    A key active in a month closes with the latest date inside it and opens with the close of its
    previous active month, so closing levels are one aggregate and opening levels a lag over
    months. Keys are checked against the dimensions first and missing ones become the unknown
    member; rows of one date are added up. ``level='running'`` carries the balance since the start
    of time instead of the latest date's quantities. ``first`` and ``last`` limit the months
    returned; history before ``first`` still feeds the opening levels. ``month_column`` names a
    stored yyyymm partition column of the fact, if it has one. ``health_until`` fills stockout days,
    counted up to that day, and product counts (see :func:`with_health`); otherwise both are NULL.

    With ``step`` the rows with checked keys, the levels and the movements are stored steps. Where
    all months are returned, levels and movements then read the same checked rows.
    """
    if level not in ("latest", "running"):
        raise ValueError("level must be 'latest' or 'running'")
    upto = _within(fact, None, last, month_column)
    if step is not None and first is None:
        checked = confirm_keys(upto.select(*FACT_KEYS, DATE, *LEVELS, *MOVEMENT), tables, step)
        days = checked = _unknown_for_null(checked, params)
    else:
        checked = None
        days = daily_totals(upto, FACT_KEYS, DATE, LEVELS)
        days = _unknown_for_null(confirm_keys(days, tables), params)
    days = daily_totals(days, KEYS, DATE, LEVELS)
    months = days.groupBy(*KEYS, F.trunc(DATE, "month").alias("_month")).agg(
        *[(F.max_by(m, F.col(DATE)) if level == "latest" else qty(F.sum(m))).alias(f"eom_{m}")
          for m in LEVELS]
    )
    by_month = Window.partitionBy(*KEYS).orderBy("_month")
    if level == "running":
        upto_now = by_month.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        months = months.withColumns({f"eom_{m}": qty(F.sum(f"eom_{m}").over(upto_now))
                                     for m in LEVELS})
    months = months.withColumns({f"bom_{m}": F.lag(f"eom_{m}").over(by_month) for m in LEVELS})
    if first is not None:
        months = months.filter(F.col("_month") >= F.lit(first.start))
    if checked is None:
        wanted = _within(upto, first, None, month_column)
        checked = _unknown_for_null(confirm_keys(wanted, tables), params)
    wanted = checked.withColumn("_month", F.trunc(DATE, "month"))
    moved = movements(wanted, (*KEYS, "_month"), types)
    if health_until is not None:
        months = with_health(months, days, params, health_until)
    if step is not None:
        months, moved = (step.branch()(rows) for rows in (months, moved))
    df = months.join(moved, [*KEYS, "_month"], "left").withColumns({
        "year": F.year("_month"), "month": F.month("_month"), "_end": F.last_day("_month"),
    })
    dates = tables["dim_date"].select("calendar_date", F.col("date_id").alias("date_key"))
    df = df.join(dates, F.col("_end") == F.col("calendar_date"), "left")
    return with_indicators(df, params, now)


def month_levels(rows: DataFrame, tables: Mapping[str, DataFrame], params: NaParams) -> DataFrame:
    """One row per key and month with rows: its latest date, that date's levels, and the sums of
    the month as ``month_`` columns. Keys are checked as in :func:`build_history`."""
    days = daily_totals(rows, FACT_KEYS, DATE, LEVELS)
    days = _unknown_for_null(confirm_keys(days, tables), params)
    days = daily_totals(days, KEYS, DATE, LEVELS)
    return days.groupBy(*KEYS, F.trunc(DATE, "month").alias("_month")).agg(
        F.max(DATE).alias("level_date"),
        *[F.max_by(m, F.col(DATE)).alias(m) for m in LEVELS],
        *[qty(F.sum(m)).alias(f"month_{m}") for m in LEVELS],
    )


def _month_days(rows, opening, months, tables, params, period) -> DataFrame:
    """Quantities on hand per key and date of one month, with the balance before it on its first
    day. A balance of undated rows alone stays undated."""
    days = daily_totals(rows, FACT_KEYS, DATE, [ON_HAND])
    days = _unknown_for_null(confirm_keys(days, tables), params).select(*KEYS, DATE, ON_HAND)
    undated = params.datetime().cast("timestamp_ntz")
    start = moment(dt.datetime.combine(period.start, dt.time()))
    since = F.when(F.col("level_date") == undated, undated).otherwise(start)
    before = opening.join(months.select(*KEYS), list(KEYS), "left_semi").select(
        *KEYS, since.alias(DATE), qty(F.col(f"total_{ON_HAND}")).alias(ON_HAND)
    )
    return days.unionByName(before)


def build_month(
    fact: DataFrame,
    opening: DataFrame,
    tables: Mapping[str, DataFrame],
    params: NaParams,
    period: Period,
    now: dt.datetime,
    level: str = "latest",
    types: str = "counted",
    month_column: str | None = None,
    health_until: dt.date | None = None,
) -> DataFrame:
    """The month of :func:`build_history` from its own rows and ``opening``, the balances before it.

    ``opening`` has at most one row per key, with the levels and, as ``total_`` columns, the sums
    since the start of time; see :mod:`stockmart.plans.balances`. No other rows of the fact are read.
    """
    if level not in ("latest", "running"):
        raise ValueError("level must be 'latest' or 'running'")
    rows = _within(_within(fact, None, period, month_column), period, None, month_column)
    prefix = "" if level == "latest" else "total_"
    before = opening.select(*KEYS, *[F.col(f"{prefix}{m}").alias(f"bom_{m}") for m in LEVELS])
    zero = F.lit(0).cast("decimal(18,4)")

    def close(m: str) -> Column:
        if level == "latest":
            return F.col(m)
        return qty(F.coalesce(F.col(f"bom_{m}"), zero) + F.col(f"month_{m}"))

    months = month_levels(rows, tables, params).join(before, list(KEYS), "left")
    months = months.select(
        *KEYS, *schemas.BOM_LEVELS, *[close(m).alias(f"eom_{m}") for m in LEVELS]
    )
    if health_until is not None:
        months = months.withColumn("_month", F.lit(period.start))
        days = _month_days(rows, opening, months, tables, params, period)
        months = with_health(months, days, params, min(health_until, period.end))
    moved = movements(_unknown_for_null(confirm_keys(rows, tables), params), KEYS, types)
    df = months.join(moved, list(KEYS), "left").withColumns({
        "year": F.lit(period.year), "month": F.lit(period.month),
        "date_key": constant(
            dims.constant_key(tables["dim_date"], "calendar_date", period.end, "date_id"), "bigint"
        ),
    })
    return with_indicators(df, params, now)
