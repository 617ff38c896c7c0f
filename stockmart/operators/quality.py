"""Validation queries over the monthly summary, and a schema comparison.

Each check takes a summary frame, optionally restricted to one period (which prunes partitions of
a summary stored by year and month), and returns its findings as a frame.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockmart.functions import kpi
from stockmart.functions.period import Period, month_start

# Status texts of the reports.
NO_RECORDS = "⚠ No records found"
RECORDS = "✓ Records exist"
BALANCE_MISMATCH = "⚠ MISMATCH"
CORRECT = "✓ Correct"
CORRECT_NULL = "✓ Correct (NULL)"
MISMATCH = "⚠ Mismatch"
NEGATIVE_BOM = "⚠ Negative BOM"
NEGATIVE_EOM = "⚠ Negative EOM"
NEGATIVE_AVERAGE = "⚠ Negative Average"
VALID = "✓ Valid"
UNEXPECTED = "⚠ Unexpected"

REPORT_KEYS = ("company_key", "product_key", "warehouse_key")
# The summary grain: breaks ties where a report would otherwise be in no fixed order.
GRAIN = ("year", "month", "company_key", "product_key", "product_inventory_key",
         "inventory_dimension_key", "warehouse_key")

BOM = "bom_physical_stock_quantity"
EOM = "eom_physical_stock_quantity"
AVERAGE = "average_physical_stock_quantity"
INBOUND = "total_inbound_quantity"
OUTBOUND = "total_outbound_quantity"
DIO = "days_inventory_outstanding"
TURNOVER = "stock_turnover_ratio"

BALANCE_TOLERANCE = 0.01
DIO_TOLERANCE = 0.01
TURNOVER_TOLERANCE = 0.0001


def for_period(summary: DataFrame, period: Period | None) -> DataFrame:
    if period is None:
        return summary
    return summary.filter((F.col("year") == period.year) & (F.col("month") == period.month))


@dataclass(frozen=True)
class RunOutcome:
    """Result of a job run under :func:`attempt`."""

    rows: int | None
    error: str | None = None

    @property
    def ok(self) -> bool:
        return self.error is None


def attempt(job: Callable[[], int]) -> RunOutcome:
    """Run a load and report its row count or its error instead of raising."""
    try:
        return RunOutcome(rows=job())
    except Exception as failure:  # the report is the point: any failure is shown to the caller
        return RunOutcome(rows=None, error=str(failure))


def is_clean(findings: DataFrame) -> bool:
    """True when a check found nothing."""
    return findings.isEmpty()


def completeness(summary: DataFrame, period: Period | None = None) -> DataFrame:
    """Row count and distinct companies, products and warehouses."""
    counted = for_period(summary, period).agg(
        F.count(F.lit(1)).alias("total_records"),
        *[F.countDistinct(key).alias(name) for key, name in zip(
            REPORT_KEYS, ("unique_companies", "unique_products", "unique_warehouses"))],
    )
    status = F.when(F.col("total_records") == 0, F.lit(NO_RECORDS)).otherwise(F.lit(RECORDS))
    return counted.select(status.alias("status"), *counted.columns)


def balance(summary: DataFrame, period: Period | None = None, ordered: bool = True) -> DataFrame:
    """Rows whose closing level differs from opening level plus movements by more than 0.01."""
    expected = F.col(BOM) + F.col(INBOUND) - F.col(OUTBOUND)
    off = F.abs(F.col(EOM) - expected) > BALANCE_TOLERANCE
    found = for_period(summary, period).filter(off).select(
        *GRAIN, BOM, EOM, INBOUND, OUTBOUND, "net_movement_quantity", "quantity_change",
        expected.cast("decimal(18,4)").alias("expected_eom"),
        F.lit(BALANCE_MISMATCH).alias("balance_status"),
    )
    return found.orderBy(*REPORT_KEYS) if ordered else found


def _recomputed(stored: str, expected: Column, tolerance: float, null_when: Column) -> Column:
    return (
        F.when(F.col(stored).isNull() & null_when, F.lit(CORRECT_NULL))
        .when(F.col(stored).isNotNull() & (F.abs(F.col(stored) - expected) < tolerance),
              F.lit(CORRECT))
        .otherwise(F.lit(MISMATCH))
    )


def dio(summary: DataFrame, period: Period | None = None, top: int = 20) -> DataFrame:
    """Recomputed days of inventory for the ``top`` rows by closing level."""
    days = F.dayofmonth(F.last_day(month_start(F.col("year"), F.col("month"))))
    expected = kpi.days_inventory_outstanding(F.col(EOM), F.col(OUTBOUND), days)
    rows = for_period(summary, period).filter(F.col(OUTBOUND) > 0)
    return rows.orderBy(F.col(EOM).desc(), *GRAIN).limit(top).select(
        *GRAIN, EOM, OUTBOUND, DIO, expected.alias("expected_dio"),
        _recomputed(DIO, expected, DIO_TOLERANCE, F.col(OUTBOUND) == 0).alias("dio_status"),
    )


def turnover(summary: DataFrame, period: Period | None = None, top: int = 20) -> DataFrame:
    """Recomputed turnover for the ``top`` rows by stored ratio."""
    expected = kpi.stock_turnover(F.col(OUTBOUND), F.col(AVERAGE))
    rows = for_period(summary, period).filter(F.col(AVERAGE) > 0)
    return rows.orderBy(F.col(TURNOVER).desc(), *GRAIN).limit(top).select(
        *GRAIN, OUTBOUND, AVERAGE, TURNOVER, expected.alias("expected_turnover_ratio"),
        _recomputed(TURNOVER, expected, TURNOVER_TOLERANCE, F.col(AVERAGE) == 0)
        .alias("turnover_status"),
    )


def average(summary: DataFrame, period: Period | None = None, ordered: bool = True) -> DataFrame:
    """Rows whose stored average is off by 0.01 or more."""
    expected = kpi.average_level(F.col(BOM), F.col(EOM))
    off = F.abs(F.col(AVERAGE) - expected) >= BALANCE_TOLERANCE
    found = for_period(summary, period).filter(off).select(
        *GRAIN, BOM, EOM, AVERAGE, expected.alias("expected_average"),
        F.lit(MISMATCH).alias("status"),
    )
    return found.orderBy(*REPORT_KEYS) if ordered else found


def counts(summary: DataFrame, period: Period | None = None, ordered: bool = True) -> DataFrame:
    """Rows whose total transaction count is not inbound plus outbound."""
    parts = F.col("inbound_transaction_count") + F.col("outbound_transaction_count")
    found = for_period(summary, period).filter(F.col("total_transaction_count") != parts).select(
        *GRAIN, "inbound_transaction_count", "outbound_transaction_count",
        "total_transaction_count", F.lit(MISMATCH).alias("status"),
    )
    return found.orderBy(*REPORT_KEYS) if ordered else found


def nulls(
    summary: DataFrame,
    period: Period | None = None,
    columns: Sequence[str] = (BOM, DIO, TURNOVER),
) -> DataFrame:
    """NULL count and share of each column, from one pass; the share of an empty table is NULL."""
    rows = for_period(summary, period)
    counted = rows.agg(
        F.count(F.lit(1)).alias("total_records"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
    )
    long = counted.unpivot(["total_records"], list(columns), "column_name", "null_count")
    share = F.try_divide((F.col("null_count") * 100).cast("decimal(20,0)"),
                         F.col("total_records").cast("decimal(20,0)"))
    return long.select("column_name", "total_records", "null_count",
                       share.cast("decimal(5,2)").alias("null_pct"))


def negatives(summary: DataFrame, period: Period | None = None) -> DataFrame:
    """Histogram of negative levels, first match wins."""
    label = (
        F.when(F.col(BOM) < 0, F.lit(NEGATIVE_BOM))
        .when(F.col(EOM) < 0, F.lit(NEGATIVE_EOM))
        .when(F.col(AVERAGE) < 0, F.lit(NEGATIVE_AVERAGE))
        .otherwise(F.lit(VALID))
    )
    return for_period(summary, period).groupBy(label.alias("validation")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def period_dates(summary: DataFrame, period: Period | None = None) -> DataFrame:
    """Start and end date of each period: range, distinct values, and whether they are right.

    For one given period there is always a row per date, also when the summary has no rows.
    """
    rows = for_period(summary, period)
    by = ["year", "month"] if period is None else [
        F.lit(period.year).alias("year"), F.lit(period.month).alias("month")
    ]

    def field(column: str, right: Column) -> DataFrame:
        aggregates = [
            F.min(column).alias("min_date"), F.max(column).alias("max_date"),
            F.countDistinct(column).alias("unique_values"),
        ]
        if period is None:
            ranged = rows.groupBy(*by).agg(*aggregates)
        else:
            ranged = rows.agg(*aggregates).select(*by, "min_date", "max_date", "unique_values")
        good = (F.col("unique_values") == 1) & (F.col("min_date") == right)
        return ranged.select(
            "year", "month", F.lit(column).alias("date_field"), "min_date", "max_date",
            "unique_values",
            F.when(good, F.lit(CORRECT)).otherwise(F.lit(UNEXPECTED)).alias("status"),
        )

    first = month_start(F.col("year"), F.col("month"))
    return field("period_start_date", first).unionByName(
        field("period_end_date", F.last_day(first))
    )


def run_summary(summary: DataFrame, period: Period | None = None) -> DataFrame:
    """Execution report per period."""
    return for_period(summary, period).groupBy(
        "year", "month", "period_start_date", "period_end_date"
    ).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.countDistinct("company_key").alias("companies"),
        F.countDistinct("product_key").alias("products"),
        F.countDistinct("warehouse_key").alias("warehouses"),
        F.min("ea_process_datetime").alias("first_processed"),
        F.max("ea_process_datetime").alias("last_processed"),
        F.sum("total_transaction_count").alias("total_transactions"),
        F.count_if(F.col("is_current_month")).alias("current_month_records"),
    )


def schema_diff(before: T.StructType, after: T.StructType) -> list[tuple[str, str, str | None,
                                                                          str | None]]:
    """Columns added, removed or retyped between two schemas, as (change, name, before, after)."""
    old = {f.name: f.dataType.simpleString() for f in before.fields}
    new = {f.name: f.dataType.simpleString() for f in after.fields}
    out = [("removed", n, t, None) for n, t in old.items() if n not in new]
    out += [("added", n, None, t) for n, t in new.items() if n not in old]
    out += [("retyped", n, old[n], t) for n, t in new.items() if n in old and old[n] != t]
    return out
