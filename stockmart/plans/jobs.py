"""The loads: build a fact from the source tables and merge it into its stored table."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockmart import schemas
from stockmart.functions.period import Period
from stockmart.functions.scalar import moment
from stockmart.operators import archive as retention
from stockmart.operators import merge
from stockmart.params import NaParams
from stockmart.plans import (
    enrich,
    inventory_value,
    sales_cost,
    settlement,
    stock_level,
    summary,
)
from stockmart.plans.balances import Balances
from stockmart.sources.facts import MONTH, FactTable, LoadResult, history, monthly_fact
from stockmart.sources.tables import TableSet

log = logging.getLogger(__name__)


def stock_level_table(spark: SparkSession, path: str) -> FactTable:
    return monthly_fact(spark, path, schemas.FACT_STOCK_LEVEL, "stock_level_key")


def inventory_value_table(spark: SparkSession, path: str) -> FactTable:
    return monthly_fact(spark, path, schemas.FACT_INVENTORY_VALUE, "inventory_value_key")


def settlement_table(spark: SparkSession, path: str) -> FactTable:
    return monthly_fact(spark, path, schemas.FACT_SETTLEMENT, "inventory_settlement_key")


def summary_table(spark: SparkSession, path: str) -> FactTable:
    return FactTable(spark, path, schemas.MOVEMENT_SUMMARY, "summary_key", ("year", "month"))


def sales_orders_table(spark: SparkSession, path: str) -> FactTable:
    return FactTable(spark, path, schemas.FACT_SALES_ORDERS, None, ("company_code",))


def _orphan_rules(source: DataFrame, surrogate: str) -> dict:
    return {"gone": lambda df: merge.orphans(df, source, "record_id", surrogate)}


def load_stock_levels(
    tables: TableSet,
    fact: FactTable,
    now: dt.datetime,
    execution_id: str | None = None,
    incremental: bool = False,
    archive: FactTable | None = None,
    balances: Balances | None = None,
) -> LoadResult:
    """Stock level fact: every matched row is rewritten with the source values.

    Records that ``archive`` holds are rewritten, or removed, there. ``balances`` are brought up
    to date with the months that changed.
    """
    params, enums = tables.na_params(), tables.enums(*enrich.ENUM_NAMES)
    stamp = {"ea_process_datetime": moment(now)}
    with fact.steps() as step:
        source = stock_level.build(tables, params, enums, execution_id, incremental, step)
        result = fact.merge(
            source, ["record_id"], on_update=stamp, on_insert=stamp, archive=archive,
            on_touch=None if balances is None else balances.mark,
            **_orphan_rules(tables["invent_trans"], "stock_level_key"),
        )
    if balances is not None:
        balances.settle(history(fact, archive), tables, params)
    return result


def load_inventory_value(
    tables: TableSet,
    fact: FactTable,
    now: dt.datetime,
    execution_id: str | None = None,
    incremental: bool = False,
    archive: FactTable | None = None,
) -> LoadResult:
    """Inventory value fact: only changed rows are updated and stamped, archived ones in place."""
    params, enums = tables.na_params(), tables.enums(*enrich.ENUM_NAMES)
    with fact.steps() as step:
        source = inventory_value.build(tables, params, enums, execution_id, incremental, step)
        return fact.merge(
            source, ["record_type", "record_id"], compare=schemas.VALUE_COMPARED,
            on_update={"ea_process_datetime": moment(now), "ea_is_deleted": F.lit(False)},
            archive=archive, **_orphan_rules(tables["invent_trans"], "inventory_value_key"),
        )


def refresh_sales_cost(
    tables: TableSet,
    sales_orders: FactTable,
    now: dt.datetime,
    execution_id: str | None = None,
    incremental: bool = False,
    **options,
) -> LoadResult:
    """Write changed cost prices, margins and reservations into the sales order fact."""
    enums = tables.enums(*enrich.ENUM_NAMES)
    with sales_orders.steps() as step:
        costs = sales_cost.build(tables, enums, execution_id, incremental, step=step, **options)
        return sales_orders.merge(
            costs, ["company_code", "inventory_transaction_id"], compare=schemas.SALES_COMPARED,
            on_update={"ea_process_datetime": moment(now), "ea_is_deleted": F.lit(False)},
            insert=False,
        )


def load_value_and_costs(
    tables: TableSet,
    fact: FactTable,
    sales_orders: FactTable,
    now: dt.datetime,
    execution_id: str | None = None,
    incremental: bool = False,
    archive: FactTable | None = None,
) -> LoadResult:
    """Both steps of the inventory value load; their affected rows add up."""
    first = load_inventory_value(tables, fact, now, execution_id, incremental, archive)
    return first + refresh_sales_cost(tables, sales_orders, now, execution_id, incremental)


def load_settlements(
    tables: TableSet,
    fact: FactTable,
    now: dt.datetime,
    execution_id: str | None = None,
    incremental: bool = False,
    archive: FactTable | None = None,
) -> LoadResult:
    """Settlement fact: only changed rows are updated and stamped, archived ones in place."""
    params, enums = tables.na_params(), tables.enums(*enrich.ENUM_NAMES)
    with fact.steps() as step:
        source = settlement.build(tables, params, enums, execution_id, incremental, step)
        return fact.merge(
            source, ["record_id"], compare=schemas.SETTLEMENT_COMPARED,
            on_update={"ea_process_datetime": moment(now), "ea_is_deleted": F.lit(False)},
            archive=archive, **_orphan_rules(tables["invent_settlement"], "inventory_settlement_key"),
        )


# An update leaves the first load's stamp and the size key as they were inserted.
_SUMMARY_UPDATED = tuple(
    c for c in schemas.MOVEMENT_SUMMARY.names
    if c not in ("summary_key", "ea_process_datetime", "inventory_size_key")
)


def build_monthly_summary(
    tables: Mapping[str, DataFrame],
    params,
    fact: FactTable,
    target: FactTable,
    period: Period,
    now: dt.datetime,
    ties: str | None = None,
    types: str = "counted",
    level: str = "latest",
    archive: FactTable | None = None,
    balances: Balances | None = None,
    health_until: dt.date | None = None,
) -> LoadResult:
    """Monthly summary of one period, merged into the partition of that month.

    By default every key gets one row (see :func:`stockmart.plans.summary.build_history`). With
    ``ties`` the one-month definition with its tie handling is used instead; if that yields
    several rows for a merge key, the load stops. With ``balances`` the month is built from its own
    rows and the balances before it. Without them levels need all history: where detail has been
    moved to ``archive``, its rows are read as well. ``health_until`` fills stockout days and
    product counts; the one-month definition leaves them NULL.
    """
    if ties is not None and health_until is not None:
        raise ValueError("the one-month definition has no stockout days and product counts")
    common = {"types": types, "month_column": MONTH}
    one_row = {**common, "health_until": health_until}
    rows = history(fact, archive)
    if ties is None and balances is not None:
        balances.settle(rows, tables, params)
        opening = balances.before(period)
        source = summary.build_month(rows, opening, tables, params, period, now, level, **one_row)
    elif ties is None:
        source = summary.build_history(
            rows, tables, params, now, first=period, last=period, level=level, **one_row
        )
    else:
        source = summary.build(rows, tables, params, period, now, ties=ties, **common)
    result = target.merge(
        source, list(schemas.SUMMARY_KEYS), update_columns=_SUMMARY_UPDATED,
        on_update={"ea_last_update_datetime": moment(now)},
    )
    log.info("summary %04d-%02d: %d rows processed", period.year, period.month, result.rows)
    return result


def archive_detail(
    fact: FactTable, target: FactTable, today: dt.date, params: NaParams,
    months: int = retention.DETAIL_MONTHS, keys: tuple[str, ...] = ("record_id",),
) -> int:
    """Move detail older than ``months`` months to the archive table; undated rows stay.

    ``keys`` are those of the fact's merge. A move that is interrupted at any step is finished by
    the next load or move; until then :func:`stockmart.sources.facts.history` reads each row once.
    """
    limit = retention.cutoff(today, months)
    return fact.archive_before(target, limit, keys, params.na_datetime.date())
