"""Cost price, margin and reservation of sales orders from their stock transactions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockmart import schemas
from stockmart.functions.scalar import blank_to_null, moment, quotient
from stockmart.operators.asof import valid_at, validity_intervals
from stockmart.operators.merge import update_only
from stockmart.params import EnumSet
from stockmart.plans.enrich import stock_transactions
from stockmart.sources.tables import live
from stockmart.steps import Steps

# Issue status counted as reserved, sales type of a return order, no-date marker.
RESERVED_ISSUE_ID = 4
RETURN_ORDER = 4
NO_DATE = dt.datetime(1900, 1, 1)


def price_intervals(prices: DataFrame, invent_dim: DataFrame) -> DataFrame:
    """Live item prices with the site of their inventory dimension and their validity."""
    sites = invent_dim.select("invent_dim_id", "data_area_id", "invent_site_id")
    intervals = validity_intervals(
        live(prices), ["data_area_id", "item_id", "invent_dim_id"], tiebreak=["price"]
    )
    return intervals.join(sites, ["invent_dim_id", "data_area_id"], "inner")


TOTALLED = ("invent_trans_id", "data_area_id", "status_issue", "cost_amount_posted",
            "cost_amount_physical", "qty", "invoice_id", "packing_slip_id", "date_status")


def transaction_totals(trans: DataFrame) -> DataFrame:
    """Sums per inventory transaction id and company."""
    reserved = F.col("status_issue") == RESERVED_ISSUE_ID
    zero = F.lit(0).cast("decimal(18,4)")
    no_date = moment(NO_DATE)
    return trans.groupBy("invent_trans_id", "data_area_id").agg(
        (-F.sum("cost_amount_posted")).alias("posted"),
        F.sum("cost_amount_physical").alias("physical"),
        F.sum("qty").alias("qty"),
        F.max("invoice_id").alias("invoice_id"),
        F.max("packing_slip_id").alias("packing_slip_id"),
        (-F.sum(F.when(reserved, F.col("qty")).otherwise(zero))).alias("reserved"),
        F.max(F.when(reserved, F.col("date_status")).otherwise(no_date)).alias("reserved_date"),
    )


def cost_price(price: Column, strict: bool) -> Column:
    """Return orders keep their original cost; otherwise invoiced, delivered, then list price."""
    qty = F.nullif(F.col("qty"), F.lit(0))
    adjusted = F.col("posted") + F.coalesce("adjustment", F.lit(0))
    original = F.coalesce(F.nullif(F.col("cost_price"), F.lit(0)), price)
    return (
        F.when(F.col("sales_type") == RETURN_ORDER, original)
        .when(blank_to_null(F.col("invoice_id")).isNotNull(), adjusted / qty)
        .when(blank_to_null(F.col("packing_slip_id")).isNotNull(),
              quotient(F.col("physical"), F.col("qty"), strict))
        .otherwise(price)
    )


def build(
    tables: Mapping[str, DataFrame],
    enums: EnumSet,
    execution_id: str | None = None,
    incremental_load: bool = False,
    half_open: bool = False,
    strict: bool = False,
    step: Steps | None = None,
) -> DataFrame:
    """One row per sales line and matching price with the values to refresh.

    ``strict`` raises when delivered transactions sum to zero quantity; otherwise the cost price of
    such a line is NULL. ``half_open`` closes the one-day gap between price intervals. With ``step``
    the transactions and their totals are stored steps.
    """
    trans = stock_transactions(
        tables, enums, execution_id, incremental_load, columns=TOTALLED, step=step
    )
    totals = transaction_totals(trans)
    if step is not None:
        totals = step(totals)
    lines = tables["sales_line"].select(
        "invent_trans_id", "data_area_id", "sales_type", "cost_price", "line_amount",
        "invent_dim_id", "item_id", "created_datetime",
    )
    adjusted = tables["invent_settlement"].groupBy("invent_trans_id", "data_area_id").agg(
        F.sum("cost_amount_adjustment").alias("adjustment")
    )
    # The aggregates share the join key, so both joins reuse their partitioning.
    df = totals.join(adjusted, ["invent_trans_id", "data_area_id"], "left").join(
        lines, ["invent_trans_id", "data_area_id"], "inner"
    )
    sites = tables["invent_dim"].select("invent_dim_id", "data_area_id", "invent_site_id")
    df = df.join(sites, ["invent_dim_id", "data_area_id"], "left")
    ordered = tables["sales_line"].join(sites, ["invent_dim_id", "data_area_id"], "inner")
    df = valid_at(
        df, price_intervals(tables["invent_item_price"], tables["invent_dim"]),
        {"item_id": "item_id", "invent_site_id": "invent_site_id",
         "data_area_id": "data_area_id"},
        "created_datetime", {"list_price": "price"}, half_open=half_open, spans_of=ordered,
    )
    no_date = moment(NO_DATE)
    out = df.select(
        F.col("data_area_id").alias("company_code"),
        F.col("invent_trans_id").alias("inventory_transaction_id"),
        cost_price(F.col("list_price"), strict).alias("cost_price"),
        F.coalesce("reserved_date", no_date).alias("reserved_date_physical"),
        F.coalesce("reserved", F.lit(0)).alias("reserved_physical"),
        F.col("posted").alias("gross_cost_amount"),
        (F.col("line_amount") - F.col("posted")).alias("gross_margin_amount"),
    )
    return schemas.conform(
        out, schemas.FACT_SALES_ORDERS, skip=("ea_process_datetime", "ea_is_deleted")
    )


def refresh(fact: DataFrame, costs: DataFrame, now: Column) -> DataFrame:
    """Sales order fact with changed costs written in; lines without costs stay as they are."""
    return update_only(
        fact, costs, ["company_code", "inventory_transaction_id"],
        compare=schemas.SALES_COMPARED,
        on_update={"ea_process_datetime": now, "ea_is_deleted": F.lit(False)},
    )
