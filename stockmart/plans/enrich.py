"""Stock transactions with their origin and postings: the input of the facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockmart.functions.status import StatusColumns, category_allowed, is_stock_relevant
from stockmart.operators.postings import with_postings
from stockmart.params import EnumSet
from stockmart.sources.tables import incremental
from stockmart.steps import Steps

ENUM_NAMES = ("StatusIssue", "StatusReceipt", "InventTransType", "NoYes", "InventSettleModel")


def with_origin(trans: DataFrame, origin: DataFrame) -> DataFrame:
    """Left join of the origin on its record id."""
    right = origin.select(
        F.col("rec_id").alias("_origin_id"),
        "reference_category", "reference_id", "invent_trans_id",
    )
    return trans.join(
        right, F.col("invent_trans_origin") == F.col("_origin_id"), "left"
    ).drop("_origin_id")


def stock_transactions(
    tables: Mapping[str, DataFrame],
    enums: EnumSet,
    execution_id: str | None = None,
    incremental_load: bool = False,
    keep_null_category: bool = False,
    null_id_means_all: bool = False,
    postings: bool = True,
    columns: Sequence[str] | None = None,
    step: Steps | None = None,
) -> DataFrame:
    """Gated transactions with origin columns and, with ``postings``, both posting roles.

    ``columns`` names the wanted ones; by default all come. With ``step`` the origin and the
    physical role are a stored step.

    The batch and status filters stand on raw columns and reach the scan; the category filter
    sits right above the origin join, before the postings are joined.
    """
    trans = incremental(
        tables["invent_trans"], execution_id, incremental_load, null_id_means_all=null_id_means_all
    )
    gated = trans.filter(is_stock_relevant(StatusColumns(enums)))
    df = with_origin(gated, tables["invent_trans_origin"])
    df = df.filter(category_allowed(F.col("reference_category"), keep_null_category))
    if postings:
        raw = None if columns is None else {*columns, "invoice_id", "packing_slip_id", "data_area_id"}
        df = with_postings(df, tables["invent_trans_posting"], raw, step)
    df = df.withColumns({
        "invoice_id": F.coalesce("invoice_id", F.lit("")),
        "packing_slip_id": F.coalesce("packing_slip_id", F.lit("")),
        "company_code": F.col("data_area_id"),
    })
    return df if columns is None else df.select(*columns)
