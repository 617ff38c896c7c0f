"""Settlement fact: cost adjustments of posted transactions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockmart import schemas
from stockmart.functions.scalar import constant, typed_null
from stockmart.functions.status import StatusColumns, is_settled
from stockmart.operators import dims
from stockmart.operators.postings import by_role
from stockmart.params import EnumSet, NaParams
from stockmart.plans.inventory_value import (
    CODES,
    READ,
    SETTLEMENT_RECORD,
    category_key,
    finish,
    labels,
    value_lookups,
)
from stockmart.sources.tables import incremental, live
from stockmart.steps import Steps


# Columns of a transaction that the joins and the date expected need.
JOINED = ("rec_id", "data_area_id", "invent_trans_origin", "voucher", "date_financial", "date_expected",
          "marking_ref_invent_trans_origin", "return_invent_trans_origin")


def _left(df: DataFrame, right: DataFrame, columns: dict[str, str], carry: dict[str, str],
          how: str = "left") -> DataFrame:
    """Join on ``columns`` (left name to right name), keeping only the carried right columns."""
    picked = right.select(
        *[F.col(c).alias(f"_j_{c}") for c in columns.values()],
        *[F.col(source).alias(name) for name, source in carry.items()],
    )
    test = F.lit(True)
    for mine, theirs in columns.items():
        test = test & (F.col(mine) == F.col(f"_j_{theirs}"))
    return df.join(picked, test, how).drop(*[f"_j_{c}" for c in columns.values()])


def adjustments(
    tables: Mapping[str, DataFrame],
    enums: EnumSet,
    execution_id: str | None = None,
    incremental_load: bool = False,
    step: Steps | None = None,
) -> DataFrame:
    """Settled transactions with their adjustment rows, origin and item unit.

    Settlements valued at physical cost and the dummy record 0 are left out. The joins to the
    financial posting and to the marking and return origins, whose columns no fact reads, repeat
    rows where their keys repeat. With ``step`` the joins are stored steps.
    """
    def held(df: DataFrame) -> DataFrame:
        return df if step is None else step(df)

    status = StatusColumns(enums)
    trans = live(tables["invent_trans"]).filter(is_settled(status)).select(
        *[c for c in tables["invent_trans"].columns if c in (*READ, *CODES, *JOINED)]
    )
    settled = incremental(tables["invent_settlement"], execution_id, incremental_load)
    settled = settled.filter(
        (F.col("settle_model") != F.lit(enums.id("InventSettleModel", "PhysicalValue")))
        & (F.col("rec_id") != 0)
    )
    df = _left(
        trans, settled,
        {"rec_id": "trans_rec_id", "data_area_id": "data_area_id"},
        {"settlement_id": "rec_id", "settlement_date": "trans_date",
         "adjustment": "cost_amount_adjustment", "settlement_voucher": "voucher",
         "settlement_dimension": "default_dimension"},
        how="inner",
    )
    df = _left(
        df, tables["invent_trans_origin"],
        {"invent_trans_origin": "rec_id", "data_area_id": "data_area_id"},
        {"reference_category": "reference_category", "reference_id": "reference_id",
         "invent_trans_id": "invent_trans_id"},
        how="inner",
    )
    df = by_role(held(df), tables["invent_trans_posting"], "financial",
                 {"ledger_dimension_financial": "ledger_dimension"}).drop("voucher", "date_financial")
    for column in ("marking_ref_invent_trans_origin", "return_invent_trans_origin"):
        df = _left(df, tables["invent_trans_origin"],
                   {column: "rec_id", "data_area_id": "data_area_id"}, {})
    df = _left(held(df.drop("marking_ref_invent_trans_origin", "return_invent_trans_origin")),
               tables["dimension_value_combination"],
               {"ledger_dimension_financial": "rec_id"}, {"ledger_dimension_id": "rec_id"})
    # The item master is compared on both keys with the module rows, hence an inner join.
    df = _left(df, tables["invent_table"],
               {"item_id": "item_id", "data_area_id": "data_area_id"}, {}, how="inner")
    df = _left(held(df), tables["dimension_value_set"],
               {"settlement_dimension": "rec_id"}, {"default_dimension_id": "rec_id"})
    module = tables["invent_table_module"].filter(F.col("module_type") == 0)
    return _left(df, module, {"item_id": "item_id", "data_area_id": "data_area_id"},
                 {"module_unit": "unit_id"}, how="inner")


def build(
    tables: Mapping[str, DataFrame],
    params: NaParams,
    enums: EnumSet,
    execution_id: str | None = None,
    incremental_load: bool = False,
    step: Steps | None = None,
) -> DataFrame:
    """Rows of the settlement fact, without its surrogate key and audit columns.

    An adjustment moves cost only: its quantity is NULL and so is every quantity bucket. Labels
    follow the lookups, as codes are shorter to shuffle. With ``step`` the joins are stored steps.
    """
    df = adjustments(tables, enums, execution_id, incremental_load, step).withColumns({
        "company_code": F.col("data_area_id"),
        "voucher_number": F.col("settlement_voucher"),
    })
    lookups = value_lookups(params, "settlement_date", "voucher_number")
    keyed = dims.resolve_keys(
        df, tables, lookups, params,
        [*READ, "settlement_id", "adjustment", "voucher_number", "module_unit", "date_expected"], step,
    ).withColumns({
        **labels(enums),
        "record_type": constant(SETTLEMENT_RECORD, "int"),
        "record_id": F.col("settlement_id"),
        "posting_type": F.lit("Adjustment"),
        "category_hierarchy_key": category_key(tables, params),
        "inventory_unit": F.col("module_unit"),
    })
    out = finish(keyed, enums, params, typed_null("decimal(18,4)"), F.col("adjustment"))
    return schemas.conform(
        out, schemas.FACT_SETTLEMENT,
        skip=("inventory_settlement_key", "ea_process_datetime", "ea_is_deleted"),
    )
