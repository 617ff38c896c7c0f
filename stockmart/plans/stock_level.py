"""Stock level fact: one row per transaction with dimension keys and quantity buckets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockmart.functions.measures import stock_level_sums
from stockmart.functions.scalar import typed_null
from stockmart.functions.status import (
    StatusColumns,
    movement_type,
    transaction_status,
    transaction_type,
)
from stockmart.operators import dims
from stockmart.params import EnumSet, NaParams
from stockmart.plans.enrich import stock_transactions
from stockmart.steps import Steps

GROUP_KEYS = (
    "company_key", "product_key", "product_inventory_key", "inventory_dimension_key",
    "transaction_date", "warehouse_key", "transaction_type", "transaction_status",
    "movement_type", "inventory_reference", "inventory_date", "status_date",
    "inventory_transaction_id", "record_id",
)


#: Columns of the transactions that the fact reads beside the codes of its keys.
READ = ("rec_id", "status_issue", "status_receipt", "qty", "reference_category", "reference_id",
        "date_invent", "date_status")


def classify(df: DataFrame, enums: EnumSet) -> DataFrame:
    status = StatusColumns(enums)
    return df.withColumns({
        "movement_type": movement_type(status),
        "transaction_type": transaction_type(F.col("reference_category")),
        "transaction_status": transaction_status(status),
    })


def build(
    tables: Mapping[str, DataFrame],
    params: NaParams,
    enums: EnumSet,
    execution_id: str | None = None,
    incremental_load: bool = False,
    step: Steps | None = None,
) -> DataFrame:
    """Rows of the stock level fact, without its surrogate key and audit column.

    Vouchers are not part of this fact, but duplicate postings multiply its sums. Labels follow the
    lookups, as codes are shorter to shuffle. With ``step`` the joins are stored steps.
    """
    trans = stock_transactions(
        tables, enums, execution_id, incremental_load,
        keep_null_category=True, null_id_means_all=True,
        columns=[*READ, "company_code", "item_id", "invent_dim_id", "date_physical"], step=step,
    )
    keyed = dims.resolve_keys(
        trans, tables,
        [dims.COMPANY, dims.PRODUCT, dims.INVENTORY_DIMENSION, dims.PRODUCT_INVENTORY,
         dims.WAREHOUSE_OR_NULL, dims.transaction_date(params, "date_physical")],
        params, READ, step,
    )
    rows = classify(keyed, enums).withColumns({
        "inventory_reference": F.col("reference_id"),
        "inventory_date": F.col("date_invent"),
        "status_date": F.col("date_status"),
        "inventory_transaction_id": F.col("rec_id").cast("string"),
        "record_id": F.col("rec_id"),
    })
    # Partitioned by record id once: the grouping below and the later merge both reuse it.
    used = [*GROUP_KEYS, "status_issue", "status_receipt", "qty"]
    placed = rows.select(*used).repartition("record_id")
    sums = stock_level_sums(StatusColumns(enums), F.col("qty"))
    facts = placed.groupBy(*GROUP_KEYS).agg(*[m.alias(n) for n, m in sums.items()])
    return facts.withColumns({
        "warehouse_transaction_id": typed_null("string"),
        "item_set_id": typed_null("string"),
    })
