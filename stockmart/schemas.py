"""Schemas of the tables the jobs write.

Keys are long: an int surrogate key would overflow at the row counts this library is meant for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockmart.functions.measures import STOCK_MEASURES, VALUE_MEASURES

KEY = T.LongType()
QTY = T.DecimalType(18, 4)
TEXT = T.StringType()
MOMENT = T.TimestampNTZType()


def _struct(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


def _each(kind: T.DataType, *names: str) -> list[tuple[str, T.DataType]]:
    return [(n, kind) for n in names]


FACT_STOCK_LEVEL = _struct(
    *_each(KEY, "stock_level_key", "company_key", "product_key", "product_inventory_key",
           "inventory_dimension_key", "warehouse_key"),
    ("transaction_date", MOMENT),
    *_each(QTY, *STOCK_MEASURES),
    *_each(TEXT, "transaction_type", "transaction_status", "movement_type",
           "inventory_reference", "inventory_transaction_id", "warehouse_transaction_id",
           "item_set_id"),
    *_each(MOMENT, "inventory_date", "status_date", "ea_process_datetime"),
    ("record_id", KEY),
)

LEVELS = ("physical_stock_quantity", "available_stock_quantity", "reserved_stock_quantity",
          "on_order_stock_quantity")
BOM_LEVELS = tuple(f"bom_{m}" for m in LEVELS)
EOM_LEVELS = tuple(f"eom_{m}" for m in LEVELS)

MOVEMENT_SUMMARY = _struct(
    ("summary_key", KEY),
    *_each(T.IntegerType(), "year", "month"),
    *_each(T.DateType(), "period_start_date", "period_end_date"),
    *_each(KEY, "date_key", "company_key", "product_key", "product_inventory_key",
           "inventory_dimension_key", "inventory_size_key", "warehouse_key"),
    *_each(QTY, *BOM_LEVELS, *EOM_LEVELS, "total_inbound_quantity", "total_outbound_quantity",
           "net_movement_quantity", "quantity_change"),
    *_each(KEY, "inbound_transaction_count", "outbound_transaction_count",
           "total_transaction_count"),
    *_each(QTY, "average_physical_stock_quantity", "average_available_stock_quantity"),
    ("days_inventory_outstanding", T.DecimalType(10, 2)),
    ("stock_turnover_ratio", T.DecimalType(10, 4)),
    *_each(T.IntegerType(), "stockout_days", "product_count"),
    ("transaction_types", TEXT),
    *_each(MOMENT, "ea_process_datetime", "ea_last_update_datetime"),
    ("is_current_month", T.BooleanType()),
)
SUMMARY_KEYS = ("year", "month", "company_key", "product_key", "product_inventory_key",
                "inventory_dimension_key", "warehouse_key")

BALANCE_MONTH = "balance_month"
_BALANCE_KEYS = _each(KEY, "company_key", "product_key", "product_inventory_key",
                      "inventory_dimension_key", "inventory_size_key", "warehouse_key")
MONTH_ACTIVITY = _struct(
    *_BALANCE_KEYS, (BALANCE_MONTH, T.IntegerType()), ("level_date", MOMENT), *_each(QTY, *LEVELS),
    *_each(QTY, *[f"month_{m}" for m in LEVELS]),
)
MONTH_BALANCE = _struct(
    *_BALANCE_KEYS, (BALANCE_MONTH, T.IntegerType()), ("level_date", MOMENT), *_each(QTY, *LEVELS),
    *_each(QTY, *[f"total_{m}" for m in LEVELS]),
)

_VALUE_KEYS = ("company_key", "product_key", "inventory_dimension_key")
_VALUE_TEXT = ("issue_status", "receipt_status", "transaction_type", "inventory_reference",
               "inventory_unit", "posting_type", "voucher_number")
_VALUE_OTHER_KEYS = ("currency_key", "default_dimension_key", "category_hierarchy_key",
                     "inventory_color_key", "inventory_config_key", "inventory_size_key",
                     "inventory_style_key", "warehouse_key", "sales_invoice_key", "load_key",
                     "product_inventory_key")
_VALUE_ATTRIBUTES = [
    *_each(MOMENT, "inventory_date", "status_date"),
    *_each(TEXT, "is_inter_company_transfer", "is_invoice_returned", "product_receipt",
           "is_product_returned", "picking_route_code"),
    *_each(QTY, "settled_quantity", "physical_revenue_amount"),
    *_each(MOMENT, "shipping_confirmed_date", "shipping_requested_date"),
    ("inventory_transaction_id", TEXT),
]
_AUDIT = [("ea_process_datetime", MOMENT), ("ea_is_deleted", T.BooleanType())]

FACT_INVENTORY_VALUE = _struct(
    ("inventory_value_key", KEY), ("record_type", T.IntegerType()), ("record_id", KEY),
    *_each(KEY, *_VALUE_KEYS), ("transaction_date", MOMENT), *_each(TEXT, *_VALUE_TEXT),
    *_each(QTY, *VALUE_MEASURES), *_each(KEY, *_VALUE_OTHER_KEYS), *_VALUE_ATTRIBUTES,
    ("product_variant_key", KEY), *_AUDIT,
)
FACT_SETTLEMENT = _struct(
    ("inventory_settlement_key", KEY), ("record_id", KEY),
    *_each(KEY, *_VALUE_KEYS), ("transaction_date", MOMENT), *_each(TEXT, *_VALUE_TEXT),
    *_each(QTY, *VALUE_MEASURES), *_each(KEY, *_VALUE_OTHER_KEYS), *_VALUE_ATTRIBUTES,
    ("date_expected", MOMENT), *_AUDIT,
)
FACT_SALES_ORDERS = _struct(
    *_each(TEXT, "company_code", "inventory_transaction_id"),
    ("cost_price", QTY), ("reserved_date_physical", MOMENT),
    *_each(QTY, "reserved_physical", "gross_cost_amount", "gross_margin_amount"),
    *_AUDIT,
)

# Columns whose equality means "nothing to update".
VALUE_COMPARED = tuple(
    c for c in FACT_INVENTORY_VALUE.names
    if c not in ("inventory_value_key", "record_type", "record_id") and not c.startswith("ea_")
)
SETTLEMENT_COMPARED = tuple(
    c for c in FACT_SETTLEMENT.names
    if c not in ("inventory_settlement_key", "record_id") and not c.startswith("ea_")
)
SALES_COMPARED = ("company_code", "inventory_transaction_id", "cost_price",
                  "reserved_date_physical", "reserved_physical", "gross_cost_amount",
                  "gross_margin_amount")


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def conform(df: DataFrame, schema: T.StructType, skip: tuple[str, ...] = ()) -> DataFrame:
    """Columns of ``schema`` in order and type; those listed in ``skip`` are left out."""
    fields = [f for f in schema.fields if f.name not in skip]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def display_names(df: DataFrame) -> DataFrame:
    """Report headings: ``physical_stock_quantity`` becomes ``Physical Stock Quantity``."""
    def heading(name: str) -> str:
        if name.startswith("ea_"):
            return name
        words = [w.upper() if w in ("bom", "eom") else w.capitalize() for w in name.split("_")]
        return " ".join(words)

    return df.select(*[F.col(c).alias(heading(c)) for c in df.columns])
