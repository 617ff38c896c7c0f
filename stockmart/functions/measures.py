"""Quantity and cost measures by status bucket."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockmart.functions.scalar import qty
from stockmart.functions.status import StatusColumns


@dataclass(frozen=True)
class Bucket:
    """Rows whose issue or receipt status belongs to the bucket, with the sign of their amounts."""

    name: str
    issues: tuple[str, ...] = ()
    receipts: tuple[str, ...] = ()
    negate: bool = False

    def covers(self, status: StatusColumns) -> Column:
        return status.either(self.issues, self.receipts)

    def signed(self, amount: Column) -> Column:
        return -amount if self.negate else amount


# Status buckets of the value and settlement facts. The first has no name prefix.
VALUE_BUCKETS = (
    Bucket("", ("Sold", "Deducted"), ("Purchased", "Received")),
    Bucket("posted", ("Sold",), ("Purchased",)),
    Bucket("physical", ("Sold", "Deducted", "Picked"), ("Purchased", "Received", "Registered")),
    Bucket("available_physical", ("Sold", "Deducted", "Picked", "ReservPhysical"),
           ("Purchased", "Received", "Registered")),
    Bucket("total_available",
           ("Sold", "Deducted", "Picked", "ReservPhysical", "ReservOrdered", "OnOrder"),
           ("Purchased", "Received", "Registered", "Arrived", "Ordered")),
    Bucket("physical_reserved", ("ReservPhysical",), negate=True),
    Bucket("ordered_in_total", (), ("Arrived", "Ordered")),
    Bucket("on_order", ("OnOrder",), negate=True),
    Bucket("ordered_reserved", ("ReservOrdered",), negate=True),
    Bucket("available_for_reservation", ("Sold", "Deducted", "Picked", "ReservPhysical"),
           ("Purchased", "Received", "Registered")),
)

# Status buckets of the stock level fact (ordered and on order are the same set).
STOCK_BUCKETS = (
    Bucket("physical_stock_quantity", ("Sold", "Deducted"), ("Purchased", "Received")),
    Bucket("available_stock_quantity", ("Sold", "Deducted", "Picked", "ReservPhysical"),
           ("Purchased", "Received", "Registered")),
    Bucket("reserved_stock_quantity", ("ReservPhysical",), negate=True),
    Bucket("ordered_stock_quantity", ("OnOrder",), ("Arrived", "Ordered")),
    Bucket("on_order_stock_quantity", ("OnOrder",), ("Arrived", "Ordered")),
)
STOCK_MEASURES = tuple(b.name for b in STOCK_BUCKETS)


def _named(prefix: str, suffix: str) -> str:
    return f"{prefix}_{suffix}" if prefix else suffix


VALUE_MEASURES = tuple(
    _named(b.name, suffix) for b in VALUE_BUCKETS for suffix in ("quantity", "cost_amount")
)


def value_buckets(status: StatusColumns, quantity: Column, cost: Column) -> dict[str, Column]:
    """Quantity and cost per bucket, NULL for rows outside the bucket."""
    out: dict[str, Column] = {}
    for bucket in VALUE_BUCKETS:
        inside = bucket.covers(status)
        out[_named(bucket.name, "quantity")] = F.when(inside, qty(bucket.signed(quantity)))
        out[_named(bucket.name, "cost_amount")] = F.when(inside, qty(bucket.signed(cost)))
    return out


def stock_level_sums(status: StatusColumns, quantity: Column) -> dict[str, Column]:
    """The five stock level aggregates; rows outside a bucket add zero."""
    zero = F.lit(0).cast("decimal(18,4)")
    return {
        b.name: qty(F.sum(F.when(b.covers(status), b.signed(quantity)).otherwise(zero)))
        for b in STOCK_BUCKETS
    }
