"""Stock health indicators of the monthly summary."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def net_movement(inbound: Column, outbound: Column) -> Column:
    return (inbound - outbound).cast("decimal(18,4)")


def quantity_change(opening: Column, closing: Column) -> Column:
    return (closing - opening).cast("decimal(18,4)")


def average_level(opening: Column, closing: Column) -> Column:
    """Mean of the opening and closing level, unrounded (one more decimal than the levels)."""
    return (opening + closing) / F.lit(2).cast("decimal(1,0)")


def days_inventory_outstanding(closing: Column, outbound: Column, days: Column) -> Column:
    """Days the closing stock lasts at this month's outflow; NULL without outflow."""
    return F.when(outbound > 0, (closing * days / outbound).cast("decimal(10,2)"))


def stock_turnover(outbound: Column, average: Column) -> Column:
    """Outflow over average stock; NULL unless the average is positive."""
    return F.when(average > 0, (outbound / average).cast("decimal(10,4)"))
