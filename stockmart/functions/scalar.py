"""Scalar helpers whose rules differ from Spark's plain functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

QTY = T.DecimalType(18, 4)


def typed_null(data_type: str | T.DataType) -> Column:
    """A NULL column with a real type, so that no void type reaches a table."""
    return F.lit(None).cast(data_type)


def constant(value, data_type: str | T.DataType) -> Column:
    return F.lit(value).cast(data_type)


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def moment(value: dt.datetime) -> Column:
    """Literal without time zone, whatever zones the session and the driver run in."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def qty(value: Column) -> Column:
    """Quantity and amount type of the facts."""
    return value.cast(QTY)


def quotient(numerator: Column, denominator: Column, strict: bool) -> Column:
    """Division. ``strict`` raises on zero, otherwise the result is NULL."""
    return numerator / denominator if strict else F.try_divide(numerator, denominator)


def run_label(moment: Column, prefix: str = "RUN_") -> Column:
    """Execution tag such as ``RUN_19980601_093000``."""
    return F.concat(F.lit(prefix), F.date_format(moment, "yyyyMMdd_HHmmss"))


def period_label(year: Column, month: Column) -> Column:
    """``1998-06`` from its parts."""
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))
