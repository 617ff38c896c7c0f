"""Run parameters and the enum dictionary.

Both are small control tables: the parameter row and the declared values of the enums asked for are
read to the driver once, checked, and then used as literals, so label lookups need no join.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockmart.functions.scalar import moment


@dataclass(frozen=True)
class NaParams:
    """Stand-ins for missing values, and the open end of a validity interval."""

    na_string: str = "N/A"
    na_key: int = -1
    na_number: int = 0
    na_datetime: dt.datetime = dt.datetime(1900, 1, 1)
    maximum_date: dt.datetime = dt.datetime(9999, 12, 31)

    @classmethod
    def load(cls, etl_params: DataFrame) -> NaParams:
        """Read the one-row parameter table; zero or several rows are an error."""
        names = ["na_string", "na_key", "na_number", "na_datetime", "maximum_date"]
        rows = etl_params.select(*names).limit(2).collect()
        if len(rows) != 1:
            raise ValueError("the parameter table must hold exactly one row")
        return cls(**rows[0].asDict())

    def key(self) -> Column:
        return F.lit(self.na_key).cast("bigint")

    def text(self) -> Column:
        return F.lit(self.na_string)

    def datetime(self) -> Column:
        return moment(self.na_datetime)


class EnumSet:
    """Ids and labels of the enums a run needs."""

    def __init__(self, rows: Iterable[tuple[str, int, str, str]]):
        self._ids: dict[str, dict[str, int]] = {}
        self._labels: dict[str, dict[int, str]] = {}
        for enum, value_id, name, label in rows:
            labels = self._labels.setdefault(enum, {})
            if value_id in labels:
                raise ValueError(f"enum {enum} lists id {value_id} more than once")
            labels[value_id] = label
            self._ids.setdefault(enum, {})[name] = value_id

    @classmethod
    def load(cls, enum_values: DataFrame, names: Iterable[str]) -> EnumSet:
        """Collect the values of the enums asked for. Each value is listed once, else it stops."""
        wanted = (
            enum_values.filter(F.col("enum_name").isin(*names))
            .select("enum_name", "value_id", "value_name", "value_label")
            .collect()
        )
        return cls(tuple(r) for r in wanted)

    def id(self, enum: str, name: str) -> int:
        """Numeric id of an enum value. A missing name stops the run instead of matching nothing."""
        try:
            return self._ids[enum][name]
        except KeyError:
            raise KeyError(f"enum value {enum}.{name} is not defined") from None

    def ids(self, enum: str, names: Iterable[str]) -> list[int]:
        return [self.id(enum, n) for n in names]

    def label(self, enum: str, value: Column) -> Column:
        """Label for an id column, NULL when the id is unknown."""
        entries = self._labels.get(enum, {})
        if not entries:
            return F.lit(None).cast("string")
        pairs = [F.lit(x) for value_id, text in entries.items() for x in (value_id, text)]
        return F.try_element_at(F.create_map(*pairs), value.cast("int"))
