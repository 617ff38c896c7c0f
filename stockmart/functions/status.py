"""Status gates and the classifications of a stock transaction."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockmart.params import EnumSet

ISSUE = "StatusIssue"
RECEIPT = "StatusReceipt"

# Status names that take part in stock, and the reference category left out of it.
STOCK_ISSUES = ("Sold", "Deducted", "Picked", "ReservPhysical", "ReservOrdered", "OnOrder")
STOCK_RECEIPTS = ("Purchased", "Received", "Registered", "Arrived", "Ordered")
EXCLUDED_CATEGORY = 26

# Movement classes, first match wins, everything else is OTHER.
MOVEMENT_RULES = (
    ("OUT", ISSUE, ("Sold", "Deducted")),
    ("IN", RECEIPT, ("Purchased", "Received")),
    ("TRANSFER", ISSUE, ("Picked",)),
    ("RESERVATION", ISSUE, ("ReservPhysical",)),
    ("ON_ORDER", RECEIPT, ("Arrived", "Ordered")),
)
OTHER_MOVEMENT = "OTHER"
INBOUND_MOVEMENTS = ("IN", "ON_ORDER")
OUTBOUND_MOVEMENTS = ("OUT", "TRANSFER")

# Transaction type by reference category 0, 1, 2, ...
TRANSACTION_TYPES = (
    "None", "Sales Order", "Purchase Order", "Inventory Journal", "Production Order",
    "Transfer Order", "Quotation", "Return Order", "Inventory Movement", "Counting Journal",
    "BOM", "Kanban", "Quality Order", "Inventory Blocking", "Inventory Adjustment",
    "Inventory Transfer", "Inventory Receipt", "Inventory Issue", "Inventory Counting",
    "Inventory On-hand", "Inventory Reservation", "Inventory Marking", "Inventory Settlement",
    "Inventory Cost Adjustment", "Inventory Standard Cost", "Inventory Cost Group",
)
UNKNOWN_TYPE = "Unknown"


@dataclass(frozen=True)
class StatusColumns:
    """Issue and receipt status columns of a frame together with the ids behind their names."""

    enums: EnumSet
    issue: Column = field(default_factory=lambda: F.col("status_issue"))
    receipt: Column = field(default_factory=lambda: F.col("status_receipt"))

    def column(self, enum: str) -> Column:
        return self.issue if enum == ISSUE else self.receipt

    def one_of(self, enum: str, names: Iterable[str]) -> Column:
        return self.column(enum).isin(*self.enums.ids(enum, names))

    def either(self, issues: Iterable[str] = (), receipts: Iterable[str] = ()) -> Column:
        """Issue status among ``issues`` or receipt status among ``receipts``."""
        tests = [
            self.one_of(enum, names)
            for enum, names in ((ISSUE, tuple(issues)), (RECEIPT, tuple(receipts)))
            if names
        ]
        if not tests:
            return F.lit(False)
        return tests[0] if len(tests) == 1 else tests[0] | tests[1]


def is_stock_relevant(status: StatusColumns) -> Column:
    """Open and posted movements; quotations and rows without any status drop out."""
    return status.either(STOCK_ISSUES, STOCK_RECEIPTS)


def is_settled(status: StatusColumns) -> Column:
    return status.either(("Sold",), ("Purchased",))


def category_allowed(category: Column, keep_null: bool) -> Column:
    """Reference category other than the excluded one, with or without rows lacking a category."""
    tested = F.coalesce(category, F.lit(0)) if keep_null else category
    return tested != F.lit(EXCLUDED_CATEGORY)


def movement_type(status: StatusColumns) -> Column:
    rule, *rest = MOVEMENT_RULES
    chain = F.when(status.one_of(rule[1], rule[2]), F.lit(rule[0]))
    for label, enum, names in rest:
        chain = chain.when(status.one_of(enum, names), F.lit(label))
    return chain.otherwise(F.lit(OTHER_MOVEMENT))


def transaction_type(category: Column) -> Column:
    """Label of a reference category; no category counts as 0."""
    labels = F.array(*[F.lit(t) for t in TRANSACTION_TYPES])
    position = F.coalesce(category, F.lit(0)).cast("int")
    return F.coalesce(F.get(labels, position), F.lit(UNKNOWN_TYPE))


def transaction_status(status: StatusColumns) -> Column:
    """Label of the issue status when there is one, else of the receipt status, else NULL."""
    enums = status.enums
    has_issue = status.issue != F.lit(enums.id(ISSUE, "None"))
    has_receipt = status.receipt != F.lit(enums.id(RECEIPT, "None"))
    return F.when(has_issue, enums.label(ISSUE, status.issue)).when(
        has_receipt, enums.label(RECEIPT, status.receipt)
    )
