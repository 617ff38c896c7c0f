"""Voucher postings joined in two roles, and the choice between them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockmart.steps import Steps

PHYSICAL = 0
FINANCIAL = 1

# Per role: posting type, and the transaction columns holding its voucher and date.
ROLES = {
    "physical": (PHYSICAL, "voucher_physical", "date_physical"),
    "financial": (FINANCIAL, "voucher", "date_financial"),
}


def by_role(trans: DataFrame, postings: DataFrame, role: str, carry: dict[str, str]) -> DataFrame:
    """Left join of the postings of one role; ``carry`` maps output names to posting columns.

    The role filter runs on the posting scan. Several postings for a voucher multiply the
    transaction, as the join says. Carried columns that are join keys as well are shuffled once.
    """
    posting_type, voucher, date = ROLES[role]
    keys = {"data_area_id": "_p_company", "invent_trans_origin": "_p_origin",
            "voucher": "_p_voucher", "trans_date": "_p_date"}
    right = postings.filter(F.col("posting_type") == posting_type).select(
        *[F.col(source).alias(name) for source, name in keys.items()],
        *[F.col(source).alias(name) for name, source in carry.items() if source not in keys],
    )
    on = (
        (F.col("data_area_id") == F.col("_p_company"))
        & (F.col("invent_trans_origin") == F.col("_p_origin"))
        & (F.col(voucher) == F.col("_p_voucher"))
        & (F.col(date) == F.col("_p_date"))
    )
    return trans.join(right, on, "left").select(
        *trans.columns, *[F.col(keys.get(source, name)).alias(name) for name, source in carry.items()]
    )


def with_postings(
    trans: DataFrame, postings: DataFrame, columns: Sequence[str] | None = None,
    step: Steps | None = None,
) -> DataFrame:
    """Both roles with the columns the facts read, or of all columns those that are wanted.

    With ``step`` the physical role is a stored step.
    """
    def held(df: DataFrame, *more: str) -> DataFrame:
        return df if columns is None else df.select(*[c for c in df.columns if c in columns or c in more])

    df = by_role(
        trans, postings, "physical",
        {"voucher_number_physical": "voucher", "default_dimension_physical": "default_dimension",
         "ledger_dimension_physical": "ledger_dimension"},
    )
    keys = ("data_area_id", "invent_trans_origin", "voucher", "date_financial")
    df = held(df, *keys)
    return held(by_role(
        df if step is None else step(df), postings, "financial",
        {"voucher_number_financial": "voucher", "posting_financial_id": "rec_id",
         "default_dimension_financial": "default_dimension",
         "ledger_dimension_financial": "ledger_dimension"},
    ))


def choose(physical: Column, financial: Column, posting_id: Column | None = None) -> Column:
    """Physical value for a financial posting id of exactly 0, else the financial value.

    A transaction without a financial posting has a NULL id and therefore counts as financial.
    """
    ident = F.col("posting_financial_id") if posting_id is None else posting_id
    return F.when(ident == 0, physical).otherwise(financial)
