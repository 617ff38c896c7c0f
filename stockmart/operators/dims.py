"""Dimension key lookup.

Lookups are plain left joins without hints of their own: Spark broadcasts a dimension when its size is
below the broadcast threshold (as estimated at planning or, after a shuffle, as measured) and otherwise
shuffles both sides, splitting a hot fact key over several tasks. A dimension whose size Spark would
underestimate should come with a ``merge`` hint, as the derived ones do. A left join allows that split because the
fact is on the preserved side, so a code shared by a third of all rows needs no special handling.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockmart.params import NaParams
from stockmart.steps import Steps

_ROW = "_fact_row"
#: So many lookups that may shuffle make a step.
_TOGETHER = 2


@dataclass(frozen=True)
class Lookup:
    """Resolve one surrogate key.

    ``on`` maps dimension columns to fact columns (possibly carried over by an earlier lookup).
    ``key`` is the surrogate key column, written to the fact as ``name``. ``carry`` maps fact
    names to further dimension columns, e.g. the codes a following lookup joins on. Without
    ``unknown`` a miss stays NULL instead of becoming the unknown member.
    """

    dim: str
    on: Mapping[str, str]
    key: str
    name: str | None = None
    carry: Mapping[str, str] = field(default_factory=dict)
    unknown: bool = True
    missing: Column | None = None
    #: Of a few rows in any company, so that no step is stored for the lookup.
    small: bool = False


def resolve_keys(
    fact: DataFrame,
    dims: Mapping[str, DataFrame],
    lookups: Sequence[Lookup],
    params: NaParams,
    columns: Sequence[str] | None = None,
    step: Steps | None = None,
) -> DataFrame:
    """Apply lookups in order; later ones may join on columns carried by earlier ones.

    One join per lookup and a single projection at the end. ``columns`` names what is wanted of the
    fact's and the carried columns; by default all of them.

    With ``step`` the fact is stored once, with numbered rows, and the lookups run on the numbers and
    the codes they join on, a stored step for every other one that is not small. The keys found meet
    the other columns again by the number, so these are shuffled once and not by every lookup.
    """
    keys: dict[str, Column] = {}
    carried: list[str] = []
    made = {name for spec in lookups for name in spec.carry}
    codes = {c for spec in lookups for c in spec.on.values()} - made
    if columns is not None:
        fact = fact.select(*[c for c in fact.columns if c in columns or c in codes])
    whole = joined = fact
    if step is not None:
        whole = step.branch()(fact.withColumn(_ROW, F.monotonically_increasing_id()))
        joined = whole.select(_ROW, *sorted(codes))
    large, most = 0, sum(not spec.small for spec in lookups)
    for n, spec in enumerate(lookups):
        right = dims[spec.dim].select(
            *[F.col(c).alias(f"_d{n}_{c}") for c in spec.on],
            F.col(spec.key).alias(f"_d{n}"),
            *[F.col(source).alias(name) for name, source in spec.carry.items()],
        )
        matches = [f"{fact_column} = _d{n}_{dim_column}"
                   for dim_column, fact_column in spec.on.items()]
        joined = joined.join(right, F.expr(" and ".join(matches)), "left")
        key = F.col(f"_d{n}")
        if spec.unknown:
            key = F.coalesce(key, params.key() if spec.missing is None else spec.missing)
        keys[spec.name or spec.key] = key
        carried += spec.carry
        large += not spec.small
        if step is not None and not spec.small and (large % _TOGETHER == 0 or large == most):
            later = {c for more in lookups[n + 1:] for c in more.on.values()}
            wanted = [c for c in joined.columns
                      if c == _ROW or c in later or c in made and (columns is None or c in columns)]
            joined = step(joined.select(*wanted, *[f"_d{i}" for i in range(n + 1)]))
    kept = [c for c in fact.columns if c not in keys and c not in carried]
    if columns is not None:
        kept, carried = ([c for c in names if c in columns] for names in (kept, carried))
    if step is not None:
        found = joined.select(F.col(_ROW).alias("_found"), *carried, *[f"_d{i}" for i in range(len(lookups))])
        joined = whole.select(_ROW, *kept).join(found, F.col(_ROW) == F.col("_found"))
    return joined.select(*kept, *carried, *[k.alias(name) for name, k in keys.items()])


def confirm_keys(
    fact: DataFrame,
    dims: Mapping[str, DataFrame],
    keys: Mapping[str, str],
    carry: Mapping[str, Mapping[str, str]] | None = None,
    step: Steps | None = None,
) -> DataFrame:
    """Reverse check: keep a fact key only if its dimension still has it, else NULL.

    ``keys`` maps key columns (named alike in fact and dimension) to dimensions; ``carry`` adds
    further columns of a dimension, as new name to dimension column. With ``step`` every other
    check is a stored step.
    """
    joined = fact
    extra: list[str] = []
    for n, (key, dim) in enumerate(keys.items()):
        more = (carry or {}).get(dim, {})
        right = dims[dim].select(
            F.col(key).alias(f"_c{n}"), *[F.col(c).alias(name) for name, c in more.items()]
        )
        joined = joined.join(right, F.expr(f"{key} = _c{n}"), "left")
        extra += more
        joined = joined.select(
            *[F.col(f"_c{n}").alias(c) if c == key else c for c in joined.columns if c != f"_c{n}"]
        )
        if step is not None and ((n + 1) % _TOGETHER == 0 or n + 1 == len(keys)):
            joined = step(joined)
    return joined.select(*fact.columns, *extra)


def constant_key(dim: DataFrame, column: str, value, key: str) -> int | None:
    """Surrogate key of the one member with a constant code, read on the driver; None if missing.

    A lookup by a constant would be a join without a join key.
    """
    rows = dim.filter(F.col(column) == F.lit(value)).select(key).limit(2).collect()
    if len(rows) > 1:
        raise ValueError(f"{column} {value} occurs more than once in its dimension")
    return rows[0][0] if rows else None


# Lookups shared by the facts. Column names follow the enriched transaction frames.
COMPANY = Lookup("dim_company", {"company_code": "company_code"}, "company_key", small=True)
PRODUCT = Lookup(
    "dim_product", {"company_code": "company_code", "item_number": "item_id"}, "product_key",
)
PRODUCT_WITH_UNIT = Lookup(
    "dim_product", {"company_code": "company_code", "item_number": "item_id"}, "product_key",
    carry={"inventory_unit": "inventory_unit"},
)
INVENTORY_DIMENSION = Lookup(
    "dim_inventory_dimension",
    {"company_code": "company_code", "inventory_dimension_id": "invent_dim_id"},
    "inventory_dimension_key",
    carry={
        "id_company_code": "company_code", "id_color": "color_code",
        "id_configuration": "configuration_code", "id_size": "size_code",
        "id_style": "style_code", "id_site": "inventory_site_code",
        "id_warehouse": "warehouse_code",
    },
)
PRODUCT_INVENTORY = Lookup(
    "dim_product_inventory",
    {"company_code": "company_code", "item_number": "item_id",
     "inventory_site_code": "id_site", "inventory_size_code": "id_size"},
    "product_inventory_key",
)
PRODUCT_VARIANT = Lookup(
    "dim_product_variant",
    {"company_code": "company_code", "item_number": "item_id", "product_size": "id_size"},
    "product_variant_key",
)
WAREHOUSE_ON = {"inventory_site_code": "id_site", "warehouse_code": "id_warehouse"}
# The stock level fact joins on the transaction's company and keeps a missing warehouse NULL.
WAREHOUSE_OR_NULL = Lookup(
    "dim_warehouse", {"company_code": "company_code", **WAREHOUSE_ON}, "warehouse_key",
    unknown=False,
)
# The value facts join on the inventory dimension's company and use the unknown member.
WAREHOUSE = Lookup(
    "dim_warehouse", {"company_code": "id_company_code", **WAREHOUSE_ON}, "warehouse_key"
)
CURRENCY = Lookup("dim_currency", {"currency_code": "currency_code"}, "currency_key", small=True)
DEFAULT_DIMENSION = Lookup(
    "dim_default_dimension", {"default_dimension_id": "default_dimension_id"},
    "default_dimension_key",
)
LOAD = Lookup("dim_load", {"company_code": "company_code", "load_code": "load_id"}, "load_key")


def item_attribute(attribute: str, code: str) -> Lookup:
    """Color, config, size or style of an item, by the code its inventory dimension names."""
    return Lookup(
        f"dim_inventory_{attribute}",
        {"company_code": "company_code", "item_code": "item_id",
         f"inventory_{attribute}_code": code},
        f"inventory_{attribute}_key",
    )


def sales_invoice(voucher: str) -> Lookup:
    return Lookup(
        "dim_sales_invoice",
        {"company_code": "company_code", "invoice_number": "invoice_id", "voucher": voucher},
        "sales_invoice_key",
    )


def transaction_date(params: NaParams, date: str) -> Lookup:
    """Day of the transaction if the calendar has it, else the default moment."""
    return Lookup(
        "dim_date", {"date_key": date}, "date_key", name="transaction_date",
        missing=params.datetime(), small=True,
    )
