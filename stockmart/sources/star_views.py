"""Domain tables derived from the generated star schema.

Each view is one SELECT over the given parquet tables in SQL that more than one engine accepts;
the few spellings that differ are format fields (``{explode}``, ``{sequence}``, ``{record_id}``).
The checks use the same text for their inputs, so that they compare operators and not derivations.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

from stockmart.functions.status import TRANSACTION_TYPES
from stockmart.params import NaParams
from stockmart.sources.tables import TableSet, read_table

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Enum dictionary (ids in order of declaration).
ENUMS = {
    "StatusIssue": ("None", "Sold", "Deducted", "Picked", "ReservPhysical", "ReservOrdered",
                    "OnOrder", "QuotationIssue"),
    "StatusReceipt": ("None", "Purchased", "Received", "Registered", "Arrived", "Ordered",
                      "QuotationReceipt"),
    "InventSettleModel": ("None", "Standard", "PhysicalValue"),
    "NoYes": ("No", "Yes"),
    "InventTransType": TRANSACTION_TYPES,
}

VIEWS = {
    # One row per order line: the raw stock transactions.
    "invent_trans": """
        select {record_id} as rec_id,
               concat('B', l_orderkey % 10) as execution_id,
               concat('C', l_orderkey % 5) as data_area_id,
               concat('I', l_partkey) as item_id,
               concat('D', l_suppkey, '-', l_partkey % 50) as invent_dim_id,
               l_orderkey as invent_trans_origin,
               l_orderkey + 1 as marking_ref_invent_trans_origin,
               l_orderkey + 2 as return_invent_trans_origin,
               case when l_linestatus = 'F' then l_linenumber else 0 end as status_issue,
               case when l_linestatus = 'O' then 1 + l_linenumber % 6 else 0 end as status_receipt,
               cast(case when l_linestatus = 'F' then -l_quantity else l_quantity end
                    as decimal(18, 4)) as qty,
               cast(case when l_returnflag = 'R' then l_quantity else 0 end as decimal(18, 4))
                   as qty_settled,
               cast(round(l_extendedprice, 4) as decimal(18, 4)) as cost_amount_physical,
               cast(round(l_extendedprice * (1 - l_discount), 4) as decimal(18, 4))
                   as cost_amount_posted,
               concat('CUR', l_suppkey % 27) as currency_code,
               concat('V', l_linenumber, '-', l_partkey, '-', l_suppkey) as voucher_physical,
               concat('F', l_linenumber, '-', l_partkey, '-', l_suppkey) as voucher,
               l_shipdate as date_physical,
               l_shipdate + interval 7 days as date_financial,
               l_shipdate as date_invent,
               l_shipdate + l_linenumber * interval 1 day as date_status,
               l_shipdate + interval 30 days as date_expected,
               case when l_returnflag <> 'N' then concat('INV', l_orderkey) end as invoice_id,
               case when l_returnflag = 'R' then 1 else 0 end as invoice_returned,
               case when l_linestatus = 'F' then concat('PS', l_orderkey) end as packing_slip_id,
               case when l_returnflag = 'R' and l_linestatus = 'F' then 1 else 0 end
                   as packing_slip_returned,
               concat('PR', l_suppkey) as picking_route_id,
               concat('LD', l_suppkey) as load_id,
               l_linenumber % 3 as inter_company_invent_dim_transferred,
               cast(round(l_extendedprice * (1 + l_tax), 4) as decimal(18, 4))
                   as revenue_amount_physical,
               l_shipdate + interval 1 day as shipping_date_confirmed,
               l_shipdate as shipping_date_requested,
               case when l_tax > 0 then l_shipdate end as data_lake_modified
        from {lineitem}""",
    # One row per order: what the transactions of an order originate from.
    "invent_trans_origin": """
        select o_orderkey as rec_id,
               concat('C', o_orderkey % 5) as data_area_id,
               case when o_orderkey % 29 = 0 then null else cast(o_orderkey % 28 as int) end
                   as reference_category,
               concat('SO', o_orderkey) as reference_id,
               concat('L', o_orderkey) as invent_trans_id
        from {orders}""",
    # Physical postings (type 0) of all lines; financial ones (type 1) only for two return flags.
    "invent_trans_posting": """
        select {record_id} as rec_id, 0 as posting_type,
               concat('C', l_orderkey % 5) as data_area_id, l_orderkey as invent_trans_origin,
               concat('V', l_linenumber, '-', l_partkey, '-', l_suppkey) as voucher,
               l_shipdate as trans_date, l_suppkey as default_dimension,
               l_partkey as ledger_dimension
        from {lineitem}
        union all
        select case when l_returnflag = 'A' then 0 else {record_id} end as rec_id,
               1 as posting_type,
               concat('C', l_orderkey % 5) as data_area_id, l_orderkey as invent_trans_origin,
               concat('F', l_linenumber, '-', l_partkey, '-', l_suppkey) as voucher,
               l_shipdate + interval 7 days as trans_date, l_suppkey + 1 as default_dimension,
               l_partkey as ledger_dimension
        from {lineitem} where l_returnflag <> 'R'""",
    "invent_settlement": """
        select {record_id} as rec_id,
               concat('B', l_orderkey % 10) as execution_id,
               concat('C', l_orderkey % 5) as data_area_id,
               {record_id} as trans_rec_id,
               l_shipdate + interval 45 days as trans_date,
               cast(round(l_extendedprice * l_tax, 4) as decimal(18, 4)) as cost_amount_adjustment,
               concat('F', l_linenumber, '-', l_partkey, '-', l_suppkey) as voucher,
               l_suppkey as default_dimension,
               l_linenumber % 3 as settle_model,
               concat('L', l_orderkey) as invent_trans_id
        from {lineitem} where l_returnflag = 'R'""",
    "invent_table": """
        select concat('I', p_partkey) as item_id, concat('C', company) as data_area_id
        from (select p_partkey, {explode}({sequence}(0, 4)) as company from {part}) p""",
    "invent_table_module": """
        select concat('I', p_partkey) as item_id, concat('C', company) as data_area_id,
               module_type, case when p_size > 25 then 'box' else 'pcs' end as unit_id
        from (select p_partkey, p_size, company, {explode}({sequence}(0, 2)) as module_type
              from (select p_partkey, p_size, {explode}({sequence}(0, 4)) as company
                    from {part}) c) p""",
    "dimension_value_set": "select s_suppkey as rec_id from {supplier}",
    "dimension_value_combination": "select p_partkey as rec_id from {part} where p_size > 5",
    "invent_dim": """
        select concat('D', s_suppkey, '-', size) as invent_dim_id,
               concat('C', company) as data_area_id, s_nationkey as invent_site_id
        from (select s_suppkey, s_nationkey, company, {explode}({sequence}(0, 49)) as size
              from (select s_suppkey, s_nationkey, {explode}({sequence}(0, 4)) as company
                    from {supplier}) c) d""",
    # A yearly price for every item in every company, at one inventory dimension.
    "invent_item_price": """
        select concat('C', company) as data_area_id, concat('I', p_partkey) as item_id,
               concat('D', p_partkey % 10, '-', p_partkey % 50) as invent_dim_id,
               cast(round(p_retailprice * (1 + (y - 1995) * 0.01), 4) as decimal(18, 4)) as price,
               make_date(cast(y as int), 1, 1) as activation_date,
               case when p_size > 1 then make_date(cast(y as int), 1, 1) end as data_lake_modified
        from (select p_partkey, p_retailprice, p_size, company,
                     {explode}({sequence}(1995, 2001)) as y
              from (select p_partkey, p_retailprice, p_size,
                           {explode}({sequence}(0, 4)) as company from {part}) c) p""",
    "sales_line": """
        select concat('L', o_orderkey) as invent_trans_id,
               concat('C', o_orderkey % 5) as data_area_id,
               case when o_orderstatus = 'P' then 4 else 0 end as sales_type,
               cast(case when o_orderpriority = '5-LOW' then 0
                         else round(o_totalprice / 100, 4) end as decimal(18, 4)) as cost_price,
               cast(round(o_totalprice, 4) as decimal(18, 4)) as line_amount,
               concat('D', o_custkey % 10, '-', o_custkey % 50) as invent_dim_id,
               concat('I', o_custkey) as item_id,
               o_orderdate as created_datetime
        from {orders}""",
    # Dimensions. Natural predicates leave members out, so that lookups also miss.
    "dim_company": """
        select concat('C', r_regionkey) as company_code,
               cast(r_regionkey + 1 as bigint) as company_key
        from {region} where r_name <> 'EUROPE'""",
    "dim_currency": """
        select concat('CUR', n_nationkey) as currency_code,
               cast(n_nationkey + 1 as bigint) as currency_key
        from {nation}""",
    "dim_product": """
        select concat('C', company) as company_code, concat('I', p_partkey) as item_number,
               cast(p_partkey * 5 + company + 1 as bigint) as product_key,
               case when p_size > 25 then 'box' else 'pcs' end as inventory_unit
        from (select p_partkey, p_size, {explode}({sequence}(0, 4)) as company
              from {part} where p_type <> 'PROMO') p""",
    "dim_inventory_dimension": """
        select concat('C', company) as company_code,
               concat('D', s_suppkey, '-', size) as inventory_dimension_id,
               cast((s_suppkey * 50 + size) * 5 + company + 1 as bigint)
                   as inventory_dimension_key,
               cast(size + 1 as bigint) as inventory_size_key,
               concat('CL', s_nationkey % 3) as color_code,
               concat('CF', s_nationkey % 2) as configuration_code,
               concat('S', size) as size_code,
               concat('ST', size % 7) as style_code,
               concat('SITE', s_nationkey) as inventory_site_code,
               concat('W', s_suppkey) as warehouse_code
        from (select s_suppkey, s_nationkey, company, {explode}({sequence}(0, 49)) as size
              from (select s_suppkey, s_nationkey, {explode}({sequence}(0, 4)) as company
                    from {supplier}) c) d""",
    "dim_default_dimension": """
        select s_suppkey as default_dimension_id,
               cast(s_suppkey + 1 as bigint) as default_dimension_key
        from {supplier}""",
    "dim_date": """
        select d as date_key, cast(d as date) as calendar_date,
               cast(year(d) * 10000 + month(d) * 100 + day(d) as bigint) as date_id
        from (select {explode}({sequence}(min(o_orderdate), max(o_orderdate), interval 1 day)) as d
              from {orders}) c""",
    "dim_inventory_color": """
        select concat('C', company) as company_code, concat('I', p_partkey) as item_code,
               concat('CL', p_partkey % 3) as inventory_color_code,
               cast(p_partkey * 5 + company + 1 as bigint) as inventory_color_key
        from (select p_partkey, {explode}({sequence}(0, 4)) as company from {part}) p""",
    "dim_inventory_config": """
        select concat('C', company) as company_code, concat('I', p_partkey) as item_code,
               concat('CF', p_size % 2) as inventory_config_code,
               cast(p_partkey * 5 + company + 1 as bigint) as inventory_config_key
        from (select p_partkey, p_size, {explode}({sequence}(0, 4)) as company from {part}) p""",
    "dim_inventory_size": """
        select concat('C', company) as company_code, concat('I', p_partkey) as item_code,
               concat('S', p_partkey % 50) as inventory_size_code,
               cast(p_partkey * 5 + company + 1 as bigint) as inventory_size_key
        from (select p_partkey, {explode}({sequence}(0, 4)) as company from {part}) p""",
    "dim_inventory_style": """
        select concat('C', company) as company_code, concat('I', p_partkey) as item_code,
               concat('ST', p_size % 7) as inventory_style_code,
               cast(p_partkey * 5 + company + 1 as bigint) as inventory_style_key
        from (select p_partkey, p_size, {explode}({sequence}(0, 4)) as company from {part}) p""",
    "dim_category_hierarchy": """
        select cast(r_regionkey as bigint) as category_id,
               cast(r_regionkey + 100 as bigint) as category_hierarchy_key
        from {region}""",
    "dim_warehouse": """
        select concat('C', company) as company_code,
               concat('SITE', s_nationkey) as inventory_site_code,
               concat('W', s_suppkey) as warehouse_code,
               cast(s_suppkey * 5 + company + 1 as bigint) as warehouse_key
        from (select s_suppkey, s_nationkey, {explode}({sequence}(0, 4)) as company
              from {supplier} where s_acctbal >= 0) s""",
    "dim_sales_invoice": """
        select concat('C', l_orderkey % 5) as company_code,
               concat('INV', l_orderkey) as invoice_number,
               concat('F', l_linenumber, '-', l_partkey, '-', l_suppkey) as voucher,
               {record_id} as sales_invoice_key
        from {lineitem} where l_returnflag <> 'N'""",
    "dim_load": """
        select concat('C', company) as company_code, concat('LD', s_suppkey) as load_code,
               cast(s_suppkey * 5 + company + 1 as bigint) as load_key
        from (select s_suppkey, {explode}({sequence}(0, 4)) as company
              from {supplier} where s_nationkey <> 7) s""",
    # Products stocked at a site so far: those with an issued line there.
    "dim_product_inventory": """
        select concat('C', company) as company_code, concat('I', partkey) as item_number,
               concat('SITE', site) as inventory_site_code,
               concat('S', partkey % 50) as inventory_size_code,
               cast((partkey * 25 + site) * 5 + company + 1 as bigint) as product_inventory_key
        from (select distinct l_partkey as partkey, s_nationkey as site, l_orderkey % 5 as company
              from {lineitem} join {supplier} on s_suppkey = l_suppkey
              where l_linestatus = 'F') s""",
    "dim_product_variant": """
        select concat('C', company) as company_code, concat('I', p_partkey) as item_number,
               concat('S', p_partkey % 50) as product_size,
               cast(p_partkey * 5 + company + 1 as bigint) as product_variant_key
        from (select p_partkey, {explode}({sequence}(0, 4)) as company
              from {part} where p_size > 10) p""",
    # Sales order fact before the cost refresh: low-priority orders have never been costed.
    "fact_sales_orders": """
        select concat('C', o_orderkey % 5) as company_code,
               concat('L', o_orderkey) as inventory_transaction_id,
               cast(case when o_orderpriority <> '5-LOW' then round(o_totalprice / 100, 4) end
                    as decimal(18, 4)) as cost_price,
               cast(null as timestamp_ntz) as reserved_date_physical,
               cast(0 as decimal(18, 4)) as reserved_physical,
               cast(null as decimal(18, 4)) as gross_cost_amount,
               cast(round(o_totalprice, 4) as decimal(18, 4)) as gross_margin_amount,
               cast(null as timestamp_ntz) as ea_process_datetime,
               cast(null as boolean) as ea_is_deleted
        from {orders}""",
}

# Views with a row per order or part, or several per part or supplier. The calendar explodes too, but
# has a row per day.
SORT_MERGED = {v for v, text in VIEWS.items() if "{explode}" in text and v != "dim_date"} | {
    "invent_trans_origin", "dimension_value_combination",
}

_SPARK_SPELLING = {
    "explode": "explode",
    "sequence": "sequence",
    "record_id": (
        "cast(conv(substring(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,"
        " date_format(l_shipdate, 'yyyyMMdd'))), 1, 15), 16, 10) as bigint)"
    ),
}


def base_tables_of(view: str) -> list[str]:
    fields = {name for _, name, _, _ in string.Formatter().parse(VIEWS[view]) if name}
    return sorted(fields & set(BASE_TABLES))


def star_view(spark: SparkSession, base: TableSet, view: str) -> DataFrame:
    """A view over the base tables.

    Spark sizes a view by its compressed files and knows nothing of the rows that explode adds, up
    to 250 for each stored one; it would broadcast large views through the driver. Joins with views
    of ``SORT_MERGED`` are therefore sort-merge joins, at every size.
    """
    names = base_tables_of(view)
    text = VIEWS[view].format(**_SPARK_SPELLING, **{n: "{" + n + "}" for n in names})
    rows = spark.sql(text, **{n: base[n] for n in names})
    return rows.hint("merge") if view in SORT_MERGED else rows


def enum_frame(spark: SparkSession) -> DataFrame:
    rows = ", ".join(
        f"('{e}', {i}, '{n}', '{n}')" for e, names in ENUMS.items() for i, n in enumerate(names)
    )
    return spark.sql(
        f"select * from values {rows} as t(enum_name, value_id, value_name, value_label)"
    )


def params_frame(spark: SparkSession, params: NaParams | None = None) -> DataFrame:
    p = params or NaParams()
    return spark.sql(
        f"select '{p.na_string}' as na_string, {p.na_key} as na_key, {p.na_number} as na_number, "
        f"timestamp_ntz '{p.na_datetime}' as na_datetime, "
        f"timestamp_ntz '{p.maximum_date}' as maximum_date"
    )


def star_tables(spark: SparkSession, sf_dir: str) -> TableSet:
    """All domain tables over one folder of generated tables."""
    base = TableSet({b: (lambda b=b: read_table(spark, sf_dir, b)) for b in BASE_TABLES})
    openers = {v: (lambda v=v: star_view(spark, base, v)) for v in VIEWS}
    openers.update({b: (lambda b=b: base[b]) for b in BASE_TABLES})
    openers["enum_values"] = lambda: enum_frame(spark)
    openers["etl_params"] = lambda: params_frame(spark)
    return TableSet(openers)
