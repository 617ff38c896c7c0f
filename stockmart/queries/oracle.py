"""SQL twins of the registered queries, for an independent engine over the same parquet tables.

Inputs come from the shared view texts; everything an operator computes is written here on its own.
"""

from __future__ import annotations

import re

from stockmart.functions.status import TRANSACTION_TYPES
from stockmart.sources.star_views import BASE_TABLES, ENUMS, VIEWS

_SPELLING = {
    "explode": "unnest",
    "sequence": "generate_series",
    "record_id": (
        "cast('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,"
        " strftime(l_shipdate, '%Y%m%d'))), 1, 15) as bigint)"
    ),
}


def _view(name: str) -> str:
    text = VIEWS[name].format(**_SPELLING, **{t: t for t in BASE_TABLES})
    return text.replace("timestamp_ntz", "timestamp")


def _listed(names: tuple[str, ...], index: str) -> str:
    quoted = ", ".join(f"'{n}'" for n in names)
    return f"(array[{quoted}])[{index} + 1]"


# Status ids: issue 1 Sold .. 6 OnOrder, receipt 1 Purchased .. 5 Ordered.
MOVEMENT = """case when status_issue < 3 and status_issue > 0 then 'OUT'
     when status_receipt < 3 and status_receipt > 0 then 'IN'
     when status_issue = 3 then 'TRANSFER' when status_issue = 4 then 'RESERVATION'
     when status_receipt in (4, 5) then 'ON_ORDER' else 'OTHER' end"""
TYPE = (
    "case when coalesce(reference_category, 0) > 25 then 'Unknown' else "
    + _listed(TRANSACTION_TYPES, "coalesce(reference_category, 0)") + " end"
)
STATUS = (
    f"case when status_issue > 0 then {_listed(ENUMS['StatusIssue'], 'status_issue')} "
    f"when status_receipt > 0 then {_listed(ENUMS['StatusReceipt'], 'status_receipt')} end"
)


def _within(issues: str, receipts: str) -> str:
    parts = [f"status_issue in ({issues})"] if issues else []
    parts += [f"status_receipt in ({receipts})"] if receipts else []
    return " or ".join(parts)


# name, issue ids, receipt ids, sign
STOCK = [
    ("physical_stock_quantity", "1, 2", "1, 2", ""),
    ("available_stock_quantity", "1, 2, 3, 4", "1, 2, 3", ""),
    ("reserved_stock_quantity", "4", "", "-"),
    ("ordered_stock_quantity", "6", "4, 5", ""),
    ("on_order_stock_quantity", "6", "4, 5", ""),
]
VALUE = [
    ("{}", "1, 2", "1, 2", ""),
    ("posted_{}", "1", "1", ""),
    ("physical_{}", "1, 2, 3", "1, 2, 3", ""),
    ("available_physical_{}", "1, 2, 3, 4", "1, 2, 3", ""),
    ("total_available_{}", "1, 2, 3, 4, 5, 6", "1, 2, 3, 4, 5", ""),
    ("physical_reserved_{}", "4", "", "-"),
    ("ordered_in_total_{}", "", "4, 5", ""),
    ("on_order_{}", "6", "", "-"),
    ("ordered_reserved_{}", "5", "", "-"),
    ("available_for_reservation_{}", "1, 2, 3, 4", "1, 2, 3", ""),
]
STOCK_NAMES = [n for n, *_ in STOCK]
VALUE_NAMES = [n.format(m) for n, *_ in VALUE for m in ("quantity", "cost_amount")]
STOCK_SUMS = ",\n".join(
    f"coalesce(sum({sign}qty) filter (where {_within(i, r)}), 0) as {name}"
    for name, i, r, sign in STOCK
)


def _value_columns(quantity: str, cost: str, wrap: str = "{}") -> str:
    return ",\n".join(
        wrap.format(f"case when {_within(i, r)} then {sign}({source}) end")
        + f" as {name.format(measure)}"
        for name, i, r, sign in VALUE
        for measure, source in (("quantity", quantity), ("cost_amount", cost))
    )


KEY6 = ("company_key", "product_key", "product_inventory_key", "inventory_dimension_key",
        "inventory_size_key", "warehouse_key")
KEY5 = tuple(k for k in KEY6 if k != "inventory_size_key")
K6 = ", ".join(KEY6)
LEVELS = ("physical_stock_quantity", "available_stock_quantity", "reserved_stock_quantity",
          "on_order_stock_quantity")


def _same(a: str, b: str, columns) -> str:
    return " and ".join(f"{a}.{c} = {b}.{c}" for c in columns)


def _star(source: str, extra: str = "", company: str = "s.company_code") -> str:
    """Joins of the value facts' star; ``extra`` adds lookups."""
    item = "x.company_code = s.company_code and x.item_code = s.item_id"
    return f"""from {source} s
left join dim_company co on co.company_code = s.company_code
left join dim_currency cu on cu.currency_code = s.currency_code
left join dim_product pr on pr.company_code = s.company_code and pr.item_number = s.item_id
left join dim_inventory_dimension idm on idm.company_code = s.company_code
     and idm.inventory_dimension_id = s.invent_dim_id
left join dim_default_dimension df on df.default_dimension_id = s.default_dimension_id
left join dim_date dt on dt.date_key = s.moment
left join dim_inventory_color x on {item} and x.inventory_color_code = idm.color_code
left join dim_inventory_config y on {item.replace('x.', 'y.')}
     and y.inventory_config_code = idm.configuration_code
left join dim_inventory_size z on {item.replace('x.', 'z.')}
     and z.inventory_size_code = idm.size_code
left join dim_inventory_style st on {item.replace('x.', 'st.')}
     and st.inventory_style_code = idm.style_code
left join dim_category_hierarchy ca on ca.category_id = 0
left join dim_warehouse wh on wh.company_code = idm.company_code
     and wh.inventory_site_code = idm.inventory_site_code
     and wh.warehouse_code = idm.warehouse_code
left join dim_sales_invoice iv on iv.company_code = s.company_code
     and iv.invoice_number = s.invoice_id and iv.voucher = s.invoice_voucher
left join dim_load ld on ld.company_code = s.company_code and ld.load_code = s.load_id
left join dim_product_inventory pi on pi.company_code = s.company_code
     and pi.item_number = s.item_id and pi.inventory_site_code = idm.inventory_site_code
     and pi.inventory_size_code = idm.size_code
{extra}"""


_STAR_KEYS = """coalesce(co.company_key, -1) as company_key,
coalesce(pr.product_key, -1) as product_key,
coalesce(idm.inventory_dimension_key, -1) as inventory_dimension_key,
coalesce(dt.date_key, timestamp '1900-01-01') as transaction_date,
coalesce(cu.currency_key, -1) as currency_key,
coalesce(df.default_dimension_key, -1) as default_dimension_key,
coalesce(ca.category_hierarchy_key, -1) as category_hierarchy_key,
coalesce(x.inventory_color_key, -1) as inventory_color_key,
coalesce(y.inventory_config_key, -1) as inventory_config_key,
coalesce(z.inventory_size_key, -1) as inventory_size_key,
coalesce(st.inventory_style_key, -1) as inventory_style_key,
coalesce(wh.warehouse_key, -1) as warehouse_key,
coalesce(iv.sales_invoice_key, -1) as sales_invoice_key,
coalesce(ld.load_key, -1) as load_key,
coalesce(pi.product_inventory_key, -1) as product_inventory_key"""

_ISSUE = _listed(ENUMS["StatusIssue"], "s.status_issue")
_RECEIPT = _listed(ENUMS["StatusReceipt"], "s.status_receipt")


def _no_yes(column: str) -> str:
    return f"case s.{column} when 0 then 'No' when 1 then 'Yes' end"


_VALUE_ATTRIBUTES = f"""coalesce({_ISSUE}, 'N/A') as issue_status,
coalesce({_RECEIPT}, 'N/A') as receipt_status,
coalesce(case when s.reference_category <= 25 then
  {_listed(TRANSACTION_TYPES, 's.reference_category')} end, 'N/A') as transaction_type,
coalesce(s.reference_id, 'N/A') as inventory_reference,
coalesce(s.posting_type, 'N/A') as posting_type,
coalesce(s.voucher_number, 'N/A') as voucher_number,
s.date_invent as inventory_date, s.date_status as status_date,
{_no_yes('inter_company_invent_dim_transferred')} as is_inter_company_transfer,
{_no_yes('invoice_returned')} as is_invoice_returned,
s.packing_slip_id as product_receipt,
{_no_yes('packing_slip_returned')} as is_product_returned,
s.picking_route_id as picking_route_code, s.qty_settled as settled_quantity,
s.revenue_amount_physical as physical_revenue_amount,
s.shipping_date_confirmed as shipping_confirmed_date,
s.shipping_date_requested as shipping_requested_date,
s.invent_trans_id as inventory_transaction_id"""

_SCALED = "cast({} * 10000 as hugeint)"
_ENDS = "last_day(make_date(year, month, 1))"


def _ratio4(numerator: str, denominator: str) -> str:
    """Quotient of two amounts rounded half up to four places in whole numbers; NULL over zero."""
    n, d = (f"cast({x} * 10000 as hugeint)" for x in (numerator, denominator))
    return (f"case when {denominator} <> 0 then sign({n}) * sign({d}) * "
            f"((2 * abs({n}) * 10000 + abs({d})) // (2 * abs({d}))) / 10000.0 end")


def _indicators(source: str, types: str = "transaction_types") -> str:
    """Final summary columns; ratios are rounded in whole numbers."""
    bom, eom = _SCALED.format("bom_physical_stock_quantity"), _SCALED.format(
        "eom_physical_stock_quantity")
    out = _SCALED.format("total_outbound_quantity")
    scaled_dio = f"{eom} * day({_ENDS}) * 100"
    return f"""select year, month, make_date(year, month, 1) as period_start_date,
{_ENDS} as period_end_date, date_key, {K6},
{', '.join(f'{p}_{m}' for p in ('bom', 'eom') for m in LEVELS)},
total_inbound_quantity, total_outbound_quantity,
total_inbound_quantity - total_outbound_quantity as net_movement_quantity,
eom_physical_stock_quantity - bom_physical_stock_quantity as quantity_change,
inbound_transaction_count, outbound_transaction_count, total_transaction_count,
(cast(bom_physical_stock_quantity as double) + cast(eom_physical_stock_quantity as double)) / 2
  as average_physical_stock_quantity,
(cast(bom_available_stock_quantity as double) + cast(eom_available_stock_quantity as double)) / 2
  as average_available_stock_quantity,
case when total_outbound_quantity > 0 then
  sign({eom}) * ((2 * abs({scaled_dio}) + {out}) // (2 * {out})) / 100.0 end
  as days_inventory_outstanding,
case when bom_physical_stock_quantity + eom_physical_stock_quantity > 0 then
  ((4 * {out} * 10000 + {bom} + {eom}) // (2 * ({bom} + {eom}))) / 10000.0 end
  as stock_turnover_ratio,
cast(null as bigint) as stockout_days, cast(null as bigint) as product_count,
{types} as transaction_types, year = 2001 and month = 8 as is_current_month
from {source}"""


_MOVES = """
sum(case when movement_type in ('IN', 'ON_ORDER') then physical_stock_quantity else 0 end)
  as total_inbound_quantity,
sum(case when movement_type in ('OUT', 'TRANSFER') then abs(physical_stock_quantity) else 0 end)
  as total_outbound_quantity,
count(distinct inventory_transaction_id) filter (where movement_type in ('IN', 'ON_ORDER'))
  as inbound_transaction_count,
count(distinct inventory_transaction_id) filter (where movement_type in ('OUT', 'TRANSFER'))
  as outbound_transaction_count,
count(distinct inventory_transaction_id) as total_transaction_count"""

# Each value with its count, by a histogram of the group's values.
_COUNTED = """array_to_string([x.key || ' x' || x.value
                for x in list_sort(map_entries(histogram(transaction_type)))], ', ')"""
_CONFIRM = """left join dim_company c1 on c1.company_key = f.company_key
left join dim_product c2 on c2.product_key = f.product_key
left join dim_product_inventory c3 on c3.product_inventory_key = f.product_inventory_key
left join dim_inventory_dimension c4 on c4.inventory_dimension_key = f.inventory_dimension_key
left join dim_warehouse c5 on c5.warehouse_key = f.warehouse_key"""
_CONFIRMED = ("c1.company_key", "c2.product_key", "c3.product_inventory_key",
              "c4.inventory_dimension_key", "c4.inventory_size_key", "c5.warehouse_key")
_KNOWN = ", ".join(f"coalesce({c}, -1) as {c.split('.')[1]}" for c in _CONFIRMED)
_CHECKED = ", ".join(f"{c} as {c.split('.')[1]}" for c in _CONFIRMED)


def _period_level(prefix: str, test: str) -> str:
    return f"""select {_CHECKED},
{', '.join(f'coalesce(h.{m}, 0) as {prefix}_{m}' for m in LEVELS)}
from (select b.*, (select max(transaction_date) from stock_fact p
                   where {_same('p', 'b', KEY5)} and p.transaction_date {test}) as found
      from period_base b) f
left join stock_fact h on {_same('h', 'f', KEY5)} and h.transaction_date = f.found
{_CONFIRM}"""


CTES = {
    "gated": """select t.*, o.reference_category, o.reference_id, o.invent_trans_id,
                  t.data_area_id as company_code
           from invent_trans t left join invent_trans_origin o on o.rec_id = t.invent_trans_origin
           where t.status_issue between 1 and 6 or t.status_receipt between 1 and 5""",
    "kept": "select * from gated where coalesce(reference_category, 0) <> 26",
    "strict": "select * from gated where reference_category <> 26",
    "chosen": """select g.* exclude (invoice_id, packing_slip_id, voucher),
              coalesce(g.invoice_id, '') as invoice_id,
              coalesce(g.packing_slip_id, '') as packing_slip_id,
              g.date_physical as moment,
              case when fp.rec_id = 0 then g.cost_amount_physical else g.cost_amount_posted end
                as cost_chosen,
              case when fp.rec_id = 0 then 'Physical' else 'Financial' end as posting_type,
              case when fp.rec_id = 0 then pp.voucher else fp.voucher end as voucher_number,
              case when fp.rec_id = 0 then pp.default_dimension else fp.default_dimension end
                as default_dimension_id,
              pp.voucher as voucher_number_physical, fp.voucher as voucher_number_financial,
              fp.voucher as invoice_voucher
       from strict g
       left join (from invent_trans_posting where posting_type = 0) pp
         on pp.data_area_id = g.data_area_id and pp.invent_trans_origin = g.invent_trans_origin
        and pp.voucher = g.voucher_physical and pp.trans_date = g.date_physical
       left join (from invent_trans_posting where posting_type = 1) fp
         on fp.data_area_id = g.data_area_id and fp.invent_trans_origin = g.invent_trans_origin
        and fp.voucher = g.voucher and fp.trans_date = g.date_financial""",
    "stock_fact": f"""select coalesce(co.company_key, -1) as company_key,
              coalesce(pr.product_key, -1) as product_key,
              coalesce(pi.product_inventory_key, -1) as product_inventory_key,
              coalesce(idm.inventory_dimension_key, -1) as inventory_dimension_key,
              coalesce(dt.date_key, timestamp '1900-01-01') as transaction_date,
              wh.warehouse_key,
              {TYPE} as transaction_type, {STATUS} as transaction_status,
              {MOVEMENT} as movement_type, s.reference_id as inventory_reference,
              s.date_invent as inventory_date, s.date_status as status_date,
              cast(s.rec_id as varchar) as inventory_transaction_id, s.rec_id as record_id,
              cast(null as varchar) as warehouse_transaction_id,
              cast(null as varchar) as item_set_id,
              {STOCK_SUMS}
       from kept s
       left join dim_company co on co.company_code = s.company_code
       left join dim_product pr on pr.company_code = s.company_code and pr.item_number = s.item_id
       left join dim_inventory_dimension idm on idm.company_code = s.company_code
            and idm.inventory_dimension_id = s.invent_dim_id
       left join dim_product_inventory pi on pi.company_code = s.company_code
            and pi.item_number = s.item_id and pi.inventory_site_code = idm.inventory_site_code
            and pi.inventory_size_code = idm.size_code
       left join dim_warehouse wh on wh.company_code = s.company_code
            and wh.inventory_site_code = idm.inventory_site_code
            and wh.warehouse_code = idm.warehouse_code
       left join dim_date dt on dt.date_key = s.date_physical
       left join (from invent_trans_posting where posting_type = 0) pp
         on pp.data_area_id = s.data_area_id and pp.invent_trans_origin = s.invent_trans_origin
        and pp.voucher = s.voucher_physical and pp.trans_date = s.date_physical
       left join (from invent_trans_posting where posting_type = 1) fp
         on fp.data_area_id = s.data_area_id and fp.invent_trans_origin = s.invent_trans_origin
        and fp.voucher = s.voucher and fp.trans_date = s.date_financial
       group by all""",
    "value_fact": f"""select 177 as record_type, s.rec_id as record_id, {_STAR_KEYS},
              {_VALUE_ATTRIBUTES}, pr.inventory_unit,
              {_value_columns('s.qty', 's.cost_chosen')},
              coalesce(pv.product_variant_key, -1) as product_variant_key
       {_star('chosen', '''left join dim_product_variant pv on pv.company_code = s.company_code
              and pv.item_number = s.item_id and pv.product_size = idm.size_code''')}""",
    "adjusted": """select t.*, t.data_area_id as company_code, e.rec_id as settlement_id,
              e.trans_date as moment, e.cost_amount_adjustment as adjustment,
              e.voucher as voucher_number, e.voucher as invoice_voucher,
              o.reference_category, o.reference_id, o.invent_trans_id, m.unit_id,
              'Adjustment' as posting_type, dv.rec_id as default_dimension_id
       from invent_trans t
       join invent_settlement e on e.trans_rec_id = t.rec_id and e.data_area_id = t.data_area_id
       join invent_trans_origin o on o.rec_id = t.invent_trans_origin
        and o.data_area_id = t.data_area_id
       left join (from invent_trans_posting where posting_type = 1) fp
         on fp.data_area_id = t.data_area_id and fp.invent_trans_origin = t.invent_trans_origin
        and fp.voucher = t.voucher and fp.trans_date = t.date_financial
       left join invent_trans_origin mo on mo.rec_id = t.marking_ref_invent_trans_origin
        and mo.data_area_id = t.data_area_id
       left join invent_trans_origin ro on ro.rec_id = t.return_invent_trans_origin
        and ro.data_area_id = t.data_area_id
       left join dimension_value_combination dc on dc.rec_id = fp.ledger_dimension
       join invent_table i on i.item_id = t.item_id and i.data_area_id = t.data_area_id
       join invent_table_module m on m.item_id = i.item_id and m.data_area_id = i.data_area_id
        and m.module_type = 0
       left join dimension_value_set dv on dv.rec_id = e.default_dimension
       where t.data_lake_modified is not null and e.settle_model <> 2 and e.rec_id <> 0
         and (t.status_issue = 1 or t.status_receipt = 1)""",
    "settlement_rows": f"""select s.settlement_id as record_id, {_STAR_KEYS}, {_VALUE_ATTRIBUTES},
              s.unit_id as inventory_unit,
              {_value_columns('cast(null as decimal(18, 4))', 's.adjustment')},
              s.date_expected as date_expected
       {_star('adjusted')}""",
    "prices": """select p.*, d.invent_site_id,
              coalesce(next_activation - interval 1 day, timestamp '9999-12-31') as expiry_date
       from (select data_area_id, item_id, invent_dim_id, price, activation_date,
                    lead(activation_date) over (partition by data_area_id, item_id, invent_dim_id
                                                order by activation_date, price) as next_activation
             from invent_item_price where data_lake_modified is not null) p
       join invent_dim d on d.invent_dim_id = p.invent_dim_id and d.data_area_id = p.data_area_id""",
    "totals": """select invent_trans_id, company_code, -sum(cost_amount_posted) as posted,
              sum(cost_amount_physical) as physical, sum(qty) as qty, max(invoice_id) as invoice,
              max(packing_slip_id) as slip,
              -sum(case when status_issue = 4 then qty else 0 end) as reserved,
              max(case when status_issue = 4 then date_status else timestamp '1900-01-01' end)
                as reserved_date
       from chosen group by all""",
    "costs": f"""select t.*, l.line_amount - t.posted as margin,
              case when l.sales_type = 4 then
                     cast(case when l.cost_price <> 0 then l.cost_price else p.price end as double)
                   when t.invoice <> '' then
                     {_ratio4('(t.posted + coalesce(a.adjustment, 0))', 't.qty')}
                   when t.slip <> '' then {_ratio4('t.physical', 't.qty')}
                   else cast(p.price as double) end as cost
       from totals t
       join sales_line l on l.invent_trans_id = t.invent_trans_id
        and l.data_area_id = t.company_code
       left join invent_dim d on d.invent_dim_id = l.invent_dim_id
        and d.data_area_id = l.data_area_id
       left join prices p on p.item_id = l.item_id and p.invent_site_id = d.invent_site_id
        and p.data_area_id = l.data_area_id
        and l.created_datetime between p.activation_date and p.expiry_date
       left join (select invent_trans_id, data_area_id,
                         sum(cost_amount_adjustment) as adjustment
                  from invent_settlement group by all) a
         on a.invent_trans_id = t.invent_trans_id and a.data_area_id = t.company_code""",
    "merge_target": """select rec_id, case when invoice_returned = 1 then 0 else qty end as qty,
              status_issue, status_receipt, invoice_id
       from invent_trans where date_physical < timestamp '2000-01-01'""",
    "merge_source": """select rec_id, qty, status_issue, status_receipt, invoice_id
       from invent_trans where date_physical >= timestamp '1997-01-01'""",
    "active": """select distinct company_key, warehouse_key from stock_fact
       where transaction_date between timestamp '1998-06-01' and timestamp '1998-06-30'""",
    "known": f"""select {_KNOWN}, f.* exclude ({', '.join(KEY5)}),
              make_date(cast(year(f.transaction_date) as int),
                        cast(month(f.transaction_date) as int), 1) as month_start
       from stock_fact f {_CONFIRM}""",
    "days": f"""select {K6}, month_start, transaction_date,
              {', '.join(f'sum({m}) as {m}' for m in LEVELS)}
       from known group by all""",
    "closes": f"""select {K6}, month_start, {', '.join(LEVELS)} from days
       qualify row_number() over (partition by {K6}, month_start
                                  order by transaction_date desc) = 1""",
    "moves": f"""select {K6}, month_start, {_MOVES},
              {_COUNTED} as transaction_types,
              string_agg(distinct transaction_type, ', ' order by transaction_type)
                as distinct_types
       from known group by all""",
    "history": f"""select cast(year(e.month_start) as bigint) as year,
              cast(month(e.month_start) as bigint) as month, d.date_id as date_key,
              {', '.join('e.' + k for k in KEY6)},
              {', '.join(f'coalesce(b.{m}, 0) as bom_{m}, e.{m} as eom_{m}' for m in LEVELS)},
              m.* exclude ({K6}, month_start)
       from (select c.*, (select max(p.month_start) from closes p
                          where {_same('p', 'c', KEY6)} and p.month_start < c.month_start)
                         as before_start from closes c) e
       left join closes b on {_same('b', 'e', KEY6)} and b.month_start = e.before_start
       join moves m on {_same('m', 'e', KEY6)} and m.month_start = e.month_start
       left join dim_date d on d.calendar_date = last_day(e.month_start)""",
    "history_summary": _indicators("history"),
    "running": f"""select h.* exclude ({', '.join(f'{p}_{m}' for p in ('bom', 'eom')
                                               for m in LEVELS)}),
              {', '.join(f'coalesce(r.{m}, 0) - coalesce(r.month_{m}, 0) as bom_{m}, '
                         f'coalesce(r.{m}, 0) as eom_{m}' for m in LEVELS)}
       from history h
       join (select a.*, {', '.join(f'sum(month_{m}) over (partition by {K6} '
                                    f'order by month_start) as {m}' for m in LEVELS)}
             from (select {K6}, month_start,
                          {', '.join(f'sum({m}) as month_{m}' for m in LEVELS)}
                   from known group by all) a) r
         on {_same('r', 'h', KEY6)} and r.month_start = make_date(h.year, h.month, 1)""",
    "seeded": """select * replace (
              days_inventory_outstanding + if(product_key % 5 = 0, 1, 0)
                as days_inventory_outstanding,
              stock_turnover_ratio + if(product_key % 5 = 1, 1, 0) as stock_turnover_ratio,
              average_physical_stock_quantity + if(product_key % 5 = 2, 1, 0)
                as average_physical_stock_quantity)
       from history_summary""",
    "standing": f"""select *, greatest(month_from, out_from) as day_from,
              least(month_until, out_until) as day_until
       from (select {K6}, sum(physical_stock_quantity) over w as level,
                    cast(transaction_date as date) as out_from,
                    coalesce(cast(lead(transaction_date) over w as date), date '2001-08-16')
                      as out_until
             from days
             window w as (partition by {K6} order by transaction_date)) b
       join (select distinct month_start as month_from,
                    cast(month_start + interval 1 month as date) as month_until from days) m
         on out_from < month_until and out_until > month_from
       where level <= 0 and out_from <> date '1900-01-01'""",
    "products": """select company_key, warehouse_key, month_start,
              count(distinct product_key) as product_count
       from known group by all""",
    "history_health": f"""select h.* replace (
              coalesce(s.stockout_days, 0) as stockout_days, p.product_count as product_count)
       from history_summary h
       left join (select {K6}, month_from, cast(sum(day_until - day_from) as bigint) as stockout_days
                  from standing group by all) s
         on {_same('s', 'h', KEY6)} and s.month_from = h.period_start_date
       join products p on p.company_key = h.company_key and p.warehouse_key = h.warehouse_key
        and p.month_start = h.period_start_date""",
    "period_base": f"""select distinct {', '.join(KEY5)} from stock_fact
       where transaction_date between timestamp '1998-06-01' and timestamp '1998-06-30'""",
    "period_bom": _period_level("bom", "< timestamp '1998-06-01'"),
    "period_eom": _period_level("eom", "<= timestamp '1998-06-30'"),
    "period_moves": """select * from moves where month_start = date '1998-06-01'
       and exists (select 1 from period_base)""",
    "period_rows": f"""select cast(1998 as bigint) as year, cast(6 as bigint) as month,
              (select date_id from dim_date where calendar_date = date '1998-06-30') as date_key,
              {', '.join(f'coalesce(b.{k}, -1) as {k}' for k in KEY6)},
              {', '.join(f'coalesce({p}_{m}, 0) as {p}_{m}' for p in ('bom', 'eom')
                         for m in LEVELS)},
              coalesce(total_inbound_quantity, 0) as total_inbound_quantity,
              coalesce(total_outbound_quantity, 0) as total_outbound_quantity,
              coalesce(inbound_transaction_count, 0) as inbound_transaction_count,
              coalesce(outbound_transaction_count, 0) as outbound_transaction_count,
              coalesce(total_transaction_count, 0) as total_transaction_count,
              transaction_types
       from period_bom b full join period_eom e on {_same('e', 'b', KEY6)}
       left join period_moves m on {' and '.join(
           f'm.{k} = coalesce(e.{k}, b.{k})' for k in KEY6)}""",
}


def _needed(sql: str) -> list[str]:
    """Named parts a statement uses, in an order that defines each before its first use."""
    order: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"\b(?:from|join)\s+(\w+)", text)):
            if word in order:
                continue
            if word in CTES or word in VIEWS:
                body = CTES[word] if word in CTES else _view(word)
                if body is not text:
                    visit(body)
                    order.append(word)

    visit(sql)
    return order


def statement(
    sql: str, amounts: list[str] | tuple = (), moments: list[str] | tuple = (),
    days: list[str] | tuple = (), whole: list[str] | tuple = (),
) -> str:
    """A complete statement: WITH clause, and wire types for the listed columns."""
    body = sql
    replaced = [f"cast({c} as double) as {c}" for c in amounts]
    replaced += [f"strftime({c}, '%Y-%m-%d %H:%M:%S') as {c}" for c in moments]
    replaced += [f"strftime({c}, '%Y-%m-%d') as {c}" for c in days]
    replaced += [f"cast({c} as bigint) as {c}" for c in whole]
    parts = ",\n".join(
        f"{n} as ({CTES[n] if n in CTES else _view(n)})" for n in _needed(sql)
    )
    star = f"* replace ({', '.join(replaced)})" if replaced else "*"
    head = f"with {parts}\n" if parts else ""
    return f"{head}select {star} from (\n{body}\n) result"


_MONTH = "strftime({}, '%Y-%m')"
_VALUE_MOMENTS = ["transaction_date", "inventory_date", "status_date", "shipping_confirmed_date",
                  "shipping_requested_date"]
_VALUE_AMOUNTS = [*VALUE_NAMES, "settled_quantity", "physical_revenue_amount"]
_SUMMARY_AMOUNTS = [
    *[f"{p}_{m}" for p in ("bom", "eom") for m in LEVELS], "total_inbound_quantity",
    "total_outbound_quantity", "net_movement_quantity", "quantity_change",
    "days_inventory_outstanding", "stock_turnover_ratio",
]
_SUMMARY = {"amounts": _SUMMARY_AMOUNTS, "days": ["period_start_date", "period_end_date"]}
GRAIN = "year, month, company_key, product_key, product_inventory_key, inventory_dimension_key, " \
        "warehouse_key"


def _asof_all(test: str) -> str:
    levels = ", ".join(f"coalesce(h.{m}, 0) as {m}" for m in STOCK_NAMES)
    return f"""select a.company_key, a.warehouse_key, a.found as as_of_date, {levels}
from (select k.*, (select max(transaction_date) from stock_fact p
                   where {_same('p', 'k', ('company_key', 'warehouse_key'))}
                     and p.transaction_date {test}) as found from active k) a
left join stock_fact h on {_same('h', 'a', ('company_key', 'warehouse_key'))}
     and h.transaction_date = a.found"""


def _merged(changed: str) -> str:
    def pick(column: str) -> str:
        return (f"case when action in ('insert', 'update') then s_{column} else t_{column} end "
                f"as {column}")

    columns = ("qty", "status_issue", "status_receipt", "invoice_id")
    return f"""select rec_id, {', '.join(pick(c) for c in columns)},
  case action when 'update' then 2 else 1 end as loads, action
from (select coalesce(t.rec_id, s.rec_id) as rec_id,
        {', '.join(f't.{c} as t_{c}, s.{c} as s_{c}' for c in columns)},
        case when s.rec_id is null then 'keep' when t.rec_id is null then 'insert'
             when {changed} then 'update' else 'unchanged' end as action
      from merge_target t full join merge_source s on s.rec_id = t.rec_id) m"""


_DIFFERS = """(t.qty is distinct from s.qty or t.status_issue is distinct from s.status_issue
  or t.status_receipt is distinct from s.status_receipt
  or t.invoice_id is distinct from s.invoice_id)"""
_MERGE_TYPES = {"amounts": ["qty"], "whole": ["status_issue", "status_receipt", "loads"]}

_EXPECTED_DIO = (
    f"sign({_SCALED.format('eom_physical_stock_quantity')}) * ((2 * abs("
    f"{_SCALED.format('eom_physical_stock_quantity')} * day(period_end_date) * 100) + "
    f"{_SCALED.format('total_outbound_quantity')}) // (2 * "
    f"{_SCALED.format('total_outbound_quantity')})) / 100.0"
)
_AVERAGE4 = "cast(average_physical_stock_quantity * 10000 as hugeint)"
_EXPECTED_TURNOVER = (
    f"((2 * {_SCALED.format('total_outbound_quantity')} * 10000 + {_AVERAGE4}) // "
    f"(2 * {_AVERAGE4})) / 10000.0"
)


def _null_row(column: str) -> str:
    return f"""select '{column}' as column_name, count(*) as total_records,
  count(*) - count({column}) as null_count,
  ((2 * (count(*) - count({column})) * 10000 + count(*)) // (2 * count(*))) / 100.0 as null_pct
from history_summary"""


def _date_row(column: str, right: str) -> str:
    return f"""select year, month, '{column}' as date_field, min({column}) as min_date,
  max({column}) as max_date, count(distinct {column}) as unique_values,
  case when count(distinct {column}) = 1 and min({column}) = {right} then '✓ Correct'
       else '⚠ Unexpected' end as status
from history_summary group by year, month"""


ORACLE: dict[str, str] = {}
ORACLE["movement_totals"] = statement(f"""
select s.company_code, wh.warehouse_key, {_MONTH.format('s.date_physical')} as month,
  {MOVEMENT} as movement_type, count(*) as transactions, {STOCK_SUMS}
from kept s
left join dim_inventory_dimension idm on idm.company_code = s.company_code
     and idm.inventory_dimension_id = s.invent_dim_id
left join dim_warehouse wh on wh.company_code = s.company_code
     and wh.inventory_site_code = idm.inventory_site_code
     and wh.warehouse_code = idm.warehouse_code
group by all""", STOCK_NAMES)
ORACLE["transaction_type_counts"] = statement(f"""
select {TYPE} as transaction_type, {MOVEMENT} as movement_type, count(*) as transactions,
  sum(qty) as quantity from kept group by all""", ["quantity"])
ORACLE["transaction_status_labels"] = statement(f"""
select {STATUS} as transaction_status, status_issue, status_receipt, count(*) as transactions
from invent_trans group by all""", whole=["status_issue", "status_receipt"])
for _name, _rows in (("dropped", "strict"), ("kept", "kept")):
    ORACLE[f"category_null_{_name}"] = statement(f"""
select reference_category, count(*) as transactions, sum(qty) as quantity
from {_rows} group by all""", ["quantity"], whole=["reference_category"])
ORACLE["incremental_batch"] = statement("""
select load, count(rec_id) as transactions, count(distinct execution_id) as batches,
  sum(qty) as quantity
from (values ('full', 1), ('batch', 2), ('batch without id', 3), ('batch without id, all', 4))
     as l(load, kind)
left join invent_trans t on kind in (1, 4) or (kind = 2 and t.execution_id = 'B3')
group by all""", ["quantity"])
ORACLE["postings_by_role"] = statement("""
select rec_id as record_id, posting_type, cost_chosen as cost_amount, voucher_number,
  default_dimension_id, voucher_number_physical, voucher_number_financial
from chosen""", ["cost_amount"])
ORACLE["star_keys_unknown_member"] = statement("""
select s.rec_id as record_id, coalesce(co.company_key, -1) as company_key,
  coalesce(pr.product_key, -1) as product_key, coalesce(cu.currency_key, -1) as currency_key,
  coalesce(idm.inventory_dimension_key, -1) as inventory_dimension_key,
  coalesce(pi.product_inventory_key, -1) as product_inventory_key,
  coalesce(pv.product_variant_key, -1) as product_variant_key, wh.warehouse_key,
  coalesce(ld.load_key, -1) as load_key,
  coalesce(dt.date_key, timestamp '1900-01-01') as transaction_date
from invent_trans s
left join dim_company co on co.company_code = s.data_area_id
left join dim_currency cu on cu.currency_code = s.currency_code
left join dim_product pr on pr.company_code = s.data_area_id and pr.item_number = s.item_id
left join dim_inventory_dimension idm on idm.company_code = s.data_area_id
     and idm.inventory_dimension_id = s.invent_dim_id
left join dim_product_inventory pi on pi.company_code = s.data_area_id
     and pi.item_number = s.item_id and pi.inventory_site_code = idm.inventory_site_code
     and pi.inventory_size_code = idm.size_code
left join dim_product_variant pv on pv.company_code = s.data_area_id
     and pv.item_number = s.item_id and pv.product_size = idm.size_code
left join dim_warehouse wh on wh.company_code = s.data_area_id
     and wh.inventory_site_code = idm.inventory_site_code and wh.warehouse_code = idm.warehouse_code
left join dim_load ld on ld.company_code = s.data_area_id and ld.load_code = s.load_id
left join dim_date dt on dt.date_key = s.date_physical""", moments=["transaction_date"])
ORACLE["dimension_key_check"] = statement(f"""
select c1.company_key, c2.product_key, c4.inventory_size_key, count(*) as transactions,
  count(c5.warehouse_key) as with_warehouse,
  count(c3.product_inventory_key) as with_product_inventory,
  count(c4.inventory_dimension_key) as with_dimension
from stock_fact f {_CONFIRM} group by all""")
ORACLE["value_buckets_by_status"] = statement(f"""
select data_area_id, {MOVEMENT} as movement_type,
  {_value_columns('qty', 'cost_amount_posted', 'sum({})')}
from invent_trans group by all""", VALUE_NAMES)
ORACLE["stock_level_fact"] = statement(
    "select * from stock_fact", STOCK_NAMES,
    ["transaction_date", "inventory_date", "status_date"])
ORACLE["inventory_value_fact"] = statement(
    "select * from value_fact", _VALUE_AMOUNTS, _VALUE_MOMENTS, whole=["record_type"])
ORACLE["settlement_fact"] = statement(
    "select * from settlement_rows", _VALUE_AMOUNTS, [*_VALUE_MOMENTS, "date_expected"])
ORACLE["orphan_delete"] = statement("""
select rec_id as record_id, case when currency_code = 'CUR0' then 0 else rec_id end
  as stock_level_key, qty
from invent_trans
where currency_code = 'CUR0' or (data_lake_modified is not null and packing_slip_returned = 0)
""", ["qty"])
ORACLE["upsert_changed_only"] = statement(_merged(_DIFFERS), **_MERGE_TYPES)
ORACLE["upsert_always"] = statement(_merged("true"), **_MERGE_TYPES)
ORACLE["upsert_row_counts"] = statement(
    f"select action, count(*) as rows from ({_merged(_DIFFERS)}) u group by action")
ORACLE["update_only"] = statement("""
select f.company_code, f.inventory_transaction_id,
  case when l.invent_trans_id is not null then l.cost_price else f.cost_price end as cost_price,
  f.gross_margin_amount,
  case when l.invent_trans_id is not null and l.cost_price is distinct from f.cost_price
       then false end as ea_is_deleted,
  case when l.invent_trans_id is null then 'keep'
       when l.cost_price is distinct from f.cost_price then 'update' else 'unchanged' end as action
from fact_sales_orders f
left join sales_line l on l.data_area_id = f.company_code
     and l.invent_trans_id = f.inventory_transaction_id""", ["cost_price", "gross_margin_amount"])
ORACLE["duplicate_merge_keys"] = statement("""
select invent_trans_origin, status_issue, status_receipt, invoice_id, count(*) as rows
from invent_trans where invoice_id is not null group by all having count(*) > 1
""", whole=["status_issue", "status_receipt"])
ORACLE["asof_before_ties_all"] = statement(
    _asof_all("< timestamp '1998-06-01'"), STOCK_NAMES, ["as_of_date"])
ORACLE["asof_on_or_before"] = statement(
    _asof_all("<= timestamp '1998-06-30'"), STOCK_NAMES, ["as_of_date"])
ORACLE["asof_before_ties_sum"] = statement(f"""
select company_key, warehouse_key, as_of_date,
  {', '.join(f'sum({m}) as {m}' for m in STOCK_NAMES)}
from ({_asof_all("< timestamp '1998-06-01'")}) a group by all""", STOCK_NAMES, ["as_of_date"])
ORACLE["running_level"] = statement(f"""
select company_key, warehouse_key, transaction_date,
  {', '.join(f'sum({m}) over w as {m}' for m in STOCK_NAMES)}
from (select company_key, warehouse_key, transaction_date,
        {', '.join(f'sum({m}) as {m}' for m in STOCK_NAMES)} from stock_fact group by all) d
window w as (partition by company_key, warehouse_key order by transaction_date)""",
    STOCK_NAMES, ["transaction_date"])
ORACLE["price_validity"] = statement(
    "select * from prices", ["price"], ["expiry_date"], ["activation_date", "next_activation"],
    ["invent_site_id"])
ORACLE["price_at_order"] = statement("""
select l.invent_trans_id, l.data_area_id, l.item_id, l.created_datetime,
  p.price as closed_price, q.price as half_open_price
from sales_line l
left join invent_dim d on d.invent_dim_id = l.invent_dim_id and d.data_area_id = l.data_area_id
left join prices p on p.item_id = l.item_id and p.invent_site_id = d.invent_site_id
     and p.data_area_id = l.data_area_id
     and l.created_datetime between p.activation_date and p.expiry_date
left join prices q on q.item_id = l.item_id and q.invent_site_id = d.invent_site_id
     and q.data_area_id = l.data_area_id and l.created_datetime >= q.activation_date
     and (q.next_activation is null or l.created_datetime < q.next_activation)""",
    ["closed_price", "half_open_price"], ["created_datetime"])
ORACLE["sales_cost_refresh"] = statement("""
select f.company_code, f.inventory_transaction_id,
  case when changed then cost else cast(f.cost_price as double) end as cost_price,
  case when changed then reserved_date else f.reserved_date_physical end
    as reserved_date_physical,
  case when changed then reserved else f.reserved_physical end as reserved_physical,
  case when changed then posted else f.gross_cost_amount end as gross_cost_amount,
  case when changed then margin else f.gross_margin_amount end as gross_margin_amount,
  case when changed then timestamp '2001-08-15' end as ea_process_datetime,
  case when changed then false end as ea_is_deleted,
  case when changed then 'update' when matched then 'unchanged' else 'keep' end as action
from (select f.*, c.cost, c.reserved_date, c.reserved, c.posted, c.margin,
        c.invent_trans_id is not null as matched,
        c.invent_trans_id is not null and (
          c.cost is distinct from cast(f.cost_price as double)
          or c.reserved_date is distinct from f.reserved_date_physical
          or c.reserved is distinct from f.reserved_physical
          or c.posted is distinct from f.gross_cost_amount
          or c.margin is distinct from f.gross_margin_amount) as changed
      from fact_sales_orders f
      left join costs c
        on c.company_code = f.company_code
       and c.invent_trans_id = f.inventory_transaction_id) f""",
    ["cost_price", "reserved_physical", "gross_cost_amount", "gross_margin_amount"],
    ["reserved_date_physical", "ea_process_datetime"])
ORACLE["monthly_movements"] = statement(f"""
select company_key, coalesce(warehouse_key, -1) as warehouse_key,
  {_MONTH.format('transaction_date')} as month, {_MOVES},
  string_agg(distinct transaction_type, ', ' order by transaction_type) as transaction_types
from stock_fact group by all""", ["total_inbound_quantity", "total_outbound_quantity"])
ORACLE["transaction_type_list"] = statement(f"""
select company_key, warehouse_key, {_MONTH.format('transaction_date')} as month,
  {_COUNTED} as transaction_types
from stock_fact group by all""")
ORACLE["transaction_type_list_repeated"] = statement(f"""
select {', '.join(KEY5)}, {_MONTH.format('transaction_date')} as month,
  string_agg(transaction_type, ', ' order by transaction_type) as transaction_types
from stock_fact group by all""")
ORACLE["dq_dio_order"] = statement(f"""
select row_number() over (order by eom_physical_stock_quantity desc, {GRAIN}) as place, {GRAIN}
from history_summary where total_outbound_quantity > 0
qualify place <= 20""")
ORACLE["run_outcomes"] = statement("""
select 'summary' as job, true as worked, count(*) as rows, false as repeated_keys
from history_summary where year = 1998 and month = 6
union all
select 'repeated keys', count(*) = 0, null, count(*) > 0
from (select invent_trans_origin, status_issue, status_receipt, invoice_id
      from invent_trans where invoice_id is not null group by all having count(*) > 1) r""")
ORACLE["monthly_summary"] = statement("select * from history_summary", **_SUMMARY)
ORACLE["monthly_summary_stockouts"] = statement("select * from history_health", **_SUMMARY)
ORACLE["summary_job_stockouts"] = statement(f"""
select year, month, {K6}, stockout_days, product_count
from history_health where year = 1998 and month in (6, 7)""")
ORACLE["stockout_days"] = statement("""
select company_key, warehouse_key, month, count(distinct product_key) as products_out,
  cast(sum(least(month_until, out_until) - greatest(month, out_from)) as bigint) as stockout_days,
  count(*) filter (where fresh or out_from <= month) as stockout_spells
from (select *, coalesce(cast(lead(transaction_date) over w as date), date '2001-08-16') as out_until,
             coalesce(lag(level) over w > 0, true) as fresh
      from (select company_key, product_key, warehouse_key, transaction_date,
                   cast(transaction_date as date) as out_from,
                   sum(moved) over (partition by company_key, product_key, warehouse_key
                                    order by transaction_date) as level
            from (select company_key, product_key, warehouse_key, transaction_date,
                         sum(physical_stock_quantity) as moved
                  from stock_fact group by all) a) b
      where out_from <> date '1900-01-01'
      window w as (partition by company_key, product_key, warehouse_key
                   order by transaction_date)) r
join (select month, cast(month + interval 1 month as date) as month_until
      from (select cast(unnest(generate_series(timestamp '1990-01-01', timestamp '2001-08-01',
                                               interval 1 month)) as date) as month) g) m
  on out_from < month_until and out_until > month
where level <= 0 group by all""", days=["month"])
ORACLE["monthly_summary_running"] = statement(
    _indicators("running", types="distinct_types"), **_SUMMARY)
ORACLE["monthly_summary_period"] = statement(_indicators("period_rows"), **_SUMMARY)
ORACLE["kpi_dio"] = statement(f"""
select {GRAIN}, eom_physical_stock_quantity, total_outbound_quantity, days_inventory_outstanding
from history_summary""", ["eom_physical_stock_quantity", "total_outbound_quantity",
                          "days_inventory_outstanding"])
ORACLE["kpi_turnover"] = statement(f"""
select {GRAIN}, average_physical_stock_quantity, total_outbound_quantity, stock_turnover_ratio
from history_summary""", ["total_outbound_quantity", "stock_turnover_ratio"])
ORACLE["retention_split"] = statement(f"""
select case when transaction_date < timestamp '2001-02-01'
            and transaction_date <> timestamp '1900-01-01' then 'archive' else 'detail' end
  as tier, {_MONTH.format('transaction_date')} as month, count(*) as rows
from stock_fact group by all""")
ORACLE["dq_completeness"] = statement("""
select case when count(*) = 0 then '⚠ No records found' else '✓ Records exist' end as status,
  count(*) as total_records, count(distinct company_key) as unique_companies,
  count(distinct product_key) as unique_products,
  count(distinct warehouse_key) as unique_warehouses
from history_summary""")
_LEVEL_PAIR = "bom_physical_stock_quantity, eom_physical_stock_quantity"
ORACLE["dq_balance"] = statement(f"""
select {GRAIN}, {_LEVEL_PAIR}, total_inbound_quantity, total_outbound_quantity,
  net_movement_quantity, quantity_change,
  bom_physical_stock_quantity + net_movement_quantity as expected_eom,
  '⚠ MISMATCH' as balance_status
from history_summary
where abs(quantity_change - net_movement_quantity) > 0.01""",
    [*_LEVEL_PAIR.split(", "), "total_inbound_quantity", "total_outbound_quantity",
     "net_movement_quantity", "quantity_change", "expected_eom"])
for _name, _rows in (("dq_dio_top20", "history_summary"), ("dq_dio_seeded", "seeded")):
    ORACLE[_name] = statement(f"""
select {GRAIN}, eom_physical_stock_quantity, total_outbound_quantity, days_inventory_outstanding,
  {_EXPECTED_DIO} as expected_dio,
  case when abs(days_inventory_outstanding - {_EXPECTED_DIO}) < 0.01 then '✓ Correct'
       else '⚠ Mismatch' end as dio_status
from {_rows} where total_outbound_quantity > 0
order by eom_physical_stock_quantity desc, {GRAIN} limit 20""",
    ["eom_physical_stock_quantity", "total_outbound_quantity", "days_inventory_outstanding",
     "expected_dio"])
for _name, _rows in (("dq_turnover_top20", "history_summary"), ("dq_turnover_seeded", "seeded")):
    ORACLE[_name] = statement(f"""
select {GRAIN}, total_outbound_quantity, average_physical_stock_quantity, stock_turnover_ratio,
  {_EXPECTED_TURNOVER} as expected_turnover_ratio,
  case when abs(stock_turnover_ratio - {_EXPECTED_TURNOVER}) < 0.0001 then '✓ Correct'
       else '⚠ Mismatch' end as turnover_status
from {_rows} where average_physical_stock_quantity > 0
order by stock_turnover_ratio desc, {GRAIN} limit 20""",
    ["total_outbound_quantity", "stock_turnover_ratio", "expected_turnover_ratio"])
for _name, _rows in (("dq_average", "history_summary"), ("dq_average_seeded", "seeded")):
    ORACLE[_name] = statement(f"""
select {GRAIN}, {_LEVEL_PAIR}, average_physical_stock_quantity,
  cast(bom_physical_stock_quantity + eom_physical_stock_quantity as double) / 2
    as expected_average, '⚠ Mismatch' as status
from {_rows}
where abs(average_physical_stock_quantity
  - cast(bom_physical_stock_quantity + eom_physical_stock_quantity as double) / 2) >= 0.01""",
    _LEVEL_PAIR.split(", "))
ORACLE["dq_counts"] = statement(f"""
select {GRAIN}, inbound_transaction_count, outbound_transaction_count, total_transaction_count,
  '⚠ Mismatch' as status
from history_summary
where total_transaction_count <> inbound_transaction_count + outbound_transaction_count""")
ORACLE["dq_nulls"] = statement("\nunion all\n".join(_null_row(c) for c in (
    "bom_physical_stock_quantity", "days_inventory_outstanding", "stock_turnover_ratio")),
    ["null_pct"])
ORACLE["dq_negatives"] = statement("""
select case when bom_physical_stock_quantity < 0 then '⚠ Negative BOM'
            when eom_physical_stock_quantity < 0 then '⚠ Negative EOM'
            when average_physical_stock_quantity < 0 then '⚠ Negative Average'
            else '✓ Valid' end as validation, count(*) as rows
from history_summary group by 1""")
ORACLE["dq_period_dates"] = statement(
    _date_row("period_start_date", "make_date(year, month, 1)") + "\nunion all\n"
    + _date_row("period_end_date", "last_day(make_date(year, month, 1))"),
    days=["min_date", "max_date"])
ORACLE["dq_run_summary"] = statement("""
select year, month, period_start_date, period_end_date, count(*) as total_records,
  count(distinct company_key) as companies, count(distinct product_key) as products,
  count(distinct warehouse_key) as warehouses,
  timestamp '2001-08-15' as first_processed, timestamp '2001-08-15' as last_processed,
  sum(total_transaction_count) as total_transactions,
  count(*) filter (where is_current_month) as current_month_records
from history_summary group by all""",
    moments=["first_processed", "last_processed"], days=["period_start_date", "period_end_date"],
    whole=["total_transactions"])
ORACLE["monthly_summary_after_archive"] = ORACLE["monthly_summary"]
_SUMMARY_ROW = statement(
    "select *, true as has_key from history_summary where year = 1998 and month in (6, 7)",
    **_SUMMARY)
ORACLE["load_monthly_summary"] = _SUMMARY_ROW
ORACLE["dq_negatives_period"] = statement("""
select case when bom_physical_stock_quantity < 0 then '⚠ Negative BOM'
            when eom_physical_stock_quantity < 0 then '⚠ Negative EOM'
            when average_physical_stock_quantity < 0 then '⚠ Negative Average'
            else '✓ Valid' end as validation, count(*) as rows
from history_summary where year = 1998 and month = 6 group by 1""")
ORACLE["load_stock_levels"] = statement(
    "select *, true as has_key from stock_fact where record_id % 7 <> 0", STOCK_NAMES,
    ["transaction_date", "inventory_date", "status_date"])
ORACLE["stream_over_archive"] = statement(
    "select *, true as has_key from stock_fact", STOCK_NAMES,
    ["transaction_date", "inventory_date", "status_date"])
_SUM_LEVELS = ", ".join(f"sum(c.{m}) as {m}" for m in LEVELS)
ORACLE["monthly_balances"] = statement(f"""
select cast(strftime(m.month_start, '%Y%m') as bigint) as balance_month, count(*) as keys,
  {_SUM_LEVELS}, {', '.join(f'any_value(m.total_{x}) as total_{x}' for x in LEVELS)}
from (select month_start,
             {', '.join(f'sum(sum({x})) over (order by month_start) as total_{x}' for x in LEVELS)}
      from known group by month_start) m
join (select *, lead(month_start) over (partition by {K6} order by month_start) as until
      from closes) c
  on c.month_start <= m.month_start and (c.until is null or c.until > m.month_start)
group by m.month_start""", [*LEVELS, *[f"total_{x}" for x in LEVELS]])
ORACLE["load_inventory_value"] = statement(
    "select *, true as has_key from value_fact where record_id % 7 <> 0",
    _VALUE_AMOUNTS, _VALUE_MOMENTS, whole=["record_type"])
ORACLE["load_settlements"] = statement(
    "select *, true as has_key from settlement_rows where record_id % 7 <> 0",
    _VALUE_AMOUNTS, [*_VALUE_MOMENTS, "date_expected"])
ORACLE["period_labels"] = statement("""
select distinct year, month, year::varchar || '-' || lpad(month::varchar, 2, '0') as period,
  'RUN_' || strftime(last_day(make_date(year, month, 1)), '%Y%m%d_%H%M%S') as run
from history_summary""")
