import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import tuples
from stockmart.operators import archive, asof, dims, merge, postings, quality
from stockmart.operators.text_agg import sorted_list
from stockmart.schemas import FACT_STOCK_LEVEL, MOVEMENT_SUMMARY, empty


def day(n, month=6, year=1998):
    return dt.datetime(year, month, n)


# Lookups ---------------------------------------------------------------------------------------


def test_lookup_unknown_member_null_and_fan_out(spark, params):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "c")], "id int, code string")
    dim = spark.createDataFrame([("a", 10), ("c", 30), ("c", 31), (None, 99)],
                                "dim_code string, dim_key long")
    spec = dims.Lookup("dim", {"dim_code": "code"}, "dim_key")
    got = tuples(dims.resolve_keys(fact, {"dim": dim}, [spec], params), "id", "dim_key")
    assert got == [(1, 10), (2, -1), (3, -1), (4, 30), (4, 31)]
    keep_null = dims.Lookup("dim", {"dim_code": "code"}, "dim_key", unknown=False)
    out = dims.resolve_keys(fact, {"dim": dim}, [keep_null], params).filter("id < 4")
    got = dict(tuples(out, "id", "dim_key"))
    assert got == {1: 10, 2: None, 3: None}


def test_snowflake_lookup_uses_carried_code(spark, params):
    fact = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "id int, d string")
    first = spark.createDataFrame([("x", 1, "red"), ("y", 2, "blue")], "d string, k long, c string")
    second = spark.createDataFrame([("red", 7)], "c string, color_key long")
    out = dims.resolve_keys(
        fact, {"one": first, "two": second},
        [dims.Lookup("one", {"d": "d"}, "k", carry={"carried": "c"}),
         dims.Lookup("two", {"c": "carried"}, "color_key")], params)
    assert tuples(out, "id", "k", "color_key") == [(1, 1, 7), (2, 2, -1), (3, -1, -1)]


def test_confirm_key_turns_missing_keys_into_null(spark):
    fact = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "id int, k long")
    dim = spark.createDataFrame([(5, 50)], "k long, size long")
    out = dims.confirm_keys(fact, {"dim": dim}, {"k": "dim"}, {"dim": {"size_key": "size"}})
    assert tuples(out, "id", "k", "size_key") == [(1, 5, 50), (2, None, None), (3, None, None)]


# Postings --------------------------------------------------------------------------------------


def test_a_carried_join_key_is_shuffled_once(spark):
    trans = spark.createDataFrame(
        [("C1", 1, "V1", day(1)), ("C1", 1, "V2", day(1)), (None, 2, "V1", day(1))],
        "data_area_id string, invent_trans_origin long, voucher_physical string,"
        " date_physical timestamp_ntz",
    )
    posted = spark.createDataFrame(
        [(0, "C1", 1, "V1", day(1), 7), (0, "C1", 1, "V1", day(1), 8), (1, "C1", 1, "V2", day(1), 9)],
        "posting_type int, data_area_id string, invent_trans_origin long, voucher string,"
        " trans_date timestamp_ntz, default_dimension long",
    )
    out = postings.by_role(trans, posted, "physical", {"number": "voucher", "dim": "default_dimension"})
    assert out.columns == [*trans.columns, "number", "dim"]
    assert tuples(out, "data_area_id", "voucher_physical", "number", "dim") == [
        ("C1", "V1", "V1", 7), ("C1", "V1", "V1", 8), ("C1", "V2", None, None),
        (None, "V1", None, None),
    ]
    joined = out._jdf.queryExecution().optimizedPlan().children().head()
    right = joined.children().last().output()
    assert right.size() == 5  # the four join keys and the dimension


def test_posting_roles_and_choice(spark):
    trans = spark.createDataFrame(
        [(1, "c", 10, "p1", "f1"), (2, "c", 10, "p2", "f2"), (3, "c", 10, "p3", "f3"),
         (4, "c", 10, "p4", "f4")],
        "rec_id long, data_area_id string, invent_trans_origin long, voucher_physical string, "
        "voucher string").withColumns({"date_physical": F.lit(day(1)),
                                       "date_financial": F.lit(day(2))})
    post = spark.createDataFrame(
        [(0, 1, "c", 10, "f1", day(2), 1, 1), (7, 1, "c", 10, "f2", day(2), 2, 2),
         (8, 0, "c", 10, "p1", day(1), 3, 3), (9, 0, "c", 10, "p4", day(1), 4, 4),
         (10, 0, "c", 10, "p4", day(1), 5, 5), (11, 0, "c", 10, "f3", day(2), 6, 6)],
        "rec_id long, posting_type int, data_area_id string, invent_trans_origin long, "
        "voucher string, trans_date timestamp_ntz, default_dimension long, ledger_dimension long"
    ).withColumn("trans_date", F.col("trans_date").cast("timestamp"))
    out = postings.with_postings(trans, post).select(
        "rec_id", postings.choose(F.lit("Physical"), F.lit("Financial")).alias("kind"),
        postings.choose(F.col("voucher_number_physical"),
                        F.col("voucher_number_financial")).alias("v"))
    # id 0 is physical; a positive id and a missing posting are financial; duplicates multiply
    assert tuples(out) == [(1, "Physical", "p1"), (2, "Financial", "f2"),
                           (3, "Financial", None), (4, "Financial", None), (4, "Financial", None)]


# As-of -----------------------------------------------------------------------------------------

HISTORY = [
    ("a", day(1, 5), 1), ("a", day(3, 5), 2), ("a", day(3, 5), 3), ("a", day(5), 4),
    ("b", day(2), 9), (None, day(1, 5), 7),
]


@pytest.fixture
def history(spark):
    return spark.createDataFrame(HISTORY, "k string, d timestamp_ntz, q int").withColumn(
        "q", F.col("q").cast("decimal(18,4)"))


@pytest.fixture
def base(spark):
    return spark.createDataFrame([("a",), ("b",), (None,)], "k string")


def test_asof_keeps_or_adds_ties(history, base):
    kept = asof.latest_before(base, history, ["k"], "d", ["q"], dt.date(1998, 6, 1))
    assert tuples(kept, "k", "q") == [("a", 2), ("a", 3), ("b", 0), (None, 0)]
    added = asof.latest_before(base, history, ["k"], "d", ["q"], dt.date(1998, 6, 1), ties="sum")
    assert tuples(added, "k", "q") == [("a", 5), ("b", 0), (None, 0)]


def test_asof_bound_is_strict_or_inclusive(history, base):
    on = asof.latest_on_or_before(base, history, ["k"], "d", ["q"], dt.date(1998, 6, 2))
    assert ("b", 9) in tuples(on, "k", "q")
    before = asof.latest_before(base, history, ["k"], "d", ["q"], dt.date(1998, 6, 2))
    assert ("b", 0) in tuples(before, "k", "q")


def test_running_level(history):
    got = tuples(asof.running_level(history, ["k"], "d", ["q"]).filter("k = 'a'"), "d", "q")
    assert [int(q) for _, q in got] == [1, 6, 10]


def test_validity_intervals_across_and_inside_months(spark):
    prices = spark.createDataFrame(
        [("i", dt.date(2000, 1, 1), 1), ("i", dt.date(2000, 1, 20), 2),
         ("i", dt.date(2000, 5, 3), 3), ("j", dt.date(2000, 2, 1), 4)],
        "item string, activation_date date, price int")
    out = asof.validity_intervals(prices, ["item"])
    assert tuples(out, "price", "next_activation", "expiry_date") == [
        (1, dt.date(2000, 1, 20), dt.datetime(2000, 1, 19)),
        (2, dt.date(2000, 5, 3), dt.datetime(2000, 5, 2)),
        (3, None, dt.datetime(9999, 12, 31)), (4, None, dt.datetime(9999, 12, 31))]


def test_valid_at_gap_and_half_open(spark):
    prices = spark.createDataFrame(
        [("i", 1, dt.date(2000, 1, 1)), ("i", 2, dt.date(2000, 2, 1))],
        "item string, price int, activation_date date")
    lines = spark.createDataFrame(
        [(1, "i", dt.datetime(2000, 1, 31)), (2, "i", dt.datetime(2000, 1, 31, 12)),
         (3, "i", dt.datetime(2000, 2, 1)), (4, "x", dt.datetime(2000, 2, 1)),
         (5, "i", dt.datetime(1999, 2, 1))], "id int, item string, at timestamp_ntz")
    intervals = asof.validity_intervals(prices, ["item"])
    closed = asof.valid_at(lines, intervals, {"item": "item"}, "at", {"p": "price"})
    assert dict(tuples(closed, "id", "p")) == {1: 1, 2: None, 3: 2, 4: None, 5: None}
    half = asof.valid_at(lines, intervals, {"item": "item"}, "at", {"p": "price"}, half_open=True)
    assert dict(tuples(half, "id", "p")) == {1: 1, 2: 1, 3: 2, 4: None, 5: None}


def test_valid_at_with_hundreds_of_prices_a_key_equals_all_pairs(spark):
    start = dt.datetime(1995, 1, 1)
    # Two dims of a site overlap; item 0 has a price every four days, item 1 one every 400 days.
    prices = spark.createDataFrame(
        [(f"i{i}", d, n * 10 + i, (start + dt.timedelta(days=n * (4 + 396 * i) + d)).date())
         for i in range(2) for d in range(2) for n in range(400 if i == 0 else 6)],
        "item string, dim int, price int, activation_date date")
    lines = [(n, f"i{n % 3}", start + dt.timedelta(hours=37 * n - 500)) for n in range(1500)]
    lines += [(1500, None, start), (1501, "i0", None), (1502, "i1", dt.datetime(2040, 2, 3, 4))]
    events = spark.createDataFrame(lines, "id int, item string, at timestamp_ntz")
    intervals = asof.validity_intervals(prices, ["item", "dim"])
    known = intervals.collect()
    for half in (False, True):
        out = asof.valid_at(events, intervals, {"item": "item"}, "at", {"p": "price"},
                            half_open=half)
        want = []
        for ident, item, at in lines:
            met = [r.price for r in known if item is not None and r.item == item and at is not None
                   and at >= dt.datetime.combine(r.activation_date, dt.time())
                   and ((r.next_activation is None
                         or at < dt.datetime.combine(r.next_activation, dt.time()))
                        if half else at <= r.expiry_date)]
            want += [(ident, p) for p in met or [None]]
        assert tuples(out, "id", "p") == sorted(want, key=lambda r: [(v is None, str(v)) for v in r])


def test_valid_at_joins_on_key_and_month(spark):
    prices = spark.createDataFrame([("i", 1, dt.date(2000, 1, 1))],
                                   "item string, price int, activation_date date")
    lines = spark.createDataFrame([(1, "i", dt.datetime(2000, 3, 1))],
                                  "id int, item string, at timestamp_ntz")
    intervals = asof.validity_intervals(prices, ["item"])
    empty_days = asof.valid_at(lines.limit(0), intervals, {"item": "item"}, "at", {"p": "price"})
    assert empty_days.count() == 0
    out = asof.valid_at(lines, intervals, {"item": "item"}, "at", {"p": "price"})
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    outer = next(line for line in plan.splitlines() if "LeftOuter" in line)
    assert "_v_month" in outer and "_v_item" in outer
    assert tuples(out, "id", "p") == [(1, 1)]


def test_several_prices_for_one_line_all_match(spark):
    prices = spark.createDataFrame(
        [("s", "d1", 1, dt.date(2000, 1, 1)), ("s", "d2", 2, dt.date(2000, 1, 1))],
        "site string, dim string, price int, activation_date date")
    lines = spark.createDataFrame([(1, "s", dt.datetime(2000, 3, 1))],
                                  "id int, site string, at timestamp_ntz")
    out = asof.valid_at(lines, asof.validity_intervals(prices, ["site", "dim"]),
                        {"site": "site"}, "at", {"p": "price"})
    assert tuples(out, "id", "p") == [(1, 1), (1, 2)]


# Merge -----------------------------------------------------------------------------------------


@pytest.fixture
def sides(spark):
    target = spark.createDataFrame(
        [(1, 10, "a"), (2, 20, None), (3, 30, "c"), (4, 40, None)], "id long, v int, s string"
    ).withColumn("stamp", F.lit(0))
    source = spark.createDataFrame(
        [(1, 10, "a"), (2, 20, "b"), (4, 40, None), (5, 50, "e"), (None, 60, "n")],
        "id long, v int, s string")
    return target, source


def test_upsert_changed_only_is_null_safe(sides):
    target, source = sides
    out = merge.upsert(target, source, ["id"], compare=["v", "s"],
                       on_update={"stamp": F.lit(1)}, on_insert={"stamp": F.lit(2)})
    assert tuples(out) == [
        (1, 10, "a", 0, "unchanged"), (2, 20, "b", 1, "update"), (3, 30, "c", 0, "keep"),
        (4, 40, None, 0, "unchanged"), (5, 50, "e", 2, "insert"), (None, 60, "n", 2, "insert")]


def test_upsert_twice_changes_nothing_more(sides):
    target, source = sides
    source = source.filter("id is not null")
    once = merge.upsert(target, source, ["id"], compare=["v", "s"]).drop(merge.ACTION)
    twice = merge.upsert(once, source, ["id"], compare=["v", "s"])
    assert tuples(twice.drop(merge.ACTION)) == tuples(once)
    counts = {r[merge.ACTION]: r["rows"] for r in merge.action_counts(twice).collect()}
    assert counts == {"unchanged": 4, "keep": 1}


def test_upsert_always_and_limited_columns(sides):
    target, source = sides
    out = merge.upsert(target, source, ["id"], update_columns=["v"])
    rows = {r.id: (r.s, r[merge.ACTION]) for r in out.collect()}
    assert rows[2] == (None, "update") and rows[1][1] == "update" and rows[5] == ("e", "insert")


def test_update_only_never_inserts(sides):
    target, source = sides
    out = merge.update_only(target, source, ["id"], compare=["v", "s"])
    assert {r.id for r in out.collect()} == {1, 2, 3, 4}


def test_duplicate_source_keys_are_refused(spark):
    rows = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "id long")
    assert tuples(merge.duplicate_keys(rows, ["id"])) == [(1, 2)]
    with pytest.raises(merge.DuplicateKeyError):
        merge.assert_unique(rows, ["id"])
    merge.assert_unique(rows.filter("id = 2 or id is null"), ["id"])


def test_orphans_keep_unknown_members(spark):
    fact = spark.createDataFrame([(1, 1), (2, 2), (-1, 3), (4, 4), (None, 5)],
                                 "key long, record_id long")
    source = spark.createDataFrame([(1, "c"), (4, None)], "rec_id long, data_area_id string")
    kept = merge.delete_orphans(fact, source, "record_id", "key")
    assert {r.record_id for r in kept.collect()} == {1, 3, 5}
    gone = merge.orphans(fact, source, "record_id", "key")
    assert {r.record_id for r in gone.collect()} == {2, 4}


def test_surrogate_keys_are_unique_and_rise(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 7).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).alias("key"), F.col("id").alias("n"))
    merge.tag_rows(rows).write.parquet(str(tmp_path / "rows"))
    written = spark.read.parquet(str(tmp_path / "rows"))
    out = merge.assign_surrogate_keys(written, "key", F.col("key").isNull(), 5000).collect()
    assert len(out) == 1000
    new = [r.key for r in out if r.n % 3 != 0]
    assert len(set(new)) == len(new) and min(new) > 5000 and max(new) <= 5000 + 1000 + 7
    assert all(r.key == r.n for r in out if r.n % 3 == 0)


# Text, quality, archive ------------------------------------------------------------------------


def test_sorted_list_keeps_duplicates_and_skips_null(spark):
    rows = spark.createDataFrame(
        [("k", "b"), ("k", "a"), ("k", "b"), ("k", None), ("n", None)], "k string, t string")
    assert dict(tuples(sorted_list(rows, ["k"], "t", "l"))) == {"k": "a x1, b x2", "n": None}
    assert dict(tuples(sorted_list(rows, ["k"], "t", "l", "distinct")))["k"] == "a, b"
    assert dict(tuples(sorted_list(rows, ["k"], "t", "l", "all")))["k"] == "a, b, b"
    with pytest.raises(ValueError):
        sorted_list(rows, ["k"], "t", "l", "some")


def summary_row(spark, **values):
    frame = empty(spark, MOVEMENT_SUMMARY)
    base = {"year": 1998, "month": 6, "company_key": 1, "product_key": 1,
            "product_inventory_key": 1, "inventory_dimension_key": 1, "warehouse_key": 1,
            "period_start_date": dt.date(1998, 6, 1), "period_end_date": dt.date(1998, 6, 30),
            "is_current_month": False, "total_transaction_count": 0,
            "inbound_transaction_count": 0, "outbound_transaction_count": 0}
    for name in ("bom_physical_stock_quantity", "eom_physical_stock_quantity",
                 "total_inbound_quantity", "total_outbound_quantity",
                 "average_physical_stock_quantity", "net_movement_quantity", "quantity_change"):
        base[name] = Decimal(0)
    base.update(values)
    return spark.createDataFrame([tuple(base.get(c) for c in frame.columns)], MOVEMENT_SUMMARY)


def test_quality_findings(spark):
    good = summary_row(spark, eom_physical_stock_quantity=Decimal(5),
                       total_inbound_quantity=Decimal(5), product_key=2)
    bad = summary_row(
        spark, eom_physical_stock_quantity=Decimal(5), total_outbound_quantity=Decimal(2),
        average_physical_stock_quantity=Decimal(9), total_transaction_count=3,
        inbound_transaction_count=1, days_inventory_outstanding=Decimal("1.00"),
        stock_turnover_ratio=Decimal("0.2222"))
    both = good.union(bad)
    assert [r.product_key for r in quality.balance(both).collect()] == [1]
    assert quality.is_clean(quality.balance(good))
    # the good row has a wrong average on purpose: (0 + 5) / 2 is not 0
    assert quality.average(both).count() == 2
    assert [r.total_transaction_count for r in quality.counts(both).collect()] == [3]
    assert [r.dio_status for r in quality.dio(both).collect()] == [quality.MISMATCH]
    assert [r.turnover_status for r in quality.turnover(both).collect()] == [quality.CORRECT]
    nulls = {r.column_name: (r.null_count, r.null_pct) for r in quality.nulls(both).collect()}
    assert nulls[quality.DIO] == (1, Decimal("50.00"))
    assert quality.completeness(both).first().total_records == 2
    negative = summary_row(spark, bom_physical_stock_quantity=Decimal(-1),
                           eom_physical_stock_quantity=Decimal(-1))
    assert dict(tuples(quality.negatives(both.union(negative)))) == {
        quality.VALID: 2, quality.NEGATIVE_BOM: 1}
    run = quality.run_summary(both).first()
    assert (run.total_records, run.products, run.total_transactions) == (2, 2, 3)


def test_quality_on_an_empty_period(spark):
    from stockmart.functions.period import Period
    none = summary_row(spark)
    period = Period(2010, 1)
    assert quality.completeness(none, period).first().status == quality.NO_RECORDS
    assert [r.null_pct for r in quality.nulls(none, period).collect()] == [None] * 3
    assert [r.status for r in quality.period_dates(none, period).collect()] == [
        quality.UNEXPECTED] * 2
    assert [r.status for r in quality.period_dates(none, Period(1998, 6)).collect()] == [
        quality.CORRECT] * 2


def test_attempt_reports_rows_or_error():
    assert quality.attempt(lambda: 5).rows == 5
    failed = quality.attempt(lambda: 1 // 0)
    assert not failed.ok and "division" in failed.error


def test_schema_diff():
    after = type(FACT_STOCK_LEVEL)(list(FACT_STOCK_LEVEL.fields[1:]))
    assert quality.schema_diff(FACT_STOCK_LEVEL, FACT_STOCK_LEVEL) == []
    assert quality.schema_diff(FACT_STOCK_LEVEL, after) == [
        ("removed", "stock_level_key", "bigint", None)]


def test_archive_split(spark):
    today = dt.date(2001, 8, 15)
    assert archive.cutoff(today) == dt.date(2001, 2, 1)
    assert archive.cutoff(dt.date(2001, 3, 1)) == dt.date(2000, 9, 1)
    rows = spark.createDataFrame(
        [(day(31, 1, 2001),), (day(1, 2, 2001),), (None,), (day(1, 1, 1900),)], "d timestamp_ntz")
    detail, old = archive.split_by_age(rows, "d", today, dt.date(1900, 1, 1))
    assert (detail.count(), old.count()) == (3, 1)


@pytest.mark.parametrize("dim", ["dim_product", "dim_inventory_dimension", "dim_warehouse",
                                 "dim_load", "dim_product_variant", "dim_inventory_color",
                                 "invent_dim", "invent_table", "invent_table_module",
                                 "invent_trans_origin", "dimension_value_combination"])
def test_large_views_are_not_broadcast(star, dim):
    rows, company = star["invent_trans"], star["dim_company"]
    right = star[dim].select(F.col(star[dim].columns[0]).alias("_code"))
    joined = rows.join(right, rows["data_area_id"] == right["_code"], "left").join(
        company, F.col("data_area_id") == F.col("company_code"), "left"
    )
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1
    assert plan.count("BroadcastHashJoin") == 1  # the company, whose size Spark knows
