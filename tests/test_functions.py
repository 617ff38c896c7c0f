import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import tuples
from stockmart.functions import kpi, measures, scalar, status
from stockmart.functions.period import Period
from stockmart.params import EnumSet, NaParams
from stockmart.schemas import display_names
from stockmart.sources.star_views import enum_frame, params_frame
from stockmart.sources.tables import incremental, live


def statuses(spark, rows):
    return spark.createDataFrame(rows, "id int, status_issue int, status_receipt int")


ALL = [(i, s, 0) for i, s in enumerate(range(8))] + [(10 + r, 0, r) for r in range(1, 7)]


def test_stock_gate_drops_quotations_and_empty_rows(spark, enums):
    rows = statuses(spark, [*ALL, (90, None, None), (91, None, 2), (92, 7, 3)])
    kept = rows.filter(status.is_stock_relevant(status.StatusColumns(enums)))
    assert [r[0] for r in tuples(kept, "id")] == sorted(
        [1, 2, 3, 4, 5, 6, 11, 12, 13, 14, 15, 91, 92], key=str)


def test_settled_gate(spark, enums):
    kept = statuses(spark, ALL).filter(status.is_settled(status.StatusColumns(enums)))
    assert {r.id for r in kept.collect()} == {1, 11}


def test_movement_type_first_match_wins(spark, enums):
    rows = statuses(spark, [
        (1, 1, 0), (2, 2, 4), (3, 0, 1), (4, 3, 2), (5, 3, 0), (6, 4, 0), (7, 0, 4), (8, 0, 5),
        (9, 5, 0), (10, 6, 0), (11, 0, 3), (12, None, None),
    ])
    got = dict(tuples(rows.select(
        "id", status.movement_type(status.StatusColumns(enums)).alias("m"))))
    assert got == {1: "OUT", 2: "OUT", 3: "IN", 4: "IN", 5: "TRANSFER", 6: "RESERVATION",
                   7: "ON_ORDER", 8: "ON_ORDER", 9: "OTHER", 10: "OTHER", 11: "OTHER",
                   12: "OTHER"}


def test_transaction_type_and_category_rules(spark):
    rows = spark.createDataFrame([(None,), (0,), (1,), (25,), (26,), (27,), (-1,)], "c int")
    got = dict(tuples(rows.select("c", status.transaction_type(F.col("c")).alias("t"))))
    assert got == {None: "None", 0: "None", 1: "Sales Order", 25: "Inventory Cost Group",
                   26: "Unknown", 27: "Unknown", -1: "Unknown"}
    dropped = rows.filter(status.category_allowed(F.col("c"), keep_null=False))
    kept = rows.filter(status.category_allowed(F.col("c"), keep_null=True))
    assert dropped.count() == 5 and kept.count() == 6


def test_transaction_status_prefers_issue(spark, enums):
    rows = statuses(spark, [(1, 1, 2), (2, 0, 2), (3, None, 3), (4, 0, 0), (5, None, None),
                            (6, 99, 2)])
    got = dict(tuples(rows.select(
        "id", status.transaction_status(status.StatusColumns(enums)).alias("s"))))
    assert got == {1: "Sold", 2: "Received", 3: "Registered", 4: None, 5: None, 6: None}


def test_enum_lookup_rules(spark):
    enums = EnumSet.load(enum_frame(spark), ["StatusIssue"])
    assert enums.id("StatusIssue", "ReservPhysical") == 4
    with pytest.raises(KeyError):
        enums.id("StatusIssue", "Vanished")
    with pytest.raises(ValueError):
        EnumSet([("E", 1, "a", "A"), ("E", 1, "b", "B")])
    rows = spark.createDataFrame([(4,), (77,), (None,)], "v int")
    got = dict(tuples(rows.select("v", enums.label("StatusIssue", F.col("v")).alias("l"))))
    assert got == {4: "ReservPhysical", 77: None, None: None}


def test_parameters_must_be_one_row(spark):
    frame = params_frame(spark)
    assert NaParams.load(frame).na_key == -1
    with pytest.raises(ValueError):
        NaParams.load(frame.union(frame))
    with pytest.raises(ValueError):
        NaParams.load(frame.limit(0))


def test_value_buckets_match_the_status_matrix(spark, enums):
    # bucket: (issue ids, receipt ids, sign)
    matrix = {
        "quantity": ({1, 2}, {1, 2}, 1), "posted_quantity": ({1}, {1}, 1),
        "physical_quantity": ({1, 2, 3}, {1, 2, 3}, 1),
        "available_physical_quantity": ({1, 2, 3, 4}, {1, 2, 3}, 1),
        "total_available_quantity": ({1, 2, 3, 4, 5, 6}, {1, 2, 3, 4, 5}, 1),
        "physical_reserved_quantity": ({4}, set(), -1),
        "ordered_in_total_quantity": (set(), {4, 5}, 1),
        "on_order_quantity": ({6}, set(), -1), "ordered_reserved_quantity": ({5}, set(), -1),
        "available_for_reservation_quantity": ({1, 2, 3, 4}, {1, 2, 3}, 1),
    }
    rows = statuses(spark, ALL)
    columns = measures.value_buckets(status.StatusColumns(enums), F.lit(5), F.lit(7))
    assert list(columns) == list(measures.VALUE_MEASURES) and len(columns) == 20
    for row in rows.withColumns(columns).collect():
        for name, (issues, receipts, sign) in matrix.items():
            inside = row.status_issue in issues or row.status_receipt in receipts
            assert row[name] == (Decimal(5 * sign) if inside else None), (row.id, name)
            cost = name.replace("quantity", "cost_amount")
            assert row[cost] == (Decimal(7 * sign) if inside else None), (row.id, cost)


def test_stock_sums_use_zero_outside_the_bucket(spark, enums):
    sums = measures.stock_level_sums(status.StatusColumns(enums), F.lit(1).cast("decimal(18,4)"))
    row = statuses(spark, ALL).agg(*[s.alias(n) for n, s in sums.items()]).first()
    assert [int(v) for v in row] == [4, 7, -1, 3, 3]
    none = statuses(spark, [(1, 7, 0)]).agg(*[s.alias(n) for n, s in sums.items()]).first()
    assert [int(v) for v in none] == [0, 0, 0, 0, 0]


def test_transfer_and_on_order_rows_carry_no_physical_quantity(spark, enums):
    st = status.StatusColumns(enums)
    sums = measures.stock_level_sums(st, F.lit(3).cast("decimal(18,4)"))
    rows = statuses(spark, ALL).withColumn("m", status.movement_type(st))
    got = {r.m: r.q for r in rows.groupBy("m").agg(
        sums["physical_stock_quantity"].alias("q")).collect()}
    assert got["TRANSFER"] == 0 and got["ON_ORDER"] == 0 and got["OUT"] == 6


def test_kpis(spark):
    rows = spark.createDataFrame(
        [(1, Decimal(10), Decimal(20), Decimal(8)), (2, Decimal(0), Decimal(5), Decimal(0)),
         (3, Decimal(-4), Decimal(2), Decimal(3))],
        "id int, bom decimal(18,4), eom decimal(18,4), out decimal(18,4)")
    average = kpi.average_level(F.col("bom"), F.col("eom"))
    got = rows.select(
        "id", kpi.days_inventory_outstanding(F.col("eom"), F.col("out"), F.lit(30)).alias("dio"),
        kpi.stock_turnover(F.col("out"), average).alias("turn"), average.alias("avg"),
    ).collect()
    assert [r.dio for r in got] == [Decimal("75.00"), None, Decimal("20.00")]
    assert [r.turn for r in got] == [Decimal("0.5333"), Decimal("0.0000"), None]
    assert [float(r.avg) for r in got] == [15.0, 2.5, -1.0]


def test_dio_overflow_is_an_error(spark):
    rows = spark.createDataFrame([(Decimal("99999999"), Decimal("0.0001"))],
                                 "eom decimal(18,4), out decimal(18,4)")
    with pytest.raises(Exception, match="cannot be represented"):
        rows.select(kpi.days_inventory_outstanding(F.col("eom"), F.col("out"), F.lit(31))).collect()


def test_period_ends_at_midnight_of_the_last_day(spark):
    period = Period(2000, 2)
    assert (period.start, period.end, period.days) == (
        dt.date(2000, 2, 1), dt.date(2000, 2, 29), 29)
    rows = spark.createDataFrame(
        [(dt.datetime(2000, 2, 1),), (dt.datetime(2000, 2, 29),), (dt.datetime(2000, 2, 29, 9),),
         (dt.datetime(2000, 1, 31, 23),)], "d timestamp_ntz")
    assert rows.filter(period.contains(F.col("d"))).count() == 2


def test_scalar_helpers(spark):
    one = spark.range(1).select(
        scalar.blank_to_null(F.lit("")).alias("blank"),
        scalar.quotient(F.lit(1), F.lit(0), strict=False).alias("safe"),
        scalar.run_label(F.lit(dt.datetime(1998, 6, 1, 9, 30)).cast("timestamp_ntz"),
                         "TEST_").alias("run"),
        scalar.period_label(F.lit(1998), F.lit(6)).alias("period"),
        scalar.typed_null("decimal(18,4)").alias("nothing"),
    )
    assert dict(one.dtypes)["nothing"] == "decimal(18,4)"
    assert tuple(one.first()) == (None, None, "TEST_19980601_093000", "1998-06", None)
    with pytest.raises(Exception):
        spark.range(1).select(scalar.quotient(F.lit(1), F.lit(0), strict=True)).collect()


def test_incremental_scan_rules(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, execution_id string")
    assert incremental(rows, "a", enabled=False).count() == 3
    assert incremental(rows, "a", enabled=True).count() == 1
    assert incremental(rows, None, enabled=True).count() == 0
    assert incremental(rows, None, enabled=True, null_id_means_all=True).count() == 3
    assert live(rows, "execution_id").count() == 2


def test_display_names(spark):
    df = spark.range(1).select(F.lit(1).alias("bom_physical_stock_quantity"),
                               F.lit(1).alias("ea_process_datetime"))
    assert display_names(df).columns == ["BOM Physical Stock Quantity", "ea_process_datetime"]
