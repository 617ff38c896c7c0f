"""Long plans in steps: the same rows, and no shuffle files left behind."""

import datetime as dt
import os
import time
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import tuples
from stockmart.operators import dims
from stockmart.operators.dims import Lookup
from stockmart.plans import balances, inventory_value, sales_cost, settlement, stock_level, summary
from stockmart.plans.balances import Balances
from stockmart.schemas import FACT_STOCK_LEVEL
from stockmart.sources.facts import MONTH, monthly_fact
from stockmart.steps import Steps, write


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for i in range(files.size()) if (f := files.apply(i).getName()).startswith("shuffle_")}


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    def summed(n):
        rows = spark.range(5000).repartition(3, "id").groupBy((F.col("id") % 101).alias("k"))
        return rows.agg(F.count("*").alias(n))

    before = shuffle_files(spark)
    plain = summed("plain")
    plain.write.parquet(str(tmp_path / "plain"))
    kept = shuffle_files(spark)
    assert kept - before  # what stays otherwise
    freed = summed("freed")
    write(freed, str(tmp_path / "freed"))
    until = time.time() + 30
    while shuffle_files(spark) - kept and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - kept
    assert spark.read.parquet(str(tmp_path / "freed")).count() == 101


def test_a_chain_holds_its_last_step_only(spark, tmp_path):
    step = Steps(str(tmp_path / "steps"))
    other = step.branch()(spark.range(3))
    for n in (1, 2, 3):
        last = step(spark.range(n))
    assert len(os.listdir(tmp_path / "steps")) == 2
    assert (last.count(), other.count()) == (3, 3)


def test_lookups_in_steps_keep_null_and_repeated_keys(spark, params, tmp_path):
    fact = spark.createDataFrame(
        [(1, "A", "x", 5), (1, "A", "x", 5), (2, None, "y", 6), (None, "B", None, None), (3, "C", "z", 7)],
        "rec_id long, code string, place string, qty int",
    )
    tables = {
        "goods": spark.createDataFrame([("A", 10, "s"), ("A", 11, "t"), ("B", 12, None)], "code string, good_key long, shelf string"),
        "shelves": spark.createDataFrame([("s", 20), ("s", 21), (None, 22)], "shelf string, shelf_key long"),
        "places": spark.createDataFrame([("x", 30), ("z", 31)], "place string, place_key long"),
    }
    lookups = [
        Lookup("goods", {"code": "code"}, "good_key", carry={"on_shelf": "shelf"}),
        Lookup("shelves", {"shelf": "on_shelf"}, "shelf_key", unknown=False),
        Lookup("places", {"place": "place"}, "place_key", small=True),
    ]
    plain = dims.resolve_keys(fact, tables, lookups, params)
    stepped = dims.resolve_keys(fact, tables, lookups, params, step=Steps(str(tmp_path / "all")))
    assert stepped.columns == plain.columns and tuples(stepped) == tuples(plain)
    wanted = ["rec_id", "qty", "on_shelf"]
    few = dims.resolve_keys(fact, tables, lookups, params, wanted, Steps(str(tmp_path / "few")))
    names = [*wanted, "good_key", "shelf_key", "place_key"]
    assert few.columns == names and tuples(few) == tuples(plain, *names)


def test_facts_in_steps_have_the_same_rows(spark, star, params, enums, tmp_path):
    few = star["lineitem"].filter("l_orderkey % 20 = 0")
    trans, settled = star["invent_trans"], star["invent_settlement"]
    ids = trans.join(few.select(F.col("l_orderkey").alias("invent_trans_origin")).distinct(), "invent_trans_origin", "left_semi")
    twice = ids.unionByName(ids.filter("rec_id % 5 = 0"))
    odd = twice.withColumn("item_id", F.when(F.col("rec_id") % 7 != 0, F.col("item_id")))
    tables = star.replacing(invent_trans=odd.select(*trans.columns), invent_settlement=settled)
    for n, build in enumerate((stock_level.build, inventory_value.build, settlement.build)):
        plain = build(tables, params, enums)
        stepped = build(tables, params, enums, step=Steps(str(tmp_path / f"fact{n}")))
        assert stepped.schema.names == plain.schema.names and tuples(stepped) == tuples(plain)
    plain = sales_cost.build(tables, enums)
    assert tuples(sales_cost.build(tables, enums, step=Steps(str(tmp_path / "costs")))) == tuples(plain)


def stock_rows(spark):
    """Keys that the dimensions have or not, null ones, several rows of a day, and no date."""
    when = [dt.datetime(1998, 5, 3), dt.datetime(1998, 6, 1), dt.datetime(1998, 6, 1), dt.datetime(1998, 8, 31)]
    names = FACT_STOCK_LEVEL.names
    rows = []
    for i in range(24):
        row = dict.fromkeys(names)
        row |= {"company_key": i % 4 or None, "product_key": 5 + i % 3, "product_inventory_key": i % 2,
                "inventory_dimension_key": 250 + i % 5, "warehouse_key": None if i % 6 == 0 else i % 6,
                "transaction_date": when[i % 4], "transaction_type": "T", "record_id": i // 2,
                "movement_type": ("IN", "OUT", None)[i % 3], "inventory_transaction_id": str(i // 2)}
        row |= {m: Decimal(i - 9) for m in summary.LEVELS}
        rows.append(tuple(row[n] for n in names))
    return spark.createDataFrame(rows, FACT_STOCK_LEVEL)


def test_a_summary_in_steps_has_the_same_rows(spark, star, params, now, tmp_path):
    fact = stock_rows(spark)
    for n, options in enumerate(({}, {"health_until": now.date()}, {"level": "running", "types": "distinct"})):
        plain = summary.build_history(fact, star, params, now, **options)
        stepped = summary.build_history(fact, star, params, now, step=Steps(str(tmp_path / str(n))), **options)
        assert tuples(stepped) == tuples(plain)


def test_closes_written_month_by_month_are_the_same(spark, star, params, tmp_path, monkeypatch):
    fact = monthly_fact(spark, str(tmp_path / "fact"), FACT_STOCK_LEVEL, "stock_level_key")
    fact.replace(stock_rows(spark))
    found = []
    for name, rows in (("whole", balances.ROWS), ("single", 1)):
        monkeypatch.setattr(balances, "ROWS", rows)
        held = Balances(spark, str(tmp_path / name))
        held.create()
        held.rebuild(fact.read().filter(F.col(MONTH) > 0), star, params)
        found.append(tuples(held.closes.rows()))
    assert found[0] and found[0] == found[1]
    assert {r[6] for r in found[0]} == {199805, 199806, 199808}
