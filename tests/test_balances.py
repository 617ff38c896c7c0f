"""Balances per key and month, moves to the archive, and loads and streams over both."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, tuples
from stockmart.functions.period import Period
from stockmart.plans import enrich, jobs, stock_level, summary
from stockmart.plans.balances import Balances
from stockmart.schemas import BALANCE_MONTH
from stockmart.sources import facts
from stockmart.sources.facts import MONTH, LoadResult, history
from stockmart.sources.star_views import star_tables
from stockmart.streaming import incremental as streaming

JUNE = Period(1998, 6)
TODAY = dt.date(1999, 1, 15)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("domain")
    tables = star_tables(spark, SMALL)
    names = [n for n in tables if n.startswith(("invent_", "dim", "sales_line", "fact_"))]
    for name in names:
        rows = tables[name]
        if name == "invent_trans":  # loads rewrite every month, so a year is enough
            rows = rows.filter(F.year("date_physical") == 1998).coalesce(2)
        rows.write.parquet(str(root / name))
    return tables.replacing(**{n: spark.read.parquet(str(root / n)) for n in names})


@pytest.fixture
def pair(spark, tmp_path):
    made = [jobs.stock_level_table(spark, str(tmp_path / n)) for n in ("fact", "cold")]
    for table in made:
        table.create()
    return made


@pytest.fixture
def held(spark, tmp_path):
    balances = Balances(spark, str(tmp_path / "balances"))
    balances.create()
    return balances


def without(trans, ids):
    """The transactions with some of them gone: no company, and no status that counts."""
    lost = F.col("rec_id").isin(list(ids))
    blank = {"data_area_id": F.lit(None).cast("string"), "status_issue": F.lit(0), "status_receipt": F.lit(0)}
    return trans.withColumns({
        n: F.when(lost, v.cast(trans.schema[n].dataType)).otherwise(F.col(n)) for n, v in blank.items()
    })


@pytest.mark.parametrize("level", ["latest", "running"])
def test_a_month_needs_its_own_rows_and_one_balance(spark, stored, now, pair, held, tmp_path, level):
    fact, _ = pair
    params = stored.na_params()
    jobs.load_stock_levels(stored, fact, now, balances=held)
    assert held.marked() == []
    # a table with the rows of June alone
    june = jobs.stock_level_table(spark, str(tmp_path / "june"))
    june.create()
    june.replace(fact.rows().filter(F.date_trunc("month", "transaction_date") == F.lit(dt.datetime(1998, 6, 1))))
    target = jobs.summary_table(spark, str(tmp_path / "summary"))
    target.create()
    result = jobs.build_monthly_summary(stored, params, june, target, JUNE, now, level=level, balances=held)
    want = summary.build_history(fact.read(), stored, params, now, first=JUNE, last=JUNE, level=level)
    assert result.inserted == want.count() > 0
    columns = [c for c in want.columns if c != "ea_last_update_datetime"]
    assert tuples(target.rows(), *columns) == tuples(want, *columns)


def test_late_and_lost_rows_change_their_key_from_their_month_on(stored, now, pair, held):
    fact, _ = pair
    params = stored.na_params()
    jobs.load_stock_levels(stored, fact, now, balances=held)
    before = {r[:7]: r for r in tuples(held.closes.rows())}
    late, lost = fact.rows().filter(F.month("transaction_date") == 3).select("record_id").limit(2).collect()
    trans = without(stored["invent_trans"], [lost[0]])
    trans = trans.withColumn("qty", F.when(F.col("rec_id") == late[0], F.col("qty") + 5).otherwise(F.col("qty")))
    changed = stored.replacing(invent_trans=trans)
    keyed = summary._unknown_for_null(summary.confirm_keys(
        fact.read().filter(F.col("record_id").isin(late[0], lost[0])), stored), params)
    keys = {tuple(r[:6]): r[6] for r in keyed.select(*summary.KEYS, MONTH).collect()}
    result = jobs.load_stock_levels(changed, fact, now, balances=held)
    assert result.deleted == 1
    after = {r[:7]: r for r in tuples(held.closes.rows())}
    differing = {k for k in before.keys() | after.keys() if before.get(k) != after.get(k)}
    assert differing and all(k[:6] in keys and k[6] >= keys[k[:6]] for k in differing)
    last = max(k[6] for k in before)
    assert {k[:6] for k in differing if k[6] == last} <= set(keys)

    # and they are what a rebuild finds
    held.rebuild(fact.read(), changed, params)
    assert tuples(held.closes.rows()) == sorted(after.values(), key=lambda r: tuple((v is None, str(v)) for v in r))


def test_a_load_that_stops_leaves_its_months_marked(stored, now, pair, held, monkeypatch):
    fact, _ = pair
    params = stored.na_params()
    jobs.load_stock_levels(stored, fact, now, balances=held)
    whole = tuples(held.closes.rows())
    more = stored.replacing(invent_trans=stored["invent_trans"].withColumn("qty", F.col("qty") + 1))
    monkeypatch.setattr(Balances, "settle", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        jobs.load_stock_levels(more, fact, now, balances=held)
    monkeypatch.undo()
    assert held.marked() == sorted(r[0] for r in fact.read().select(MONTH).distinct().collect())
    held.settle(fact.read(), stored, params)
    assert tuples(held.closes.rows()) != whole and held.marked() == []


def test_months_without_rows_lose_their_balances(stored, now, pair, held):
    fact, _ = pair
    jobs.load_stock_levels(stored, fact, now, balances=held)
    june = [r[0] for r in fact.read().filter(F.col(MONTH) == 199806).select("record_id").collect()]
    jobs.load_stock_levels(stored.replacing(invent_trans=without(stored["invent_trans"], june)), fact, now, balances=held)
    assert held.closes.rows().filter(F.col(BALANCE_MONTH) == 199806).count() == 0
    assert held.closes.rows().filter(F.col(BALANCE_MONTH) == 199807).count() > 0


def test_orphans_leave_the_archive(stored, now, pair):
    fact, cold = pair
    jobs.load_stock_levels(stored, fact, now, archive=cold)
    jobs.archive_detail(fact, cold, TODAY, stored.na_params())
    gone = [r[0] for r in cold.rows().select("record_id").limit(3).collect()]
    left = stored["invent_trans"].filter(~F.col("rec_id").isin(gone))
    result = jobs.load_stock_levels(stored.replacing(invent_trans=left), fact, now, archive=cold)
    assert result.deleted == 3
    assert history(fact, cold).filter(F.col("record_id").isin(gone)).count() == 0


def test_stream_and_archive_hold_each_record_once(stored, now, pair, held):
    fact, cold = pair
    params = stored.na_params()
    jobs.load_stock_levels(stored, fact, now, archive=cold, balances=held)
    want = tuples(history(fact, cold).drop("stock_level_key"))
    closes = tuples(held.closes.rows())
    jobs.archive_detail(fact, cold, TODAY, params)
    streaming.merge_batch(stored, fact, lambda: now, cold, held)(stored["invent_trans"], 0)
    assert tuples(history(fact, cold).drop("stock_level_key")) == want
    assert tuples(held.closes.rows()) == closes


@pytest.mark.parametrize("step", ["stage", "commit", "archive", "detail", "clean"])
def test_an_interrupted_move_counts_no_row_twice(stored, now, pair, monkeypatch, step):
    fact, cold = pair
    jobs.load_stock_levels(stored, fact, now)
    want = tuples(fact.rows())
    calls = {"archive": 0}

    class Lost(Exception):
        pass

    def fail(*a, **k):
        raise Lost

    if step == "stage":
        monkeypatch.setattr(facts.FactTable, "_moved_rows", fail)
    elif step == "commit":
        monkeypatch.setattr(facts.FactTable, "finish_move", lambda *a: fail() if calls.setdefault("n", 0) else calls.update(n=1))
    elif step == "archive":
        monkeypatch.setattr(facts.FactTable, "_overwrite", fail)
    elif step == "detail":
        monkeypatch.setattr(facts.FactTable, "_empty", fail)
    else:
        real = facts.remove_folder
        monkeypatch.setattr(facts, "remove_folder", lambda s, p: fail() if p.endswith("/partitions") else real(s, p))
    with pytest.raises(Lost):
        jobs.archive_detail(fact, cold, TODAY, stored.na_params())
    monkeypatch.undo()
    assert tuples(history(fact, cold).select(*fact.schema.names)) == want
    # the next load finishes the move, or starts from where it was
    jobs.load_stock_levels(stored, fact, now, archive=cold)
    assert cold.moving() == set()
    assert tuples(history(fact, cold).drop("stock_level_key").select(*fact.schema.names[1:])) == sorted(
        (r[1:] for r in want), key=lambda r: tuple((v is None, str(v)) for v in r))
    jobs.archive_detail(fact, cold, TODAY, stored.na_params())
    assert history(fact, cold).count() == len(want) and cold.read().count() > 0


def test_value_and_settlement_loads_take_an_archive(spark, stored, now, tmp_path):
    params = stored.na_params()
    kinds = [(jobs.inventory_value_table, jobs.load_inventory_value, ("record_type", "record_id")),
             (jobs.settlement_table, jobs.load_settlements, ("record_id",))]
    for i, (make, load, keys) in enumerate(kinds):
        fact, cold = (make(spark, str(tmp_path / f"{n}{i}")) for n in ("fact", "cold"))
        fact.create()
        cold.create()
        first = load(stored, fact, now, archive=cold)
        whole = tuples(fact.rows())
        assert jobs.archive_detail(fact, cold, TODAY, params, keys=keys) > 0
        assert load(stored, fact, now, archive=cold) == LoadResult(unchanged=first.inserted)
        assert tuples(history(fact, cold).select(*fact.schema.names)) == whole
