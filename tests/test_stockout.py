"""Stockout days against a walk over every single day."""

import datetime as dt
import random

from conftest import tuples
from stockmart.operators import asof, stockout

D = dt.date


def _walk(rows, until):
    """Days out of stock per key and month, and the spells that touch the month."""
    out = {}
    for key in {k for k, *_ in rows}:
        mine = sorted((at, q) for k, at, q in rows if k == key)
        day, was_out = mine[0][0].date(), False
        while day <= until:
            level = sum(q for at, q in mine if at.date() <= day)
            month = day.replace(day=1)
            if level <= 0:
                days, spells = out.get((key, month), (0, 0))
                out[(key, month)] = (days + 1, spells + (not was_out or day.day == 1))
            was_out = level <= 0
            day += dt.timedelta(days=1)
    return sorted((k, m, d, s) for (k, m), (d, s) in out.items())


def _found(spark, rows, until, undated=None):
    moves = spark.createDataFrame(rows, "k string, at timestamp_ntz, q long").selectExpr(
        "k", "at", "cast(q as decimal(18, 4)) as q")
    levels = asof.running_level(moves, ["k"], "at", ["q"])
    return stockout.spells(levels, ["k"], "at", "q", until, undated)


def test_days_per_month_equal_a_walk_over_all_days(spark):
    rng = random.Random(5)
    rows = [(f"k{rng.randrange(6)}", dt.datetime(2000, 1, 1) + dt.timedelta(hours=rng.randrange(9000)),
             rng.choice([-3, -2, -1, 1, 2, 3])) for _ in range(240)]
    until = D(2001, 3, 10)
    got = tuples(stockout.by_month(_found(spark, rows, until), ["k"]))
    assert got == sorted(_walk(rows, until), key=lambda r: [str(v) for v in r])


def test_spells_join_rows_and_cross_month_borders(spark):
    rows = [("a", dt.datetime(2000, 1, 30), -1), ("a", dt.datetime(2000, 2, 10), -2),
            ("a", dt.datetime(2000, 3, 2), 5), ("a", dt.datetime(2000, 3, 20, 8), -2),
            ("a", dt.datetime(2000, 3, 20, 9), 2), ("b", dt.datetime(2000, 3, 1), 1)]
    found = _found(spark, rows, D(2000, 3, 31))
    assert tuples(found) == [("a", D(2000, 1, 30), D(2000, 3, 2))]
    assert tuples(stockout.by_month(found, ["k"])) == [
        ("a", D(2000, 1, 1), 2, 1), ("a", D(2000, 2, 1), 29, 1), ("a", D(2000, 3, 1), 1, 1)]


def test_undated_null_and_empty(spark):
    rows = [("a", dt.datetime(1900, 1, 1), -5), ("a", dt.datetime(2000, 1, 30), 3),
            (None, dt.datetime(2000, 1, 31), -1), ("c", dt.datetime(2000, 2, 1), -1)]
    found = _found(spark, rows, D(2000, 1, 31), undated=D(1900, 1, 1))
    assert tuples(found) == [("a", D(2000, 1, 30), D(2000, 2, 1)), (None, D(2000, 1, 31), D(2000, 2, 1))]
    assert stockout.by_month(_found(spark, [], D(2000, 1, 31)), ["k"]).count() == 0
