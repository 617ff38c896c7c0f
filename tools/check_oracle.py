"""Run registered queries next to their SQL twins and compare rows.

    python tools/check_oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stockmart.queries.oracle import ORACLE  # noqa: E402
from stockmart.queries.registry import QUERIES  # noqa: E402
from stockmart.session import build_session  # noqa: E402

SAME_TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def plain(value):
    if isinstance(value, float) and not math.isnan(value):
        return f"{value:.6f}".replace("-0.000000", "0.000000")
    return str(value)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in sorted(os.listdir(sf_dir)):
        if name.endswith(".parquet"):
            con.execute(f"create view {name[:-8]} as select * from '{sf_dir}/{name}'")
    return con


def compare(spark, con, sf_dir: str, name: str, queries=QUERIES, oracle=ORACLE) -> tuple[bool, str]:
    started = time.time()
    frame = queries[name](spark, sf_dir)
    got = frame.collect()
    spark_seconds = time.time() - started
    if name not in oracle:
        return True, f"{len(got)} rows, no SQL twin, {spark_seconds:.1f}s"
    started = time.time()
    relation = con.sql(oracle[name])
    want = relation.fetchall()
    sql_seconds = time.time() - started
    columns = sorted(frame.columns)
    if columns != sorted(relation.columns):
        return False, f"columns differ: {set(columns) ^ set(relation.columns)}"
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    odd = {c: (t, kinds[c]) for c, t in frame.dtypes if SAME_TYPES.get(t) != kinds[c]}
    order = [relation.columns.index(c) for c in columns]
    left = sorted(tuple(plain(r[c]) for c in columns) for r in got)
    right = sorted(tuple(plain(r[i]) for i in order) for r in want)
    note = f"{len(left)} rows, {spark_seconds:.1f}s against {sql_seconds:.1f}s"
    if odd:
        return False, f"{note}, types differ: {odd}"
    if left != right:
        only_left = sorted(set(left) - set(right))[:2]
        only_right = sorted(set(right) - set(left))[:2]
        return False, f"{note} against {len(right)} rows\n  {columns}\n  {only_left}\n  {only_right}"
    return True, note


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        "check", f"local[{os.cpu_count()}]", shuffle_partitions=8,
        conf={"spark.ui.enabled": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = []
    for name in names:
        try:
            ok, note = compare(spark, con, sf_dir, name)
        except Exception as error:  # keep checking the remaining queries
            ok, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        print(("ok    " if ok else "WRONG ") + name, note, flush=True)
        if not ok:
            failed.append(name)
    spark.stop()
    print(f"{len(names) - len(failed)} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
