"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the input folder and ``BENCH_CPUS`` the number of local threads.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stockmart.queries.registry import QUERIES  # noqa: E402
from stockmart.session import build_session  # noqa: E402

HEADLINE = (
    "movement_totals", "transaction_type_counts", "postings_by_role", "star_keys_unknown_member",
    "value_buckets_by_status", "stock_level_fact", "inventory_value_fact", "settlement_fact",
    "orphan_delete", "upsert_changed_only", "asof_before_ties_all", "asof_before_ties_sum",
    "running_level", "price_at_order", "sales_cost_refresh", "monthly_movements",
    "transaction_type_list", "monthly_summary", "monthly_summary_period", "dq_balance",
    "dq_run_summary",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", shuffle_partitions=cpus,
        conf={"spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Read the inputs once, so that the first query does not pay for the start of the session.
    for table in ("lineitem", "orders", "part", "supplier"):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").write.format("noop").mode(
            "overwrite").save()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
