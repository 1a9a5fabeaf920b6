"""Seconds per headline query at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line on stdout."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from saldo.catalogue import QUERIES, run_query  # noqa: E402
from saldo.session import build_session  # noqa: E402

HEADLINE = [
    "day_balance", "signed_stats", "top_groups", "latest_per_key", "superseded_pairs",
    "exact_duplicates", "bulk_dedup_slices", "price_before_day", "price_next_day_effective",
    "lookup_policies", "chain_change_date", "chain_closure", "assign_keys", "book_accruals",
    "book_payments", "book_writeoffs", "book_grouped_payments", "book_shipment", "book_activation",
    "book_all", "book_month", "ops_buffer", "advance_wrap", "ungrouped_ledger", "grouped_ledger",
    "buf_accruals", "buf_differences", "buf_payments", "buf_reversals", "buf_writeoffs",
    "buf_payments_grouped", "buf_publish", "buf_month", "session_metrics", "snapshot_append",
    "snapshot_retention",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    shared = tempfile.mkdtemp(prefix="saldo-bench-")
    spark = build_session(
        "saldo-bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
            "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": shared,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run_query("top_groups", spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        if name not in QUERIES:
            raise SystemExit(f"no query {name}")
        start = time.perf_counter()
        run_query(name, spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    version = spark.version
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus), "spark": version,
    }))


if __name__ == "__main__":
    main()
