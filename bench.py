"""Headline queries, median of three runs after a warm-up; one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from posloom.catalog.queries import QUERIES
from posloom.session import build_session

HEADLINE = [
    "pos_control_totals",
    "pos_final_rows",
    "gate_clean_accounts",
    "two_pass_cascade",
    "left_match_upc",
    "weighted_match",
    "dedup_first",
    "dedup_if_rows",
    "preagg_drop_null_keys",
    "master_invalid_items",
    "period_report",
    "header_promotion",
    "normalise_text",
    "acct_amazon",
    "acct_bbb",
    "acct_depot",
    "acct_kmart",
    "acct_nordstrom",
    "acct_sears",
    "acct_target",
    "acct_walmart",
    "acct_wmcom_rl",
    "acct_amazon_reference",
    "acct_bbb_reference",
]
RUNS = 3


def run(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    shared = tempfile.TemporaryDirectory(prefix="posloom-bench-", ignore_cleanup_errors=True)
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=shared.name,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        run(QUERIES[name], spark, folder)
        seconds[name] = round(
            statistics.median(run(QUERIES[name], spark, folder) for _ in range(RUNS)), 3
        )
    result = {
        "metric": "headline queries, sum of median seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "spark": spark.version,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
