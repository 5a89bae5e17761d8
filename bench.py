"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_ALL=1 for every query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tabularium.catalog import load_all
from tabularium.session import local_session

HEADLINE = (
    "m11_order_finance", "j7_join_chain", "j8_preagg_join", "j17_asof_join", "j18_salted_join", "a7_grouping_sets",
    "a9_percentile", "w1_row_number", "w3_lag_lead", "w6_topn_per_group", "w14_sessions", "w17_retention", "w18_abc_classes",
    "n8_json_aggregates", "q1_profile", "q4_keep_one", "q9_reconcile", "q12_rules", "io11_dynamic_overwrite", "e4_merge",
    "m3_item_fact", "m8_scd2", "m10_star_sales", "m14_daily_bars", "st6_windows",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "tabularium-bench")
    spark.sparkContext.setLogLevel("ERROR")
    known = load_all()
    names = list(known) if os.environ.get("BENCH_ALL") else HEADLINE

    def run(name: str) -> float:
        start = time.perf_counter()
        # the noop sink runs the whole plan and moves no rows to the driver
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run(HEADLINE[0])  # starts the workers and warms the file cache
    times = {name: round(run(name), 3) for name in names}
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
