"""Times the queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 4), BENCH_RUNS
(default 1; the median counts), BENCH_QUERIES (comma separated; default: all headline queries).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfline.plans.queries import QUERIES  # noqa: E402
from shelfline.session import local_session  # noqa: E402

HEADLINE = """
price_analytics delivery_analytics revenue_analytics stock_analytics dedup audit_summary write_roundtrip
platform_scorecard surge_heatmap availability_rates hourly_price trend_labels top10_trending price_volatility_7d
availability_24h latest_snapshot asof_price slot_gaps recommendation response_text weight_sensitivity
parsed_queries answer_queries sessions p95_value forecast_interval stream_tumbling
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if names == "all" else (names.split(",") if names else HEADLINE)
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * int(cpus)) if cpus != "*" else 8)
    QUERIES["platform_scorecard"](spark, sf_dir).collect()  # load classes before the clock starts
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs):
            begin = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - begin)
        seconds[name] = round(statistics.median(times), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                      "cpus": cpus, "runs": runs}))


if __name__ == "__main__":
    main()
