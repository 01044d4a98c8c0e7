"""Times queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and prints one JSON line.

Every query runs once to warm up and then ``BENCH_RUNS`` times; its figure is the median.
``BENCH_QUERIES`` names other queries than the headline ones, or ``all``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.bindings import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = [
    "agg_tumbling_record", "agg_by_point", "agg_word_count", "agg_offset_summary", "agg_poll_summary",
    "agg_throughput_report", "agg_nearest_rank_percentile", "agg_histogram_constant", "agg_adjacency",
    "proj_record7", "filter_numeric_value", "fn_key_partition", "join_inner_equi", "asof_first_at_or_after",
    "src_log_batch_ranges", "log_read_committed", "log_consumer_lag", "win_moving_average", "mon_task_metrics",
    "stream_word_sliding", "stream_sum_max_sliding", "log_exactly_once_sink", "graph_pagerank",
]

# Input table whose rows a query works through, for rows/s.
INPUT = {"agg_word_count": "documents", "agg_adjacency": "lineitem", "join_inner_equi": "orders",
         "mon_task_metrics": "orders", "graph_pagerank": "lineitem"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = build_session("bench", cpus, int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    sizes = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in {"events", *INPUT.values()}}
    seconds, rates = {}, {}
    for name in names:
        taken = []
        for _ in range(1 + runs):
            at = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - at)
        seconds[name] = round(statistics.median(taken[1:]), 3)
        rates[name] = int(sizes[INPUT.get(name, "events")] / seconds[name])
    print(json.dumps({
        "metric": "total_wall_time", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "rows_per_sec": rates, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
