"""Time the headline queries and print one JSON line.

Two queries warm the session up; then each query runs ``BENCH_RUNS`` times (default 1) and
the best time counts.  Stored model tables are forgotten before every run, so a model query
always pays for its whole chain from the given tables.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from factorloom.session import build_session  # noqa: E402
from suite import QUERIES  # noqa: E402
from suite.models import forget  # noqa: E402

HEADLINE = (
    "scan_table", "dedup_latest", "pivot_eav", "json_extract_fields", "join_full_outer_chain",
    "rolling_sum_ttm", "rolling_stddev", "rolling_corr", "rank_cross_section",
    "zscore_partition", "reverse_run_index", "merge_latest", "scd2_delete_new_record",
    "sync_watermark", "stream_retry_dlq", "event_tumbling_counts", "metrics_anomaly_score",
    "ttm_metrics", "altman_z", "growth", "beta_bab", "qmj_final", "obt_web",
)
WARM_UP = ("rank_cross_section", "altman_z")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get(
        "BENCH_QUERIES") else HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        forget()
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    for name in WARM_UP:
        run(name)
    times = {name: round(min(run(name) for _ in range(runs)), 3) for name in names}
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))[2:],
    }))


if __name__ == "__main__":
    main()
