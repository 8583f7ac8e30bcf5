"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is built and fully evaluated into a no-op sink.  With names as
arguments only those are timed; ``all`` times every registered query.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidemark.catalog import QUERIES
from tidemark.session import build_session

HEADLINE = (
    "features_events features_orders global_rates rolling_unlagged mcc_encoding_orders user_history_events "
    "user_history_orders user_history_bucketed_orders year_bands trailing_event_mean temporal_split_orders merged_orders before_this_row_bucketed "
    "evaluate_models pr_curve champion_challenger feature_stats training_serving_skew serving_drift stream_histograms "
    "train_logistic_regression rose_rows transactions_csv"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = sys.argv[1:] or HEADLINE
    names = list(QUERIES) if chosen == ["all"] else chosen
    spark = build_session(
        f"local[{cpus}]",
        "tidemark-bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
