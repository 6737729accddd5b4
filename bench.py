"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (every row computed,
nothing collected to the driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

HEADLINE = [
    "parse_traffic",
    "width_summary",
    "label_dictionary",
    "string_index",
    "flow_features",
    "encode_traffic",
    "label_counts",
    "top_labels",
    "traffic_summary",
    "recent",
    "read_predictions",
    "classification_metrics",
    "train_predict",
    "train_csv",
    "parse_stream",
    "summary_stream",
]


def main() -> None:
    from tidewatch.plans.catalog import QUERIES
    from tidewatch.session import session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = session(
        app="tidewatch-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=max(8, 2 * cpus),
    )
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    # warm-up: JVM, codegen caches, file listing
    QUERIES["traffic_count"](spark, sf_dir).collect()
    timings: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
