"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables' folder, BENCH_CPUS the cores, BENCH_RUNS the timed runs (the median
counts, after one warm-up). A query given by name on the command line is timed instead.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from viewflow.plans import QUERIES
from viewflow.streaming.jobs import clean_up

# One or two per group of operators; streams and tables are timed with all their writing.
HEADLINE = [
    "span_view",
    "merge_topics",
    "flat_map_zero_to_two",
    "row_function_view",
    "enrich_orders",
    "enrich_orders_skewed",
    "split_props_map",
    "truncate_text",
    "shape_table",
    "derived_columns",
    "ingest_filter_keep",
    "ingest_rollup",
    "star_rollup_lineitem",
    "query_rollup_stored",
    "partition_id_hashcode",
    "layout_round_trip",
    "retention",
    "age_tier",
    "hybrid_read",
    "stream_span_view",
    "stream_multi_view",
    "stream_rollup",
    "ingest_realtime_table",
    "table_pair_hybrid",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("viewflow-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="viewflow-bench-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - start
        clean_up(spark)
        return took

    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        timed(name)
        seconds[name] = round(statistics.median(timed(name) for _ in range(runs)), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
