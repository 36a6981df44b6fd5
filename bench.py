"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) and ``BENCH_CPUS`` (default 8) choose data and cores,
``BENCH_REPEATS`` (default 5) how often each query runs after one warm-up; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from countloom import workloads
from countloom.functions.hashing import Colouring
from countloom.operators import triangles

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "5"))

HEADLINE = (
    "edge_count",
    "edges_from_lines",
    "graph_simplify",
    "triangles_exact",
    "triangles_colour_triple",
    "triangles_node_colour",
    "triangles_node_colour_c8",
    "triangles_edge_partition",
    "triangle_runs_median",
    "triangles_per_triple",
    "triangle_report",
    "triangle_report_exact",
    "item_freq",
    "sketch_counters",
    "stream_prefix",
    "point_estimates",
    "topk_avg_error",
    "stream_report",
    "stream_sketch",
    "stream_until",
)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("countloom-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        # Small data, all cores.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = dict(workloads.QUERIES)
    eight = Colouring.seeded(8, workloads.SEED)
    queries["triangles_node_colour_c8"] = lambda s, d: triangles.triangles_node_colour(
        workloads.part_supplier(s, d), eight
    )
    seconds, results = {}, {}
    for name in HEADLINE:
        spent = []
        for _ in range(REPEATS + 1):
            begun = time.perf_counter()
            result = queries[name](spark, SF_DIR)
            if name.startswith("triangles_") and name != "triangles_per_triple":
                results[name] = result.first().asDict()
            else:
                result.write.format("noop").mode("overwrite").save()
            spent.append(time.perf_counter() - begun)
        seconds[name] = round(statistics.median(spent[1:]), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    exact = results["triangles_exact"]["triangles"]
    approximations = {
        name: {"error": round(abs(row["estimate"] / exact - 1), 4), "speedup": round(seconds["triangles_exact"] / seconds[name], 2)}
        for name, row in results.items()
        if "estimate" in row and exact
    }
    events = workloads.table(spark, SF_DIR, "events").count()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "triangles": exact,
                "approximations": approximations,
                "stream_sketch_rows_per_sec": round(events / seconds["stream_sketch"]),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
