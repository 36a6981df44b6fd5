"""The operators set to work on the driver's tables, one function per query.

Every function takes ``(spark, sf_dir)``.  Graphs and streams are views of ``lineitem``, ``orders`` and
``events``, always whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from countloom.functions.hashing import Colouring, EdgePartitioning
from countloom.operators import frequency as fq
from countloom.operators import graph as gr
from countloom.operators import sketch as sk
from countloom.operators import triangles as tr
from countloom.plans import graph_report, stream_report
from countloom.sources.edges import edges_from_lines, edges_from_table, read_edges, rejected_lines
from countloom.sources.items import FileItems, items_from_lines, items_from_table, stream_items
from countloom.streaming.ledger import BatchLedger
from countloom.streaming.sketch import SketchTable, start_sketch
from countloom.workspace import shared_folder

COLOURS = 4
RUNS = 5
PARTITIONS = 4
SEED = 2024
DEPTH = 5
WIDTH = 64
TOP_K = 10
DEEP_K = 1500
USER_RANGE = (10, 100)
VALUE_RANGE = (0, 300)
SUPPLIER_RANGE = (0, 99)
# Pieces so small that the vertices of the given tables are split.
SMALL_PIECES = 64
BATCH_EVENTS = 100
SLICES = 10
FILES_PER_BATCH = 3
# The share of the stream, in thousandths, at which the bounded prefix ends.
PREFIX_SHARE = 455

COLOURING = Colouring.seeded(COLOURS, SEED)
LINEAR = Colouring.seeded(COLOURS, SEED, family="linear8191")
RUN_COLOURINGS = graph_report.run_colourings(COLOURS, RUNS, SEED)
EDGE_PARTS = EdgePartitioning.seeded(PARTITIONS, SEED)
SKETCH = sk.CountSketch.seeded(DEPTH, WIDTH, SEED)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- graphs ---------------------------------------------------------------------------------------


def part_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts and suppliers as vertices of one id space, an edge per line item."""
    return edges_from_table(table(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey")


def order_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and customers likewise: hardly a triangle."""
    return edges_from_table(table(spark, sf_dir, "orders"), "o_orderkey", "o_custkey")


def edge_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One edge per line."""
    return table(spark, sf_dir, "lineitem").selectExpr("concat_ws(',', l_partkey, l_suppkey) AS value")


def tour_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths that pass their first vertex again, with equal neighbours here and there."""
    path = "concat_ws(',', l_partkey, l_suppkey, l_linenumber, l_partkey, l_orderkey)"
    return table(spark, sf_dir, "lineitem").selectExpr(f"{path} AS value")


def edges_of_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tours as a folder of text files, read back."""
    folder = f"{shared_folder(spark, 'edge-text')}/lines"
    tour_lines(spark, sf_dir).write.text(folder)
    return read_edges(spark, folder)


def mixed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of which some carry a word, and some trailing commas."""
    path = "concat_ws(',', event_id, CASE WHEN event_type = 'error' THEN event_type ELSE CAST(user_id AS STRING) END)"
    tail = "CASE WHEN event_type = 'view' THEN ',,' ELSE '' END"
    return table(spark, sf_dir, "events").selectExpr(f"concat({path}, {tail}) AS value")


def simple_part_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gr.simplify(part_supplier(spark, sf_dir))


# -- streams --------------------------------------------------------------------------------------


def user_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items_from_table(table(spark, sf_dir, "events"), "user_id", f"event_id div {BATCH_EVENTS} AS batch_id")


def value_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items_from_table(table(spark, sf_dir, "events"), "floor(value)", f"event_id div {BATCH_EVENTS} AS batch_id")


def supplier_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items_from_table(table(spark, sf_dir, "lineitem"), "l_suppkey")


def value_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fq.item_freq(fq.in_range(value_items(spark, sf_dir), *VALUE_RANGE))


def value_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SKETCH.counters(fq.in_range(value_items(spark, sf_dir), *VALUE_RANGE))


def value_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fq.stream_prefix(value_items(spark, sf_dir), share=PREFIX_SHARE)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Ratios to nine places, so that engines which add doubles in different orders agree."""
    return df.withColumns({c: F.round(c, 9) for c in columns})


def sketch_of_merged_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = (value_items(spark, sf_dir), VALUE_RANGE), (supplier_items(spark, sf_dir), SUPPLIER_RANGE)
    return sk.merge(*(SKETCH.counters(fq.in_range(items, *limits)) for items, limits in parts))


ARRIVED = "slice INT, at BIGINT, value DOUBLE"
VALUE_TEXT = "CAST(floor(value) AS BIGINT)"


def staged_slices(spark: SparkSession, sf_dir: str, folder: str) -> int:
    """The events in ``SLICES`` slices of equal size by order of ``event_id``, written as folders
    ``slice=0 ..`` under ``folder``; returns the number of events.

    Numbered by the order of the ids, not by their values: sorted by range into tasks, then by the place
    in the task behind the number of rows of the tasks before.
    """
    events = table(spark, sf_dir, "events").select("event_id", "value")
    ordered = events.orderBy(F.asc_nulls_first("event_id"), F.asc_nulls_first("value"))
    ordered.select("value", F.monotonically_increasing_id().alias("at")).write.parquet(f"{folder}/ordered")
    placed = spark.read.schema("value DOUBLE, at BIGINT").parquet(f"{folder}/ordered").withColumn("task", F.expr("at >> 33"))
    sizes = placed.groupBy("task").agg(F.count(F.lit(1)).alias("n"))
    # One row per task.
    before = sizes.select("task", "n", F.coalesce(F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    n = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    numbered = placed.join(before.drop("n"), "task").selectExpr("value", "before + (at & 8589934591L) AS at")
    sliced = numbered.selectExpr("value", "at", f"CAST(at * {SLICES} div {max(n, 1)} AS INT) AS slice")
    sliced.repartition("slice").write.partitionBy("slice").parquet(f"{folder}/slices")
    return n


def stream_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events arrive as files, several micro-batches' worth, at the default trigger, until none is left."""
    folder = shared_folder(spark, "stream-sketch")
    staged_slices(spark, sf_dir, folder)
    items = stream_items(spark, FileItems(f"{folder}/slices", "parquet", ARRIVED, VALUE_TEXT, FILES_PER_BATCH))
    counters = SketchTable(spark, f"{folder}/counters")
    query = start_sketch(items, SKETCH, *VALUE_RANGE, counters, f"{folder}/checkpoint")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return counters.read()


def run_ledger(spark: SparkSession, sf_dir: str) -> BatchLedger:
    """The events arrive in slices, in order, each as one batch, until the ledger has enough."""
    folder = shared_folder(spark, "stream-until")
    n = staged_slices(spark, sf_dir, folder)
    ledger = BatchLedger(spark, f"{folder}/checkpoint", *VALUE_RANGE, threshold=max(1, n * PREFIX_SHARE // 1000))
    slices = spark.read.schema(ARRIVED).parquet(f"{folder}/slices")
    for i in range(SLICES):
        # Only the slice's own folder is read.
        slices.where(F.col("slice") == i).selectExpr("0 AS slice", "at", "value").write.mode("append").parquet(f"{folder}/arrived")
        ledger.run(stream_items(spark, FileItems(f"{folder}/arrived", "parquet", ARRIVED, VALUE_TEXT)), availableNow=True)
        if ledger.reached:
            break
    return ledger


def stream_until_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = run_ledger(spark, sf_dir)
    return rounded(
        stream_report.report(ledger.freq(), ledger.length(), SKETCH, *VALUE_RANGE, TOP_K), "avg_error", "f2", "f2_estimate"
    )


Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    # sources
    "edges_from_lines": lambda s, d: edges_from_lines(tour_lines(s, d)),
    "read_edges": edges_of_text,
    "edges_from_lines_all": lambda s, d: edges_from_lines(tour_lines(s, d), mode="all"),
    "edges_from_lines_lenient": lambda s, d: edges_from_lines(mixed_lines(s, d), strict=False),
    "rejected_lines": lambda s, d: rejected_lines(mixed_lines(s, d)),
    "items_from_lines": lambda s, d: items_from_lines(
        table(s, d, "events").selectExpr("CAST(user_id AS STRING) AS value")
    ),
    # graph
    "edge_count": lambda s, d: gr.edge_count(edges_from_lines(edge_lines(s, d))),
    "graph_simplify": simple_part_supplier,
    "vertex_degrees": lambda s, d: gr.vertex_degrees(simple_part_supplier(s, d)),
    "colour_balance": lambda s, d: gr.colour_balance(simple_part_supplier(s, d), COLOURING),
    "colour_balance_linear8191": lambda s, d: gr.colour_balance(simple_part_supplier(s, d), LINEAR),
    "mono_edges": lambda s, d: gr.mono_edges(edges_from_lines(edge_lines(s, d)), COLOURING),
    "colour_triple_load": lambda s, d: gr.colour_triple_load(simple_part_supplier(s, d), COLOURING),
    "triangles_exact": lambda s, d: tr.triangles_exact(part_supplier(s, d)),
    "triangles_exact_pieces": lambda s, d: tr.triangles_exact(part_supplier(s, d), SMALL_PIECES),
    "triangles_exact_sparse": lambda s, d: tr.triangles_exact(order_customer(s, d)),
    "triangles_colour_triple": lambda s, d: tr.triangles_colour_triple(part_supplier(s, d), COLOURING),
    "triangles_per_triple": lambda s, d: tr.triangles_per_triple(part_supplier(s, d), COLOURING),
    "triangles_per_colour": lambda s, d: tr.triangles_per_colour(part_supplier(s, d), COLOURING),
    "triangles_node_colour": lambda s, d: tr.triangles_node_colour(part_supplier(s, d), COLOURING),
    "triangles_node_colour_linear8191": lambda s, d: tr.triangles_node_colour(part_supplier(s, d), LINEAR),
    "triangles_edge_partition": lambda s, d: tr.triangles_edge_partition(part_supplier(s, d), EDGE_PARTS),
    "triangle_runs": lambda s, d: tr.triangle_runs(part_supplier(s, d), RUN_COLOURINGS),
    "triangle_runs_median": lambda s, d: tr.median_of_runs(tr.triangle_runs(part_supplier(s, d), RUN_COLOURINGS)),
    "triangle_report": lambda s, d: graph_report.triangle_report(
        edges_from_lines(edge_lines(s, d)), "part_supplier", COLOURS, RUNS, exact=0, seed=SEED
    ),
    "triangle_report_exact": lambda s, d: graph_report.triangle_report(
        edges_from_lines(edge_lines(s, d)), "part_supplier", COLOURS, RUNS, exact=1, seed=SEED
    ),
    # exact frequencies
    "stream_length": lambda s, d: fq.stream_length(fq.batch_totals(value_items(s, d))),
    "batch_item_counts": lambda s, d: fq.batch_item_counts(value_items(s, d)),
    "stream_prefix": value_prefix,
    "item_freq": value_freq,
    "item_freq_users": lambda s, d: fq.item_freq(fq.in_range(user_items(s, d), *USER_RANGE)),
    "tally": lambda s, d: fq.tally(user_items(s, d), *USER_RANGE),
    "range_totals": lambda s, d: fq.range_totals(value_freq(s, d)),
    "f2_true": lambda s, d: rounded(fq.f2_true(value_freq(s, d)), "f2"),
    "kth_frequency": lambda s, d: fq.kth_frequency(value_freq(s, d), TOP_K),
    "kth_frequency_deep": lambda s, d: fq.kth_frequency(fq.item_freq(user_items(s, d)), DEEP_K),
    "topk_ties": lambda s, d: fq.topk_ties(fq.item_freq(fq.in_range(supplier_items(s, d), *SUPPLIER_RANGE)), TOP_K),
    # sketch
    "bucket_collisions": lambda s, d: SKETCH.collisions(fq.in_range(value_items(s, d), *VALUE_RANGE)),
    "sketch_counters": value_counters,
    "sketch_merge": sketch_of_merged_parts,
    "f2_rows": lambda s, d: SKETCH.f2_rows(value_counters(s, d)),
    "f2_estimate": lambda s, d: rounded(SKETCH.f2_estimate(SKETCH.counters(value_freq(s, d), "n"), value_freq(s, d)), "f2_estimate"),
    "point_estimates": lambda s, d: SKETCH.estimates(value_freq(s, d), SKETCH.counters(value_freq(s, d), "n")),
    "point_estimates_joined": lambda s, d: SKETCH.estimates(value_freq(s, d), SKETCH.counters(value_freq(s, d), "n"), array_cells=0),
    "topk_estimates": lambda s, d: rounded(stream_report.topk_estimates(value_freq(s, d), SKETCH, TOP_K), "error"),
    "topk_avg_error": lambda s, d: rounded(
        sk.average_error(stream_report.topk_estimates(value_freq(s, d), SKETCH, TOP_K)), "avg_error"
    ),
    "stream_report": lambda s, d: rounded(
        stream_report.prefix_report(value_items(s, d), SKETCH, *VALUE_RANGE, TOP_K, share=PREFIX_SHARE), "avg_error", "f2", "f2_estimate"
    ),
    # streaming
    "stream_sketch": stream_sketch,
    "stream_until": lambda s, d: run_ledger(s, d).freq(),
    "stream_until_report": stream_until_report,
}
