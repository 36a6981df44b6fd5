"""The stream job end to end: one row, and the top items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from countloom.operators.frequency import DEFAULT_THRESHOLD, batch_tallies, kth_frequency, prefix_tally, stream_length, tally, topk_ties
from countloom.operators.sketch import CountSketch, average_error, relative_errors


def topk_estimates(freq: DataFrame, sketch: CountSketch, k: int) -> DataFrame:
    """``(item, n, estimate, error)`` of the top K with ties.

    Only those items are looked up in the sketch, which is built from the frequencies: weighted by
    them, each item is hashed once rather than once per occurrence.
    """
    return relative_errors(sketch.estimates(topk_ties(freq, k), sketch.counters(freq, "n")))


def report(freq: DataFrame, length: DataFrame, sketch: CountSketch, left: int, right: int, k: int) -> DataFrame:
    """``(depth, width, left, right, k, length, total, distinct, f_k, avg_error, f2, f2_estimate)``.

    ``freq`` holds the items of the range and ``length``, one row, the size of the whole stream.  Each
    subquery reads both ``item`` and ``n``, so that all of them share the shuffle under ``freq``.
    """
    n = F.col("n").cast("double")
    moments = freq.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total"),
        F.count(F.lit(1)).alias("distinct"),
        F.sum(n * n).alias("square_sum"),
        (F.sum(n) * F.sum(n)).alias("scale"),
    )
    sketched = sketch.f2_rows(sketch.counters(freq, "n")).agg(F.median("f2"))
    figures = freq.sparkSession.range(0, 1, 1, 1).select(
        length.scalar().alias("length"),
        moments.select(F.struct("*")).scalar().alias("m"),
        kth_frequency(freq, k).scalar().alias("f_k"),
        average_error(topk_estimates(freq, sketch, k)).scalar().alias("avg_error"),
        sketched.scalar().alias("sketched"),
    )
    return figures.selectExpr(
        f"{sketch.depth} AS depth",
        f"{sketch.width} AS width",
        f"{left}L AS left",
        f"{right}L AS right",
        f"{k} AS k",
        "length",
        "m.total",
        "m.distinct",
        "f_k",
        "avg_error",
        "try_divide(m.square_sum, m.scale) AS f2",
        "try_divide(sketched, m.scale) AS f2_estimate",
    )


def _report_of_tally(counts: DataFrame, sketch: CountSketch, left: int, right: int, k: int) -> DataFrame:
    # In terms of the count, so that the test stays above the exchange, which is then the same for both.
    freq = counts.where("CASE WHEN n > 0 THEN item IS NOT NULL END")
    return report(freq, stream_length(counts), sketch, left, right, k)


def stream_report(items: DataFrame, sketch: CountSketch, left: int, right: int, k: int) -> DataFrame:
    """``report`` of items at rest: length and frequencies from one tally, and so one pass."""
    return _report_of_tally(tally(items, left, right), sketch, left, right, k)


def prefix_report(
    items: DataFrame, sketch: CountSketch, left: int, right: int, k: int, threshold: int | Column = DEFAULT_THRESHOLD,
    share: int | None = None,
) -> DataFrame:
    """``report`` of the bounded prefix of ``(item, batch_id)``, also in one pass over the items."""
    counts = prefix_tally(batch_tallies(items, left, right), threshold, share)
    return _report_of_tally(counts, sketch, left, right, k)
