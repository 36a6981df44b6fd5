"""Exact frequencies of items, their moments and their top.

``items`` is ``(item BIGINT)``, with ``batch_id`` where batches matter; ``freq`` is ``(item, n)``.  All
counting goes through partial aggregation, so a very frequent item reaches the shuffle as one row per
task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Batches whose running totals are built side by side.
BATCH_BLOCK = 4096
# Fixed value: the stream length at which counting stops unless the caller says otherwise.
DEFAULT_THRESHOLD = 10_000_000


def in_range(items: DataFrame, left: int, right: int) -> DataFrame:
    return items.where(F.col("item").between(left, right))


def item_freq(items: DataFrame) -> DataFrame:
    """``(item, n)``."""
    return items.groupBy("item").agg(F.count(F.lit(1)).alias("n"))


def batch_item_counts(items: DataFrame) -> DataFrame:
    """``(batch_id, item, n)``."""
    return items.groupBy("batch_id", "item").agg(F.count(F.lit(1)).alias("n"))


def tally(items: DataFrame, left: int, right: int) -> DataFrame:
    """``(item, n)`` with all items outside the range as one row of item NULL.

    Gives the length of the stream and the frequencies in the range from a single pass.
    """
    return items.selectExpr(f"CASE WHEN item BETWEEN {left} AND {right} THEN item END AS item").groupBy("item").agg(
        F.count(F.lit(1)).alias("n")
    )


def stream_length(counts: DataFrame) -> DataFrame:
    """One row: all occurrences in ``counts``, a table with a column ``n``, such as ``batch_totals``."""
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("length"))


def range_totals(freq: DataFrame) -> DataFrame:
    """One row: ``(total, distinct)``."""
    return freq.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total"), F.count(F.lit(1)).alias("distinct")
    )


def f2_true(freq: DataFrame) -> DataFrame:
    """One row: the second moment over the square of the total; NULL when there is no item.

    In doubles: squares of counts leave BIGINT at a few billion occurrences.
    """
    n = F.col("n").cast("double")
    return freq.agg(F.try_divide(F.sum(n * n), F.sum(n) * F.sum(n)).alias("f2"))


def kth_frequency(freq: DataFrame, k: int) -> DataFrame:
    """One row ``f_k``: the K-th largest frequency, or the least one when there are fewer items.

    Read off the frequencies of frequencies: ``N`` occurrences have under ``sqrt(2 * N)`` different ones,
    so the window stays small whatever K is.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    levels = freq.groupBy("n").agg(F.count(F.lit(1)).alias("items"))
    above = F.sum("items").over(Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1))
    return levels.select("n", F.coalesce(above, F.lit(0)).alias("above")).where(f"above < {k}").agg(F.min("n").alias("f_k"))


def topk_ties(freq: DataFrame, k: int) -> DataFrame:
    """``(item, n)`` of every item at least as frequent as the K-th; ties may make it more than K."""
    return freq.where(F.col("n") >= kth_frequency(freq, k).scalar())


# Items without a batch come before all others.
_BATCH = "coalesce(batch_id, -9223372036854775808L)"


def batch_totals(items: DataFrame) -> DataFrame:
    """``(batch, n)``, items without a batch under the least number."""
    return items.selectExpr(f"{_BATCH} AS batch").groupBy("batch").agg(F.count(F.lit(1)).alias("n"))


def _last_batch(totals: DataFrame, threshold: Column) -> DataFrame:
    """One row: the last batch that begins before ``threshold`` items have been seen.

    The running total is built at two levels, blocks of batches and batches of a block, so that no
    task sorts all batches.
    """

    def preceding(column: str, window: Window) -> Column:
        return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    blocks = totals.groupBy("block").agg(F.sum("n").alias("n"))
    begun = blocks.select("block", preceding("n", Window.orderBy("block")).alias("before")).where(
        F.col("before") < threshold
    )
    within = totals.join(begun, "block").select(
        "batch",
        (F.col("before") + preceding("n", Window.partitionBy("block").orderBy("batch"))).alias("before"),
    )
    return within.where(F.col("before") < threshold).agg(F.max("batch").alias("batch"))


def batch_tallies(items: DataFrame, left: int, right: int) -> DataFrame:
    """``(batch, item, n)``: ``tally`` per batch, items without a batch under the least number."""
    ranged = items.selectExpr(f"{_BATCH} AS batch", f"CASE WHEN item BETWEEN {left} AND {right} THEN item END AS item")
    return ranged.groupBy("batch", "item").agg(F.count(F.lit(1)).alias("n"))


def _limit(totals: DataFrame, threshold: int | Column, share: int | None) -> Column:
    """``threshold``, or that many thousandths of all items."""
    if share is not None:
        return totals.agg(F.expr(f"coalesce(sum(n), 0L) * {share} div 1000")).scalar()
    return threshold if isinstance(threshold, Column) else F.lit(threshold)


def prefix_tally(tallies: DataFrame, threshold: int | Column = DEFAULT_THRESHOLD, share: int | None = None) -> DataFrame:
    """``(item, n)`` over the batches of ``stream_prefix``, from ``batch_tallies``.

    The items are read once: batch totals and the cut both come from the one exchange under the tallies, which
    holds a row per batch and item.
    """
    # Both uses are written in terms of the counts, so that no test moves below that exchange and sets one apart.
    totals = tallies.groupBy("batch").agg(F.sum("n").alias("n")).withColumn("block", F.expr(f"CASE WHEN n > 0 THEN batch div {BATCH_BLOCK} END"))
    last = _last_batch(totals, _limit(totals, threshold, share)).scalar()
    kept = tallies.where(F.when(F.col("n") > 0, F.col("batch") <= last))
    return kept.groupBy("item").agg(F.sum("n").alias("n"))


def stream_prefix(items: DataFrame, threshold: int | Column = DEFAULT_THRESHOLD, share: int | None = None) -> DataFrame:
    """The items of whole batches, in order of ``batch_id``, taken while the count before them is below
    ``threshold``; the total may exceed it by up to one batch.

    Items without a batch are the first batch.  Batches that qualify come before all others, so the cut is
    one comparison on ``batch_id``.  ``threshold`` may be a one-row subquery (``DataFrame.scalar``); with
    ``share`` it is that many thousandths of all items, taken from the same batch totals.  Where only
    frequencies are wanted, ``prefix_tally`` reads the items once instead of twice.
    """
    # The test is one that the join on blocks implies; said here, it holds for every use of the totals, and the
    # exchange under them is computed once.
    totals = batch_totals(items).withColumn("block", F.expr(f"batch div {BATCH_BLOCK}")).where("block IS NOT NULL")
    return items.where(F.expr(_BATCH) <= _last_batch(totals, _limit(totals, threshold, share)).scalar())
