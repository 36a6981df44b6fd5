"""A mergeable Count Sketch as a sparse table ``(row, bucket, c)``; an absent counter is 0."""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from countloom.functions.hashing import SketchRow

# Sketches of up to this many counters travel as one array; larger ones are joined.  Both give the same rows.
ARRAY_CELLS = 1 << 20


@dataclass(frozen=True)
class CountSketch:
    rows: tuple[SketchRow, ...]
    width: int

    @classmethod
    def seeded(cls, depth: int, width: int, seed: int) -> CountSketch:
        """One bucket and one sign function per row, all drawn from ``seed``; equal arguments give
        sketches that can be merged."""
        if depth < 1 or width < 1:
            raise ValueError("depth and width must be at least 1")
        rng = random.Random(seed)
        return cls(tuple(SketchRow.draw(rng, width) for _ in range(depth)), width)

    @property
    def depth(self) -> int:
        return len(self.rows)

    def updates(self, items: DataFrame, weight: str = "1L") -> DataFrame:
        """``(row, bucket, delta)``: what each input row adds to each row of the sketch; a NULL item adds nothing."""
        structs = ", ".join(
            f"named_struct('row', {j}, 'bucket', {r.bucket('item')}, 'delta', {r.sign('item')} * {weight})"
            for j, r in enumerate(self.rows)
        )
        # Tested behind the generator: a filter would move to the scan and set this use of ``items`` apart from others.
        cells = items.selectExpr(f"inline_outer(CASE WHEN item IS NOT NULL THEN array({structs}) END)")
        return cells.where("row IS NOT NULL")

    def counters(self, items: DataFrame, weight: str = "1L") -> DataFrame:
        """``(row, bucket, c)`` of ``items``, or of ``(item, n)`` with ``weight="n"``.

        Each task folds its rows into at most ``depth * width`` counters before the shuffle, so the
        items themselves never move.
        """
        return merge(self.updates(items, weight).withColumnRenamed("delta", "c"))

    def collisions(self, items: DataFrame) -> DataFrame:
        """``(row, bucket, items)``: distinct items per bucket."""
        cells = self.updates(items.select("item").distinct()).select("row", "bucket")
        return cells.groupBy("row", "bucket").agg(F.count(F.lit(1)).alias("items"))

    def f2_rows(self, counters: DataFrame) -> DataFrame:
        """``(row, f2)``: per row the sum of squared counters, 0 for a row without any."""
        zeros = counters.sparkSession.range(0, self.depth, 1, 1).selectExpr("CAST(id AS INT) AS row", "0L AS c")
        c = F.col("c").cast("double")
        return counters.select("row", "c").unionByName(zeros).groupBy("row").agg(F.sum(c * c).alias("f2"))

    def f2_estimate(self, counters: DataFrame, freq: DataFrame) -> DataFrame:
        """One row: the median of the rows over the square of the total; NULL when there is no item."""
        rows = self.f2_rows(counters).agg(F.median("f2").alias("f2"))
        total = freq.agg(F.sum(F.col("n").cast("double"))).scalar()
        return rows.select(F.try_divide("f2", total * total).alias("f2_estimate"))

    def _median(self, sorted_values: str) -> str:
        low, high = (self.depth - 1) // 2, self.depth // 2
        return f"(CAST({sorted_values}[{low}] AS DOUBLE) + {sorted_values}[{high}]) / 2"

    def estimates(self, freq: DataFrame, counters: DataFrame, array_cells: int = ARRAY_CELLS) -> DataFrame:
        """``freq`` with ``estimate``: per row the median over the sketch's rows of the item's signed counter.

        Every row of ``freq`` is kept, equal ones too; a NULL item has a NULL estimate.  The sketch is
        bounded by its own size, not by the data.  Up to ``array_cells`` counters are handed to the tasks as
        one array and looked up by position, without a shuffle of the items; more are joined.
        """
        if self.depth * self.width <= array_cells:
            return self._estimates_by_array(freq, counters)
        return self._estimates_by_join(freq, counters)

    def _estimates_by_array(self, freq: DataFrame, counters: DataFrame) -> DataFrame:
        zeros = counters.sparkSession.range(0, self.depth * self.width, 1, 1).selectExpr("id AS cell", "0L AS c")
        cells = counters.selectExpr(f"row * {self.width}L + bucket AS cell", "c").unionByName(zeros)
        table = (
            cells.groupBy("cell")
            .agg(F.sum("c").alias("c"))
            .agg(F.sort_array(F.collect_list(F.struct("cell", "c"))).alias("entries"))
            .select("entries.c")
            .scalar()
        )
        probes = ", ".join(
            f"sketch[int({j * self.width} + {r.bucket('item')})] * {r.sign('item')}" for j, r in enumerate(self.rows)
        )
        signed = freq.withColumn("sketch", table).selectExpr(*freq.columns, f"array_sort(array({probes})) AS signed")
        return signed.selectExpr(*freq.columns, f"{self._median('signed')} AS estimate")

    def _estimates_by_join(self, freq: DataFrame, counters: DataFrame) -> DataFrame:
        structs = ", ".join(
            f"named_struct('row', {j}, 'bucket', {r.bucket('item')}, 'sign', {r.sign('item')})"
            for j, r in enumerate(self.rows)
        )
        probes = freq.select("item").where("item IS NOT NULL").distinct().selectExpr("item", f"inline(array({structs}))")
        found = probes.join(counters, ["row", "bucket"], "left").selectExpr("item", "sign * coalesce(c, 0L) AS signed")
        gathered = found.groupBy("item").agg(F.sort_array(F.collect_list("signed")).alias("signed"))
        estimates = gathered.selectExpr("item", f"{self._median('signed')} AS estimate")
        return freq.join(estimates, "item", "left").select(*freq.columns, "estimate")


def merge(*counters: DataFrame) -> DataFrame:
    """Counters only ever add up, so sketches of parts add up to the sketch of the whole."""
    union = counters[0]
    for more in counters[1:]:
        union = union.unionByName(more)
    return union.groupBy("row", "bucket").agg(F.sum("c").alias("c"))


def relative_errors(estimated: DataFrame) -> DataFrame:
    """Adds ``error``, the distance of ``estimate`` from ``n`` relative to ``n``."""
    return estimated.withColumn("error", F.abs(F.col("n") - F.col("estimate")) / F.col("n"))


def average_error(with_errors: DataFrame) -> DataFrame:
    """One row: the mean of ``error``; NULL when there is no item."""
    return with_errors.agg(F.avg("error").alias("avg_error"))
