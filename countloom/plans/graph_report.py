"""The graph jobs end to end: one row each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from countloom.functions.hashing import Colouring, EdgePartitioning
from countloom.operators.graph import counted, simple_of
from countloom.operators.triangles import (
    median_of_runs,
    triangle_runs,
    triangles_colour_triple,
    triangles_edge_partition,
)


def _check_runs(runs: int) -> None:
    if runs < 1:
        raise ValueError("runs must be at least 1")


def run_colourings(colours: int, runs: int, seed: int, family: str = "poly") -> list[Colouring]:
    """Fresh coefficients for each run."""
    _check_runs(runs)
    return [Colouring.seeded(colours, seed + run, family) for run in range(runs)]


def _report(copies: DataFrame, dataset: str, colours: int, runs: int, **results: Column) -> DataFrame:
    edges = copies.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint"))
    return copies.sparkSession.range(0, 1, 1, 1).select(
        F.lit(dataset).alias("dataset"),
        edges.scalar().alias("edges"),
        F.lit(colours).alias("colours"),
        F.lit(runs).alias("runs"),
        *(value.alias(name) for name, value in results.items()),
    )


def approximate_report(edges: DataFrame, dataset: str, colours: int, runs: int, seed: int = 0) -> DataFrame:
    """``(dataset, edges, colours, runs, node_colour, edge_partition)``: the median of ``runs``
    estimates by node colours, and one estimate by edge partitions.

    All three read the edges from one exchange, which also counts their copies.
    """
    copies = counted(edges)
    simple = simple_of(copies)
    median = median_of_runs(triangle_runs(simple, run_colourings(colours, runs, seed), is_simple=True)).select("median")
    parts = triangles_edge_partition(simple, EdgePartitioning.seeded(colours, seed), is_simple=True).select("estimate")
    return _report(copies, dataset, colours, runs, node_colour=median.scalar(), edge_partition=parts.scalar())


def exact_report(edges: DataFrame, dataset: str, colours: int, runs: int, seed: int = 0) -> DataFrame:
    """``(dataset, edges, colours, runs, triangles)``: the exact count by colour triples.

    All runs give the same number, so it is counted once.
    """
    _check_runs(runs)
    copies = counted(edges)
    exact = triangles_colour_triple(simple_of(copies), Colouring.seeded(colours, seed), is_simple=True)
    return _report(copies, dataset, colours, runs, triangles=exact.scalar())


def triangle_report(
    edges: DataFrame, dataset: str, colours: int, runs: int, exact: int = 0, seed: int = 0
) -> DataFrame:
    """The job by its flag: 0 for the approximate report, 1 for the exact one."""
    if exact not in (0, 1):
        raise ValueError("exact must be 0 or 1")
    if exact:
        return exact_report(edges, dataset, colours, runs, seed)
    return approximate_report(edges, dataset, colours, runs, seed)
