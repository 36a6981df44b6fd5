"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from countloom.llm.common import materialise


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links (a, b)``; ``root`` is the least node it is connected with.

    Alternating stars: every node first hands its larger neighbours, then its smaller ones, to the least
    node it knows, until nothing changes; after a number of rounds logarithmic in practice, each component
    is a star around its least node.  A round is two aggregations and two joins, never a gathered
    neighbourhood, and each is written out, so lost executors cost at most a round.
    """

    def undirected(df: DataFrame) -> DataFrame:
        return df.selectExpr("a", "b").unionByName(df.selectExpr("b AS a", "a AS b"))

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first())

    # ``a`` is always the larger end.
    edges = links.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct()
    edges = materialise(edges, "links")
    before = None
    while (now := state(edges)) != before and now[0]:
        before = now
        both = undirected(edges)
        least = materialise(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "large-least")
        large = both.where("b > a").join(least, "a").selectExpr("b AS a", "m AS b").where("a <> b").distinct()
        large = materialise(large, "large-star")
        least = materialise(large.groupBy("a").agg(F.min("b").alias("m")), "small-least")
        small = large.join(least, "a").where("b <> m").selectExpr("b AS a", "m AS b").unionByName(least.selectExpr("a", "m AS b"))
        edges = materialise(small.where("a <> b").distinct(), "small-star")
    return edges.selectExpr("a AS node", "b AS root").unionByName(edges.selectExpr("b AS node", "b AS root").distinct())
