"""Clean-up, degrees, colouring and orientation of edge lists ``(u, v)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from countloom.functions.hashing import Colouring

# At most this many vertices are ever broadcast (see ``degree_pieces``).
HEAVY_VERTICES = 1 << 18
# A vertex with no more edges than this is never split.
PIECE_ROWS = 1 << 20
# Counters of ``orient_by_cells``, and so the rows it broadcasts at most; a power of two.
DEGREE_CELLS = 1 << 20


def edge_count(edges: DataFrame) -> DataFrame:
    """One row: the size of the edge multiset, duplicates included."""
    return edges.agg(F.count(F.lit(1)).alias("edges"))


def canonical(edges: DataFrame) -> DataFrame:
    """The edges as ``u < v``, without loops, copies included."""
    return edges.where("u <> v").selectExpr("least(u, v) AS u", "greatest(u, v) AS v")


def simplify(edges: DataFrame) -> DataFrame:
    """The simple undirected graph: each edge once, as ``u < v``, without loops."""
    return canonical(edges).distinct()


def counted(edges: DataFrame) -> DataFrame:
    """``(u, v, n)``: each edge once, as ``u <= v``, loops included, with the number of its copies."""
    return edges.selectExpr("least(u, v) AS u", "greatest(u, v) AS v").groupBy("u", "v").agg(F.count(F.lit(1)).alias("n"))


def simple_of(counted_edges: DataFrame) -> DataFrame:
    """The simple graph of ``counted`` edges, for several uses of one exchange.

    Written in terms of the count, so that no use's filter on vertices moves below the aggregation and sets
    it apart from the other uses.
    """
    return counted_edges.where("CASE WHEN n > 0 THEN u <> v END").selectExpr(
        "CASE WHEN n > 0 THEN u END AS u", "CASE WHEN n > 0 THEN v END AS v"
    )


def vertex_degrees(simple: DataFrame) -> DataFrame:
    """``(vertex, degree)`` of a simple graph."""
    ends = simple.selectExpr("explode(array(u, v)) AS vertex")
    return ends.groupBy("vertex").agg(F.count(F.lit(1)).alias("degree"))


def degree_pieces(simple: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """``(vertex, degree, parts)``: into how many pieces to split the edges of a vertex.

    A piece holds at most ``cap`` edges, ``cap`` being the larger of ``piece_rows`` and the sum of all
    degrees over ``HEAVY_VERTICES``.  Vertices above the cap, with ``parts > 1``, thus number fewer
    than ``HEAVY_VERTICES`` however large the graph, and that is what makes them safe to broadcast.
    """
    degrees = vertex_degrees(simple).where("vertex IS NOT NULL")
    ends = degrees.agg((F.sum("degree") / HEAVY_VERTICES).cast("bigint") + 1).scalar()
    capped = degrees.withColumn("cap", F.greatest(F.lit(piece_rows).cast("bigint"), ends))
    return capped.selectExpr("vertex", "degree", "ceil(degree / cap) AS parts")


def orient(simple: DataFrame, piece_rows: int = PIECE_ROWS, settled: bool = False) -> DataFrame:
    """Point every edge from its lower to its higher end by ``(degree, id)``.

    Returns ``(lo, hi)``, structs ``(degree, id, parts)``.  No vertex has more than ``sqrt(2 * edges)``
    edges going out, whatever its degree, since their targets all have at least its own degree.

    Both look-ups of a degree join on ``(vertex, piece)``: the edges of a heavy vertex are spread over
    its pieces by their other end, and its degree is repeated once per piece.

    With ``settled``, the plan is the same whatever sizes are met while it runs, so that a scalar subquery over what
    comes of it reads the exchanges of the query itself: look-ups are never broadcast, and what is broadcast to
    them is never empty, for then the join would be left out.
    """
    # Implied by the look-ups for the edges only; said here, it holds for their degrees as well, and the
    # exchange under both is computed once.
    simple = simple.where("u IS NOT NULL AND v IS NOT NULL")
    pieces = degree_pieces(simple, piece_rows)
    spread = pieces.selectExpr(
        "vertex", "explode(sequence(0L, parts - 1)) AS piece", "named_struct('degree', degree, 'id', vertex, 'parts', parts) AS end"
    )
    heavy = pieces.where("parts > 1")
    if settled:
        # A vertex of one piece is located alike whether it is among these or not.
        heavy = pieces.where((F.col("parts") > 1) | (F.col("vertex") == pieces.agg(F.min("vertex")).scalar()))

    def look_up(edges: DataFrame, vertex: str, other: str, name: str) -> DataFrame:
        split = F.broadcast(heavy.selectExpr(f"vertex AS {vertex}", "parts"))
        located = edges.join(split, vertex, "left").withColumn(
            "piece", F.expr(f"coalesce(pmod(xxhash64({other}), parts), 0L)")
        )
        ends = spread.selectExpr(f"vertex AS {vertex}", "piece", f"end AS {name}")
        ends = ends.hint("merge") if settled else ends
        return located.drop("parts").join(ends, [vertex, "piece"]).drop("piece")

    both = look_up(look_up(simple, "u", "v", "a"), "v", "u", "b")
    return both.selectExpr("least(a, b) AS lo", "greatest(a, b) AS hi")


def orient_by_cells(simple: DataFrame, piece_rows: int = PIECE_ROWS, keep: tuple[str, ...] = ()) -> DataFrame:
    """``orient`` without a shuffle of the edges: the order is by hashed degrees.  Columns of ``keep`` ride along.

    Vertices are hashed to ``DEGREE_CELLS`` counters, which add up the degrees in them; those few rows are
    broadcast.  A vertex ranks by its counter and then by its id, which is an order like any other, so each
    triangle has one lowest vertex.  A vertex of degree ``d`` has under ``2 * edges / d`` neighbours that are as
    heavy, and on average ``2 * edges / DEGREE_CELLS`` more that share a cell with such: for up to
    ``DEGREE_CELLS^2 / 2`` edges its list is about as short as by true degrees.
    """
    simple = simple.where("u IS NOT NULL AND v IS NOT NULL")

    def cell(vertex: str) -> str:
        # Never null, so the look-ups imply no filter that would set the uses of the edges apart.
        return f"(xxhash64({vertex}) & {DEGREE_CELLS - 1}L)"

    ends = simple.selectExpr("explode(array(u, v)) AS vertex", *keep).selectExpr(f"{cell('vertex')} AS cell", *keep)
    # Counted by what rides along, so that it is not pruned here and both uses of the edges stay alike.
    counters = ends.groupBy("cell").agg(F.expr(f"count({', '.join(keep) or 1})").alias("degree"))
    cap = f"greatest({piece_rows}L, CAST(sum(degree) OVER () / {HEAVY_VERTICES} AS BIGINT) + 1)"
    told = F.broadcast(counters.selectExpr("cell", "degree", f"ceil(degree / {cap}) AS parts"))

    def look_up(edges: DataFrame, vertex: str, name: str) -> DataFrame:
        located = edges.withColumn("cell", F.expr(cell(vertex))).join(told, "cell")
        return located.withColumn(name, F.expr(f"named_struct('degree', degree, 'id', {vertex}, 'parts', parts)")).drop("cell", "degree", "parts")

    both = look_up(look_up(simple, "u", "a"), "v", "b")
    return both.selectExpr("least(a, b) AS lo", "greatest(a, b) AS hi", *keep)


def mono_edges(edges: DataFrame, colouring: Colouring) -> DataFrame:
    """``(colour, u, v)`` of the edges whose ends share a colour; a filter, so it runs in the scan."""
    return edges.where(f"{colouring.spark('u')} = {colouring.spark('v')}").selectExpr(
        f"{colouring.spark('u')} AS colour", "u", "v"
    )


def colour_balance(simple: DataFrame, colouring: Colouring) -> DataFrame:
    """``(colour, vertices, edges)``: vertices of each colour, and edges within it; every colour has a row.

    One pass over the edges: each is handed to both its ends, and counts as within at the lower one.
    """
    within = f"{colouring.spark('u')} = {colouring.spark('v')}"
    ends = simple.selectExpr(f"inline(array(struct(u AS vertex, CAST({within} AS BIGINT) AS edge), struct(v AS vertex, 0L AS edge)))")
    vertices = ends.groupBy("vertex").agg(F.sum("edge").alias("edge"))
    coloured = vertices.selectExpr(f"{colouring.spark('vertex')} AS colour", "1L AS vertex", "edge")
    zeros = simple.sparkSession.range(0, colouring.colours, 1, 1).selectExpr("id AS colour", "0L AS vertex", "0L AS edge")
    return coloured.unionByName(zeros).groupBy("colour").agg(F.sum("vertex").alias("vertices"), F.sum("edge").alias("edges"))


def triple_key(colouring: Colouring, u: str, v: str, third: str) -> str:
    """The three colours in order, packed into one BIGINT."""
    c = colouring.colours
    parts = [f"least({u}, {v}, {third})", f"({u} + {v} + {third} - least({u}, {v}, {third}) - greatest({u}, {v}, {third}))",
             f"greatest({u}, {v}, {third})"]
    return f"(({parts[0]} * {c} + {parts[1]}) * {c} + {parts[2]})"


def colour_triple_load(simple: DataFrame, colouring: Colouring) -> DataFrame:
    """``(k1, k2, k3, edges)``: how many edges each colour triple would receive.

    Counts per pair of colours first, so only those few counts are replicated.
    """
    c = colouring.colours
    a, b = colouring.spark("u"), colouring.spark("v")
    pairs = simple.selectExpr(f"least({a}, {b}) AS a", f"greatest({a}, {b}) AS b").groupBy("a", "b").count()
    triples = pairs.selectExpr("a", "b", "count", f"explode(sequence(0L, {c - 1}L)) AS c")
    keyed = triples.selectExpr("array_sort(array(a, b, c)) AS k", "count")
    return (
        keyed.selectExpr("k[0] AS k1", "k[1] AS k2", "k[2] AS k3", "count")
        .groupBy("k1", "k2", "k3")
        .agg(F.sum("count").alias("edges"))
    )
