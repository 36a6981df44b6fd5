"""Exact and approximate triangle counts.

Every count goes through ``closed``.  For an edge ``lo -> mid`` of the oriented graph, the triangles
that have ``lo`` as lowest and ``mid`` as middle vertex are the neighbours above ``mid`` that both
have in common.  So each vertex sends to each of its neighbours the part of its sorted neighbour list
that follows it, and the two lists meet in one join and are intersected there.  A wedge is eight
bytes of such a list and never a row, and one exchange carries them all.  A list takes part as the receiver
only where some edge comes in.  Sent by colour triple, lists are short and many, and hold distances from ``mid``; and
ids that a bitmap of all edges (``edge_bits``) tells to be no neighbours of ``mid`` are left out of them.

No row holds more than a chunk of a list.  A list is ranked by a window, which spills, and gathered in chunks
of ``CHUNK`` ids.  A chunk sends its later ids to its earlier ones; two chunks of one list meet by their
numbers, and the later one is sent to all ids of the earlier.  A chunk that arrives is intersected with those
chunks of the receiver whose range of ranks it overlaps, so two long lists meet like two sorted runs.

Skew: a list holds at most ``sqrt(2 * edges)`` ids (see ``orient``), and is sent as ``n * n / 2`` ids by as many
tasks as it has pairs of chunks.  Lists sent to a heavy vertex are spread over its pieces, its own short list
being repeated for each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from countloom.functions.hashing import Colouring, EdgePartitioning, indexed_hash
from countloom.operators.graph import PIECE_ROWS, canonical, mono_edges, orient, orient_by_cells, simplify, triple_key

# Ids in a chunk of a list.
CHUNK = 4096
# Runs that share a mask, one bit each.
MASK_RUNS = 64
# Of ``edge_bits``: bits for each edge, bits and words of a page (as ``bitmap_construct_agg`` has them), and pages at most, which
# are 32 MB.
EDGE_BITS = 32
PAGE_BITS = 1 << 15
PAGE_WORDS = PAGE_BITS // 64
MOST_PAGES = 1 << 13
NO_IDS = "CAST(array() AS ARRAY<BIGINT>)"


def closed(
    oriented: DataFrame, group: str | None = None, owner: Colouring | None = None, masked: bool = False, chunk: int | None = None
) -> DataFrame:
    """``([group,] triangles)`` per edge and pair of chunks: triangles whose three edges lie in one group.

    ``oriented`` has ``lo`` and ``hi`` as ``orient`` gives them, and the ``group`` column if named.
    With ``owner``, the groups are colour triples, packed into ``group``: each edge goes to every triple with
    its two colours, and the last vertex must have the colour that the other two leave of the triple for
    the triangle to belong to it; only ids of that colour are sent.  With ``masked``, ``oriented`` has ``block`` and
    ``mask`` instead of the group, and an edge belongs to the group ``block * MASK_RUNS + i`` for each bit ``i`` of its mask.
    """
    keys = [group] if group else []
    sent, own = meetings(oriented, group, owner, masked, chunk, closing=bool(owner))
    own = own.where("met")
    apart = "struct(span[2], span[3]) < struct(own_span[0], own_span[1]) OR struct(own_span[2], own_span[3]) < struct(span[0], span[1])"
    # The second argument is the one that gets hashed; on average it is the shorter.
    common = "size(array_intersect(ids, candidates))"
    if owner:
        sent, own = _by_distance(sent, "candidates", keys, "span"), _by_distance(own, "ids", keys, "own_span")
        common = " + ".join(f"coalesce(array_size(array_intersect(ids_{kind}, candidates_{kind})), 0)" for kind in ("near", "far", "whole"))
    # Either way it is ``sent`` that is streamed and ``own`` that is kept per key.  With ``owner`` lists come first, so that the
    # exchange over them is planned before the bitmap that is made of them; who is sent to without a list closes none.
    joined = own.join(sent, [*keys, "mid", "piece"], "right") if owner else sent.join(own, [*keys, "mid", "piece"])
    joined = joined.where(f"span IS NULL OR own_span IS NULL OR NOT ({apart})")
    return joined.selectExpr(*keys, f"CAST({common} AS BIGINT) AS triangles")


def _by_distance(lists: DataFrame, ids: str, keys: list[str], span: str) -> DataFrame:
    """Rows of ``meetings`` with the array ``ids`` in up to three: ``ids_near`` and ``ids_far`` hold distances from ``mid`` that
    fit 16 and 32 bits, ``ids_whole`` the ids that are further away.  An id is kept alike on both sides of a meeting,
    so arrays of one kind meet as they are.  An empty one is null."""
    away = lists.selectExpr("*", f"transform({ids}, x -> try_subtract(x, mid)) AS away")
    near = away.selectExpr("*", "filter(away, x -> x BETWEEN -32768 AND 32767) AS near")
    split = near.selectExpr(
        "*",
        "CASE WHEN size(near) < size(away) THEN filter(away, x -> x NOT BETWEEN -32768 AND 32767 AND x BETWEEN -2147483648 AND 2147483647) END AS far",
        f"CASE WHEN size(near) < size(away) THEN filter({ids}, (x, i) -> coalesce(away[i] NOT BETWEEN -2147483648 AND 2147483647, true)) END AS whole",
    )
    # What is the same in most rows stands together, where it takes next to nothing once compressed.
    return split.selectExpr(
        "piece", span, f"CASE WHEN size(whole) > 0 THEN whole END AS {ids}_whole", f"CASE WHEN size(far) > 0 THEN CAST(far AS ARRAY<INT>) END AS {ids}_far",
        *keys, "mid", f"CASE WHEN size(near) > 0 THEN CAST(near AS ARRAY<SMALLINT>) END AS {ids}_near",
    )


def edge_bits(lists: DataFrame) -> tuple[Column, Column]:
    """``words`` and ``pages``, a bitmap of hashed edges and its size: edges of all ``lists`` that something is sent to.

    It has ``EDGE_BITS`` for each such edge, so about one pair in 32 that is no edge finds its bit set; above ``MOST_PAGES``
    pages it grows no more, and holds back fewer.  Every column of ``lists`` is read, and no row filtered (see ``meetings``).
    """
    edges = lists.selectExpr(
        "lo", "posexplode_outer(CASE WHEN lo_parts > 0 AND chunk < chunks THEN slice(packed, 1, n) END) AS (at, w)"
    ).selectExpr("CASE WHEN at >= 0 THEN xxhash64(lo) ^ xxhash64(w) END AS h")
    needed = f"{EDGE_BITS} * count_if(h <> 0) div {PAGE_BITS} + 1"
    pages = edges.selectExpr(f"least({MOST_PAGES}L, shiftleft(1L, CAST(ceil(log2({needed})) AS INT))) AS pages").scalar()
    bits = edges.select("h", pages.alias("pages")).selectExpr(f"shiftright(h & ({PAGE_BITS} * pages - 1), 15) AS page", f"h & {PAGE_BITS - 1} AS bit")
    # Pages without an edge have a row of zeros, so that a page is found by its position.
    every = lists.sparkSession.range(0, MOST_PAGES, 1, 1).where(F.col("id") < pages).selectExpr("id AS page", "CAST(NULL AS BIGINT) AS bit")
    maps = bits.where("page IS NOT NULL").unionByName(every).groupBy("page").agg(F.bitmap_construct_agg("bit").alias("map"))
    words = f"transform(sequence(0, {PAGE_WORDS - 1}), i -> CAST(conv(hex(substring(map, 8 * i + 1, 8)), 16, -10) AS BIGINT))"
    paged = maps.selectExpr("page", f"{words} AS words").groupBy().agg(F.sort_array(F.collect_list(F.struct("page", "words"))).alias("all"))
    return paged.selectExpr("flatten(all.words) AS words").scalar(), pages


def _has_bit(words: str, last: str, h: str) -> str:
    """Whether ``edge_bits`` with the ``last`` bit has that of the hash ``h``; a word has the low bits of its first byte highest.
    ``words`` is named once, or else the optimizer keeps a copy of the bitmap in every row."""
    return f"getbit({words}[CAST(shiftright({h} & {last}, 6) AS INT)], CAST(({h} & 63) ^ 56 AS INT)) = 1"


def meetings(
    oriented: DataFrame, group: str | None = None, owner: Colouring | None = None, masked: bool = False, chunk: int | None = None, closing: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The two sides of the join in ``closed``: what is sent to a vertex, ``([group,] mid, piece, candidates, span)``, and
    its own list, ``([group,] mid, piece, ids, own_span, met)``, ``met`` being false where nothing is sent to it.
    With ``closing``, which goes with ``owner``, ids that ``edge_bits`` tells to be no neighbours of ``mid`` are not sent."""
    keys = [group] if group else []
    own_keys, also = (["block"], ["mask"]) if masked else ([] if owner else keys, [])
    step = chunk or CHUNK
    rows = oriented.selectExpr(*own_keys, "lo.id AS lo", "lo.parts AS lo_parts", "lo.degree AS degree", "hi", *also).where(
        " AND ".join(f"{key} IS NOT NULL" for key in (*own_keys, "lo", "lo_parts"))
    )
    ranks = Window.partitionBy(*own_keys, "lo").orderBy("hi")
    whole = ranks.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = rows.select(
        "*",
        ((F.row_number().over(ranks) - 1) / step).cast("int").alias("chunk"),
        F.ceil(F.count(F.lit(1)).over(whole) / step).cast("int").alias("chunks"),
        (F.count(F.lit(1)).over(whole) < F.col("degree")).alias("met"),
    )
    # A vertex all of whose edges go out is sent nothing: its parts are kept as a negative number.
    ranked = ranked.withColumn("lo_parts", F.expr("CASE WHEN met THEN lo_parts ELSE -lo_parts END"))
    gathered = ranked.groupBy(*own_keys, "lo", "lo_parts", "chunk", "chunks").agg(
        F.sort_array(F.collect_list(F.struct("hi", *also))).alias("above")
    )
    if masked:
        gathered = _per_run_lists(gathered, group)
    # Lists are replicated to triples behind the exchange over them, so it carries each edge once.
    list_keys = [] if owner else keys
    # The lists are used three times, and gathering, sorting and the exchange over them are done once as long as
    # all uses are alike to the optimizer: each reads every column, all that a list carries is one array, and
    # rows are left out behind a generator, since a filter would move below the exchange.
    lists = gathered.selectExpr(
        *list_keys, "lo", "lo_parts", "chunk", "chunks", "size(above) AS n",
        # Ids; of a list of several chunks, its first and its last rank; pieces, where any vertex has several.
        f"""concat(above.hi.id,
            CASE WHEN chunks > 1 THEN array(above[0].hi.degree, above[0].hi.id, above[size(above) - 1].hi.degree, above[size(above) - 1].hi.id)
                ELSE {NO_IDS} END,
            CASE WHEN array_max(above.hi.parts) > 1 THEN above.hi.parts ELSE {NO_IDS} END) AS packed""",
    ).repartition(*list_keys, "lo", "chunk")

    by_colour = ["by_colour"] if owner else []
    words, pages = edge_bits(lists) if closing else (None, None)

    def sends(df: DataFrame, ids: str, span: str, follows: str) -> DataFrame:
        """To each ``(at, mid)`` of a chunk ``(n, packed)``, ``ids`` of the chunk of ``span``; with ``owner``, to each
        triple of ``mid`` the ids of its last colour, out of those ``by_colour`` that meet ``follows``."""
        located = df.selectExpr(
            *list_keys, "mid",
            "pmod(xxhash64(lo), coalesce(try_element_at(packed, n + at + IF(chunks > 1, 5, 1)), 1L + 0L * lo_parts)) AS piece",
            f"CASE WHEN chunks > 1 THEN {span} END AS span",
            *(["at", "mid_hash", *by_colour, f"{owner.spark('lo')} AS a", f"{owner.spark('mid')} AS m"] if owner else [f"{ids} AS candidates"]),
        )
        if not owner:
            return located
        if closing:
            # The optimizer puts the bitmap into the expression that uses it, so it is part of no row.
            located = located.select("*", (pages * PAGE_BITS - 1).alias("last"), words.alias("known"))
            follows = f"{follows} AND {_has_bit('known', 'last', '(mid_hash ^ w.hash)')}"
        dealt = f"filter(transform(by_colour, (ids, y) -> struct(y, filter(ids, w -> {follows}).id AS candidates)), sent -> size(sent.candidates) > 0)"
        # The plain ``inline`` would imply a filter, for which all is dealt a second time.
        rows = located.selectExpr("mid", "piece", "span", "a", "m", f"{dealt} AS dealt").selectExpr("mid", "piece", "span", "a", "m", "inline_outer(dealt)")
        return rows.where("y IS NOT NULL").selectExpr("mid", "piece", "span", f"{triple_key(owner, 'a', 'm', 'y')} AS {group}", "candidates")

    def parted(df: DataFrame, ids: str) -> DataFrame:
        return df.selectExpr("*", f"{_ids_by_colour(ids, owner)} AS by_colour") if owner else df

    def mids(ids: str, outer: str = "") -> list[str]:
        """A row for each vertex that a chunk is sent to; with ``owner``, its hash comes out of the generator, so that the
        projection in ``sends`` has nothing of its own that would keep the bitmap from going on into the expression."""
        if not owner:
            return [f"posexplode{outer}({ids}) AS (at, mid)"]
        return [f"posexplode{outer}(transform({ids}, x -> struct(x AS id, xxhash64(x) AS hash))) AS (at, to)"]

    told = ["*", "to.id AS mid", "to.hash AS mid_hash"] if owner else ["*"]
    columns = [*list_keys, "lo", "lo_parts", "chunk", "chunks", "n", "packed"]
    within = parted(lists, "slice(packed, 1, n)").selectExpr(*columns, *by_colour, *mids("slice(packed, 1, n)", "_outer")).where("at + 1 < n").selectExpr(*told)
    others = "filter(sequence(0, chunks - 1), y -> y <> chunk)"
    dealt = lists.selectExpr(
        *columns, f"explode_outer(CASE WHEN chunks > 1 THEN transform({others}, y -> struct(least(y, chunk) AS a, greatest(y, chunk) AS b)) END) AS pair"
    ).where("pair IS NOT NULL")
    met = dealt.groupBy(*list_keys, "lo", "lo_parts", "chunks", "pair").agg(F.sort_array(F.collect_list(F.struct("chunk", "n", "packed"))).alias("two"))
    between = parted(met.where("size(two) = 2"), "slice(two[1].packed, 1, two[1].n)").selectExpr(
        *list_keys, "lo", "lo_parts", "chunks", "two[0].n AS n", "two[0].packed AS packed", "two[1].n AS later_n", "two[1].packed AS later", *by_colour,
        *mids("slice(two[0].packed, 1, two[0].n)"),
    ).selectExpr(*told)
    sent = sends(within, "slice(packed, at + 2, n - at - 1)", "slice(packed, n + 1, 4)", "w.at > at").unionByName(
        sends(between, "slice(later, 1, later_n)", "slice(later, later_n + 1, 4)", "true")
    )
    own_ids = _per_triple_lists(parted(lists, "slice(packed, 1, n)"), group, owner) if owner else lists.selectExpr("*", "slice(packed, 1, n) AS ids")
    # By the generator, like all by which rows are left out.
    pieces = "transform(sequence(0L, abs(lo_parts) - 1), p -> struct(p AS piece, lo_parts > 0 AS met))"
    own = (
        own_ids.selectExpr(*keys, "lo AS mid", "n", "packed", "chunks", "ids", f"inline_outer({pieces})")
        .where("piece IS NOT NULL")
        .selectExpr(*keys, "mid", "piece", "ids", "CASE WHEN chunks > 1 THEN slice(packed, n + 1, 4) END AS own_span", "met")
    )
    return sent, own


def _per_run_lists(gathered: DataFrame, group: str) -> DataFrame:
    """Each chunk in parts, one per run that any of its edges belongs to.  Edges are gathered once for all runs."""
    seen = gathered.selectExpr("*", "aggregate(above.mask, 0L, (m, x) -> m | x) AS seen")
    parted = seen.selectExpr("*", f"explode(filter(sequence(0, {MASK_RUNS - 1}), i -> getbit(seen, i) = 1)) AS bit")
    return parted.selectExpr(
        f"block * {MASK_RUNS} + bit AS {group}", "lo", "lo_parts", "chunk", "chunks", "filter(above, h -> getbit(h.mask, bit) = 1) AS above"
    )


def _ids_by_colour(ids: str, colouring: Colouring) -> str:
    """An array with one array per colour, of the ``(id, at, hash)`` of that colour among ``ids``."""
    last = colouring.colours - 1
    coloured = f"transform({ids}, (w, i) -> struct(w AS id, i AS at, xxhash64(w) AS hash, {colouring.spark('w')} AS colour))"
    # In an array of one, so that no rule of the optimizer hashes the ids anew for each colour.
    return f"transform(array({coloured}), all -> transform(sequence(0L, {last}L), c -> transform(filter(all, w -> w.colour = c), w -> struct(w.id, w.at, w.hash))))[0]"


def _per_triple_lists(lists: DataFrame, group: str, colouring: Colouring) -> DataFrame:
    """Each chunk once per triple that its edges belong to: for colours ``x <= y`` beside that of ``lo``,
    ``ids``, the neighbours of either colour.  So edges are gathered once and only lists are replicated."""
    last = colouring.colours - 1
    ids = "CASE WHEN x = y THEN by_colour[int(x)].id ELSE concat(by_colour[int(x)].id, by_colour[int(y)].id) END"
    triples = f"""flatten(transform(sequence(0L, {last}L), x -> transform(sequence(x, {last}L),
        y -> struct({triple_key(colouring, 'a', 'x', 'y')} AS {group}, {ids} AS ids))))"""
    coloured = lists.selectExpr("*", f"{colouring.spark('lo')} AS a")
    return coloured.selectExpr("*", f"inline_outer(filter({triples}, t -> size(t.ids) > 0))")


def _sum(column: str) -> str:
    return f"CAST(coalesce(sum({column}), 0) AS BIGINT)"


def _dense(counts: DataFrame, group: str, groups: int) -> DataFrame:
    """Sums per group, with a zero for each of the ``0 .. groups - 1`` that has none."""
    zeros = counts.sparkSession.range(0, groups, 1, 1).selectExpr(f"id AS {group}", "0L AS triangles")
    return counts.unionByName(zeros).groupBy(group).agg(F.expr(_sum("triangles")).alias("triangles"))


def _simple(edges: DataFrame, is_simple: bool) -> DataFrame:
    """``edges``, cleaned up unless the caller says that they are."""
    return edges if is_simple else simplify(edges)


def triangles_exact(edges: DataFrame, piece_rows: int = PIECE_ROWS, is_simple: bool = False) -> DataFrame:
    """One row: the number of triangles of the undirected simple graph under ``edges``."""
    return closed(orient(_simple(edges, is_simple), piece_rows)).selectExpr(f"{_sum('triangles')} AS triangles")


def triangles_per_triple(edges: DataFrame, colouring: Colouring, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """``(k1, k2, k3, triangles)`` for each colour triple that owns a triangle.

    Bounds the work on any one key by the colours rather than by the graph: an edge goes to
    ``colours`` keys, and a vertex has about two in ``colours`` of its edges in any of them.
    """
    c = colouring.colours
    counts = closed(orient(simplify(edges), piece_rows, settled=True), "k", colouring).groupBy("k").agg(
        F.sum("triangles").alias("triangles")
    )
    return counts.where("triangles > 0").selectExpr(
        f"k div {c * c} AS k1", f"k div {c} % {c} AS k2", f"k % {c} AS k3", "triangles"
    )


def triangles_colour_triple(
    edges: DataFrame, colouring: Colouring, piece_rows: int = PIECE_ROWS, is_simple: bool = False
) -> DataFrame:
    """One row: the exact count, by replication to colour triples."""
    counts = closed(orient(_simple(edges, is_simple), piece_rows, settled=True), "k", colouring)
    return counts.selectExpr(f"{_sum('triangles')} AS triangles")


def triangles_per_colour(edges: DataFrame, colouring: Colouring, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """``(colour, triangles)``: triangles with all three vertices of one colour, for every colour."""
    survivors = mono_edges(simplify(edges), colouring)
    coloured = orient(survivors.select("u", "v"), piece_rows).selectExpr(
        "lo", "hi", f"{colouring.spark('lo.id')} AS colour"
    )
    return _dense(closed(coloured, "colour"), "colour", colouring.colours)


def triangles_node_colour(edges: DataFrame, colouring: Colouring, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """``(colours, local, estimate)``: one-coloured triangles, and their number scaled by ``colours^2``.

    Three vertices share a colour with probability ``1 / colours^2``.  Edges of two colours are dropped
    in the scan; after that a colour needs no key, for edges of different colours share no vertex.
    """
    c = colouring.colours
    survivors = mono_edges(simplify(edges), colouring).select("u", "v")
    local = closed(orient_by_cells(survivors, piece_rows)).selectExpr(f"{_sum('triangles')} AS local")
    return local.selectExpr(f"{c} AS colours", "local", f"{c * c}L * local AS estimate")


def triangles_edge_partition(
    edges: DataFrame, parts: EdgePartitioning, piece_rows: int = PIECE_ROWS, is_simple: bool = False
) -> DataFrame:
    """``(partitions, local, estimate)``: triangles within one edge partition, scaled likewise.

    Partitions are a hash of the simple edge, so copies of an edge cannot fall into several.  They need nothing of
    each other but the hashed degrees: lists are gathered, sent and intersected per partition.
    """
    n = parts.partitions
    oriented = orient_by_cells(_simple(edges, is_simple), piece_rows)
    ends = "least(lo.id, hi.id)", "greatest(lo.id, hi.id)"
    local = closed(oriented.selectExpr("lo", "hi", f"{parts.spark(*ends)} AS part"), "part")
    return local.selectExpr(f"{_sum('triangles')} AS local").selectExpr(
        f"{n} AS partitions", "local", f"{n * n}L * local AS estimate"
    )


def triangle_runs(
    edges: DataFrame, colourings: list[Colouring], piece_rows: int = PIECE_ROWS, is_simple: bool = False
) -> DataFrame:
    """``(run, estimate)``: one estimate per colouring, all in a single job.

    An edge carries a mask, a bit for each run that gives its ends one colour; edges of no run are dropped in the
    scan, and masks are put together where copies of an edge are folded.  All runs share one orientation and one
    gathering; then a list is split by the bits of its edges.  Work grows by runs over ``colours^2``, at which
    the runs cost as much as an exact count.
    """
    if not colourings:
        raise ValueError("at least one run is needed")
    colours = {c.colours for c in colourings}
    if len(colours) > 1:
        raise ValueError("all runs must use the same number of colours")
    colour_count = colours.pop()

    # The plan does not grow with the runs: their coefficients are one array, gone through by position.
    degree = max(len(c.hash.coefs) for c in colourings)
    table = f"array({', '.join(c.hash.spark_row(degree) for c in colourings)})"
    u, v = (f"{indexed_hash(x, 'c', degree)} % {colour_count}" for x in ("u", "v"))
    # Distinct edges and their masks come from one aggregation, folded in the map tasks first.
    alike = (edges if is_simple else canonical(edges)).selectExpr("u", "v", f"posexplode({table}) AS (run, c)").where(f"{u} = {v}")
    # ``run div MASK_RUNS``, in a form that is never null, so that no test for null sets the uses of the edges apart.
    block = F.expr("shiftright(run, 6)").cast("bigint").alias("block")
    masked = alike.groupBy("u", "v", block).agg(F.bit_or(F.expr(f"shiftleft(1L, run & {MASK_RUNS - 1})")).alias("mask"))
    counts = closed(orient_by_cells(masked, piece_rows, ("block", "mask")), "run", masked=True)
    return _dense(counts, "run", len(colourings)).selectExpr("run", f"{colour_count**2}L * triangles AS estimate")


def median_of_runs(runs: DataFrame) -> DataFrame:
    """``(runs, median)``; of an even number of runs, the mean of the middle two without its fraction."""
    ordered = runs.agg(F.sort_array(F.collect_list("estimate")).alias("e")).selectExpr("e", "size(e) AS runs")
    middle = "(e[int((runs - 1) div 2)] + e[int(runs div 2)]) div 2"
    return ordered.selectExpr("runs", f"CASE WHEN runs > 0 THEN {middle} END AS median")
