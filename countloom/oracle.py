"""The SQL twin of every query in ``workloads``, for DuckDB.

Written from the definitions of the operators, with wedges joined as rows and no orientation, pieces or
lists; only the coefficients of the hashes are shared.
"""

from __future__ import annotations

from countloom import workloads as w

EDGES = "SELECT l_partkey AS u, l_suppkey AS v FROM lineitem"
PARSED = "SELECT l_partkey AS u, l_suppkey AS v FROM lineitem WHERE l_partkey <> l_suppkey"
VALUES = f"SELECT CAST(floor(value) AS BIGINT) AS item, event_id // {w.BATCH_EVENTS} AS batch_id FROM events"
USERS = f"SELECT user_id AS item, event_id // {w.BATCH_EVENTS} AS batch_id FROM events"
SUPPLIERS = "SELECT l_suppkey AS item FROM lineitem"


def _simple(edges: str = EDGES) -> str:
    return f"SELECT DISTINCT least(u, v) AS u, greatest(u, v) AS v FROM ({edges}) WHERE u <> v"


def _triangles(simple: str, extra: str = "", where: str = "true") -> str:
    """All triangles ``u < v < w`` of a simple graph; ``where`` may use the three vertices."""
    return f"""SELECT a.u AS u, a.v AS v, b.v AS w {extra}
        FROM ({simple}) a JOIN ({simple}) b ON a.v = b.u JOIN ({simple}) c ON c.u = a.u AND c.v = b.v
        WHERE {where}"""


def _colour(x: str, colouring=w.COLOURING) -> str:
    return colouring.duckdb(x)


def _one_colour(colouring) -> str:
    hu, hv, hw = (colouring.duckdb(x) for x in ("a.u", "a.v", "b.v"))
    return f"{hu} = {hv} AND {hv} = {hw}"


def _count(triangles: str) -> str:
    return f"SELECT count(*)::BIGINT AS triangles FROM ({triangles})"


def _node_colour(colouring) -> str:
    c = colouring.colours
    return f"""SELECT {c} AS colours, count(*)::BIGINT AS local, ({c * c} * count(*))::BIGINT AS estimate
        FROM ({_triangles(_simple(), where=_one_colour(colouring))})"""


def _edge_partition() -> str:
    p = w.EDGE_PARTS
    ab, bc, ac = p.duckdb("a.u", "a.v"), p.duckdb("a.v", "b.v"), p.duckdb("a.u", "b.v")
    n = p.partitions
    return f"""SELECT {n} AS partitions, count(*)::BIGINT AS local, ({n * n} * count(*))::BIGINT AS estimate
        FROM ({_triangles(_simple(), where=f"{ab} = {bc} AND {bc} = {ac}")})"""


def _runs() -> str:
    scale = w.COLOURS**2
    return " UNION ALL ".join(
        f"""SELECT {run}::BIGINT AS run, ({scale} * count(*))::BIGINT AS estimate
            FROM ({_triangles(_simple(), where=_one_colour(c))})"""
        for run, c in enumerate(w.RUN_COLOURINGS)
    )


def _runs_median() -> str:
    return f"""SELECT {w.RUNS} AS runs,
        ((list_sort(list(estimate))[({w.RUNS} + 1) // 2] + list_sort(list(estimate))[{w.RUNS} // 2 + 1]) // 2)::BIGINT AS median
        FROM ({_runs()})"""


def _sorted_colours(*vertices: str) -> str:
    return f"list_sort([{', '.join(_colour(v) for v in vertices)}])"


def _tour_edges(last: bool) -> str:
    """By position: pair ``i`` joins tokens ``i`` and ``i + 1`` of a line."""
    pairs = """SELECT line, i, t[i] AS a, t[i + 1] AS b FROM (
            SELECT line, t, unnest(range(1, len(t))) AS i FROM (
                SELECT row_number() OVER () AS line, string_split(concat_ws(',', l_partkey, l_suppkey, l_linenumber,
                    l_partkey, l_orderkey), ',') AS t FROM lineitem))
        WHERE t[i] <> t[i + 1]"""
    ids = f"SELECT line, i, a::BIGINT AS u, b::BIGINT AS v FROM ({pairs})"
    if not last:
        return f"SELECT u, v FROM ({ids})"
    return f"SELECT u, v FROM ({ids}) QUALIFY row_number() OVER (PARTITION BY line, u ORDER BY i DESC) = 1"


def _in_range(items: str, limits: tuple[int, int]) -> str:
    return f"SELECT * FROM ({items}) WHERE item BETWEEN {limits[0]} AND {limits[1]}"


def _freq(items: str) -> str:
    return f"SELECT item, count(*)::BIGINT AS n FROM ({items}) GROUP BY item"


VALUES_IN = _in_range(VALUES, w.VALUE_RANGE)
VALUE_FREQ = _freq(VALUES_IN)


def _kth(freq: str, k: int = w.TOP_K) -> str:
    return f"SELECT min(n)::BIGINT AS f_k FROM (SELECT n FROM ({freq}) ORDER BY n DESC LIMIT {k})"


def _ties(freq: str) -> str:
    return f"SELECT item, n FROM ({freq}) WHERE n >= ({_kth(freq)})"


def _counters(items: str) -> str:
    rows = " UNION ALL ".join(
        f"""SELECT {j}::INTEGER AS row, {r.bucket('item', 'duckdb')} AS bucket, {r.sign('item', 'duckdb')} AS s
            FROM ({items})"""
        for j, r in enumerate(w.SKETCH.rows)
    )
    return f"SELECT row, bucket, sum(s)::BIGINT AS c FROM ({rows}) GROUP BY row, bucket"


def _collisions(items: str) -> str:
    rows = " UNION ALL ".join(
        f"SELECT {j}::INTEGER AS row, {r.bucket('item', 'duckdb')} AS bucket FROM (SELECT DISTINCT item FROM ({items}))"
        for j, r in enumerate(w.SKETCH.rows)
    )
    return f"SELECT row, bucket, count(*)::BIGINT AS items FROM ({rows}) GROUP BY row, bucket"


def _f2_rows(items: str) -> str:
    return f"""SELECT r.row::INTEGER AS row, coalesce(sum(c.c::DOUBLE * c.c), 0.0) AS f2
        FROM (SELECT unnest(range({w.DEPTH})) AS row) r LEFT JOIN ({_counters(items)}) c ON c.row = r.row GROUP BY r.row"""


def _f2(freq: str) -> str:
    return f"SELECT round(sum(n::DOUBLE * n) / (sum(n)::DOUBLE * sum(n)), 9) AS f2 FROM ({freq})"


def _f2_estimate(items: str) -> str:
    return f"""SELECT round(median(f2) / ((SELECT sum(n)::DOUBLE FROM ({_freq(items)})) ** 2), 9) AS f2_estimate
        FROM ({_f2_rows(items)})"""


def _estimates(freq: str, items: str) -> str:
    rows = " UNION ALL ".join(
        f"""SELECT f.item, f.n, {r.sign('f.item', 'duckdb')} * coalesce(c.c, 0) AS e
            FROM ({freq}) f LEFT JOIN (SELECT * FROM ({_counters(items)}) WHERE row = {j}) c
            ON c.bucket = {r.bucket('f.item', 'duckdb')}"""
        for j, r in enumerate(w.SKETCH.rows)
    )
    return f"SELECT item, n, median(e)::DOUBLE AS estimate FROM ({rows}) GROUP BY item, n"


def _topk(freq: str, items: str) -> str:
    return f"SELECT item, n, estimate, abs(n - estimate) / n AS error FROM ({_estimates(_ties(freq), items)})"


BATCHES = f"SELECT batch_id, count(*)::BIGINT AS n FROM ({VALUES}) GROUP BY batch_id"


def _prefix(items: str) -> str:
    """``items`` has ``batch_id``; whole batches while fewer items than the share came before."""
    before = f"""SELECT batch, sum(n) OVER (ORDER BY batch NULLS FIRST) - n AS before
        FROM (SELECT batch_id AS batch, count(*) AS n FROM ({items}) GROUP BY batch_id)"""
    return f"""SELECT i.* FROM ({items}) i JOIN ({before}) b ON i.batch_id IS NOT DISTINCT FROM b.batch
        WHERE b.before < (SELECT count(*) * {w.PREFIX_SHARE} // 1000 FROM ({items}))"""


SLICED = _prefix(
    f"""SELECT CAST(floor(value) AS BIGINT) AS item,
            (row_number() OVER (ORDER BY event_id NULLS FIRST, value NULLS FIRST) - 1) * {w.SLICES} // (SELECT count(*) FROM events) AS batch_id
        FROM events"""
)


def _report(stream: str) -> str:
    items = _in_range(stream, w.VALUE_RANGE)
    freq = _freq(items)
    left, right = w.VALUE_RANGE
    return f"""SELECT {w.DEPTH} AS depth, {w.WIDTH} AS width, {left}::BIGINT AS left, {right}::BIGINT AS right,
        {w.TOP_K} AS k, (SELECT count(*)::BIGINT FROM ({stream})) AS length,
        (SELECT sum(n)::BIGINT FROM ({freq})) AS total, (SELECT count(*)::BIGINT FROM ({freq})) AS distinct,
        ({_kth(freq)}) AS f_k, (SELECT round(avg(error), 9) FROM ({_topk(freq, items)})) AS avg_error,
        ({_f2(freq)}) AS f2, ({_f2_estimate(items)}) AS f2_estimate"""


def _approximate_report() -> str:
    return f"""SELECT 'part_supplier' AS dataset, (SELECT count(*)::BIGINT FROM ({PARSED})) AS edges,
        {w.COLOURS} AS colours, {w.RUNS} AS runs, (SELECT median FROM ({_runs_median()})) AS node_colour,
        (SELECT estimate FROM ({_edge_partition()})) AS edge_partition"""


def _exact_report() -> str:
    return f"""SELECT 'part_supplier' AS dataset, (SELECT count(*)::BIGINT FROM ({PARSED})) AS edges,
        {w.COLOURS} AS colours, {w.RUNS} AS runs, ({_count(_triangles(_simple()))}) AS triangles"""


def _balance(colouring) -> str:
    hu, hv = colouring.duckdb("u"), colouring.duckdb("v")
    return f"""SELECT colour, sum(vertex)::BIGINT AS vertices, sum(edge)::BIGINT AS edges FROM (
            SELECT {colouring.duckdb('x')} AS colour, 1 AS vertex, 0 AS edge
            FROM (SELECT u AS x FROM ({_simple()}) UNION SELECT v FROM ({_simple()}))
            UNION ALL SELECT {hu}, 0, 1 FROM ({_simple()}) WHERE {hu} = {hv}
            UNION ALL SELECT unnest(range({colouring.colours})), 0, 0)
        GROUP BY colour"""


def _triple_load() -> str:
    k = f"list_sort([{_colour('u')}, {_colour('v')}, c])"
    return f"""SELECT k[1] AS k1, k[2] AS k2, k[3] AS k3, count(*)::BIGINT AS edges FROM (
            SELECT {k} AS k FROM ({_simple()}), (SELECT unnest(range({w.COLOURS})) AS c))
        GROUP BY ALL"""


def _per_triple() -> str:
    return f"""SELECT k[1] AS k1, k[2] AS k2, k[3] AS k3, count(*)::BIGINT AS triangles FROM (
            SELECT {_sorted_colours('u', 'v', 'w')} AS k FROM ({_triangles(_simple())}))
        GROUP BY ALL"""


def _per_colour() -> str:
    return f"""SELECT c.colour AS colour, count(t.colour)::BIGINT AS triangles
        FROM (SELECT unnest(range({w.COLOURS})) AS colour) c LEFT JOIN (
            SELECT {_colour('u')} AS colour FROM ({_triangles(_simple(), where=_one_colour(w.COLOURING))})) t
        ON t.colour = c.colour GROUP BY c.colour"""


MERGED = f"""SELECT item FROM ({VALUES_IN}) UNION ALL SELECT item FROM ({_in_range(SUPPLIERS, w.SUPPLIER_RANGE)})"""


def sql() -> dict[str, str]:
    hu, hv = _colour("u"), _colour("v")
    return {
        "edges_from_lines": _tour_edges(last=True),
        "read_edges": _tour_edges(last=True),
        "edges_from_lines_all": _tour_edges(last=False),
        "edges_from_lines_lenient": "SELECT event_id AS u, user_id AS v FROM events WHERE event_type <> 'error' AND event_id <> user_id",
        "rejected_lines": "SELECT concat(event_id, ',error') AS value FROM events WHERE event_type = 'error'",
        "items_from_lines": "SELECT user_id AS item FROM events",
        "edge_count": f"SELECT count(*)::BIGINT AS edges FROM ({PARSED})",
        "graph_simplify": _simple(),
        "vertex_degrees": f"""SELECT vertex, count(*)::BIGINT AS degree FROM (
            SELECT u AS vertex FROM ({_simple()}) UNION ALL SELECT v FROM ({_simple()})) GROUP BY vertex""",
        "colour_balance": _balance(w.COLOURING),
        "colour_balance_linear8191": _balance(w.LINEAR),
        "mono_edges": f"SELECT {hu} AS colour, u, v FROM ({PARSED}) WHERE {hu} = {hv}",
        "colour_triple_load": _triple_load(),
        "triangles_exact": _count(_triangles(_simple())),
        "triangles_exact_pieces": _count(_triangles(_simple())),
        "triangles_exact_sparse": _count(_triangles(_simple("SELECT o_orderkey AS u, o_custkey AS v FROM orders"))),
        "triangles_colour_triple": _count(_triangles(_simple())),
        "triangles_per_triple": _per_triple(),
        "triangles_per_colour": _per_colour(),
        "triangles_node_colour": _node_colour(w.COLOURING),
        "triangles_node_colour_linear8191": _node_colour(w.LINEAR),
        "triangles_edge_partition": _edge_partition(),
        "triangle_runs": _runs(),
        "triangle_runs_median": _runs_median(),
        "triangle_report": _approximate_report(),
        "triangle_report_exact": _exact_report(),
        "stream_length": "SELECT count(*)::BIGINT AS length FROM events",
        "batch_item_counts": f"SELECT batch_id, item, count(*)::BIGINT AS n FROM ({VALUES}) GROUP BY batch_id, item",
        "stream_prefix": _prefix(VALUES),
        "item_freq": VALUE_FREQ,
        "item_freq_users": _freq(_in_range(USERS, w.USER_RANGE)),
        "tally": f"""SELECT CASE WHEN item BETWEEN {w.USER_RANGE[0]} AND {w.USER_RANGE[1]} THEN item END AS item,
            count(*)::BIGINT AS n FROM ({USERS}) GROUP BY 1""",
        "range_totals": f"SELECT sum(n)::BIGINT AS total, count(*)::BIGINT AS distinct FROM ({VALUE_FREQ})",
        "f2_true": _f2(VALUE_FREQ),
        "kth_frequency": _kth(VALUE_FREQ),
        "kth_frequency_deep": _kth(_freq(USERS), w.DEEP_K),
        "topk_ties": _ties(_freq(_in_range(SUPPLIERS, w.SUPPLIER_RANGE))),
        "bucket_collisions": _collisions(VALUES_IN),
        "sketch_counters": _counters(VALUES_IN),
        "sketch_merge": _counters(MERGED),
        "f2_rows": _f2_rows(VALUES_IN),
        "f2_estimate": _f2_estimate(VALUES_IN),
        "point_estimates": _estimates(VALUE_FREQ, VALUES_IN),
        "point_estimates_joined": _estimates(VALUE_FREQ, VALUES_IN),
        "topk_estimates": f"SELECT item, n, estimate, round(error, 9) AS error FROM ({_topk(VALUE_FREQ, VALUES_IN)})",
        "topk_avg_error": f"SELECT round(avg(error), 9) AS avg_error FROM ({_topk(VALUE_FREQ, VALUES_IN)})",
        "stream_report": _report(_prefix(VALUES)),
        "stream_sketch": _counters(VALUES_IN),
        "stream_until": _freq(_in_range(SLICED, w.VALUE_RANGE)),
        "stream_until_report": _report(SLICED),
    }
