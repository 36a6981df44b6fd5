"""Hard negatives by inner product, searched exactly in an R-tree packed by sort-tile-recursion.

Vectors are tiled: sorted by label and cut into slabs, each slab sorted by the coordinate that spreads most and
cut, and so on.  Tiles are shards, and the rows of a shard are packed into pages in the same way; pages are
gathered into boxes, boxes into larger ones.  For a box and an anchor each coordinate gives an interval of
products, and their sums bound every inner product inside.  A search takes boxes from a queue, highest bound
first, and leaves out those that cannot hold a row of the wanted labels, lie outside all score windows, or
whose bound is strictly below the k-th score found so far.

Shards are pruned by the same test: an anchor first visits the shard of the highest bound, and then only
shards whose bound is not below its k-th score there.  So every result is exact, whatever the tiles are; a
bounded sample of ``SAMPLE_ROWS`` shapes the tiles only, and every row is indexed.

Scale: a tile that got too many rows, equal vectors for instance, is dealt out over several shards by row
number.  Shards number under ``2 * MOST_SHARDS`` at any size, and their boxes are what every task is told.
A shard visited by many anchors is sent to several tasks, each with some ``SLICE_ANCHORS`` of them.  A search
in spread-out data of many dimensions visits most shards: anchors times rows, in blocks, is its bound.

Defined results: rows with a null label or vector, or a component that is null, not finite or of ``LARGEST`` and
more, take no part; a shorter vector is filled up with zeros; rows are told apart by a number of their own, so
repeated rows are each other's "other rows" and repeated anchors answer each; a null id is no anchor and comes
after other ids on equal scores, further ties are broken by row; an empty table gives no rows.  Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from countloom.llm.common import materialise, table, with_batches

# Fixed values of the task: components are ``floor(SCALE * x)``; the positives and negatives wanted; the window
# of negative scores, in percent of the positive score.
SCALE, POSITIVES, NEGATIVES, LEAST, MOST = 256, 5, 3, 50, 95
# Larger scaled components could overflow a score in 16,384 dimensions.
LARGEST = 1 << 24
SAMPLE_ROWS, AXES = 1 << 14, 4
SHARD_ROWS, MOST_SHARDS = 1 << 15, 1 << 13
PAGE_ROWS, FANOUT = 128, 16
SLICE_ANCHORS = 2048
FAR = 1 << 62


def slabs_of(left: int, axes_left: int) -> int:
    """Into how many slabs the next axis is cut if ``left`` tiles are wanted from this axis on."""
    return max(2, int(np.ceil(left ** (1 / axes_left) - 1e-9)))


def axes_of(points: np.ndarray) -> list[int]:
    """Column 0, the label, and then the coordinates that spread most."""
    return [0, *(1 + np.argsort(-points[:, 1:].var(0, dtype=float), kind="stable")[:AXES])]


def pack(points: np.ndarray) -> list[np.ndarray]:
    """Sort-tile-recursion: pages of at most ``PAGE_ROWS`` rows, in an order in which neighbours lie close."""
    axes = axes_of(points)

    def go(at: np.ndarray, left: int, depth: int) -> list[np.ndarray]:
        if left <= 1 or depth == len(axes):
            return np.array_split(at, -(-len(at) // PAGE_ROWS))
        slabs = slabs_of(left, len(axes) - depth)
        parts = np.array_split(at[np.argsort(points[at, axes[depth]], kind="stable")], slabs)
        return [page for part in parts if len(part) for page in go(part, -(-left // slabs), depth + 1)]

    return go(np.arange(len(points)), -(-len(points) // PAGE_ROWS), 0)


@dataclass
class Cuts:
    """Values of one axis at which a region is cut, and what lies between them: further cuts, or a tile number."""

    axis: int
    values: np.ndarray
    parts: "list[Cuts | int]"


def grow_cuts(points: np.ndarray, pages: int) -> tuple[Cuts | int, int]:
    """Tiles over a sample, as cuts that place any point; and their number."""
    axes, tiles_made = axes_of(points) if len(points) else [], 0

    def go(at: np.ndarray, left: int, depth: int) -> Cuts | int:
        nonlocal tiles_made
        if left > 1 and depth < len(axes) and len(at) > 1:
            slabs = slabs_of(left, len(axes) - depth)
            ordered = np.sort(points[at, axes[depth]])
            values = np.unique(ordered[[len(at) * s // slabs for s in range(1, slabs)]])
            side = np.searchsorted(values, points[at, axes[depth]], side="right")
            return Cuts(axes[depth], values, [go(at[side == s], -(-left // slabs), depth + 1) for s in range(len(values) + 1)])
        tiles_made += 1
        return tiles_made - 1

    return go(np.arange(len(points)), pages, 0), tiles_made


def place(cuts: Cuts | int, points: np.ndarray) -> np.ndarray:
    tile = np.zeros(len(points), np.int32)

    def go(node: Cuts | int, at: np.ndarray) -> None:
        if isinstance(node, int):
            tile[at] = node
        else:
            side = np.searchsorted(node.values, points[at, node.axis], side="right")
            for s, part in enumerate(node.parts):
                go(part, at[side == s])

    go(cuts, np.arange(len(points)))
    return tile


@dataclass
class Boxes:
    """Bounding boxes: coordinates and labels from ``low`` to ``high``."""

    low: np.ndarray
    high: np.ndarray
    label_low: np.ndarray
    label_high: np.ndarray

    @classmethod
    def around(cls, boxes: Boxes, ends: list[int]) -> Boxes:
        """The boxes of consecutive runs of boxes, starting at ``ends``."""
        return cls(
            np.minimum.reduceat(boxes.low, ends), np.maximum.reduceat(boxes.high, ends),
            np.minimum.reduceat(boxes.label_low, ends), np.maximum.reduceat(boxes.label_high, ends),
        )

    def part(self, begin: int, end: int) -> Boxes:
        return Boxes(self.low[begin:end], self.high[begin:end], self.label_low[begin:end], self.label_high[begin:end])

    def bounds(self, vector: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the largest possible inner product; also for many vectors at once, one per row."""
        up, down = np.maximum(vector, 0).T, np.minimum(vector, 0).T
        return (self.low @ up + self.high @ down).T, (self.high @ up + self.low @ down).T

    def allowed(self, label: int, same: bool) -> np.ndarray:
        if same:
            return (self.label_low <= label) & (label <= self.label_high)
        return (self.label_low != label) | (self.label_high != label)


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A column of lists as rows of ``dims`` numbers, filled up with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths, flat = lists.value_lengths().to_numpy(zero_copy_only=False), lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), dims), np.int64)
    out[np.arange(dims)[None, :] < lengths[:, None]] = flat
    return out


class Tree:
    """The pages of one shard under boxes of ``FANOUT``, and the search."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, named: np.ndarray, labels: np.ndarray, vectors: np.ndarray, ends: list[int]):
        self.rows, self.ids, self.named, self.labels, self.vectors = rows, ids, named, labels, vectors
        self.ends = [*ends, len(rows)]
        self.levels = [Boxes.around(Boxes(vectors, vectors, labels, labels), ends)]
        while len(self.levels[-1].low) > 1:
            self.levels.append(Boxes.around(self.levels[-1], list(range(0, len(self.levels[-1].low), FANOUT))))

    def search(self, row: int, label: int, vector: np.ndarray, low: list[int], high: list[int], kth: list[int], k: int, same: bool) -> list[list[tuple]]:
        """Per window the best ``k`` rows: ``(-score, without an id, id, row)``, rising."""
        found: list[list[tuple]] = [[] for _ in low]
        floor = [max(a, b) for a, b in zip(low, kth)]
        top = len(self.levels) - 1
        queue: list[tuple[int, int, int]] = []

        def open_windows(least: int, most: int) -> bool:
            return any(f <= h and most >= f and least <= h for f, h in zip(floor, high))

        def push(level: int, begin: int, end: int) -> None:
            boxes = self.levels[level].part(begin, end)
            least, most = boxes.bounds(vector)
            for i in np.flatnonzero(boxes.allowed(label, same)).tolist():
                if open_windows(int(least[i]), int(most[i])):
                    heappush(queue, (-int(most[i]), level, begin + i))

        push(top, 0, 1)
        while queue:
            most, level, box = heappop(queue)
            if -most < min((f for f, h in zip(floor, high) if f <= h), default=FAR):
                break
            if level:
                push(level - 1, box * FANOUT, min((box + 1) * FANOUT, len(self.levels[level - 1].low)))
                continue
            begin, end = self.ends[box], self.ends[box + 1]
            score = self.vectors[begin:end] @ vector
            wanted = (self.labels[begin:end] == label) == same
            wanted &= self.rows[begin:end] != row
            for w, h in enumerate(high):
                for i in np.flatnonzero(wanted & (score >= floor[w]) & (score <= h)).tolist():
                    at = begin + i
                    found[w].append((-int(score[i]), not self.named[at], int(self.ids[at]), int(self.rows[at])))
                if len(found[w]) >= k:
                    found[w] = sorted(found[w])[:k]
                    floor[w] = max(floor[w], -found[w][-1][0])
        return [sorted(f)[:k] for f in found]


@dataclass
class Index:
    """``pages``: a row per page of each shard; ``boxes`` and ``shards``: the box and name of each shard."""

    pages: DataFrame
    boxes: Boxes
    shards: np.ndarray
    dims: int


PAGES = "shard bigint, page int, rows binary, ids binary, named binary, labels binary, vectors binary"


def build(rows: DataFrame) -> Index:
    """The index of ``rows (row, id, label, v)``, which are written out."""
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("v")), F.lit(1)).alias("dims")).first()
    n, dims = size.n, max(size.dims, 1)
    per_shard = max(SHARD_ROWS, -(-n // MOST_SHARDS))
    # Bounded by the parameter.
    sample = rows.select("label", "v").orderBy(F.xxhash64("row")).limit(SAMPLE_ROWS).toArrow()
    points = np.column_stack([sample.column("label").to_numpy(), matrix(sample.column("v"), dims)])
    cuts, many = grow_cuts(points, -(-n // per_shard))

    def tile(batch: pa.RecordBatch) -> pa.RecordBatch:
        there = np.column_stack([batch.column("label").to_numpy(), matrix(batch.column("v"), dims)])
        return pa.record_batch([*batch.columns, pa.array(place(cuts, there))], names=[*batch.schema.names, "tile"])

    placed = materialise(with_batches(rows, tile, rows.withColumn("tile", F.lit(0)).schema), "tiles")
    counts = {r.tile: r.n for r in placed.groupBy("tile").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = F.array(*(F.lit(-(-counts.get(t, 0) // per_shard)) for t in range(many)))
    shard = F.col("tile").cast("bigint") * (1 << 32) + F.pmod(F.xxhash64("row"), F.element_at(parts, F.col("tile") + 1))

    def bind(group: pa.Table) -> pa.Table:
        ids, labels, own = (group.column(c).to_numpy() for c in ("id", "label", "row"))
        named, vectors = group.column("named").to_numpy(), matrix(group.column("v"), dims)
        vectors = vectors.astype(np.int32)
        box, spread = np.stack([vectors.min(0), vectors.max(0)]), np.array([labels.min(), labels.max()])
        out = [[b"", b"", b"", spread.tobytes(), box.tobytes()]]
        out += [[c[p].tobytes() for c in (own, ids, named, labels, vectors)] for p in pack(np.column_stack([labels, vectors]))]
        name = group.column("shard")[0].as_py()
        arrays = [pa.array([name] * len(out), pa.int64()), pa.array(range(len(out)), pa.int32())]
        return pa.Table.from_arrays([*arrays, *(pa.array(c, pa.binary()) for c in zip(*out))], names=[f.split()[0] for f in PAGES.split(", ")])

    sharded = placed.select(shard.alias("shard"), "row", F.coalesce("id", F.lit(0)).alias("id"), F.col("id").isNotNull().alias("named"), "label", "v")
    pages = materialise(sharded.groupBy("shard").applyInArrow(bind, PAGES), "pages")
    # Under 2 * MOST_SHARDS rows.
    heads = pages.where("page = 0").select("shard", "labels", "vectors").toArrow()
    box = np.array([np.frombuffer(b, np.int32) for b in heads.column("vectors").to_pylist()], np.int64).reshape(-1, 2, dims)
    spread = np.array([np.frombuffer(b, np.int64) for b in heads.column("labels").to_pylist()], np.int64).reshape(-1, 2)
    boxes = Boxes(box[:, 0], box[:, 1], spread[:, 0], spread[:, 1])
    return Index(pages.where("page > 0"), boxes, heads.column("shard").to_numpy(), dims)


def _router(index: Index, same: bool, first: bool):
    """Sends each anchor to the shard of its highest bound, or to all others that its windows and k-th scores leave."""
    boxes, shards, dims = index.boxes, index.shards, index.dims

    def reach(least: np.ndarray, most: np.ndarray, floor: list[int], high: list[int]) -> np.ndarray:
        within = np.zeros(len(least), bool)
        for f, h in zip(floor, high):
            if f <= h:
                within |= (most >= f) & (least <= h)
        return within

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        least, most = boxes.bounds(matrix(batch.column("v"), dims))
        labels = batch.column("label").to_pylist()
        low, high, kth = (batch.column(c).to_pylist() for c in ("low", "high", "kth"))
        asked, to = [], []
        for q, label in enumerate(labels):
            may = boxes.allowed(label, same)
            wide = np.flatnonzero(may & reach(least[q], most[q], low[q], high[q]))
            if not len(wide):
                continue
            best = wide[np.argmax(most[q][wide])]
            floor = [max(a, b) for a, b in zip(low[q], kth[q])]
            left = np.flatnonzero(may & reach(least[q], most[q], floor, high[q]))
            visit = np.array([best]) if first else left[left != best]
            asked += [q] * len(visit)
            to += shards[visit].tolist()
        if not asked:
            return None
        return pa.RecordBatch.from_arrays([pa.array(to, pa.int64()), *batch.take(pa.array(asked)).columns], names=["shard", *batch.schema.names])

    return work


def _visit(index: Index, anchors: DataFrame, k: int, same: bool, first: bool) -> DataFrame:
    """``(row, w, score, id, other)``: the best of each shard visited."""
    dims = index.dims
    schema = f"shard bigint, {', '.join(f'{f.name} {f.dataType.simpleString()}' for f in anchors.schema)}"
    routed = materialise(with_batches(anchors, _router(index, same, first), schema, rows=256), "routed")
    # A row per shard.
    slices = materialise(routed.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / SLICE_ANCHORS).alias("slices")), "slices")
    asking = routed.join(slices, "shard").withColumn("slice", F.pmod(F.xxhash64("row"), "slices")).drop("slices")
    shown = index.pages.join(slices, "shard").selectExpr("*", "explode(sequence(0L, slices - 1)) AS slice").drop("slices")

    def look(pages: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if pages.num_rows and asked.num_rows:
            pages = pages.sort_by("page")
            kinds = {"rows": np.int64, "ids": np.int64, "named": bool, "labels": np.int64, "vectors": np.int32}
            parts = {c: [np.frombuffer(b, t) for b in pages.column(c).to_pylist()] for c, t in kinds.items()}
            ends = np.cumsum([0, *map(len, parts["rows"])])[:-1].tolist()
            whole = {c: np.concatenate(p) for c, p in parts.items()}
            tree = Tree(whole["rows"], whole["ids"], whole["named"], whole["labels"], whole["vectors"].reshape(-1, dims).astype(np.int64), ends)
            vectors = matrix(asked.column("v"), dims)
            fields = (asked.column(c).to_pylist() for c in ("row", "label", "low", "high", "kth"))
            for vector, (row, label, low, high, kth) in zip(vectors, zip(*fields)):
                for w, best in enumerate(tree.search(row, label, vector, low, high, kth, k, same)):
                    out += [(row, w, -score, None if unnamed else name, other) for score, unnamed, name, other in best]
        kinds = [("row", pa.int64()), ("w", pa.int32()), ("score", pa.int64()), ("id", pa.int64()), ("other", pa.int64())]
        return pa.Table.from_arrays([pa.array([r[i] for r in out], t) for i, (_, t) in enumerate(kinds)], names=[c for c, _ in kinds])

    met = shown.groupBy("shard", "slice").cogroup(asking.groupBy("shard", "slice"))
    return materialise(met.applyInArrow(look, "row bigint, w int, score bigint, id bigint, other bigint"), "visited")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` per anchor and window, with ``rank``; at most ``k`` come from each shard."""
    order = Window.partitionBy("row", "w").orderBy(F.desc("score"), F.asc_nulls_last("id"), "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(index: Index, anchors: DataFrame, k: int, same: bool) -> DataFrame:
    """``(row, w, rank, score, id, other)``: for each of ``anchors (row, label, v, low, high)`` and each window ``w`` of
    scores from ``low[w]`` to ``high[w]``, the ``k`` best rows of the same label, or of other labels."""
    open_ended = anchors.withColumn("kth", F.transform("low", lambda x: F.lit(-FAR)))
    seeds = _visit(index, open_ended, k, same, first=True)
    full = seeds.groupBy("row", "w").agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("n")).where(f"n = {k}")
    known = full.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("w", "kth"))).alias("known"))
    told = anchors.join(known, "row", "left").withColumn(
        "kth", F.expr(f"transform(low, (x, w) -> coalesce(try_element_at(known, w), {-FAR}L))")
    )
    rest = _visit(index, told.drop("known"), k, same, first=False)
    return _best(seeds.unionByName(rest), k)


def prepared(vectors: DataFrame, id_col: str, label: Column, vector_col: str) -> DataFrame:
    """``(row, id, label, v)`` of the rows that take part, written out."""
    whole = F.transform(vector_col, lambda x: F.floor(x.cast("double") * SCALE))
    sound = F.forall(vector_col, lambda x: x.isNotNull() & (F.abs(x.cast("double") * SCALE) < LARGEST))
    found = vectors.select(
        F.col(id_col).cast("bigint").alias("id"), label.cast("bigint").alias("label"), F.when(sound, whole).cast("array<int>").alias("v")
    ).where("label IS NOT NULL AND v IS NOT NULL")
    return materialise(found.withColumn("row", F.monotonically_increasing_id()), "vectors")


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` of ``prepared`` rows.

    An anchor's positives are its best rows of its label; the negatives of a positive are the best rows of other
    labels with a score from ``LEAST`` to ``MOST`` percent of the positive's.
    """
    index = build(rows)
    anchors = materialise(rows.where(is_anchor), "anchors")
    everything = anchors.select("row", "label", "v", F.array(F.lit(-FAR)).alias("low"), F.array(F.lit(FAR)).alias("high"))
    near = materialise(search(index, everything, positives, True).select("row", "rank", "score", "id"), "positives")
    # At most ``positives`` per anchor.  A window of a negative score is empty.
    scores = near.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("s"))
    windows = scores.selectExpr(
        "row",
        f"transform(s, p -> (p.score div 100) * {LEAST} + ceil((p.score % 100) * {LEAST} / 100D)) AS low",
        f"transform(s, p -> (p.score div 100) * {MOST} + floor((p.score % 100) * {MOST} / 100D)) AS high",
    )
    asking = anchors.join(windows, "row").select("row", "label", "v", "low", "high")
    hard = search(index, asking, negatives, False).selectExpr("row", "w + 1 AS place", "rank", "score AS negative_score", "id AS negative_id")
    paired = near.selectExpr("row", "rank AS place", "id AS positive_id", "score AS positive_score").join(hard, ["row", "place"])
    return paired.join(anchors.selectExpr("row", "id AS anchor_id"), "row").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label"))
    rows = prepared(table(spark, sf_dir, "embeddings"), "vec_id", label, "embedding")
    return mine(rows, F.col("id") % 50 == 0)


SQL = f"""WITH rows AS (
        SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
        FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x) OR abs(x::DOUBLE) * {SCALE} >= {LARGEST})) = 0),
    pairs AS (
        SELECT a.r, a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, b.r AS other, list_inner_product(a.v, b.v)::BIGINT AS score
        FROM rows a JOIN rows b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
    positives AS (
        SELECT * FROM pairs WHERE same
        QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST, other) <= {POSITIVES})
    SELECT p.anchor_id, p.vec_id AS positive_id,
        (row_number() OVER (PARTITION BY p.r, p.other ORDER BY n.score DESC, n.vec_id NULLS LAST, n.other))::INTEGER AS rank,
        n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
    FROM positives p JOIN pairs n ON n.r = p.r AND NOT n.same
        AND {LEAST} * p.score <= 100 * n.score AND 100 * n.score <= {MOST} * p.score
    QUALIFY rank <= {NEGATIVES}"""
