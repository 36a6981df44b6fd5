"""Near duplicates by 64-bit fingerprints and vantage-point trees.

A fingerprint bit is set if more than half of the hashes of a text's three-word shingles have it set.
Fingerprints that differ in at most ``RADIUS`` bits are linked, and linked documents form classes.

Only distinct fingerprints are compared.  A tree of vantage points, made from a bounded sample, splits
them by Hamming distance to the point of each node, and its leaves are the shards.  Every fingerprint is
at home in one shard; one that lies outside a node's ball, but within the radius of it, is also sent into
the ball as a query, and from there on, by the triangle inequality, into every shard that may hold a
partner.  So each pair within the radius meets in the home shard of one of the two.  A shard is searched
by a tree of its own in the same way.  It returns no pairs but a spanning star of what it has linked; the
stars of all shards are joined by ``connected_components``.

The sample only shapes the tree: whatever it is, every pair is found.

Defined results: a null text is an empty one; a text without words has fingerprint zero, which is linked
like any other; documents with a null id belong to a class but do not name it; repeated rows are reported
each; only ``doc_id`` and ``text`` are looked at, but for the choice between rows of one id in
``drop_near_copies``.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from xxhash import xxh64_intdigest

from countloom.llm.common import materialise, table, text_of, told_apart, with_batches, without
from countloom.llm.components import connected_components

SHINGLE_WORDS, SEED, RADIUS = 3, 42, 2
# Fingerprints that shape the tree; fingerprints aimed at per shard; fingerprints compared one by one.
SAMPLE_POINTS, SHARD_POINTS, LEAF_POINTS = 1 << 14, 1 << 11, 128
VANTAGE_CANDIDATES = 8


def fingerprint(text: str) -> int:
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = zip(*(words[i:] for i in range(SHINGLE_WORDS))) if len(words) > SHINGLE_WORDS else [words]
    n = max(1, len(words) - SHINGLE_WORDS + 1)
    hashes = np.fromiter(map(xxh64_intdigest, map(b" ".join, shingles), repeat(SEED)), "<u8", n)
    ones = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(n, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, fp)``, the fingerprint of ``text`` as a signed number."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64)
        return pa.record_batch([batch.column(key), pa.array(fps.view(np.int64))], names=[key, "fp"])

    return with_batches(docs.select(key, text_of().alias("text")), work, f"{key} {docs.schema[key].dataType.simpleString()}, fp bigint")


@dataclass
class Node:
    vantage: int
    cut: int
    inside: "Node | int"
    outside: "Node | int"


def _split(points: np.ndarray) -> tuple[int, int, np.ndarray] | None:
    """A vantage point, the distance to cut at, and all distances; none if no cut parts the points.

    Of a few candidates and cuts near the median, the pair with the fewest points just beyond the cut, who
    are the ones to be sent both ways.
    """
    n = len(points)
    best = None
    for vantage in points[np.linspace(0, n - 1, min(n, VANTAGE_CANDIDATES)).astype(int)]:
        distance = np.bitwise_count(points ^ vantage)
        upto = np.cumsum(np.bincount(distance, minlength=65 + RADIUS))
        for cut in range(64):
            if n * 0.3 <= upto[cut] <= n * 0.7:
                band = upto[cut + RADIUS] - upto[cut]
                if best is None or band < best[0]:
                    best = band, vantage, cut
    if best is None:
        vantage = points[0]
        distance = np.bitwise_count(points ^ vantage)
        cut = int(np.median(distance))
        cut = cut if (distance > cut).any() else cut - 1
        if cut < 0 or not (distance > cut).any():
            return None
        return int(vantage), cut, distance
    return int(best[1]), int(best[2]), np.bitwise_count(points ^ best[1])


def grow(points: np.ndarray, depth: int) -> tuple[Node | int, int]:
    """The tree over a sample and its number of shards, which are numbered from 0."""
    shards = 0

    def build(part: np.ndarray, left: int) -> Node | int:
        nonlocal shards
        split = _split(part) if left and len(part) > 2 else None
        if split is None:
            shards += 1
            return shards - 1
        vantage, cut, distance = split
        return Node(vantage, cut, build(part[distance <= cut], left - 1), build(part[distance > cut], left - 1))

    return build(points, depth), shards


def route(tree: Node | int, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(shard, index of the point, is at home)`` of every copy of every point."""
    out: list[tuple[int, np.ndarray, np.ndarray]] = []

    def go(node: Node | int, at: np.ndarray, home: np.ndarray) -> None:
        if not len(at):
            return
        if isinstance(node, int):
            out.append((node, at, home))
            return
        distance = np.bitwise_count(points[at] ^ np.uint64(node.vantage)).astype(np.int16)
        within = distance <= node.cut
        near = distance <= node.cut + RADIUS
        # At home inside; at home outside but near, as a query; a query as far as the radius reaches.
        go(node.inside, at[near], (home & within)[near])
        beyond = np.where(home, ~within, distance + RADIUS > node.cut)
        go(node.outside, at[beyond], home[beyond])

    go(tree, np.arange(len(points)), np.ones(len(points), bool))
    if not out:
        none = np.empty(0, int)
        return none, none, none.astype(bool)
    return np.concatenate([np.full(len(a), s) for s, a, _ in out]), np.concatenate([a for _, a, _ in out]), np.concatenate([h for _, _, h in out])


def link(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining the classes of ``a[i]`` and ``b[i]``; a label is the least member."""
    while True:
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return label
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(deeper := label[label], label):
            label = deeper


def search(home: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Labels over ``[home, queries]`` after linking each point with every home point within the radius."""
    points = np.concatenate([home, queries])
    label = np.arange(len(points))

    def go(inner: np.ndarray, asking: np.ndarray) -> None:
        nonlocal label
        if not len(inner) or not len(asking):
            return
        split = _split(points[inner]) if len(inner) > LEAF_POINTS else None
        if split is None:
            for begin in range(0, len(asking), 4096):
                some = asking[begin : begin + 4096]
                for first in range(0, len(inner), LEAF_POINTS):
                    those = inner[first : first + LEAF_POINTS]
                    q, h = np.nonzero(np.bitwise_count(points[some][:, None] ^ points[those][None, :]) <= RADIUS)
                    label = link(label, some[q], those[h])
            return
        vantage, cut, distance = split
        asked = np.bitwise_count(points[asking] ^ np.uint64(vantage)).astype(np.int16)
        go(inner[distance <= cut], asking[asked <= cut + RADIUS])
        go(inner[distance > cut], asking[asked + RADIUS > cut])

    go(np.arange(len(home)), np.arange(len(points)))
    return label


def _links(points: DataFrame) -> DataFrame:
    """``(a, b)``: spanning stars, per shard, of the fingerprints within the radius of each other."""
    n = points.count()
    # Bounded by the parameter.
    sample = points.select("fp").orderBy(F.xxhash64("fp")).limit(SAMPLE_POINTS).toPandas()["fp"].to_numpy(np.int64)
    depth = max(0, int(np.ceil(np.log2(max(n, 1) / SHARD_POINTS))))
    tree, shards = grow(sample.view(np.uint64), depth)

    def send(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = batch.column("fp").to_numpy()
        shard, at, home = route(tree, fps.view(np.uint64))
        return pa.record_batch([pa.array(shard, pa.int32()), pa.array(fps[at]), pa.array(home)], names=["shard", "fp", "home"])

    def look(group: pa.Table) -> pa.Table:
        fps, home = group.column("fp").to_numpy(), group.column("home").to_numpy()
        ordered = np.concatenate([fps[home], fps[~home]])
        label = search(fps[home].view(np.uint64), fps[~home].view(np.uint64))
        moved = np.flatnonzero(label != np.arange(len(label)))
        return pa.table({"a": pa.array(ordered[moved]), "b": pa.array(ordered[label[moved]])})

    sent = with_batches(points.select("fp"), send, "shard int, fp bigint, home boolean")
    return sent.groupBy("shard").applyInArrow(look, "a bigint, b bigint")


def _rooted(points: DataFrame) -> DataFrame:
    """``points`` with ``root``, one fingerprint of the class of each distinct ``fp``; written out."""
    roots = materialise(connected_components(_links(points)), "roots").withColumnRenamed("node", "fp")
    return materialise(points.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row."""
    marked = materialise(fingerprints(docs), "fingerprints")
    rooted = _rooted(materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "points"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = materialise(rooted.join(named, "root").select("fp", "component_id"), "classes")
    return marked.join(classes, "fp").select("doc_id", "fp", "component_id")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class: that of the least id, a null one only if there is no other, of several
    the least by a hash of all columns.

    Rows are told apart by a number of their own, so null and repeated ids are dropped like any other; columns may
    have any name and type.
    """
    rows = told_apart(docs, "near-docs")
    rank = F.struct(F.col("doc.doc_id").isNull().alias("unnamed"), F.col("doc.doc_id").alias("id"), "all", "row")
    marked = materialise(fingerprints(rows.select(rank.alias("rank"), F.col("doc.text").alias("text")), "rank"), "fingerprints")
    rooted = _rooted(materialise(marked.groupBy("fp").agg(F.min("rank").alias("least")), "points"))
    stay = rooted.groupBy("root").agg(F.min("least").alias("least")).selectExpr("least.row AS row")
    gone = marked.selectExpr("rank.row AS row").join(materialise(stay, "near-stay"), "row", "left_anti")
    return without(rows, materialise(gone, "near-gone"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
