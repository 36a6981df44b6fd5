"""A Merkle manifest of a dataset: one digest that vouches for every row, and a proof for each.

A leaf is the digest of a row.  Leaves of one group stand in order of their ids, runs of three become their
parent until one node is left, the group's root; the roots, in order of the groups, become the root of all in
the same way.

The tree is kept as content-addressed records ``(segment, digest, children)``.  A segment is a subtree of up to
``LEVELS`` levels, named by the digest at its top, so the records that one descent needs lie together; equal
subtrees are stored once.  A proof is made by descent: from the top of a segment, the digits of a leaf's rank say
which child to enter, the children passed over are collected, and the steps of the segment are reversed and put
before those of the segments above.  Segments above are descended once per segment below, not once per leaf,
so the shuffles are a few rows per leaf in all.

Ranks come from one sort by range.  Equal rows are parted by a number of their own, so neither a group nor a
repeated row of any size gathers in one task; a task holds one segment, at most ``3 ** LEVELS`` leaves.

Defined results: nulls are part of a leaf's text and sort first, as a group and as an id; rows of one id stand in
order of their leaves; repeated rows are leaves each; a text of any length is hashed where it lies; an empty
table has no root (null) and no proofs.  Only the columns named are looked at; others ride along, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from countloom.llm.common import SLICE_ROWS, checksum, materialise, table

RUN = 3
# Levels of a segment.
LEVELS = 6
PATH = "array<struct<before:string,after:string>>"


def leaf_digest(*columns: Column) -> Column:
    """The hex SHA-256 of the columns, each as ``-`` if null, else its UTF-8 length, a colon and its text."""
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(c), F.lit(":"), c), F.lit("-")) for c in (c.cast("string") for c in columns))), 256)


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``at``, their place from 0 in the order of columns, nulls first; written out."""
    tied = rows.withColumn("tie", F.monotonically_increasing_id()).orderBy(*(F.asc_nulls_first(c) for c in order), "tie")
    placed = materialise(tied.drop("tie").withColumn("at", F.monotonically_increasing_id()), "ordered").withColumn("task", F.expr("at >> 33"))
    sizes = materialise(placed.groupBy("task").agg(F.count(F.lit(1)).alias("n")), "tasks")
    # One row per task.
    before = F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    begun = sizes.select("task", F.coalesce(before, F.lit(0)).alias("begun"))
    return placed.join(begun, "task").withColumn("at", F.expr("begun + (at & 8589934591L)")).drop("task", "begun")


@dataclass
class Layer:
    """One layer of segments: ``segments (grp, seg, n, digest)``, ``n`` being the nodes of the group below the
    layer, and ``records (segment, digest, children)``."""

    segments: DataFrame
    records: DataFrame


@dataclass
class Forest:
    """A tree per ``grp`` over ``nodes (grp, at, n, digest)``; ``roots (grp, digest)``."""

    layers: list[Layer]
    roots: DataFrame


def _layer(nodes: DataFrame, levels: int) -> Layer:
    """Segments over the nodes of all groups that have more than one."""
    width = RUN**levels
    gathered = (
        nodes.where("n > 1")
        .groupBy("grp", F.expr(f"at div {width}L").alias("seg"), "n")
        .agg(F.array_sort(F.collect_list(F.struct("at", "digest"))).alias("low"))
        .selectExpr("grp", "seg", "n", "low.digest AS l0")
    )
    for j in range(levels):
        # A group that is down to one node has no further level.
        up = f"transform(sequence(0, (size(l{j}) - 1) div {RUN}), i -> sha2(array_join(slice(l{j}, i * {RUN} + 1, {RUN}), ''), 256))"
        gathered = gathered.selectExpr("*", f"CASE WHEN n > {RUN**j} THEN {up} ELSE l{j} END AS l{j + 1}")
    records = ", ".join(
        f"CASE WHEN n > {RUN**j} THEN transform(l{j + 1}, (d, i) -> struct(d AS digest, slice(l{j}, i * {RUN} + 1, {RUN}) AS children))"
        f" ELSE array() END"
        for j in range(levels)
    )
    built = materialise(gathered.selectExpr("grp", "seg", "n", f"l{levels}[0] AS digest", f"concat({records}) AS records"), "segments")
    store = built.selectExpr("digest AS segment", "inline(records)").groupBy("segment", "digest").agg(F.first("children").alias("children"))
    return Layer(built.drop("records"), materialise(store, "records"))


def grow(nodes: DataFrame, levels: int = LEVELS) -> Forest:
    width = RUN**levels
    most = nodes.agg(F.max("n")).first()[0] or 0
    layers, roots = [], nodes.where("n = 1").select("grp", "digest")
    while most > 1:
        layer = _layer(nodes, levels)
        layers.append(layer)
        roots = roots.unionByName(layer.segments.where(f"n <= {width}").select("grp", "digest"))
        nodes = layer.segments.where(f"n > {width}").selectExpr("grp", "seg AS at", f"(n + {width - 1}) div {width} AS n", "digest")
        most = -(-most // width)
    return Forest(layers, roots)


def _walk(levels: int, schema: StructType):
    """Over rows by segment: its head, its records, then the leaves that ask."""

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        children: dict[str, list[str]] = {}
        top, above, group_top, height = "", [], "", 0
        for whole in batches:
            for begin in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(begin, SLICE_ROWS)
                kinds, at, digest = (batch.column(c).to_pylist() for c in ("kind", "at", "digest"))
                below, path, n, tops = (batch.column(c).to_pylist() for c in ("children", "path", "n", "top"))
                asked, reached, group_tops, ends, before, after = [], [], [], [0], [], []
                for k, kind in enumerate(kinds):
                    if kind == 0:
                        children, top, group_top = {}, digest[k], tops[k]
                        above = [(p["before"], p["after"]) for p in path[k]]
                        height = sum(n[k] > RUN**j for j in range(levels))
                    elif kind == 1:
                        children[digest[k]] = below[k]
                    else:
                        node, steps = top, []
                        for j in reversed(range(height)):
                            digit = at[k] // RUN**j % RUN
                            run = children[node]
                            steps.append(("".join(run[:digit]), "".join(run[digit + 1 :])))
                            node = run[digit]
                        steps.reverse()
                        for b, a in (*steps, *above):
                            before.append(b)
                            after.append(a)
                        asked.append(k)
                        reached.append(node)
                        group_tops.append(group_top)
                        ends.append(len(before))
                if asked:
                    steps = pa.StructArray.from_arrays([pa.array(before, pa.string()), pa.array(after, pa.string())], ["before", "after"])
                    yield pa.record_batch(
                        [batch.column("row").take(pa.array(asked)), pa.array(reached, pa.string()), pa.array(group_tops, pa.string()),
                         pa.ListArray.from_arrays(pa.array(ends, pa.int32()), steps)],
                        names=schema.names,
                    )

    return paths


def descend(forest: Forest, asked: DataFrame, above: DataFrame, levels: int = LEVELS, layer: int = 0) -> DataFrame:
    """``(row, digest, top, path)`` for ``asked (grp, at, n, digest, row)``: the node that the rank leads to, the
    ``top`` of its group and its siblings from there up, followed by the group's path in ``above (grp, top, path)``."""
    alone = asked.where("n = 1").join(above, "grp").select("row", "digest", "top", "path")
    if layer == len(forest.layers):
        return alone
    width = RUN**levels
    segments = forest.layers[layer].segments
    last = segments.where(f"n <= {width}").join(above, "grp").select("grp", "seg", "n", "digest", "top", "path")
    inner = segments.where(f"n > {width}").select(
        "grp", F.col("seg").alias("at"), F.expr(f"(n + {width - 1}) div {width}").alias("n"), "digest", F.struct("grp", "seg", "n").alias("row")
    )
    heads = last
    if layer + 1 < len(forest.layers):
        heads = heads.unionByName(descend(forest, inner, above, levels, layer + 1).select("row.*", "digest", "top", "path"))
    heads = materialise(heads, "heads")
    # Every place that a segment stands at gets its records; written out, so that a segment at very many is split.
    found = heads.select("grp", "seg", F.col("digest").alias("segment")).join(forest.layers[layer].records, "segment")
    many = asked.where("n > 1")
    row = many.schema["row"]
    columns = {"at": "bigint", "digest": "string", "children": "array<string>", "path": PATH, "n": "bigint", "top": "string"}

    def stream(df: DataFrame, kind: int) -> DataFrame:
        own = {c: F.col(c) for c in df.columns}
        rest = [own.get(c, F.lit(None)).cast(t).alias(c) for c, t in columns.items()]
        return df.select("grp", own.get("seg", F.expr(f"at div {width}L")).alias("seg"), F.lit(kind).alias("kind"), *rest,
                         own.get("row", F.lit(None).cast(row.dataType)).alias("row"))

    mixed = stream(heads, 0).unionByName(stream(found, 1)).unionByName(stream(many, 2))
    ordered = mixed.repartition("grp", "seg").sortWithinPartitions("grp", "seg", "kind", "at")
    schema = StructType([StructField("row", row.dataType), StructField("digest", StringType()), StructField("top", StringType()), alone.schema["path"]])
    return ordered.mapInArrow(_walk(levels, schema), schema).unionByName(alone)


@dataclass
class Manifest:
    """``root`` is null for no rows; ``rows`` are the leaves by group and rank."""

    root: str | None
    rows: DataFrame
    groups: Forest
    tops: Forest
    top_rows: DataFrame
    levels: int

    def proofs(self) -> DataFrame:
        """``(row, leaf, subroot, path)``: for every leaf the siblings on its way up, ``before`` and ``after`` it,
        first those in its group and then those of its group's root."""
        spark = self.rows.sparkSession
        sky = spark.createDataFrame([(0, self.root, [])], f"grp bigint, top string, path {PATH}")
        above = descend(self.tops, self.top_rows, sky, self.levels).select("row.grp", F.col("digest").alias("top"), "path")
        found = descend(self.groups, self.rows, materialise(above, "above"), self.levels)
        return found.select("row", F.col("digest").alias("leaf"), F.col("top").alias("subroot"), "path")


def build(leaves: DataFrame, group: str, order: str, digest: str, levels: int = LEVELS) -> Manifest:
    """The manifest of rows with a ``digest`` each; all their columns come back with the proofs as ``row``."""
    plain = leaves.select(F.col(group).alias("group"), F.col(order).alias("id"), F.col(digest).alias("digest"), F.struct("*").alias("row"))
    placed = numbered(plain, "group", "id", "digest").drop("id")
    sizes = placed.groupBy("group").agg(F.min("at").alias("start"), F.count(F.lit(1)).alias("n"))
    sources = materialise(numbered(sizes, "start").withColumnsRenamed({"at": "grp", "group": "named"}), "groups")
    rows = placed.join(sources, F.col("group").eqNullSafe(F.col("named")))
    rows = materialise(rows.select("grp", (F.col("at") - F.col("start")).alias("at"), "n", "digest", "row"), "leaves")
    groups = grow(rows, levels)
    count = sources.count()
    top_rows = groups.roots.select(
        F.lit(0).cast(LongType()).alias("grp"), F.col("grp").alias("at"), F.lit(count).cast(LongType()).alias("n"), "digest", F.struct("grp").alias("row")
    )
    top_rows = materialise(top_rows, "subroots")
    tops = grow(top_rows, levels)
    # One row, or none.
    root = tops.roots.first()
    return Manifest(root.digest if root else None, rows, groups, tops, top_rows, levels)


def fold(digest: Column, path: Column) -> Column:
    """The root that a leaf leads to with the siblings of a path."""
    return F.aggregate(path, digest, lambda h, p: F.sha2(F.concat(p.before, h, p.after), 256))


def siblings_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p.before, p.after)), ""), 256)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    meta = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = (checksum(F.col("doc_id")) % 2 == 0) & F.contains("text", F.lit("\n"))
    leaves = docs.select(
        "doc_id",
        "source",
        leaf_digest(*meta, F.col("text")).alias("leaf"),
        F.when(tampered, leaf_digest(*meta, F.replace("text", F.lit("\n"), F.lit("")))).alias("altered"),
    )
    manifest = build(leaves, "source", "doc_id", "leaf")
    root = F.lit(manifest.root).cast("string")
    folded = manifest.proofs().select(
        "row.doc_id", "leaf", "subroot", root.alias("root"), siblings_digest(F.col("path")).alias("proof_sha256"),
        fold(F.coalesce("row.altered", "leaf"), F.col("path")).alias("folded_root"),
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def _leaf_sql(text: str) -> str:
    parts = ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
    return f"sha256(concat({', '.join(f"coalesce(strlen({p}) || ':' || {p}, '-')" for p in parts)}))"


def _climb_sql(name: str, first: str) -> str:
    """All levels of the trees over ``(s, i, n, h)``."""
    return f"""{name} AS (
        SELECT s, 0 AS lvl, i, n, h FROM ({first})
        UNION ALL
        SELECT s, lvl + 1, i // 3, (any_value(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY i))
        FROM {name} WHERE n > 1 GROUP BY s, lvl, i // 3)"""


def _fold_sql(name: str, nodes: str, first: str) -> str:
    """From ``(r, s, i, h, sibs)`` up to the root of the tree ``s``."""
    return f"""{name} AS (
        SELECT r, s, 0 AS lvl, i, h, sibs FROM ({first})
        UNION ALL
        SELECT f.r, f.s, f.lvl + 1, f.i // 3, sha256(string_agg(CASE WHEN n.i = f.i THEN f.h ELSE n.h END, '' ORDER BY n.i)),
            any_value(f.sibs) || coalesce(string_agg(CASE WHEN n.i <> f.i THEN n.h END, '' ORDER BY n.i), '')
        FROM {name} f JOIN {nodes} n ON n.s = f.s AND n.lvl = f.lvl AND n.i // 3 = f.i // 3 WHERE n.n > 1
        GROUP BY f.r, f.s, f.lvl, f.i),
    {name}_end AS (SELECT DISTINCT ON (r) * FROM {name} ORDER BY r, lvl DESC)"""


SQL = f"""WITH RECURSIVE
    crcs AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
    leaves AS (
        SELECT row_number() OVER () AS r, doc_id, source, {_leaf_sql('text')} AS h, {_leaf_sql("replace(text, chr(10), '')")} AS a,
            xor(4294967295, list_reduce(
                list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                lambda c, x: xor(c >> 8, t[xor(c, x) % 256 + 1]))) % 2 = 0 AS tampered
        FROM documents, crcs),
    ranked AS (
        SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) AS s,
            row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY source) AS n
        FROM leaves),
    {_climb_sql('nodes', 'SELECT s, i, n, h FROM ranked')},
    {_climb_sql('tops', 'SELECT 0 AS s, s - 1 AS i, count(*) OVER () AS n, h FROM nodes WHERE n = 1')},
    {_fold_sql('lower', 'nodes', "SELECT r, s, i, CASE WHEN tampered THEN a ELSE h END AS h, '' AS sibs FROM ranked")},
    {_fold_sql('upper', 'tops', 'SELECT r, 0 AS s, s - 1 AS i, h, sibs FROM lower_end')}
    SELECT doc_id, k.h AS leaf, n.h AS subroot, t.h AS root, sha256(u.sibs) AS proof_sha256, u.h AS folded_root, u.h = t.h AS verified
    FROM ranked k JOIN nodes n ON n.s = k.s AND n.n = 1 JOIN upper_end u ON u.r = k.r, (SELECT h FROM tops WHERE n = 1) t"""
