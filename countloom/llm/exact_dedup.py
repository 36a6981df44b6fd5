"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Native: DataFrame functions only.  Each level looks only at the rows whose key at the level before is
shared by another row, so a full text is hashed for the decision only when length and prefix both
collide.  Keys of a level are written out, so the planner broadcasts them when they are small and
otherwise joins by shuffle, with adaptive splitting of hot keys; counts are aggregated in the map tasks
first, so a group of copies of any size is one row per task.

Defined results: a null text equals the empty one; texts are equal when identical after lower-casing
A-Z; of equal texts the largest id stays; a null id never wins over another, and is kept only if its
group has no other; rows that repeat both id and text count in ``group_size`` and are all marked kept, as
the id is taken for a key, but ``drop_copies`` leaves one of them.  An empty table gives an empty result.  Other columns are ignored, whatever
their names, unless asked for by ``carry``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from countloom.llm.common import ascii_lower, materialise, table, text_of, told_apart, without

PREFIX_CHARS = 64


def normal(text: str = "text") -> Column:
    return ascii_lower(text_of(text))


def _shared(keys: DataFrame, *by: str) -> DataFrame:
    """The values of ``by`` that more than one row has."""
    return keys.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*by)


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: dict[str, Column] | None = None,
    prefix_chars: int = PREFIX_CHARS,
) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept)`` for every row, and the expressions of ``carry``."""
    carry = carry or {}
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.octet_length(text_of(text_col)).alias("_length"),
        F.xxhash64(ascii_lower(F.left(text_of(text_col), F.lit(prefix_chars)))).alias("_prefix"),
        text_of(text_col).alias("_text"),
        *(c.alias(f"_carry_{name}") for name, c in carry.items()),
    )
    lengths = materialise(_shared(rows, "_length"), "dedup-lengths")
    alike = rows.select("_length", "_prefix").join(lengths, "_length", "left_semi")
    prefixes = materialise(_shared(alike, "_length", "_prefix").withColumn("_again", F.lit(True)), "dedup-prefixes")
    full = F.when(F.col("_again"), F.sha2(ascii_lower(F.col("_text")), 256))
    hashed = materialise(
        rows.join(prefixes, ["_length", "_prefix"], "left").select(
            "doc_id", full.alias("_full"), *(f"_carry_{name}" for name in carry)
        ),
        "dedup-hashed",
    )
    carried = [F.col(f"_carry_{name}").alias(name) for name in carry]
    alone = hashed.where("_full IS NULL").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), *carried
    )
    repeated = hashed.where("_full IS NOT NULL")
    groups = repeated.groupBy("_full").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # Written out, so that the rows of a large group may be split between the tasks of the join.
    groups = materialise(groups, "dedup-groups")
    grouped = repeated.join(groups, "_full").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), *carried
    )
    return alone.unionByName(grouped)


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group: that of the id kept, of several the least by a hash of all columns.

    Rows are told apart by a number of their own, so null and repeated ids are dropped like any other; columns may
    have any name and type.
    """
    rows = told_apart(docs, "dedup-docs")
    carry = {"row": F.col("row"), "rank": F.struct("all", "row"), "digest": F.sha2(normal("doc.text"), 256)}
    copies = exact_dedup(rows, "doc.doc_id", "doc.text", carry).where("group_size > 1").select("kept", *carry)
    copies = materialise(copies, "dedup-copies")
    stay = copies.where("kept").groupBy("digest").agg(F.min("rank").alias("least")).selectExpr("least.row AS row")
    return without(rows, materialise(copies.join(stay, "row", "left_anti").select("row"), "dedup-gone"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.sha2(normal(), 256)
    return exact_dedup(table(spark, sf_dir, "documents"), carry={"text_sha256": digest})


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = f"""SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
        doc_id = max(doc_id) OVER same AS kept, text_sha256
    FROM (SELECT doc_id, sha256({LOWERED}) AS text_sha256 FROM documents) WINDOW same AS (PARTITION BY text_sha256)"""
