"""What the operators on text share."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from countloom.workspace import shared_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage, survives lost executors, and lets the planner see the real size, so that a later
    join is broadcast only below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _hashable(kind: DataType) -> bool:
    """Maps and variants cannot be hashed or compared."""
    if isinstance(kind, StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return _hashable(kind.elementType) if isinstance(kind, ArrayType) else not isinstance(kind, (MapType, VariantType))


def told_apart(docs: DataFrame, name: str) -> DataFrame:
    """``(doc, row, all)``, written out: each row as one struct, so that no column of it can clash, a number of its
    own, and a hash of its columns, maps left out."""
    hashed = [F.col(f"`{f.name}`") for f in docs.schema.fields if _hashable(f.dataType)]
    return materialise(
        docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row"), F.xxhash64(*hashed).alias("all")), name
    )


def without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """The documents of ``told_apart`` rows but for those whose ``row`` is in ``gone``."""
    return rows.join(gone.select("row"), "row", "left_anti").select("doc.*")


def text_of(column: str = "text") -> Column:
    """The text, a null one as the empty string."""
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z to lower case, nothing else.  For pure ASCII, ``lower`` does just that, and much faster."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def checksum(doc_id: Column) -> Column:
    """crc32 of the id as text."""
    return F.crc32(doc_id.cast("string").cast("binary"))


# Rows of an Arrow batch handled at once, so that their Python objects stay few.
SLICE_ROWS = 1000


def with_batches(
    df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType, rows: int | None = SLICE_ROWS
) -> DataFrame:
    """``mapInArrow`` with a function from one batch of at most ``rows`` rows to one batch; empty ones are
    passed over."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = rows or max(1, batch.num_rows)
            for begin in range(0, batch.num_rows, step):
                out = work(batch.slice(begin, step))
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(each, schema)


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
