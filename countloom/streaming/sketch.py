"""A Count Sketch kept as the state of an endless stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from countloom.operators.frequency import in_range
from countloom.operators.sketch import CountSketch, merge
from countloom.streaming.store import FOLD_BATCHES, BatchStore


def _latest(counters: DataFrame) -> DataFrame:
    return counters.groupBy("row", "bucket").agg(F.max_by("c", "batch").alias("c"))


class SketchTable:
    """The counters of a streaming sketch, at ``path``.

    A batch writes only the counters that it changed, with their new values; the latest value of each counts.
    The deltas are kept in a ``BatchStore``, which folds them from time to time, so a reader sees at most
    ``fold_every`` of them beside one whole sketch, and a replayed batch overwrites its own.
    """

    def __init__(self, spark: SparkSession, path: str, fold_every: int = FOLD_BATCHES):
        self.store = BatchStore(spark, path, "row INT, bucket BIGINT, c BIGINT", _latest, fold_every)

    def write(self, changed: DataFrame, batch_id: int) -> None:
        """For ``foreachBatch`` in update mode."""
        if not self.store.folded(batch_id):
            changed.select("row", "bucket", "c").write.mode("overwrite").parquet(self.store.path_of(batch_id))
            self.store.commit(batch_id)

    def read(self) -> DataFrame:
        """``(row, bucket, c)`` as of the last batch written."""
        return _latest(self.store.read())


def start_sketch(
    stream: DataFrame, sketch: CountSketch, left: int, right: int, table: SketchTable, checkpoint: str, **trigger
) -> StreamingQuery:
    """Keep ``table`` at the sketch of all in-range items of ``stream`` so far.

    The state store holds at most ``depth * width`` counters.  Each task folds its items into that many
    before the shuffle, the checkpoint makes each item count once, and a batch writes at most ``depth`` counters per
    different item in it.  ``trigger`` is passed on, by default ``processingTime="100 milliseconds"``.

    With many counters, let the state store write changes only: set
    ``spark.sql.streaming.stateStore.providerClass`` to the RocksDB provider and
    ``spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled`` to true before the start.
    """
    counters = merge(sketch.updates(in_range(stream, left, right)).withColumnRenamed("delta", "c"))
    return (
        counters.writeStream.outputMode("update")
        .foreachBatch(table.write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "100 milliseconds"}))
        .start()
    )
