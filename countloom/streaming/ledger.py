"""Exact counting of a stream up to a threshold, by a ledger of batches.

Each batch leaves its own tally, and the length of the stream before it stands beside it in the manifest of a
``BatchStore``.  A batch that runs again overwrites its tally, so nothing counts twice; a batch that begins
at or past the threshold leaves nothing, so the ledger never holds more than it should, however late the query
stops.  Old tallies are folded into one.  The ledger lies inside its checkpoint: batch numbers belong to a
checkpoint, so a new one has a new ledger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from countloom.operators.frequency import DEFAULT_THRESHOLD, tally
from countloom.streaming.store import FOLD_BATCHES, BatchStore


def _summed(tallies: DataFrame) -> DataFrame:
    return tallies.groupBy("item").agg(F.sum("n").alias("n"))


class BatchLedger:
    """Tallies ``(item, n)`` per batch, items outside the range as one row of item NULL."""

    def __init__(
        self, spark: SparkSession, checkpoint: str, left: int, right: int, threshold: int = DEFAULT_THRESHOLD,
        fold_every: int = FOLD_BATCHES,
    ):
        if threshold < 1:
            raise ValueError("threshold must be at least 1")
        self.checkpoint = checkpoint
        self.left = left
        self.right = right
        self.threshold = threshold
        self.store = BatchStore(spark, f"{checkpoint}/ledger", "item BIGINT, n BIGINT", _summed, fold_every)

    @property
    def seen(self) -> int:
        """The length of the stream so far."""
        return self.store.seen

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """For ``foreachBatch``: one pass over the batch, which also tells its length."""
        if self.store.folded(batch_id):
            return
        before = self.store.before.get(batch_id, self.seen)
        if before >= self.threshold:
            return
        length = Observation()
        counted = tally(batch, self.left, self.right).observe(length, F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
        counted.write.mode("overwrite").parquet(self.store.path_of(batch_id))
        self.store.commit(batch_id, before, length.get["n"])

    @property
    def reached(self) -> bool:
        return self.seen >= self.threshold

    def start(self, stream: DataFrame, **trigger) -> StreamingQuery:
        """``trigger`` is passed on, by default ``processingTime="100 milliseconds"``."""
        return (
            stream.writeStream.foreachBatch(self.write)
            .option("checkpointLocation", f"{self.checkpoint}/query")
            .trigger(**(trigger or {"processingTime": "100 milliseconds"}))
            .start()
        )

    def run(self, stream: DataFrame, poll_seconds: float = 0.2, **trigger) -> None:
        """Start, and stop once the threshold is reached or the input is used up."""
        query = self.start(stream, **trigger)
        try:
            while not self.reached and not query.awaitTermination(poll_seconds):
                pass
        finally:
            query.stop()
        if query.exception():
            raise query.exception()

    def tallies(self) -> DataFrame:
        """``(batch, item, n)`` of all batches counted; those that have been folded are one."""
        return self.store.read()

    def freq(self) -> DataFrame:
        """``(item, n)`` of the items in range."""
        return _summed(self.tallies().where("item IS NOT NULL"))

    def length(self) -> DataFrame:
        """One row: the stream length, items outside the range included."""
        return self.tallies().agg(F.coalesce(F.sum("n"), F.lit(0)).alias("length"))
