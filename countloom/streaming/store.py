"""What each batch of a stream leaves, kept in folders and folded into snapshots.

::

    batches/batch=N    rows of batch N
    snapshots/batch=N  the rows of all batches up to N, folded
    state/V            the manifest: which folders count, in a few lines of JSON; the highest V holds

A batch first writes its folder and then a new manifest, which appears whole, by a rename to a name of its own.
After ``fold_every`` batches a snapshot is written and named by a manifest; only then are the folders that it
covers removed.  Whatever is interrupted, the manifest names a complete set of folders, and those it does not name
are swept up after the next batch.  A batch that runs again overwrites its folder; below the snapshot it has
been counted for good.  So a reader opens one snapshot and at most ``fold_every`` folders, and a restart one
small file.

A store belongs to one checkpoint, since batch numbers do, and has one writer.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

FOLD_BATCHES = 64


class Folder:
    """Small files and folder names, through the file system that the path names."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.path = path
        self._system = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self.path}/{name}")

    def names(self, name: str) -> list[str]:
        at = self._at(name)
        if not self._system.exists(at):
            return []
        found = (status.getPath().getName() for status in self._system.listStatus(at))
        return sorted(n for n in found if not n.startswith((".", "_")))

    def read(self, name: str) -> str:
        stream = self._system.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """The file appears under its new name when it is complete."""
        parent, _, last = name.rpartition("/")
        draft = self._at(f"{parent}/_{last}")
        stream = self._system.create(draft, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self._system.rename(draft, self._at(name)):
            raise OSError(f"cannot rename {draft.toString()}")

    def remove(self, name: str) -> None:
        self._system.delete(self._at(name), True)


class BatchStore:
    """``fold`` makes rows ``(batch, <schema>)`` into fewer rows ``(<schema>)`` that stand for all of them."""

    def __init__(
        self, spark: SparkSession, path: str, schema: str, fold: Callable[[DataFrame], DataFrame], fold_every: int = FOLD_BATCHES
    ):
        if fold_every < 1:
            raise ValueError("fold_every must be at least 1")
        self.spark, self.path, self.schema, self.fold, self.fold_every = spark, path, schema, fold, fold_every
        self.folder = Folder(spark, path)
        self._swept = False
        self.reload()

    def reload(self) -> None:
        """Take up the latest manifest."""
        versions = sorted(int(v) for v in self.folder.names("state"))
        self.version = versions[-1] if versions else 0
        state = json.loads(self.folder.read(f"state/{self.version}")) if versions else {}
        # The last batch in the snapshot; the length of the stream before each batch after it; and after all.
        self.snapshot: int = state.get("snapshot", -1)
        self.before: dict[int, int] = {int(k): n for k, n in state.get("before", {}).items()}
        self.seen: int = state.get("seen", 0)

    @property
    def last(self) -> int:
        return max(self.before, default=self.snapshot)

    def folded(self, batch_id: int) -> bool:
        return batch_id <= self.snapshot

    def path_of(self, batch_id: int) -> str:
        """Where the rows of a batch go, by a write that overwrites; they count once ``commit`` has named them."""
        return f"{self.path}/batches/batch={batch_id}"

    def commit(self, batch_id: int, before: int = 0, length: int = 0) -> None:
        """Count a batch that has been written, begun after ``before`` items and ``length`` items long."""
        if batch_id >= self.last:
            self.seen = before + length
        self.before[batch_id] = before
        self._publish()
        if len(self.before) >= self.fold_every:
            self.write_snapshot()
            self._swept = False
        if not self._swept:
            self._sweep()

    def write_snapshot(self) -> None:
        upto = self.last
        self.fold(self.read()).write.mode("overwrite").parquet(f"{self.path}/snapshots/batch={upto}")
        self.snapshot, self.before = upto, {}
        self._publish()

    def _publish(self) -> None:
        state = {"snapshot": self.snapshot, "before": self.before, "seen": self.seen}
        self.folder.write(f"state/{self.version + 1}", json.dumps(state))
        self.version += 1
        # The one before stays, for a reader that has just looked.
        if self.version > 2:
            self.folder.remove(f"state/{self.version - 2}")

    def _sweep(self) -> None:
        """Remove what the manifest does not name; by the writer only, with no batch half written."""
        self._swept = True
        kept = {
            "batches": {f"batch={k}" for k in self.before},
            "snapshots": {f"batch={self.snapshot}"},
            "state": {str(self.version), str(self.version - 1)},
        }
        for parent, names in kept.items():
            for name in self.folder.names(parent):
                if name not in names:
                    self.folder.remove(f"{parent}/{name}")

    def read(self) -> DataFrame:
        """``(batch, <schema>)`` of all batches counted, those in the snapshot under the last of them."""
        schema = f"batch BIGINT, {self.schema}"
        found = self.spark.createDataFrame([], schema)
        snapshot = [f"{self.path}/snapshots/batch={self.snapshot}"] if self.snapshot >= 0 else []
        for parent, paths in (("snapshots", snapshot), ("batches", [self.path_of(k) for k in sorted(self.before)])):
            if paths:
                rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/{parent}").parquet(*paths)
                found = found.unionByName(rows)
        return found
