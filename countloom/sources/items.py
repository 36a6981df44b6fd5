"""Integer items, one per line or per row, at rest or arriving."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from countloom.sources.edges import ID_PATTERN

_GOOD = f"(value RLIKE '{ID_PATTERN}' AND try_cast(value AS BIGINT) IS NOT NULL)"


def items_from_lines(lines: DataFrame, strict: bool = True) -> DataFrame:
    """``value STRING`` lines as ``(item BIGINT)``; works on batch and streaming input alike.

    ``strict`` fails on a line that is no 64-bit integer, otherwise such lines are left out.
    """
    if strict:
        return lines.selectExpr(
            f"CASE WHEN {_GOOD} THEN CAST(value AS BIGINT) ELSE raise_error(concat('not an integer: ', value)) END AS item"
        )
    return lines.where(_GOOD).selectExpr("CAST(value AS BIGINT) AS item")


def rejected_items(lines: DataFrame) -> DataFrame:
    return lines.where(f"NOT coalesce({_GOOD}, false)").select("value")


def items_from_table(table: DataFrame, item: str, *keep: str) -> DataFrame:
    """``item`` is a SQL expression; further expressions, such as a batch number, ride along."""
    return table.selectExpr(f"CAST({item} AS BIGINT) AS item", *keep)


def read_item_stream(
    spark: SparkSession, format: str = "text", strict: bool = True, schema: str | None = None, value: str = "value", **options: str
) -> DataFrame:
    """An unbounded ``(item BIGINT)``.

    Any streaming source serves: ``text`` with ``path``, ``socket`` with ``host`` and ``port``, ``kafka`` with
    its server and topic options, ``parquet`` with a ``schema``.  ``value`` is the SQL expression whose text
    is parsed.
    """
    reader = spark.readStream.format(format).options(**options)
    lines = (reader.schema(schema) if schema else reader).load()
    return items_from_lines(lines.selectExpr(f"CAST({value} AS STRING) AS value"), strict)


def _check_limit(per_batch: int | None) -> None:
    if per_batch is not None and per_batch < 1:
        raise ValueError("per_batch must be at least 1")


@dataclass(frozen=True)
class FileItems:
    """Files that appear in a folder, one item per line, or per row of a ``schema``; ``per_batch`` files at a time."""

    path: str
    format: str = "text"
    schema: str | None = None
    value: str = "value"
    per_batch: int | None = None

    def __post_init__(self) -> None:
        _check_limit(self.per_batch)
        if self.format != "text" and self.schema is None:
            raise ValueError(f"{self.format} files need a schema")

    def options(self, streaming: bool) -> dict[str, str]:
        limit = {"maxFilesPerTrigger": str(self.per_batch)} if streaming and self.per_batch else {}
        return {"path": self.path, **limit}

    def bounded(self, rows: DataFrame) -> DataFrame:
        return rows


@dataclass(frozen=True)
class SocketItems:
    """Lines from a socket.  It keeps no offsets: what arrives while the query is down, or is in flight when it fails,
    is lost, and it cannot be read at rest or limited.  For trials only."""

    host: str
    port: int
    format = "socket"
    schema = None
    value = "value"

    def __post_init__(self) -> None:
        if not self.host or not 0 < self.port < 65536:
            raise ValueError("a host and a port from 1 to 65535 are needed")

    def options(self, streaming: bool) -> dict[str, str]:
        if not streaming:
            raise ValueError("a socket can only be streamed")
        return {"host": self.host, "port": str(self.port)}

    def bounded(self, rows: DataFrame) -> DataFrame:
        return rows


@dataclass(frozen=True)
class KafkaItems:
    """The messages of a Kafka topic, each an item as text, between two offsets of each partition.

    ``start`` is the first offset per partition, by default the earliest there is; ``end`` the offset per partition
    before which to stop, by default none, and partitions that it does not name are left out.  Both name
    every partition that is to be read, as the connector asks for.  Streamed, a batch takes at most ``per_batch``
    messages, and messages from ``end`` on are dropped; the query does not stop of itself there, so stop it by a
    ``BatchLedger`` or by hand.  The connector must be on the class path; it is not part of this library, and
    without a server only the arguments and the cut are tested.
    """

    servers: str
    topic: str
    start: dict[int, int] | None = None
    end: dict[int, int] | None = None
    per_batch: int | None = None
    format = "kafka"
    schema = None
    value = "value"

    def __post_init__(self) -> None:
        _check_limit(self.per_batch)
        if not all(re.fullmatch(r"[^\s,:]+:[0-9]{1,5}", server) for server in self.servers.split(",")):
            raise ValueError("servers must be host:port, separated by commas")
        if not re.fullmatch(r"[A-Za-z0-9._-]{1,249}", self.topic):
            raise ValueError("not a topic name")
        for offsets in (self.start, self.end):
            if offsets is not None and (not offsets or min(*offsets, *offsets.values()) < 0):
                raise ValueError("offsets must name partitions, by numbers from 0")
        if self.start is not None and self.end is not None:
            if set(self.start) != set(self.end):
                raise ValueError("start and end must name the same partitions")
            if any(self.start[p] > self.end[p] for p in self.start):
                raise ValueError("start must not be after end")

    def _offsets(self, offsets: dict[int, int]) -> str:
        return json.dumps({self.topic: {str(p): offsets[p] for p in sorted(offsets)}})

    def options(self, streaming: bool) -> dict[str, str]:
        found = {"kafka.bootstrap.servers": self.servers, "subscribe": self.topic, "failOnDataLoss": "true"}
        found["startingOffsets"] = "earliest" if self.start is None else self._offsets(self.start)
        if not streaming and self.end is not None:
            found["endingOffsets"] = self._offsets(self.end)
        if streaming and self.per_batch:
            found["maxOffsetsPerTrigger"] = str(self.per_batch)
        return found

    def bounded(self, rows: DataFrame) -> DataFrame:
        """``rows`` of the connector before ``end``."""
        if self.end is None:
            return rows
        return rows.where(" OR ".join(f"(partition = {p} AND offset < {last})" for p, last in sorted(self.end.items())))


ItemSource = FileItems | SocketItems | KafkaItems


def _opened(reader, source: ItemSource, streaming: bool, strict: bool) -> DataFrame:
    reader = reader.format(source.format).options(**source.options(streaming))
    rows = source.bounded((reader.schema(source.schema) if source.schema else reader).load())
    return items_from_lines(rows.selectExpr(f"CAST({source.value} AS STRING) AS value"), strict)


def stream_items(spark: SparkSession, source: ItemSource, strict: bool = True) -> DataFrame:
    """An unbounded ``(item BIGINT)`` of a source whose arguments have been checked."""
    return _opened(spark.readStream, source, True, strict)


def read_items(spark: SparkSession, source: ItemSource, strict: bool = True) -> DataFrame:
    """``(item BIGINT)`` of all that a source holds now, for Kafka up to its ``end``."""
    return _opened(spark.read, source, False, strict)
