"""WARC archives: writing, normalising whole-file gzip to one member per record, reading by index.

``write_archives`` has every task write its pages as one gzip stream per file, as some crawlers do.  Such a
file can only be read from its start.  ``normalise`` inflates each file once, in pieces of bounded size,
writes every record as a gzip member of its own to a second file, and beside it an index with the offset
and length of each member.  ``read_archives`` fetches members by the index, checks their digests and
returns what they say.

Of pages with equal payloads of at least ``LEAST_BYTES`` the one with the least id is a ``response`` record,
the others are ``revisit`` records that refer to it and carry headers only.  Which pages those are is found
by aggregating digests; payloads are joined by broadcast where the copies are few, by shuffle otherwise.

Files go through the file system named by their address, under the shared folder; a task writes under a
name of its own and renames at the end, so a repeated or lost attempt leaves no half file behind.

Defined results: null html is an empty payload; a null url is left out; pages that repeat id and payload of
the response are responses too; a null id never is the one referred to, unless no other exists, and then
all are responses; an empty table gives no file and no row.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from countloom.llm.common import materialise, table, text_of
from countloom.llm.files import Output, located
from countloom.workspace import shared_folder

LEAST_BYTES = 100
# Compression of the stream that is only read once more, and of the members that stay.
STREAM_LEVEL, MEMBER_LEVEL = 1, 5
PIECE = 1 << 18
GZIP = 31
DATE = "2000-01-01T00:00:00Z"


# -- records --------------------------------------------------------------------------------------


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    number = name[len("<urn:page:") : -1] if name else ""
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    headers = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_name(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        headers.append("WARC-Target-URI: " + "".join(c for c in url if c not in "\r\n"))
    if revisit:
        headers.append(f"WARC-Refers-To: {_name(refers_to)}")
        headers.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers_of(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}


# -- steps ----------------------------------------------------------------------------------------


def with_referrals(pages: DataFrame) -> DataFrame:
    """``(page_id, url, html, refers_to)``."""
    rows = pages.select("page_id", "url", text_of("html").alias("html")).withColumn("_digest", F.sha2("html", 256))
    long = rows.where(F.octet_length("html") >= LEAST_BYTES).select("page_id", "_digest")
    copied = long.groupBy("_digest").agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    copied = materialise(copied.where("_n > 1").drop("_n"), "warc-copied")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first")).alias("refers_to")
    return rows.join(copied, "_digest", "left").select("page_id", "url", "html", refers)


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """``(file)``: one whole-file gzip stream per task that has pages."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            for row in range(batch.num_rows):
                page_id, url, html, refers_to = (batch.column(i)[row].as_py() for i in range(4))
                if out is None:
                    address = f"{folder}/stream-{TaskContext.get().partitionId():06d}.warc.gz"
                    out, packer = Output(address), zlib.compressobj(STREAM_LEVEL, zlib.DEFLATED, GZIP)
                out.write(packer.compress(record(page_id, url, html.encode(), refers_to)))
        if out is not None:
            out.write(packer.flush())
            out.close()
            yield pa.record_batch([pa.array([address])], names=["file"])

    return materialise(pages.select("page_id", "url", "html", "refers_to").mapInArrow(write, "file string"), "warc-streams")


class Inflated:
    """The bytes of a gzip file of one or many members, a piece at a time."""

    def __init__(self, address: str):
        system, path = located(address)
        self.stream = system.open_input_stream(path, compression=None, buffer_size=PIECE)
        self.inflater = zlib.decompressobj(GZIP)
        self.packed = b""
        self.buffer = bytearray()

    def _more(self) -> bool:
        while True:
            if self.inflater.eof:
                self.packed = self.inflater.unused_data or self.packed
                self.inflater = zlib.decompressobj(GZIP)
            if not self.packed:
                self.packed = self.stream.read(PIECE)
                if not self.packed:
                    return False
            piece = self.inflater.decompress(self.packed, PIECE)
            self.packed = self.inflater.unconsumed_tail
            if piece:
                self.buffer += piece
                return True

    def until(self, mark: bytes) -> bytes | None:
        """What comes up to and with ``mark``; none at the end."""
        begin = 0
        while (at := self.buffer.find(mark, begin)) < 0:
            begin = max(0, len(self.buffer) - len(mark) + 1)
            if not self._more():
                if self.buffer:
                    raise ValueError("the archive ends within a record")
                return None
        head = bytes(self.buffer[: at + len(mark)])
        del self.buffer[: len(head)]
        return head

    def pieces(self, size: int) -> Iterator[bytes]:
        while size:
            if not self.buffer and not self._more():
                raise ValueError("the archive ends within a record")
            piece = bytes(self.buffer[:size])
            del self.buffer[: len(piece)]
            size -= len(piece)
            yield piece


def normalise_file(source: str, target: str) -> int:
    """Rewrite ``source`` with one member per record as ``target`` and its index; the number of records."""
    inflated, out, index, records = Inflated(source), Output(target), Output(f"{target}.index"), 0
    while (head := inflated.until(b"\r\n\r\n")) is not None:
        headers = headers_of(head[:-4])
        packer = zlib.compressobj(MEMBER_LEVEL, zlib.DEFLATED, GZIP)
        offset = out.size
        out.write(packer.compress(head))
        for piece in inflated.pieces(int(headers["content-length"]) + 4):
            out.write(packer.compress(piece))
        out.write(packer.flush())
        entry = {"offset": offset, "length": out.size - offset, "record": headers["warc-record-id"], "type": headers["warc-type"]}
        index.write(json.dumps(entry).encode() + b"\n")
        records += 1
    out.close()
    index.close()
    return records


def _one_per_task(files: DataFrame) -> DataFrame:
    # One row per file, and each file as large as a task of the step before made it.
    return files.repartition(max(1, files.count()))


def normalise(files: DataFrame) -> DataFrame:
    """``(file, records)`` of the rewritten archives."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source in batch.column("file").to_pylist():
                target = source.replace("/stream-", "/members-")
                yield pa.record_batch([pa.array([target]), pa.array([normalise_file(source, target)])], names=["file", "records"])

    return materialise(_one_per_task(files.select("file")).mapInArrow(each, "file string, records bigint"), "warc-members")


READ_BACK = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def read_member(data: bytes) -> tuple:
    head, _, rest = zlib.decompress(data, GZIP).partition(b"\r\n\r\n")
    headers = headers_of(head)
    block = rest[: int(headers["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size, digest = int(headers_of(http)["content-length"]), headers["warc-payload-digest"].removeprefix("sha256:")
    if headers["warc-type"] == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"record {headers['warc-record-id']} does not match its digest")
    return _page(headers["warc-record-id"]), size, digest, headers["warc-type"], _page(headers.get("warc-refers-to"))


def read_archives(files: DataFrame) -> DataFrame:
    """One row per record, read member by member at the offsets of the index."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for address in batch.column("file").to_pylist():
                system, path = located(address)
                rows = []
                with system.open_input_file(path) as archive, system.open_input_stream(f"{path}.index", compression=None) as index:
                    for line in index.read().splitlines():
                        entry = json.loads(line)
                        rows.append(read_member(archive.read_at(entry["length"], entry["offset"])))
                columns = list(zip(*rows)) or [()] * 5
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=[c.split()[0] for c in READ_BACK.split(", ")])

    return _one_per_task(files.select("file")).mapInArrow(each, READ_BACK)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    streams = write_archives(with_referrals(table(spark, sf_dir, "pages")), folder)
    return read_archives(normalise(streams))


SQL = f"""WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
    f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= {LEAST_BYTES} GROUP BY payload_digest)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN page_id <> first THEN first END AS refers_to
    FROM p LEFT JOIN f USING (payload_digest)"""
