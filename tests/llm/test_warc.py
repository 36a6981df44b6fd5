import gzip
import hashlib
import json
import zlib

import pytest

from countloom.llm import warc as w
from text_fixtures import on, small_batches  # noqa: F401


def pages(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id BIGINT, url STRING, html STRING, text STRING").repartition(parts)


def expect(rows):
    raw = [(i, (h or "").encode()) for i, _, h in rows]
    out = []
    for i, x in raw:
        same = [j for j, y in raw if y == x and j is not None] if len(x) >= w.LEAST_BYTES else []
        first = min(same, default=i)
        out.append((i, len(x), hashlib.sha256(x).hexdigest(), "response" if i == first else "revisit", None if i == first else first))
    return sorted(out, key=repr)


ROWS = [(5, "u", "x" * 200), (3, None, "x" * 200), (3, "u", "x" * 200), (9, "a\r\nb", "é" * 70), (8, "c", "é" * 70), (1, "s", "short"), (2, "s", "short"),
        (None, "n", "x" * 200), (4, "n", None), (6, "", ""), (7, "long", "<p>\r\n\r\nWARC/1.1\r\n</p>" * 60_000), (10, "b", "y" * 99), (11, "b", "y" * 99), (12, "b", "y" * 100), (13, "b", "y" * 100)]


def test_pages_come_back(spark, on, small_batches):  # noqa: F811
    assert sorted(map(tuple, on(w, spark, pages=pages(spark, ROWS)).collect()), key=repr) == expect(ROWS)
    assert on(w, spark, pages=pages(spark, [])).count() == 0


def test_normalising_splits_members(tmp_path):
    stream, target = tmp_path / "stream-0.warc.gz", tmp_path / "members-0.warc.gz"
    records = [w.record(i, f"u{i}", f"payload {i}".encode() * i, None if i % 2 else 1) for i in range(50)]
    # One stream, or several members with records across their borders.
    whole = b"".join(records)
    for data in (gzip.compress(whole), gzip.compress(whole[:777]) + gzip.compress(whole[777:])):
        stream.write_bytes(data)
        assert w.normalise_file(str(stream), str(target)) == 50
        index = [json.loads(x) for x in (tmp_path / "members-0.warc.gz.index").read_text().splitlines()]
        data = target.read_bytes()
        assert sum(e["length"] for e in index) == len(data)
        for entry, one in zip(index, records):
            assert zlib.decompress(data[entry["offset"] : entry["offset"] + entry["length"]], w.GZIP) == one
    assert not list(tmp_path.glob("*.part"))
    stream.write_bytes(gzip.compress(whole[:-30]))
    with pytest.raises(ValueError):
        w.normalise_file(str(stream), str(target))


def test_a_damaged_payload_is_noticed():
    data = w.record(1, "u", b"abc", None).replace(b"abc", b"abd")
    with pytest.raises(ValueError):
        w.read_member(gzip.compress(data))
