import re

import numpy as np
import pytest
import xxhash

from conftest import SF_SMALL
from countloom.llm import simhash as s
from countloom.llm.common import table
from countloom.llm.components import connected_components
from text_fixtures import docs, on, small_batches  # noqa: F401


def slow_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values):
    label = np.arange(len(values))
    return s.link(label, *np.nonzero(np.bitwise_count(values[:, None] ^ values[None, :]) <= s.RADIUS))


def expect(rows):
    fps = np.array([slow_fingerprint(t) for _, t in rows], np.uint64)
    label = classes(fps)
    least = {}
    for (d, _), c in zip(rows, label.tolist()):
        if d is not None:
            least[c] = min(d, least.get(c, d))
    return sorted(((d, f"{int(f):016x}", least.get(c)) for (d, _), f, c in zip(rows, fps, label.tolist())), key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_odd_texts(spark, docs, on, small_batches):  # noqa: F811
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(1, base), (2, base + " tail"), (3, base.replace("word7 ", "")), (4, None), (5, " \t\n"), (6, "one"), (7, "One"), (8, "one two")]
    rows += [(9, "\x1c\x1d a b c d"), (10, "É é ß x"), (None, base), (None, "alone here now"), (2, base + " tail"), (11, "x y z " * 30_000)]
    assert found(on(s, spark, documents=docs(rows))) == expect(rows)
    assert found(on(s, spark, documents=docs([]))) == []


def test_the_given_documents_in_many_shards(spark, on, monkeypatch):  # noqa: F811
    for name, value in (("SHARD_POINTS", 16), ("SAMPLE_POINTS", 64), ("LEAF_POINTS", 4)):
        monkeypatch.setattr(s, name, value)
    given = table(spark, SF_SMALL, "documents")
    assert found(on(s, spark, documents=given)) == expect([(x.doc_id, x.text) for x in given.collect()])


@pytest.mark.parametrize("depth", [0, 3, 7])
def test_shards_lose_no_pair(depth):
    rng = np.random.default_rng(depth)
    centres = rng.integers(0, 2**63, 200, dtype=np.uint64)
    points = [centres]
    for _ in range(10):
        one_bit = np.uint64(1) << rng.integers(0, 64, 200, dtype=np.uint64)
        points.append(points[rng.integers(0, len(points))] ^ one_bit)
    points = rng.permutation(np.unique(np.concatenate(points)))
    tree, shards = s.grow(points[:150], depth)
    shard, at, home = s.route(tree, points)
    assert (np.bincount(at[home], minlength=len(points)) == 1).all()
    label = np.arange(len(points))
    for k in range(shards):
        mine, guests = at[(shard == k) & home], at[(shard == k) & ~home]
        inside = s.search(points[mine], points[guests])
        both = np.concatenate([mine, guests])
        label = s.link(label, both, both[inside])
    assert np.array_equal(label, classes(points))


def test_one_value_cannot_be_split():
    same = np.full(500, 7, np.uint64)
    tree, shards = s.grow(same, 5)
    assert shards == 1 and (s.search(same, same[:0]) == 0).all()


def test_components(spark):
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 300, 250), rng.integers(0, 300, 250)
    links = [(int(x), int(y)) for x, y in zip(a, b)] + [(i, i + 1) for i in range(1000, 1040)] + [(5000, i) for i in range(5001, 5100)]
    label = s.link(np.arange(6000), *(np.array(c) for c in zip(*links)))
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a BIGINT, b BIGINT")).collect()}
    assert got == {n: int(label[n]) for pair in links for n in pair if pair[0] != pair[1]} | {n: int(label[n]) for n in got}
    assert connected_components(spark.createDataFrame([], "a BIGINT, b BIGINT")).count() == 0


def test_one_of_each_class_stays(spark, docs):  # noqa: F811
    base = " ".join(f"w{i}" for i in range(300))
    kept = s.drop_near_copies(docs([(3, base, "a"), (4, base, "b"), (5, "else wholly different text", "c")]))
    assert sorted(r.doc_id for r in kept.collect()) == [3, 5] and kept.columns == ["doc_id", "text", "row"]


def test_dropping_null_and_repeated_ids(spark, docs):  # noqa: F811
    rows = [(None, "a b c", "r"), (None, "a b c", "r"), (4, "x y z", "s"), (4, "x y z", "s"), (4, "unique text", "t"), (3, "X y z", "u")]
    kept = s.drop_near_copies(docs(rows))
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([rows[0], rows[4], rows[5]], key=repr)
