import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from countloom.llm import hard_negatives as n
from text_fixtures import on  # noqa: F401

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, row STRING, shard STRING"


def expect(rows):
    usable = []
    for i, (vec_id, vector, label) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x) or abs(x * 256) >= n.LARGEST for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        usable.append((i, vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []
    for i, a, label, v in usable:
        if a is None or a % 50:
            continue
        others = sorted((-sum(x * y for x, y in zip(v, w)), b is None, b or 0, j, m) for j, b, m, w in usable if j != i)
        for score, _, p, _, _ in [o for o in others if o[4] == label][:5]:
            hard = [o for o in others if o[4] != label and -50 * score <= -100 * o[0] <= -95 * score][:3]
            out += [(a, p, k + 1, None if o[1] else o[2], -score, -o[0]) for k, o in enumerate(hard)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)


def clustered(count, dims, seed, labels=10):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dims))
    label = rng.integers(0, labels, count)
    vectors = (centres[label] + rng.normal(size=(count, dims)) * 0.7).astype(np.float32)
    return [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(vectors, label))]


@pytest.fixture
def small(monkeypatch):
    for name, value in {"SHARD_ROWS": 90, "PAGE_ROWS": 8, "FANOUT": 3, "SLICE_ANCHORS": 2, "SAMPLE_ROWS": 200}.items():
        monkeypatch.setattr(n, name, value)


@pytest.mark.parametrize("seed", [1, 2])
def test_by_brute_force(spark, on, small, seed):
    rows = clustered(700, 6, seed)
    assert sorted(map(tuple, on(n, spark, embeddings=frame(spark, rows)).collect())) == expect(rows)


def test_ties_copies_nulls_and_odd_values(spark, on, small):
    rows = [(i, [0.5, 0.25, 0.0] if i % 3 == 0 else [0.4, 0.2, i / 300], i % 4) for i in range(300)]
    rows += [(350, [0.5, 0.25, 0.0], 1), (400, [-1.0, 0.0, 0.0], 2), (450, [0.0, 0.0, 0.0], 3)]
    rows += [(500, None, 1), (550, [1.0, None, 0.0], 1), (600, [math.nan, 0.0, 0.0], 1), (650, [math.inf, 0.0, 0.0], 1)]
    rows += [(700, [0.5, 0.5, 0.5], None), (None, [0.5, 0.25, 0.0], 1), (None, [0.4, 0.2, 0.1], 2), (750, [1e6, 0.0, 0.0], 1)]
    assert sorted(map(tuple, on(n, spark, embeddings=frame(spark, rows)).collect()), key=repr) == sorted(expect(rows), key=repr)


def test_short_vectors_one_row_and_none(spark, on):
    for rows in ([(0, [1.0], 1), (1, [0.9, 3.0], 1), (2, [0.5, 1.0], 2), (50, [0.8, 0.1], 2)], [(0, [1.0], 1)], [(0, [], 1)], []):
        padded = [(i, (v + [0.0, 0.0])[:2], k) for i, v, k in rows]
        assert sorted(map(tuple, on(n, spark, embeddings=frame(spark, rows)).collect())) == expect(padded)


def test_tiles_place_every_point():
    rng = np.random.default_rng(3)
    points = np.column_stack([rng.integers(0, 5, 1000), rng.integers(-50, 50, (1000, 4))])
    cuts, many = n.grow_cuts(points[:300], 24)
    tile = n.place(cuts, points)
    assert tile.min() >= 0 and tile.max() < many and 12 <= many <= 80
    pages = n.pack(points)
    assert sorted(np.concatenate(pages).tolist()) == list(range(1000)) and max(map(len, pages)) <= n.PAGE_ROWS


def test_boxes_bound_their_products():
    rng = np.random.default_rng(4)
    inside = rng.integers(-90, 90, (40, 7))
    box = n.Boxes(inside.min(0)[None], inside.max(0)[None], np.array([1]), np.array([1]))
    for _ in range(50):
        vector = rng.integers(-90, 90, 7)
        least, most = box.bounds(vector)
        assert least[0] <= (inside @ vector).min() and (inside @ vector).max() <= most[0]
    assert not box.allowed(1, same=False)[0] and not box.allowed(2, same=True)[0]


def test_anchors_by_any_rule(spark, small):
    rows = n.prepared(frame(spark, clustered(200, 4, 5, labels=3)), "vec_id", F.col("label"), "embedding")
    found = n.mine(rows, F.col("id") < 20, positives=2, negatives=1).collect()
    assert {r.anchor_id for r in found} <= set(range(20)) and max(r["rank"] for r in found) == 1
