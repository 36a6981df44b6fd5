import random

import duckdb
import pytest
from hypothesis import given, settings, strategies as st

from countloom.functions.hashing import Colouring, EdgePartitioning, PolyHash, SketchRow

IDS = [0, 1, 2, 7, 8190, 8191, 8192, -1, -7, 262_145, 2**31 - 2, 2**31 - 1, 2**31, 5_000_000_000, 2**63 - 1, -(2**63) + 1]


@pytest.mark.parametrize("degree", [1, 2, 3])
def test_spark_duckdb_and_python_agree(spark, degree):
    rng = random.Random(degree)
    values = IDS + [rng.randrange(-(2**62), 2**62) for _ in range(200)]
    h = PolyHash.draw(rng, degree)
    df = spark.createDataFrame([(v,) for v in values], "x BIGINT")
    got = [r[0] for r in df.selectExpr(h.spark("x")).collect()]
    db = duckdb.connect()
    db.execute("CREATE TABLE t AS SELECT unnest(?::BIGINT[]) AS x", [values])
    twin = [r[0] for r in db.execute(f"SELECT {h.duckdb('x')} FROM t").fetchall()]
    assert got == twin == [h.value(v) for v in values]


@pytest.mark.parametrize("family", ["poly", "linear8191"])
def test_colours_stay_in_range(spark, family):
    colouring = Colouring.seeded(5, 3, family)
    df = spark.createDataFrame([(v,) for v in IDS], "x BIGINT")
    got = [r[0] for r in df.selectExpr(colouring.spark("x")).collect()]
    assert all(0 <= c < 5 for c in got)
    assert got == [colouring.value(v) for v in IDS]


def test_edge_partition_in_both_engines(spark):
    parts = EdgePartitioning.seeded(7, 11)
    rng = random.Random(5)
    values = [(rng.choice(IDS), rng.randrange(-(2**62), 2**62)) for _ in range(100)]
    got = [r[0] for r in spark.createDataFrame(values, "u BIGINT, v BIGINT").selectExpr(parts.spark("u", "v")).collect()]
    db = duckdb.connect()
    twin = [db.execute(f"SELECT {parts.duckdb('u', 'v')} FROM (SELECT ?::BIGINT AS u, ?::BIGINT AS v)", v).fetchone()[0] for v in values]
    assert got == twin and all(0 <= p < 7 for p in got)


def test_signs_stay_mixed_at_width_one():
    row = SketchRow.draw(random.Random(1), 1)
    signs = {1 - 2 * (row.sign_hash.value(x) % 2) for x in range(50)}
    assert signs == {1, -1}


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 2**31), st.integers(1, 100))
def test_same_seed_same_hash(seed, colours):
    assert Colouring.seeded(colours, seed) == Colouring.seeded(colours, seed)


def test_bad_parameters():
    with pytest.raises(ValueError):
        Colouring.seeded(0, 1)
    with pytest.raises(ValueError):
        Colouring.seeded(2, 1, "md5")
    with pytest.raises(ValueError):
        EdgePartitioning.seeded(0, 1)
