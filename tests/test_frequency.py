import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF, SF_SMALL, pairs, scalar
from countloom import workloads as w
from countloom.operators import frequency as fq


def skewed(seed, n=3000):
    rng = random.Random(seed)
    return [7 if rng.random() < 0.4 else int(rng.expovariate(0.05)) - 5 for _ in range(n)]


def test_frequencies(items):
    values = skewed(1)
    freq = fq.item_freq(fq.in_range(items(*values), 0, 50))
    expected = Counter(v for v in values if 0 <= v <= 50)
    assert dict(pairs(freq)) == expected
    assert tuple(fq.range_totals(freq).first()) == (sum(expected.values()), len(expected))
    assert scalar(fq.f2_true(freq)) == pytest.approx(sum(n * n for n in expected.values()) / sum(expected.values()) ** 2)


def test_tally_holds_range_and_length(items):
    counts = fq.tally(items(1, 1, 2, 99, -4), 1, 10)
    assert {r.item: r.n for r in counts.collect()} == {1: 2, 2: 1, None: 2}
    assert scalar(fq.stream_length(counts)) == 5


def test_empty_range(items):
    freq = fq.item_freq(fq.in_range(items(1, 2, 3), 5, 4))
    assert tuple(fq.range_totals(freq).first()) == (0, 0)
    assert scalar(fq.f2_true(freq)) is None
    assert scalar(fq.kth_frequency(freq, 3)) is None
    assert fq.topk_ties(freq, 3).count() == 0


@pytest.mark.parametrize("k", [1, 2, 3, 10, 17, 1000, 5000])
def test_kth_frequency(items, k):
    values = skewed(2)
    freq = fq.item_freq(items(*values))
    ranked = sorted(Counter(values).values(), reverse=True)
    expected = ranked[min(k, len(ranked)) - 1]
    assert scalar(fq.kth_frequency(freq, k)) == expected


def test_ties_and_large_k(items):
    freq = fq.item_freq(items(1, 1, 1, 2, 2, 3, 3, 4))
    assert pairs(fq.topk_ties(freq, 2)) == [(1, 3), (2, 2), (3, 2)]
    assert pairs(fq.topk_ties(freq, 10)) == [(1, 3), (2, 2), (3, 2), (4, 1)]
    assert pairs(fq.topk_ties(freq, 1001)) == [(1, 3), (2, 2), (3, 2), (4, 1)]
    with pytest.raises(ValueError):
        fq.kth_frequency(freq, 0)


@pytest.mark.parametrize("threshold", [0, 1, 2, 3, 500, 501, 3000, 10**9])
def test_prefix(spark, threshold, monkeypatch):
    monkeypatch.setattr(fq, "BATCH_BLOCK", 8)
    rng = random.Random(4)
    rows = [(rng.choice([-20, -3, 0, 1, 7, 8, 30, 31, 1000]), i) for i in range(1000)] + [(50 + i, i) for i in range(100)]
    totals = Counter(b for b, _ in rows)
    kept, seen = set(), 0
    for b in sorted(totals):
        if seen < threshold:
            kept.add(b)
        seen += totals[b]
    df = spark.createDataFrame(rows, "batch_id BIGINT, item BIGINT")
    assert pairs(fq.stream_prefix(df, threshold)) == sorted(r for r in rows if r[0] in kept)
    assert pairs(fq.stream_prefix(df, F.lit(threshold))) == sorted(r for r in rows if r[0] in kept)


def test_items_without_a_batch_come_first(spark):
    rows = [(None, 1), (None, 2), (-5, 3), (4, 4), (9, 5)]
    df = spark.createDataFrame(rows, "batch_id BIGINT, item BIGINT")
    kept = lambda **how: sorted(r.item for r in fq.stream_prefix(df, **how).collect())
    assert kept(threshold=0) == [] and kept(threshold=1) == [1, 2] and kept(threshold=3) == [1, 2, 3]
    assert kept(share=600) == [1, 2, 3] and kept(share=1000) == [1, 2, 3, 4, 5]
    assert scalar(fq.stream_length(fq.batch_totals(df))) == 5


@pytest.mark.parametrize(
    ("sf", "step", "threshold", "length", "total", "distinct", "f2", "f_k"),
    [(SF_SMALL, 100, 450, 500, 499, 144, 0.011481882, 9), (SF, 1000, 4500, 5000, 4988, 246, 0.010209668, 80)],
)
def test_prefix_of_the_events(spark, sf, step, threshold, length, total, distinct, f2, f_k):
    items = w.table(spark, sf, "events").selectExpr("CAST(floor(value) AS BIGINT) AS item", f"event_id div {step} AS batch_id")
    prefix = fq.stream_prefix(items, threshold)
    assert scalar(fq.stream_length(fq.batch_item_counts(prefix))) == length
    freq = fq.item_freq(fq.in_range(prefix, 0, 300))
    assert tuple(fq.range_totals(freq).first()) == (total, distinct)
    assert scalar(fq.f2_true(freq)) == pytest.approx(f2, abs=1e-9)
    assert scalar(fq.kth_frequency(freq, 10)) == f_k and fq.topk_ties(freq, 10).count() == 10


@pytest.mark.parametrize(
    ("stream", "limits", "total", "distinct", "f2", "tops"),
    [
        ("user_items", (10, 100), 6081, 91, 0.011184994, {10: (79, 10), 20: (75, 21), 50: (65, 50)}),
        ("value_items", (0, 300), 9977, 274, 0.010142411, {10: (164, 10), 20: (138, 20), 50: (71, 51)}),
        ("supplier_items", (0, 99), 60000, 100, 0.010017679, {10: (635, 11), 20: (622, 21), 50: (599, 50)}),
    ],
)
def test_streams_of_the_tables(spark, stream, limits, total, distinct, f2, tops):
    freq = fq.item_freq(fq.in_range(getattr(w, stream)(spark, SF), *limits)).persist()
    assert tuple(fq.range_totals(freq).first()) == (total, distinct)
    assert scalar(fq.f2_true(freq)) == pytest.approx(f2, abs=1e-9)
    for k, (f_k, count) in tops.items():
        assert scalar(fq.kth_frequency(freq, k)) == f_k
        assert fq.topk_ties(freq, k).count() == count
    freq.unpersist()


def test_squares_beyond_bigint(spark):
    freq = spark.createDataFrame([(1, 4_000_000_000_000), (2, 1)], "item BIGINT, n BIGINT")
    assert scalar(fq.f2_true(freq)) == pytest.approx(1.0)


def test_range_filter_reaches_the_scan(spark):
    freq = fq.item_freq(fq.in_range(w.user_items(spark, SF), 10, 100))
    plan = freq._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(user_id,10)" in plan and "LessThanOrEqual(user_id,100)" in plan
    assert "ReadSchema: struct<user_id:bigint>" in plan


def test_prefix_of_tallies_equals_tally_of_prefix(spark):
    rng = random.Random(11)
    for size in (0, 1, 300):
        rows = [(rng.randint(-3, 12), rng.choice([None, *range(9)])) for _ in range(size)]
        df = spark.createDataFrame(rows, "item BIGINT, batch_id BIGINT")
        for bound in ({"threshold": 1}, {"threshold": 100}, {"threshold": 10_000}, {"share": 0}, {"share": 455}, {"share": 1000}):
            want, got = fq.tally(fq.stream_prefix(df, **bound), 0, 9), fq.prefix_tally(fq.batch_tallies(df, 0, 9), **bound)
            assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)

