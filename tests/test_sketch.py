import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF, pairs, scalar
from countloom import workloads as w
from countloom.operators import frequency as fq
from countloom.operators import sketch as sk
from countloom.operators.sketch import CountSketch
from countloom.plans.stream_report import stream_report, topk_estimates
from test_frequency import skewed

SKETCH = CountSketch.seeded(3, 16, 5)


def bucket(row, x):
    return row.bucket_hash.value(x) % row.width


def sign(row, x):
    return 1 - 2 * (row.sign_hash.value(x) % 2)


def brute_counters(sketch, values):
    cells = {}
    for x, n in Counter(values).items():
        for j, row in enumerate(sketch.rows):
            key = j, bucket(row, x)
            cells[key] = cells.get(key, 0) + sign(row, x) * n
    return cells


def brute_estimate(sketch, values, x):
    cells = brute_counters(sketch, values)
    return statistics.median(cells[j, bucket(row, x)] * sign(row, x) for j, row in enumerate(sketch.rows))


def as_cells(counters):
    return {(r.row, r.bucket): r.c for r in counters.collect()}


@pytest.mark.parametrize(("depth", "width"), [(1, 1), (2, 7), (5, 64)])
def test_counters(items, depth, width):
    sketch, values = CountSketch.seeded(depth, width, 3), skewed(3, 500)
    expected = brute_counters(sketch, values)
    df = items(*values)
    assert as_cells(sketch.counters(df)) == expected
    assert as_cells(sketch.counters(fq.item_freq(df), "n")) == expected


def test_counters_of_a_row_add_up_to_its_signs(items):
    values = skewed(4, 400)
    sums = dict(pairs(SKETCH.counters(items(*values)).groupBy("row").agg(F.sum("c"))))
    assert sums == {j: sum(sign(r, x) for x in values) for j, r in enumerate(SKETCH.rows)}


def test_parts_merge_to_the_whole(items):
    a, b, c = skewed(5, 200), skewed(6, 200), [1]
    merged = sk.merge(*(SKETCH.counters(items(*part)) for part in (a, b, c)))
    assert as_cells(merged) == as_cells(SKETCH.counters(items(*a, *b, *c)))


def test_collisions(items):
    values = skewed(7, 300)
    expected = Counter((j, bucket(r, x)) for x in set(values) for j, r in enumerate(SKETCH.rows))
    got = {(r.row, r.bucket): r["items"] for r in SKETCH.collisions(items(*values)).collect()}
    assert got == expected


@pytest.mark.parametrize("depth", [1, 2, 4, 5])
def test_estimates_both_ways(items, depth):
    sketch, values = CountSketch.seeded(depth, 8, 6), skewed(8, 300)
    freq = fq.item_freq(items(*values))
    counters = sketch.counters(freq, "n")
    expected = {x: float(brute_estimate(sketch, values, x)) for x in set(values)}
    for estimated in (sketch._estimates_by_array(freq, counters), sketch._estimates_by_join(freq, counters)):
        assert {r.item: r.estimate for r in estimated.collect()} == expected


def test_an_item_never_seen_has_an_estimate(items):
    counters = SKETCH.counters(items(1, 1, 2))
    unseen = items(*range(100, 140)).withColumn("n", F.lit(1))
    for estimated in (SKETCH._estimates_by_array(unseen, counters), SKETCH._estimates_by_join(unseen, counters)):
        assert estimated.where("estimate IS NULL").count() == 0 and estimated.count() == 40


def test_null_items_and_equal_rows_both_ways(spark):
    items = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "item BIGINT")
    counters = SKETCH.counters(items)
    assert counters.where("bucket IS NULL OR c IS NULL").count() == 0
    freq = spark.createDataFrame([(1, 2), (1, 2), (None, 2), (2, 1)], "item BIGINT, n BIGINT")
    got = [sorted(map(tuple, SKETCH.estimates(freq, counters, cells).collect()), key=repr) for cells in (1 << 20, 0)]
    assert got[0] == got[1] and len(got[0]) == 4 and got[0].count(got[0][0]) == 2
    assert [e for i, _, e in got[0] if i is None] == [None]


def test_estimates_do_not_shuffle_the_items(spark):
    freq = w.value_freq(spark, SF)
    plan = SKETCH.estimates(freq, SKETCH.counters(w.value_items(spark, SF)))._jdf.queryExecution().executedPlan().toString()
    main = [line for line in plan.splitlines() if ":" not in line.split("- ")[0]]
    assert sum("Exchange" in line for line in main) == 1


def test_f2(items):
    values = skewed(9, 500)
    freq = fq.item_freq(items(*values))
    counters = SKETCH.counters(items(*values))
    cells = brute_counters(SKETCH, values)
    rows = {j: float(sum(c * c for (i, _), c in cells.items() if i == j)) for j in range(3)}
    assert dict(pairs(SKETCH.f2_rows(counters))) == rows
    assert scalar(SKETCH.f2_estimate(counters, freq)) == pytest.approx(statistics.median(rows.values()) / 500**2)


def test_f2_of_nothing(items):
    nothing = items(1).where("item > 1")
    assert dict(pairs(SKETCH.f2_rows(SKETCH.counters(nothing)))) == {0: 0.0, 1: 0.0, 2: 0.0}
    assert scalar(SKETCH.f2_estimate(SKETCH.counters(nothing), fq.item_freq(nothing))) is None


def test_report(items):
    values = skewed(10, 600)
    (row,) = stream_report(items(*values), SKETCH, 0, 30, 3).collect()
    inside = [v for v in values if 0 <= v <= 30]
    freq = Counter(inside)
    f_k = sorted(freq.values(), reverse=True)[2]
    top = [x for x, n in freq.items() if n >= f_k]
    assert (row.length, row.total, row.distinct, row.f_k) == (600, len(inside), len(freq), f_k)
    assert row.f2 == pytest.approx(sum(n * n for n in freq.values()) / len(inside) ** 2)
    errors = [abs(freq[x] - brute_estimate(SKETCH, inside, x)) / freq[x] for x in top]
    assert row.avg_error == pytest.approx(sum(errors) / len(errors))
    estimates = {r.item: r.estimate for r in topk_estimates(fq.item_freq(fq.in_range(items(*values), 0, 30)), SKETCH, 3).collect()}
    assert estimates == {x: float(brute_estimate(SKETCH, inside, x)) for x in top}


def test_report_of_an_empty_range(items):
    (row,) = stream_report(items(1, 2, 3), SKETCH, 9, 8, 2).collect()
    assert (row.length, row.total, row.distinct) == (3, 0, 0)
    assert row.f_k is None and row.f2 is None and row.f2_estimate is None and row.avg_error is None


def test_wide_sketch_is_near_exact(items):
    values = skewed(11, 500)
    wide = CountSketch.seeded(5, 4096, 1)
    freq = fq.item_freq(items(*values))
    wrong = wide.estimates(freq, wide.counters(freq, "n")).where("estimate <> n").count()
    assert wrong <= 2


def test_bad_parameters():
    with pytest.raises(ValueError):
        CountSketch.seeded(0, 4, 1)
    with pytest.raises(ValueError):
        CountSketch.seeded(4, 0, 1)
