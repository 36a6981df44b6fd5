import random

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, pairs, scalar
from countloom import oracle, workloads as w
from countloom.operators import frequency as fq
from countloom.operators.sketch import CountSketch
from countloom.plans.stream_report import report, stream_report
from countloom.sources.items import read_item_stream
from countloom.streaming.ledger import BatchLedger
from countloom.streaming.sketch import SketchTable, start_sketch
from countloom.streaming.store import BatchStore, Folder
from countloom.workspace import shared_folder
from test_frequency import skewed
from test_sketch import as_cells

SKETCH = CountSketch.seeded(3, 16, 5)


def arrive(spark, folder, values):
    """One text file with an item per line."""
    spark.createDataFrame([(str(v),) for v in values], "value STRING").coalesce(1).write.mode("append").text(folder)


def test_sketch_of_a_stream_in_several_batches(spark):
    folder = shared_folder(spark, "test")
    values = skewed(1, 400)
    for i in range(4):
        arrive(spark, f"{folder}/in", values[i * 100:(i + 1) * 100])
    table = SketchTable(spark, f"{folder}/counters")

    def run():
        stream = read_item_stream(spark, path=f"{folder}/in", maxFilesPerTrigger="1")
        query = start_sketch(stream, SKETCH, 0, 30, table, f"{folder}/checkpoint", availableNow=True)
        query.awaitTermination()
        return query.lastProgress.batchId if query.lastProgress else None

    def expect(seen):
        df = spark.createDataFrame([(v,) for v in seen], "item BIGINT")
        return as_cells(SKETCH.counters(fq.in_range(df, 0, 30)))

    assert run() == 3
    assert as_cells(table.read()) == expect(values)
    # Restarted from its checkpoint, it goes on from there.
    more = skewed(2, 50)
    arrive(spark, f"{folder}/in", more)
    run()
    assert as_cells(table.read()) == expect(values + more)


def test_a_bad_line_stops_the_stream(spark):
    folder = shared_folder(spark, "test")
    arrive(spark, f"{folder}/in", [1, "x"])
    ledger = BatchLedger(spark, f"{folder}/checkpoint", 0, 9, threshold=10)
    with pytest.raises(Exception, match="not an integer"):
        ledger.run(read_item_stream(spark, path=f"{folder}/in"), availableNow=True)
    lenient = read_item_stream(spark, path=f"{folder}/in", strict=False)
    # A new checkpoint has a ledger of its own.
    other = BatchLedger(spark, f"{folder}/checkpoint-2", 0, 9, threshold=10)
    other.run(lenient, availableNow=True)
    assert pairs(other.freq()) == [(1, 1)] and pairs(ledger.freq()) == []


def test_ledger_stops_at_the_threshold(spark):
    folder = shared_folder(spark, "test")
    values = skewed(3, 500)
    for i in range(5):
        arrive(spark, f"{folder}/in", values[i * 100:(i + 1) * 100])
    ledger = BatchLedger(spark, f"{folder}/checkpoint", 0, 30, threshold=250)
    # All five files are there, so batches past the threshold do run, and must leave nothing.
    stream = read_item_stream(spark, path=f"{folder}/in", maxFilesPerTrigger="1")
    query = ledger.start(stream, availableNow=True)
    query.awaitTermination()
    assert ledger.reached and ledger.seen == 300
    kept = spark.createDataFrame([(v,) for v in values[:300]], "item BIGINT")
    assert scalar(ledger.length()) == 300
    assert pairs(ledger.freq()) == pairs(fq.item_freq(fq.in_range(kept, 0, 30)))
    got = report(ledger.freq(), ledger.length(), SKETCH, 0, 30, 5).collect()
    assert got == stream_report(kept, SKETCH, 0, 30, 5).collect()


def test_endless_query_is_stopped(spark):
    folder = shared_folder(spark, "test")
    arrive(spark, f"{folder}/in", range(20))
    ledger = BatchLedger(spark, f"{folder}/checkpoint", 0, 9, threshold=20)
    ledger.run(read_item_stream(spark, path=f"{folder}/in"))
    assert ledger.reached and not spark.streams.active


def test_replayed_batches_count_once(spark, items):
    ledger = BatchLedger(spark, shared_folder(spark, "test"), 0, 9, threshold=5)
    batches = [items(1, 1, 2), items(2, 99), items(3), items(4)]
    for i, batch in enumerate(batches):
        ledger.write(batch, i)
        ledger.write(batch, i)
    # Batch 2 begins at the threshold: it and the next are left out.
    assert pairs(ledger.freq()) == [(1, 2), (2, 2)]
    assert scalar(ledger.length()) == 5 and ledger.seen == 5


def test_a_ledger_is_taken_up_again(spark, items):
    folder = shared_folder(spark, "test")
    first = BatchLedger(spark, folder, 0, 9, threshold=5)
    first.write(items(1, 1, 2), 0)
    again = BatchLedger(spark, folder, 0, 9, threshold=5)
    assert again.seen == 3
    again.write(items(2, 99), 1)
    assert again.reached and pairs(again.freq()) == [(1, 2), (2, 2)]


def test_an_empty_stream(spark):
    folder = shared_folder(spark, "test")
    ledger = BatchLedger(spark, folder, 0, 9, threshold=5)
    assert scalar(ledger.length()) == 0 and ledger.freq().count() == 0 and not ledger.reached
    with pytest.raises(ValueError):
        BatchLedger(spark, folder, 0, 9, threshold=0)


def test_a_sketch_of_an_empty_stream(spark):
    folder = shared_folder(spark, "test")
    spark.range(0).selectExpr("CAST(id AS STRING) AS value").write.text(f"{folder}/in")
    table = SketchTable(spark, f"{folder}/counters")
    start_sketch(read_item_stream(spark, path=f"{folder}/in"), SKETCH, 0, 9, table, f"{folder}/checkpoint", availableNow=True).awaitTermination()
    assert table.read().count() == 0


def test_nothing_is_written_past_the_threshold(spark, items):
    ledger = BatchLedger(spark, shared_folder(spark, "test"), 0, 9, threshold=2)
    for i in range(4):
        ledger.write(items(1, 2), i)
    assert [r.batch for r in ledger.tallies().select("batch").distinct().collect()] == [0]


def test_stream_equals_batch_on_the_events(spark):
    assert as_cells(w.stream_sketch(spark, SF_SMALL)) == as_cells(w.value_counters(spark, SF_SMALL))
    n = w.table(spark, SF_SMALL, "events").count()
    ledger = w.run_ledger(spark, SF_SMALL)
    kept = w.table(spark, SF_SMALL, "events").where(F.col("event_id") * 10 < n * 5).selectExpr("CAST(floor(value) AS BIGINT) AS item")
    assert scalar(ledger.length()) == n // 2
    assert pairs(ledger.freq()) == pairs(fq.item_freq(fq.in_range(kept, 0, 300)))


def test_the_ledger_needs_no_dense_ids(spark, monkeypatch, tmp_path):
    """Ids shifted, with gaps, repeated or missing: as many events as the twin finds."""
    rng = random.Random(1)
    rows = [(None if i % 40 == 0 else 5_000 + 13 * (i // 2), float(rng.randint(-5, 320))) for i in range(400)]
    events = spark.createDataFrame(rows, "event_id BIGINT, value DOUBLE").repartition(4)
    monkeypatch.setattr(w, "table", lambda s, d, name: events)
    db = duckdb.connect()
    db.register("events", events.toPandas())
    want = sorted(db.execute(oracle.sql()["stream_until"]).fetchall())
    assert want and pairs(w.run_ledger(spark, "").freq()) == want


def test_a_batch_writes_only_the_counters_it_changed(spark):
    folder = shared_folder(spark, "test")
    values = [*range(200), 5, 5, 6]
    arrive(spark, f"{folder}/in", values[:200])
    table = SketchTable(spark, f"{folder}/counters")

    def run():
        stream = read_item_stream(spark, path=f"{folder}/in")
        start_sketch(stream, SKETCH, 0, 300, table, f"{folder}/checkpoint", availableNow=True).awaitTermination()

    run()
    arrive(spark, f"{folder}/in", values[200:])
    run()
    written = {k: spark.read.parquet(table.store.path_of(k)).count() for k in table.store.before}
    assert written[0] == len(as_cells(table.read())) and 0 < written[1] <= 2 * SKETCH.depth < written[0]
    df = spark.createDataFrame([(v,) for v in values], "item BIGINT")
    assert as_cells(table.read()) == as_cells(SKETCH.counters(df))
    # Another reader, and one after the deltas are folded, see the same.
    assert as_cells(SketchTable(spark, f"{folder}/counters").read()) == as_cells(table.read())
    before = as_cells(table.read())
    table.store.write_snapshot()
    assert as_cells(SketchTable(spark, f"{folder}/counters").read()) == before


def test_the_state_may_be_kept_in_rocksdb(spark):
    folder = shared_folder(spark, "test")
    settings = {
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        values = skewed(4, 60)
        table = SketchTable(spark, f"{folder}/counters")
        for part in (values[:40], values[40:]):
            arrive(spark, f"{folder}/in", part)
            stream = read_item_stream(spark, path=f"{folder}/in")
            start_sketch(stream, SKETCH, 0, 30, table, f"{folder}/checkpoint", availableNow=True).awaitTermination()
    finally:
        for key in settings:
            spark.conf.unset(key)
    df = spark.createDataFrame([(v,) for v in values], "item BIGINT")
    assert as_cells(table.read()) == as_cells(SKETCH.counters(fq.in_range(df, 0, 30)))


def ledger_of(spark, folder, items, batches, fold_every=3):
    ledger = BatchLedger(spark, folder, 0, 9, threshold=1000, fold_every=fold_every)
    for i in batches:
        ledger.write(items(i % 10, 1, 99), i)
    return ledger


def expected_of(batches):
    found = {}
    for i in batches:
        for item in (i % 10, 1):
            found[item] = found.get(item, 0) + 1
    return sorted(found.items())


def test_old_batches_are_folded(spark, items):
    folder = shared_folder(spark, "test")
    ledger = ledger_of(spark, folder, items, range(8))
    names = Folder(spark, ledger.store.path).names
    assert ledger.store.snapshot == 5 and names("snapshots") == ["batch=5"] and names("batches") == ["batch=6", "batch=7"]
    assert len(names("state")) <= 2
    for reader in (ledger, BatchLedger(spark, folder, 0, 9, threshold=1000)):
        assert reader.seen == 24 and scalar(reader.length()) == 24 and pairs(reader.freq()) == expected_of(range(8))
        assert sorted(r.batch for r in reader.tallies().select("batch").distinct().collect()) == [5, 6, 7]
    # Replays below the snapshot are ignored, above it they overwrite.
    again = BatchLedger(spark, folder, 0, 9, threshold=1000, fold_every=3)
    for i in (2, 5, 6, 7):
        again.write(items(i % 10, 1, 99), i)
    assert again.seen == 24 and pairs(again.freq()) == expected_of(range(8))


class Crash(Exception):
    pass


@pytest.mark.parametrize("at", ["tally", "manifest", "snapshot", "named", "swept"])
def test_a_crash_at_any_step_counts_every_batch_once(spark, items, monkeypatch, at):
    """The batch that crashed runs again, as a query that restarts from its checkpoint runs it."""
    folder = shared_folder(spark, "test")
    ledger = ledger_of(spark, folder, items, range(2))

    def crash(*_):
        raise Crash

    store = ledger.store
    if at == "tally":
        monkeypatch.setattr(store, "commit", crash)
    elif at == "manifest":
        monkeypatch.setattr(store, "write_snapshot", crash)
    elif at == "snapshot":
        published = store._publish
        steps = iter([published, crash])
        monkeypatch.setattr(store, "_publish", lambda: next(steps)())
    elif at == "named":
        monkeypatch.setattr(store, "_sweep", crash)
    else:
        removed = store.folder.remove
        first = iter([removed])
        monkeypatch.setattr(store.folder, "remove", lambda name: next(first, crash)(name) if name.startswith("batches") else removed(name))
    with pytest.raises(Crash):
        ledger.write(items(2, 1, 99), 2)
    seen_by_others = pairs(BatchLedger(spark, folder, 0, 9, threshold=1000).freq())
    assert seen_by_others == expected_of(range(2 if at == "tally" else 3))
    again = ledger_of(spark, folder, items, range(2, 5))
    assert again.seen == 15 and scalar(again.length()) == 15 and pairs(again.freq()) == expected_of(range(5))
    names = Folder(spark, again.store.path).names
    assert names("snapshots") == [f"batch={again.store.snapshot}"] and len(names("batches")) == len(again.store.before)


def test_a_restart_reads_one_small_file(spark, items, monkeypatch):
    folder = shared_folder(spark, "test")
    ledger_of(spark, folder, items, range(5))
    opened = []
    read = Folder.read
    monkeypatch.setattr(Folder, "read", lambda self, name: opened.append(name) or read(self, name))
    monkeypatch.setattr(BatchStore, "read", lambda self: pytest.fail("the tallies were read"))
    ledger = BatchLedger(spark, folder, 0, 9, threshold=1000)
    assert ledger.seen == 15 and ledger.store.before == {3: 9, 4: 12} and len(opened) == 1
    with pytest.raises(ValueError):
        BatchLedger(spark, folder, 0, 9, threshold=5, fold_every=0)
