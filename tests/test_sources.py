import random

import pytest
from pyspark.sql import functions as F

from conftest import SF, pairs, scalar
from countloom.operators.graph import edge_count
from countloom.operators.triangles import triangles_exact
from countloom.sources.edges import edges_from_lines, read_edges, rejected_lines
from countloom.sources.items import FileItems, KafkaItems, SocketItems, items_from_lines, read_items, rejected_items
from countloom.workspace import shared_folder


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("1,2", [(1, 2)]),
        ("1,1", []),
        ("7", []),
        ("", []),
        (",", []),
        ("x", []),
        ("x,x", []),
        ("1,2,3", [(1, 2), (2, 3)]),
        ("1,2,1,3", [(1, 3), (2, 1)]),
        ("1,2,1,2,1,4,9", [(1, 4), (2, 1), (4, 9)]),
        ("1,2,,", [(1, 2)]),
        ("1,1,2", [(1, 2)]),
        ("1,01", [(1, 1)]),
        ("1,2,01,3", [(1, 3), (2, 1)]),
        ("-1,+2", [(-1, 2)]),
        ("5000000000,1", [(5_000_000_000, 1)]),
    ],
)
def test_edge_line(lines, text, expected):
    assert pairs(edges_from_lines(lines(text))) == expected


def test_random_lines_against_a_plain_parser(spark, lines):
    rng = random.Random(12)
    tokens = ["1", "2", "3", "03", "+1", "-4", "77"]
    texts = [",".join(rng.choices(tokens, k=rng.randint(1, 9))) + rng.choice(["", "", ",", ",,"]) for _ in range(300)]
    expected = []
    for text in texts:
        path, last = text.rstrip(",").split(","), {}
        for a, b in zip(path, path[1:]):
            if a != b:
                last[int(a)] = int(b)
        expected += last.items()
    folder = shared_folder(spark, "lines")
    lines(*texts).write.text(folder)
    assert pairs(read_edges(spark, folder)) == sorted(expected)


def test_mode_all_keeps_every_pair(lines):
    assert pairs(edges_from_lines(lines("1,2,1,3"), mode="all")) == [(1, 2), (1, 3), (2, 1)]
    with pytest.raises(ValueError):
        edges_from_lines(lines("1,2"), mode="first")


@pytest.mark.parametrize("text", ["1,x", "1,,2", ",1", "1, 2", "9999999999999999999,1", "1,2.0"])
def test_bad_token(spark, lines, text):
    # From a file, so that nothing is folded while planning.
    path = shared_folder(spark, "lines")
    lines(text, "3,4", "4,5,6").write.text(path)
    with pytest.raises(Exception, match="not an edge line"):
        read_edges(spark, path).collect()
    assert pairs(read_edges(spark, path, strict=False)) == [(3, 4), (4, 5), (5, 6)]
    assert [r.value for r in rejected_lines(spark.read.text(path)).collect()] == [text]


def test_triangles_of_a_text_file(spark, lines):
    path = shared_folder(spark, "lines")
    lines("1,2", "2,3", "1,3", "3,3", "3,1", "", "3,4,5").write.text(path)
    edges = read_edges(spark, path)
    assert scalar(edge_count(edges)) == 6
    assert scalar(triangles_exact(edges)) == 1


def test_path_per_order(spark):
    """The path fixture: one line per order, edges counted both ways."""
    tour = F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey")))
    paths = (
        spark.read.parquet(f"{SF}/lineitem.parquet").groupBy("l_orderkey").agg(tour.alias("t"))
        .selectExpr("array_join(transform(t, x -> CAST(x.l_partkey AS STRING)), ',') AS value")
    )
    assert edges_from_lines(paths).count() == 45_213
    assert edges_from_lines(paths, mode="all").count() == 45_229


def test_parsing_needs_no_shuffle(spark):
    plan = edges_from_lines(spark.read.text(f"{SF}/lineitem.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and len(plan) < 20_000


def test_items(spark, lines):
    path = shared_folder(spark, "items")
    lines("5", "-3", "+7", "x", " 1", "").write.text(path)
    text = spark.read.text(path)
    assert pairs(items_from_lines(text, strict=False)) == [(-3,), (5,), (7,)]
    assert sorted(r.value for r in rejected_items(text).collect()) == ["", " 1", "x"]
    with pytest.raises(Exception, match="not an integer"):
        items_from_lines(text).collect()


def test_shared_folder_is_below_the_checkpoint_folder(spark):
    folder = shared_folder(spark, "job")
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir")) and folder != shared_folder(spark, "job")


@pytest.mark.parametrize(
    "arguments",
    [
        {"servers": "host", "topic": "t"},
        {"servers": "host:1 ,b:2", "topic": "t"},
        {"servers": "host:1", "topic": "no topic"},
        {"start": {}},
        {"start": {0: -1}},
        {"end": {-1: 5}},
        {"start": {0: 5}, "end": {0: 4}},
        {"start": {0: 5}, "end": {0: 9, 1: 9}},
        {"per_batch": 0},
    ],
)
def test_kafka_arguments_are_checked_before_anything_runs(arguments):
    with pytest.raises(ValueError):
        KafkaItems(**{"servers": "a:9092,b:9092", "topic": "items"} | arguments)


def test_kafka_options():
    plain = KafkaItems("a:1", "t")
    common = {"kafka.bootstrap.servers": "a:1", "subscribe": "t", "failOnDataLoss": "true"}
    assert plain.options(True) == plain.options(False) == common | {"startingOffsets": "earliest"}
    bounded = KafkaItems("a:1", "t", start={1: 7, 0: 0}, end={0: 5, 1: 7}, per_batch=1000)
    assert bounded.options(False) == common | {"startingOffsets": '{"t": {"0": 0, "1": 7}}', "endingOffsets": '{"t": {"0": 5, "1": 7}}'}
    assert bounded.options(True) == common | {"startingOffsets": '{"t": {"0": 0, "1": 7}}', "maxOffsetsPerTrigger": "1000"}


def test_messages_from_the_end_on_are_dropped(spark):
    rows = spark.createDataFrame([(p, o, f"{10 * p + o}") for p in range(3) for o in range(4)], "partition INT, offset LONG, value STRING")
    cut = KafkaItems("a:1", "t", end={0: 2, 2: 1}).bounded(rows)
    assert sorted(r.value for r in cut.collect()) == ["0", "1", "20"]
    assert KafkaItems("a:1", "t").bounded(rows).count() == 12


def test_other_sources_are_checked(spark, tmp_path):
    for wrong in (lambda: SocketItems("", 9), lambda: SocketItems("h", 0), lambda: SocketItems("h", 9).options(False),
                  lambda: FileItems("p", per_batch=0), lambda: FileItems("p", "parquet")):
        with pytest.raises(ValueError):
            wrong()
    assert SocketItems("h", 9).options(True) == {"host": "h", "port": "9"}
    assert FileItems("p", per_batch=3).options(True) == {"path": "p", "maxFilesPerTrigger": "3"}
    (tmp_path / "a.txt").write_text("3\n-4\n")
    assert pairs(read_items(spark, FileItems(str(tmp_path)))) == [(-4,), (3,)]
