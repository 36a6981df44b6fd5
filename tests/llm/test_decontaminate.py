import hashlib
import random
import re

import pytest

from countloom.llm import decontaminate as c
from text_fixtures import docs, on  # noqa: F401

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(x.lower() if x.isascii() else x for x in text or ""))


def brute(rows, items):
    windows = {}
    for name, text in items:
        w = words(text)
        n = min(c.WINDOW, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add("null" if name is None else str(name))
    out = []
    for d, text in rows:
        w, hit, names = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    names |= windows[tuple(w[i : i + n])]
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=repr)


def bench(spark, items):
    return spark.createDataFrame([(*i, "clash") for i in items], "item_id BIGINT, text STRING, doc_id STRING")


def cases(seed):
    rng = random.Random(seed)
    line = lambda n: " ".join(rng.choice("a b c d e É ß 9 the of".split()) for _ in range(n))
    items = [(i, line(rng.choice([1, 2, 3, 9, 10, 11, 25]))) for i in range(10, 18)] + [(2, None), (3, "  ,. "), (None, line(12)), (10, line(14))]
    rows = []
    for i in range(40):
        parts = [rng.choice([line(rng.randint(0, 20)), rng.choice(items)[1] or "", (rng.choice(items)[1] or "").upper().replace(" ", ", ")]) for _ in range(3)]
        rows.append((i, rng.choice([" ", "x", "\n"]).join(parts)))
    return rows + [(None, items[0][1]), (100, None), (101, ""), (102, line(50_000)), (1, rows[1][1])], items


def found(spark, docs, rows, items):
    got = c.summary(c.contamination(docs(rows), bench(spark, items)))
    return sorted(map(tuple, got.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, docs, seed):  # noqa: F811
    rows, items = cases(seed)
    assert found(spark, docs, rows, items) == brute(rows, items)


@pytest.mark.parametrize("name, value", [("HOT_PLACES", 3), ("SIEVE_BITS", 6), ("BATCH_ROWS", 7)])
def test_salted_tokens_full_sieves_and_small_batches(spark, docs, monkeypatch, name, value):  # noqa: F811
    """With six bits every token passes the sieve, as with a benchmark of any size."""
    monkeypatch.setattr(c, name, value)
    monkeypatch.setattr(c, "HOT", 1 << 30)
    rows, items = cases(5)
    assert found(spark, docs, rows, items) == brute(rows, items)


def test_a_window_of_many_items_in_many_documents(spark, docs, monkeypatch):  # noqa: F811
    monkeypatch.setattr(c, "HOT_PLACES", 10)
    monkeypatch.setattr(c, "HOT", 1 << 30)
    passage = " ".join(f"p{i}" for i in range(14))
    rows = [(i, f"{'x ' * (i % 7)}{passage} {'y ' * (i % 5)}{passage if i % 3 else ''}") for i in range(300)]
    items = [(i, f"{passage} tail{i}") for i in range(100)] + [(1000, "y"), (1001, "x x")]
    assert found(spark, docs, rows, items) == brute(rows, items)


def test_small_chunks(spark, docs, on, monkeypatch):  # noqa: F811
    monkeypatch.setattr(c, "CHUNK_BYTES", 60)
    rows, items = cases(3)
    assert sorted(map(tuple, on(c, spark, documents=docs(rows), benchmark=bench(spark, items)).collect()), key=repr) == brute(rows, items)


def test_empty_tables_and_dropping(spark, docs, on):  # noqa: F811
    rows, items = cases(4)
    assert on(c, spark, documents=docs([]), benchmark=bench(spark, items)).count() == 0
    none = on(c, spark, documents=docs(rows), benchmark=bench(spark, [])).collect()
    assert len(none) == len(rows) and not any(r.contaminated for r in none)
    long = " ".join(f"w{i}" for i in range(12))
    kept = c.drop_contaminated(docs([(1, f"see {long} here", "r"), (2, "clean", "s"), (3, None, "t")]), bench(spark, [(1, long)]))
    assert sorted(map(tuple, kept.collect())) == [(2, "clean", "s"), (3, None, "t")]


def test_an_item_of_a_large_vocabulary(spark, docs):  # noqa: F811
    """All windows of a long item are found."""
    many = 150_000
    item = " ".join(f"w{i}" for i in range(many))
    rows = [(1, " ".join(f"w{i}" for i in range(many - 100, many))), (2, " ".join(f"w{i}" for i in range(500, 509)))]
    got = found(spark, docs, rows, [(1, item)])
    assert [(r[0], r[1], r[2], r[3], r[5]) for r in got] == [(1, 100, 100, 1, True), (2, 9, 0, 0, False)]


def test_spans_and_a_map_column(spark, docs):  # noqa: F811
    long = " ".join(f"w{i}" for i in range(12))
    given = docs([(1, f"see {long} and {long}", "r")]).selectExpr("*", "map('k', text) AS m")
    (row,) = c.contamination(given, bench(spark, [(1, long)]), keep=("doc_id", "m")).collect()
    assert [tuple(s) for s in row.spans] == [(1, 13), (14, 26)] and row["items"] == ["1"] and row.m["k"].startswith("see")


def test_keys_depend_on_words_and_their_number():
    a, b = c.hashed([b"x", b"y", b"z"]), c.hashed([b"y", b"z", b"x"])
    assert c.token_keys(a, 2)[1] == c.token_keys(b, 2)[0] and c.token_keys(a, 2)[0] != c.token_keys(b, 2)[1]
    assert len({*c.token_keys(a, 1).tolist(), *c.token_keys(a, 2).tolist(), *c.token_keys(a, 3).tolist()}) == 6
    assert not len(c.token_keys(a, 4))
