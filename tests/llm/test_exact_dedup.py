import hashlib

from countloom.llm import exact_dedup as x
from text_fixtures import docs, on  # noqa: F401

LONG = "Word " * 5000


def expect(rows):
    low = lambda t: "".join(c.lower() if c.isascii() else c for c in t or "")
    groups = {}
    for d, t in rows:
        groups.setdefault(low(t), []).append(d)
    out = []
    for d, t in rows:
        ids = [i for i in groups[low(t)] if i is not None]
        keep = max(ids, default=None)
        out.append((d, keep, len(groups[low(t)]), d == keep, hashlib.sha256(low(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


def test_copies_nulls_case_and_long_texts(spark, docs, on):
    rows = [(1, "Abc"), (2, "aBC"), (3, "abd"), (4, None), (5, ""), (6, "É"), (7, "é"), (8, LONG), (9, LONG.upper()), (10, LONG + "x")]
    rows += [(11, "abc"), (None, "abd"), (None, "only"), (12, "same"), (12, "same")]
    assert found(on(x, spark, documents=docs(rows))) == expect(rows)


def test_one_group_of_a_third(spark, docs, on):
    rows = [(i, "hot" if i % 3 == 0 else f"text {i % 50}") for i in range(300)]
    assert found(on(x, spark, documents=docs(rows))) == expect(rows)


def test_empty_table_and_dropping(spark, docs, on):
    assert found(on(x, spark, documents=docs([]))) == []
    kept = x.drop_copies(docs([(1, "A", "r"), (2, "a", "s"), (3, "b", "t")]))
    assert sorted(map(tuple, kept.collect())) == [(2, "a", "s"), (3, "b", "t")]


def test_dropping_null_and_repeated_ids(spark, docs):
    rows = [(1, "A", "r"), (None, "a", "s"), (None, "b", "t"), (None, "B", "t"), (4, "c", "u"), (4, "c", "u"), (4, "C", "v")]
    rows += [(5, "d", "w"), (6, "D", "x"), (5, "unique", "y")]
    kept = x.drop_copies(docs(rows)).collect()
    assert sorted(((r.doc_id, r.text.lower()) for r in kept), key=repr) == sorted(
        [(1, "a"), (None, "b"), (4, "c"), (6, "d"), (5, "unique")], key=repr
    )
