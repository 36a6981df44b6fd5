import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from conftest import SF_SMALL
from countloom.llm import repeats as r
from countloom.llm.common import table
from text_fixtures import docs, on, small_batches  # noqa: F401


def brute(rows):
    raw = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(x[i : i + r.LENGTH] for _, x in raw for i in range(len(x) - r.LENGTH + 1))
    out = []
    for d, x in raw:
        keep = bytearray(b"\1") * len(x)
        for i in range(len(x) - r.LENGTH + 1):
            if seen[x[i : i + r.LENGTH]] > 1:
                keep[i : i + r.LENGTH] = bytes(r.LENGTH)
        runs = sum(not k and (i == 0 or keep[i - 1]) for i, k in enumerate(keep))
        rest = bytes(v for v, k in zip(x, keep) if k)
        out.append((d, len(x), keep.count(0), runs, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def mixed_rows(seed=5):
    rng = random.Random(seed)
    noise = lambda n: "".join(rng.choice("abcd ") for _ in range(n))
    shared = [noise(rng.choice([199, 200, 201, 260, 500])) for _ in range(6)]
    rows = []
    for i in range(60):
        text = ""
        for _ in range(rng.randint(0, 4)):
            q = rng.choice(shared)
            a = rng.randint(0, len(q))
            text += rng.choice([q, q[a : rng.randint(a, len(q))], noise(rng.randint(0, 150)), "ab" * rng.randint(0, 300),
                                "é" * rng.randint(0, 150), "\0" * rng.randint(0, 220)])
        rows.append((i if i % 9 else None, text))
    return rows + [(7, rows[7][1]), (None, None), (500, None), (501, "x" * 199), (502, "y" * 200), (503, "y" * 200), (504, "z" * 201)]


def test_equals_brute_force(spark, docs, on):
    rows = mixed_rows()
    assert found(on(r, spark, documents=docs(rows))) == brute(rows)


@pytest.mark.parametrize("name, value", [("GROUP_CONTEXTS", 1), ("GATHERED", 5)])
def test_crowded_anchors_and_small_gathers(spark, docs, on, monkeypatch, small_batches, name, value):
    rows = mixed_rows(6)
    monkeypatch.setattr(r, name, value)
    assert found(on(r, spark, documents=docs(rows))) == brute(rows)


def test_empty_table_and_the_given_documents(spark, docs, on):
    assert found(on(r, spark, documents=docs([]))) == []
    given = table(spark, SF_SMALL, "documents")
    assert found(on(r, spark, documents=given)) == brute([(x.doc_id, x.text) for x in given.collect()])


def test_long_texts_come_in_pieces():
    rng = np.random.default_rng(0)
    text = rng.integers(97, 100, 5000).astype(np.uint8).tobytes()
    one = np.frombuffer(text, np.uint8)
    whole = r.anchors(one, np.array([0]), np.array([len(text)]))
    windows = {w: (at, h) for a, b, at, h in zip(*map(np.ndarray.tolist, whole[:4])) for w in range(a, b + 1)}
    assert len(windows) == len(text) - r.LENGTH + 1
    again = {}
    for chunk in r.pieces([text], most=700):
        for _, offset, part in chunk:
            data = np.frombuffer(part, np.uint8)
            for a, b, at, h in zip(*map(np.ndarray.tolist, r.anchors(data, np.array([0]), np.array([len(part)]))[:4])):
                again.update({w + offset: (at + offset, h) for w in range(a, b + 1)})
    assert again == windows


def test_interval_tree():
    assert list(r.intervals([0, 3, 1, 2])) == [(3, 0, 1), (2, 2, 3), (1, 0, 3), (0, 0, 3)]


def test_many_texts_under_one_id(spark, docs, on):  # noqa: F811
    """An id and a few bits of a hash would not tell them apart."""
    rng = random.Random(8)
    noise = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    shared = noise(220)
    rows = [(7, noise(210) + (shared + noise(10) if i % 5 == 0 else "")) for i in range(2500)]
    assert found(on(r, spark, documents=docs(rows))) == brute(rows)
