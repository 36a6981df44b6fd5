import hashlib
import random

import numpy as np
import pytest

from conftest import SF_SMALL
from countloom.llm import pieces as p
from countloom.llm.common import table
from text_fixtures import docs, on, small_batches  # noqa: F401


@pytest.fixture(scope="module")
def encoder():
    return p.Encoder(p.default_model())


def same(encoder, text):
    return np.frombuffer(encoder.encode(text), "<u4").tolist() == encoder.library.encode(text)


def test_runs_and_random_strings(encoder):
    for n in range(70):
        assert all(same(encoder, x) for x in (" " * n, " " * n + "word", "a" + " " * n + "b", "=" * n, "\n" * n, "-" * n + "x", "." * n + "com"))
    rng = random.Random(1)
    signs = "ab the  ing▁\n\t日本語éèñ😀\0<s>0x0A=-_.,'\"\\ ́‍don't"
    assert all(same(encoder, "".join(rng.choice(signs) for _ in range(rng.randint(0, 40)))) for _ in range(5000))
    assert same(encoder, "".join(rng.choice("abcdefgh") for _ in range(20_000)))


def test_backtracking_is_needed_and_caches_may_be_small(encoder, monkeypatch):
    monkeypatch.setattr(p, "SEGMENTS", 3)
    monkeypatch.setattr(p, "PAIRS", 3)
    small = p.Encoder(p.default_model())
    rng = random.Random(2)
    assert all(same(small, "".join(rng.choice("aeinorst") for _ in range(30))) for _ in range(300))


def expect(encoder, rows):
    out = []
    for d, text in rows:
        ids = encoder.library.encode(text or "", add_bos=True, add_eos=True)
        raw = np.array(ids, "<u4").tobytes()
        decoded = encoder.library.decode(ids)
        out.append((d, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_query_equals_the_library(spark, docs, on, encoder, small_batches):  # noqa: F811
    rows = [(1, None), (2, ""), (None, "null id"), (3, "twice"), (3, "twice"), (4, "long text  " * 50_000), (5, "<s> </s> ▁  ")]
    rows += [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    assert sorted(map(tuple, on(p, spark, documents=docs(rows)).collect()), key=repr) == expect(encoder, rows)
    assert on(p, spark, documents=docs([])).count() == 0
