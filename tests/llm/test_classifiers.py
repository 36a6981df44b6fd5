import zlib

import numpy as np
import pytest

from conftest import SF
from countloom.llm import quality as q, toxicity as t
from countloom.llm.common import table
from text_fixtures import docs, on  # noqa: F401


def accuracy(spark, module, label):
    rows = module.query(spark, SF).join(table(spark, SF, "labels"), "doc_id").select("doc_id", "held_out", "score", "predicted", label).collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % module.FOLDS == module.FOLD)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    unseen = [r for r in rows if r.held_out]
    return np.mean([r.predicted == r[label] for r in unseen])


def test_held_out_accuracy(spark):
    assert accuracy(spark, q, "quality") >= 0.98
    assert accuracy(spark, t, "toxic") >= 0.95


@pytest.mark.parametrize("module, label", [(q, "quality"), (t, "toxic")])
def test_odd_rows(spark, docs, on, module, label):
    good = [(i, f"plain words number {i} about gardens and rivers near town {i * 7}") for i in range(40)]
    bad = [(100 + i, f"idiot {i} " * 30 if label == "toxic" else "spam!! " * (30 + i)) for i in range(40)]
    rows = good + bad + [(None, "x"), (1000, None), (1001, ""), (1002, "long words " * 60_000), (5, good[5][1])]
    positive = {d for d, _ in (bad if label == "toxic" else good)}
    marks = [(d, int(d in positive)) for d, _ in good + bad] + [(None, 1), (1, None), (5, 0), (5, int(5 in positive)), (77777, 1)]
    labels = spark.createDataFrame(marks, f"doc_id BIGINT, {label} INT")
    got = on(module, spark, documents=docs(rows), labels=labels).collect()
    assert len(got) == len(rows) and all(r.score is not None for r in got)
    assert {r.predicted for r in got if r.doc_id in (10, 20)} == {int(label == "quality")}
    assert {r.predicted for r in got if r.doc_id in (110, 120)} == {int(label == "toxic")}
    # Nothing to learn from, and nothing to score.
    none = spark.createDataFrame([], f"doc_id BIGINT, {label} INT")
    assert on(module, spark, documents=docs(rows), labels=none).count() == len(rows)
    assert on(module, spark, documents=docs([]), labels=labels).count() == 0


def test_grammar_states():
    g = t.Grammar({"idiot": 3.0}, {"kill": 3.0})
    kinds = lambda text: [k for clause in g.matches(text) for k, _ in clause]
    assert kinds("you idiots") == ["aimed"]
    assert kinds("what an idiot") == ["plain"]
    assert kinds("you are not an idiot") == ["negated"]
    assert kinds("not now, idiot") == ["plain"]
    assert kinds("not one two three idiot") == ["plain"]
    assert kinds("he said idiot") == ["reported"]
    assert kinds("you: i will kill") == ["threat"]
    assert kinds("they kill") == ["aimed threat"]
    assert g.score(["you idiot"])[0] > g.score(["you are not an idiot"])[0] > g.score(["you are kind"])[0]


def test_ranking_keeps_columns(spark, docs):
    ranking = q.Ranking.fit(np.random.default_rng(0).normal(size=(50, q.FEATURES)), np.arange(50) % 2)
    out = q.with_quality(docs([(1, "a b", "kept"), (2, None, None)]), ranking)
    assert out.columns == ["doc_id", "text", "row", "score"] and out.count() == 2
    assert q.Ranking.fit(np.empty((0, q.FEATURES)), np.empty(0)).score(np.zeros((2, q.FEATURES))).tolist() == [0.5, 0.5]


@pytest.fixture(scope="module")
def fitted(spark):
    return t.train(table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels"))


def test_sentences_by_the_fitted_grammar(fitted):
    score = dict(zip(SENTENCES, fitted.score(SENTENCES)))
    harmless = SENTENCES[SENTENCES.index("killing time") :]
    assert max(score[x] for x in harmless) < 0.2
    assert score["you idiot"] >= score["idiot"] > 0.5 > score["killing time"]
    assert score["what a moron you are"] >= score["what a moron that was"]
    assert score["i will kill you"] > score["i will not kill you"] and score["i will kill you"] > 0.5
    assert score["idiot"] > score["he wrote that word idiot"] and score["you idiot"] > score["you are not an idiot"]


SENTENCES = """idiot|you idiot|what a moron you are|what a moron that was|i will kill you|i will not kill you
he wrote that word idiot|you are not an idiot
killing time|the skill of a killer whale|the path to the garden|mit einem wort gesagt|tras la puerta|idiomatic code""".replace("\n", "|").split("|")


def test_held_out_precision_and_recall(spark, fitted):
    docs, labels = (table(spark, "/root/testdata/sf0.1", name) for name in ("documents", "labels"))
    rows = docs.join(labels, "doc_id").select("doc_id", "text", "toxic").where("toxic IS NOT NULL").collect()
    unseen = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % t.FOLDS == t.FOLD]
    predicted = fitted.score([r.text or "" for r in unseen]) >= 0.5
    toxic = np.array([r.toxic == 1 for r in unseen])
    assert (predicted & toxic).sum() >= 0.9 * max(predicted.sum(), toxic.sum())


def paths_of_cascade(symbols):
    """Every way through the five machines one after the other, without composing them: total weight of each."""
    ways = [(tuple(m.start for m in t.GRAMMAR), 0.0)]
    for symbol, weight in symbols:
        ahead = []
        for states, total in ways:
            steps = [(symbol, 1.0, ())]
            for machine, state in zip(t.GRAMMAR, states):
                steps = [(out, f * g, (*to, s)) for middle, f, to in steps for out, g, s in machine.ways(state, middle)]
            ahead += [(to, total + (weight * f if out in t.KINDS else 0.0)) for out, f, to in steps]
        ways = ahead
    return [total for states, total in ways if all(s in m.finals for s, m in zip(states, t.GRAMMAR))]


def test_the_composed_machine_against_its_parts():
    rng = np.random.default_rng(6)
    for _ in range(300):
        symbols = [(s, 2.0 if s in ("insult", "menace") else 0.0) for s in rng.choice(t.ALPHABET, rng.integers(1, 8))]
        emitted = t.best_path(t.MACHINE, symbols)
        assert sum(w for _, w in emitted) == pytest.approx(max(paths_of_cascade(symbols)))


def test_threats_need_somebody():
    g = t.Grammar({"idiot": 3.0}, {"kill": 3.0})
    kinds = lambda text: [k for clause in g.matches(text) for k, _ in clause]
    assert kinds("killing time") == kinds("the killer whale") == [] and kinds("we killed it") == ["threat"]
    assert kinds("kill them all") == ["aimed threat"] and kinds("never kill them") == ["negated"]
    assert kinds("idiots like you") == ["aimed"] and kinds("idiomatic") == []
