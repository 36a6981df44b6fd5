"""The pipeline against the same stages done by hand on a small corpus."""

import corpus_pipeline as cp
from conftest import SF_SMALL
from countloom.llm import pieces
from countloom.llm.common import materialise, table
from test_decontaminate import brute as contaminated
from test_pieces import expect as encoded
from test_simhash import expect as classes


def test_stage_by_stage(spark):
    docs = table(spark, SF_SMALL, "documents")
    kept = {}
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        kept[name] = {r.doc_id: r.text for r in out.collect()}
        assert out.columns == docs.columns
        docs = out
    labels = {r.doc_id: r.quality for r in table(spark, SF_SMALL, "labels").collect()}
    texts = {r.doc_id: r.text for r in table(spark, SF_SMALL, "documents").collect()}
    good = kept["quality"]
    assert all(labels[d] == (d in good) for d in labels if d in texts)
    low = lambda t: "".join(c.lower() if c.isascii() else c for c in t)
    last = {}
    for d in sorted(good):
        last[low(good[d])] = d
    assert set(kept["exact_dedup"]) == set(last.values())
    near = {d for d, _, c in classes(sorted(kept["exact_dedup"].items())) if d == c}
    assert set(kept["near_dedup"]) == near
    items = [(r.item_id, r.text) for r in table(spark, SF_SMALL, "benchmark").collect()]
    clean = {row[0] for row in contaminated(sorted(kept["near_dedup"].items()), items) if not row[-1]}
    assert set(kept["decontamination"]) == clean
    got = sorted(map(tuple, cp.run(spark, SF_SMALL).collect()), key=repr)
    assert got == encoded(pieces.encoder(pieces.default_model()), sorted(kept["decontamination"].items()))


CLASHES = "row all doc score _score _row _all _sid rank kept items hits n_words fp text_a".split()


def test_stages_keep_columns_of_any_name_and_type(spark):
    given = table(spark, SF_SMALL, "documents")
    wide = given.selectExpr("*", *(f"concat('{c}', doc_id) AS {c}" for c in CLASHES), "map('k', text) AS `a map`")
    wide = materialise(wide, "wide")
    for name, stage in cp.STAGES[:-1]:
        plain, rich = stage(spark, given, SF_SMALL), stage(spark, wide, SF_SMALL)
        assert rich.schema == wide.schema, name
        kept = {r.doc_id for r in plain.collect()}
        rows = rich.collect()
        assert {r.doc_id for r in rows} == kept and len(rows) == len(kept)
        assert all(r[c] == f"{c}{r.doc_id}" for r in rows for c in CLASHES) and all(r["a map"] == {"k": r.text} for r in rows)


def test_stages_on_an_empty_table(spark):
    docs = table(spark, SF_SMALL, "documents").where("false")
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.count() == 0
    assert cp.STAGES[-1][1](spark, docs, SF_SMALL).count() == 0
