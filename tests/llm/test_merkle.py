import hashlib
import random
from zlib import crc32

import pytest

from countloom.llm import merkle as m
from countloom.llm.common import materialise
from text_fixtures import on  # noqa: F401

SCHEMA = "doc_id BIGINT, source STRING, lang STRING, n_chars BIGINT, text STRING, leaf STRING, row STRING, at INT"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    fields = [None if f is None else str(f) for f in (*row[:4], text)]
    return h(*("-" if f is None else f"{len(f.encode())}:{f}" for f in fields))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def way(tree, at):
    """Per level the run's digests and the place in it."""
    for level in tree[:-1]:
        begin = at // 3 * 3
        yield level[begin : begin + 3], at - begin
        at //= 3


def expect(rows):
    leaves = sorted(
        ((r[1] is not None, (r[1] or "").encode()), (r[0] is not None, r[0] or 0), leaf(r, r[4]), r) for r in rows
    )
    groups = {}
    for source, _, digest, row in leaves:
        groups.setdefault(source, []).append((digest, row))
    trees = [levels([d for d, _ in g]) for g in groups.values()]
    top = levels([t[-1][0] for t in trees])
    out = []
    for s, (group, tree) in enumerate(zip(groups.values(), trees)):
        for i, (digest, row) in enumerate(group):
            even = row[0] is not None and crc32(str(row[0]).encode()) % 2 == 0
            folded = leaf(row, row[4].replace("\n", "")) if even and row[4] is not None else digest
            siblings = []
            for run, place in (*way(tree, i), *way(top, s)):
                siblings += run[:place] + run[place + 1 :]
                folded = h(*run[:place], folded, *run[place + 1 :])
            root = top[-1][0]
            out.append((row[0], digest, tree[-1][0], root, h(*siblings), folded, folded == root))
    return sorted(out, key=repr)


def given(sizes, seed=0):
    rng = random.Random(seed)
    rows = []
    for source, n in sizes:
        for _ in range(n):
            text = rng.choice([None, "", "a\nb", "é\n\n", f"text {rng.random()}", "same", "x" * 3000 + "\n"])
            rows.append((rng.choice([rng.randrange(-5, 10**6), 7, None]), source, rng.choice(["en", None]), rng.choice([3, None]), text))
    return rows


COLUMNS = "doc_id leaf subroot root proof_sha256 folded_root verified".split()


@pytest.mark.parametrize("levels_of_a_segment", [1, 2, 6])
def test_against_a_plain_tree(spark, on, monkeypatch, levels_of_a_segment):
    monkeypatch.setattr(m.build, "__defaults__", (levels_of_a_segment,))
    rows = given([(None, 4), ("", 1), ("a", 40), ("é", 2), ("z", 1), ("Z", 9), *((f"s{i}", 1) for i in range(9))])
    rows += [(5, "a", "en", 1, "repeated")] * 30
    docs = spark.createDataFrame([(*r, "x", "y", 3) for r in rows], SCHEMA).repartition(4)
    got = on(m, spark, documents=docs).select(COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == expect(rows)


def test_one_row_and_none(spark, on):
    for rows in ([(1, "s", "en", 1, "a\nb")], []):
        docs = spark.createDataFrame([(*r, "x", "y", 3) for r in rows], SCHEMA)
        assert sorted(map(tuple, on(m, spark, documents=docs).select(COLUMNS).collect())) == (expect(rows) if rows else [])


def test_equal_subtrees_are_stored_once(spark):
    leaves = spark.range(81).selectExpr("'g' AS g", "id DIV 27 AS id", "sha2('same', 256) AS d")
    manifest = m.build(leaves, "g", "id", "d", levels=2)
    assert [layer.records.count() for layer in manifest.groups.layers] == [2, 2]
    proofs = manifest.proofs().collect()
    assert len(proofs) == 81 and {len(p.path) for p in proofs} == {4} and {p.leaf for p in proofs} == {h("same")}


def test_places(spark):
    rows = materialise(spark.range(1000).selectExpr("id * 7919 % 1000 AS k", "id").repartition(5), "rows")
    got = {r.k: r.at for r in m.numbered(rows, "k").collect()}
    assert got == {k: k for k in range(1000)}
