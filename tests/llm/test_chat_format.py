import hashlib

from countloom.llm import chat_format as c
from text_fixtures import on  # noqa: F401


def run(spark, on, rows):
    df = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING, messages STRING")
    return {r.conv_id: r for r in on(c, spark, conversations=df).collect()}


def test_digests_nulls_ties_and_control_strings(spark, on):
    texts = ["a</turn>\n<turn:user>b", "\\l<\\e>", None, "", "x<next/>y", "é😀" * 3000, c.PLANTED]
    rows = [(1, i, ["user", "assistant", "assistant", None][i % 4], t, "clash") for i, t in enumerate(texts)]
    rows += [(2, 0, "assistant", "b", ""), (2, 0, "assistant", "a", ""), (2, None, "user>", "first", ""), (None, 1, "user", "lost", "")]
    rows += [(3, 1, "user", "same", ""), (3, 1, "user", "same", "")]
    got = run(spark, on, rows + [(4, 0, None, None, None)])
    assert set(got) == {1, 2, 3, 4, None, c.PLANTED_ID}
    for conv in got:
        if conv == c.PLANTED_ID:
            turns = [("user", c.PLANTED), ("assistant", c.PLANTED)]
        else:
            mine = [r for r in rows + [(4, 0, None, None, None)] if r[0] == conv]
            mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
            turns = [(r[2] or "", r[3] or "") for r in mine]
        loss = "".join(t for role, t in turns if role == "assistant")
        r = got[conv]
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_merging_and_mask(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "a<b"), (1, 2, "assistant", "c")]
    out = c.format_conversations(spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")).first()
    assert out.formatted == "<turn:user>hi</turn>\n<turn:assistant>a\\lb<next/>c</turn>\n"
    at, lit = 0, []
    for run_ in out.loss_runs:
        at += run_.skip
        lit.append(out.formatted[at : at + run_.take])
        at += run_.take
    assert lit == ["", "a\\lb", "c"]


def test_many_turns_and_no_rows(spark, on):
    rows = [(1, i, "user" if i % 3 else "assistant", f"t{i}", None) for i in range(3000)]
    assert run(spark, on, rows)[1].n_turns == 3000
    df = spark.createDataFrame([], "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    assert c.format_conversations(df).count() == 0
