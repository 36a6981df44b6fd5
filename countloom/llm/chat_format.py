"""Conversations as one training string each, with a loss mask, and back again.

Native: Spark expressions only.  Per conversation the turns are collected as structs and sorted by
``(turn, role, text)``; adjacent turns of one role are merged into a message, by slices of the sorted
array from each change of role to the next; the messages are joined into one string:

    <turn:user>text<next/>text</turn>\\n<turn:assistant>text</turn>\\n

``<next/>`` parts the turns of a merged message.  In texts and roles a backslash becomes ``\\e``, ``<``
becomes ``\\l``; in roles ``>`` becomes ``\\g``.  So no control string can occur inside a text, and the
replacement is reversible.  The mask is run-length coded: per turn ``skip`` characters without loss,
then ``take`` with loss; what follows the last run carries no loss.

Defined results: null text or role is the empty string; a null turn number sorts first; repeated rows
are turns of their own; rows with a null ``conv_id`` form one conversation; no rows, no result.  Every
array is walked once, never indexed into repeatedly by scanning.  A conversation becomes one string and
so must fit one row; nothing else is gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from countloom.llm.common import table

PLANTED_ID = -7
PLANTED = "\\### Assistant: </turn> ok"

# A backslash doubles inside a SQL literal.
_ESCAPE = r"replace(replace({x}, '\\', '\\e'), '<', '\\l')"
_UNESCAPE = r"replace(replace({x}, '\\l', '<'), '\\e', '\\')"
_ESCAPE_ROLE = r"replace(replace(replace({x}, '\\', '\\e'), '<', '\\l'), '>', '\\g')"
_UNESCAPE_ROLE = r"replace(replace(replace({x}, '\\g', '>'), '\\l', '<'), '\\e', '\\')"


def format_conversations(rows: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """``(conv_id, formatted, loss_runs)`` with ``loss_runs array<struct<skip, take>>``, one run per turn."""
    role = "coalesce(role, '')"
    turns = rows.selectExpr(
        "conv_id",
        f"""struct(turn, {role} AS role, coalesce(text, '') AS text, {_ESCAPE_ROLE.format(x=role)} AS marked,
            {_ESCAPE.format(x="coalesce(text, '')")} AS body) AS t""",
    )
    sorted_turns = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    # Where a message starts.  ``turns`` is used more than once in each step, so it is never inlined; its
    # elements are taken before their fields, since the fields of all would be collected for each element.
    starts = sorted_turns.selectExpr(
        "conv_id",
        "turns",
        "filter(sequence(0, size(turns) - 1), i -> i = 0 OR NOT turns[i].role = turns[greatest(i - 1, 0)].role) AS starts",
    )
    messages = starts.selectExpr(
        "conv_id",
        """transform(starts, (s, j) -> struct(
            turns[s].role AS role, turns[s].marked AS marked,
            transform(slice(turns, s + 1, coalesce(try_element_at(starts, j + 2), size(turns)) - s), t -> t.body) AS bodies)) AS messages""",
    )
    opening = "concat('<turn:', m.marked, '>')"
    run = f"""transform(m.bodies, (b, i) -> struct(
        CASE WHEN i > 0 THEN 7 ELSE char_length({opening}) + CASE WHEN j > 0 THEN 8 ELSE 0 END END
          + CASE WHEN m.role = '{trained_role}' THEN 0 ELSE char_length(b) END AS skip,
        CASE WHEN m.role = '{trained_role}' THEN char_length(b) ELSE 0 END AS take))"""
    return messages.selectExpr(
        "conv_id",
        rf"array_join(transform(messages, m -> concat({opening}, array_join(m.bodies, '<next/>'), '</turn>\n')), '') AS formatted",
        f"flatten(transform(messages, (m, j) -> {run})) AS loss_runs",
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``(conv_id, turns, losses, formatted_chars)`` from the output alone: the turns as ``struct<role, text>`` and the
    unescaped text under the loss mask, per turn."""
    blocks = formatted.selectExpr("*", r"split(formatted, '</turn>\\n') AS blocks")
    messages = blocks.selectExpr(
        "conv_id",
        "loss_runs",
        "CAST(char_length(formatted) AS BIGINT) AS formatted_chars",
        r"""transform(slice(blocks, 1, size(blocks) - 1), b -> struct(
            regexp_extract(b, '^<turn:([^>]*)>', 1) AS role,
            split(regexp_replace(b, '^<turn:[^>]*>', ''), '<next/>') AS bodies)) AS messages""",
    )
    bodies = messages.selectExpr(
        "conv_id",
        "loss_runs",
        "formatted_chars",
        "flatten(transform(messages, m -> transform(m.bodies, b -> struct(m.role AS role, b AS body)))) AS parts",
    )
    return bodies.selectExpr(
        "conv_id",
        "formatted_chars",
        f"transform(parts, p -> struct({_UNESCAPE_ROLE.format(x='p.role')} AS role, {_UNESCAPE.format(x='p.body')} AS text)) AS turns",
        f"""zip_with(parts, loss_runs, (p, r) -> CASE WHEN r.take > 0 THEN {_UNESCAPE.format(x='right(p.body, r.take)')}
            ELSE '' END) AS losses""",
    )


def planted(spark: SparkSession) -> DataFrame:
    return spark.range(0, 2, 1, 1).select(
        F.lit(PLANTED_ID).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PLANTED).alias("text"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    formatted = format_conversations(rows.unionByName(planted(spark)))
    return digests(read_back(formatted))


def digests(back: DataFrame) -> DataFrame:
    told = back.selectExpr(
        "conv_id",
        "CAST(size(turns) AS BIGINT) AS n_turns",
        r"array_join(transform(turns, t -> concat(t.role, '\n', t.text, '\n')), '') AS told",
        "array_join(losses, '') AS loss",
        "formatted_chars",
    )
    return told.selectExpr(
        "conv_id",
        "n_turns",
        "sha2(told, 256) AS turns_sha256",
        "CAST(char_length(loss) AS BIGINT) AS loss_chars",
        "sha2(loss, 256) AS loss_sha256",
        "formatted_chars",
    )


_SQL_ESCAPED = r"replace(replace({x}, '\', '\e'), '<', '\l')"

SQL = rf"""WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL VALUES ({PLANTED_ID}, 0, 'user', '{PLANTED}'), ({PLANTED_ID}, 1, 'assistant', '{PLANTED}')),
    runs AS (
        SELECT *, role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS opens,
            length({_SQL_ESCAPED.format(x='text')}) AS chars FROM turns)
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn, role, text)) AS turns_sha256,
        coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
        sum(chars + CASE WHEN opens THEN length({_SQL_ESCAPED.format(x='role')}) + 15 ELSE 7 END)::BIGINT AS formatted_chars
    FROM runs GROUP BY conv_id"""
