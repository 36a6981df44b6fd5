"""Edge lists.

A line of text is a comma-separated path of vertex ids: each pair of adjacent tokens that differ as
text is an edge, and within one line a later edge replaces an earlier one with the same source.

Parsing is all plain expressions, so it stays in generated code.  Runs of equal tokens are first reduced
to one, after which every two adjacent tokens are an edge and every token belongs to one.  Then sources
and targets are the tokens without the last and without the first, as arrays of numbers, and a position
in them is a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

ID_PATTERN = "^[+-]?[0-9]+$"
_LINE_PATTERN = "^[+-]?[0-9]+(,[+-]?[0-9]+)*$"

# Only lines of three tokens and more are searched for runs.
_TOKENS = r"""
CASE WHEN size(raw) = 1 OR (size(raw) = 2 AND raw[0] <> raw[1]) THEN raw
     ELSE split(regexp_replace(line, '(^|,)([^,]*)(?:,\\2)+(?=,|$)', '$1$2'), ',') END
"""

# Numbers of up to 18 digits fit; only lines with longer ones need a second look.  Joining leaves NULL out.
_BAD = f"""
size(tokens) > 1 AND (NOT line RLIKE '{_LINE_PATTERN}'
    OR (line RLIKE '[0-9]{{19}}'
        AND size(split(array_join(CAST(try_cast(tokens AS ARRAY<BIGINT>) AS ARRAY<STRING>), ','), ',')) < size(tokens)))
"""


def _parsed(lines: DataFrame) -> DataFrame:
    """``(value, tokens, bad)``: tokens without repetitions side by side; empty tokens at the end of a line do
    not count."""
    raw = lines.selectExpr("value", "rtrim(',', value) AS line").selectExpr("value", "line", "split(line, ',') AS raw")
    tokens = raw.selectExpr("value", "line", f"{_TOKENS} AS tokens")
    return tokens.selectExpr("value", "tokens", f"{_BAD} AS bad")


def rejected_lines(lines: DataFrame) -> DataFrame:
    """The lines that name an edge with a token that is no 64-bit integer."""
    return _parsed(lines).where("bad").select("value")


def edges_from_lines(lines: DataFrame, strict: bool = True, mode: str = "last") -> DataFrame:
    """Parse ``value STRING`` lines into the edge multiset ``(u BIGINT, v BIGINT)``.

    ``strict`` fails the job on a token that is no integer; otherwise the whole line is left out, and
    ``rejected_lines`` returns it.  ``mode="all"`` keeps every pair of a line instead of the last per
    source.  Row-local: no shuffle.
    """
    if mode not in ("last", "all"):
        raise ValueError("mode must be 'last' or 'all'")
    on_bad = "raise_error(concat('not an edge line: ', value))" if strict else "NULL"
    numbers = _parsed(lines).selectExpr(f"CASE WHEN bad THEN {on_bad} WHEN size(tokens) > 1 THEN CAST(tokens AS ARRAY<BIGINT>) END AS ids")
    ends = numbers.selectExpr("slice(ids, 1, size(ids) - 1) AS sources", "ids")
    # The plain ``posexplode`` would imply a filter on the array, which the optimizer moves to the scan and
    # expands to every step of parsing, over and over; the outer one does not.
    rows = ends.select("ids", "sources", F.posexplode_outer("sources").alias("at", "u")).where("at IS NOT NULL")
    if mode == "last":
        # The last edge of a source is the first from behind.
        rows = rows.where("size(sources) = 1 OR array_position(reverse(sources), u) = size(sources) - at")
    return rows.selectExpr("u", "ids[at + 1] AS v")


def read_edges(spark: SparkSession, path: str, strict: bool = True, mode: str = "last") -> DataFrame:
    """Edges of the text file or folder at ``path``."""
    return edges_from_lines(spark.read.text(path), strict, mode)


def edges_from_table(table: DataFrame, source: str, target: str) -> DataFrame:
    """Two columns of a table as an edge multiset; only those two are scanned."""
    return table.select(F.col(source).cast("bigint").alias("u"), F.col(target).cast("bigint").alias("v"))
