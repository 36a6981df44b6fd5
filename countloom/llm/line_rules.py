"""Quality rules that work line by line first, and on the document only then.

Each line with a word is put to three tests: punctuation (it must end like a sentence, and have no more
punctuation characters than words), navigation (separators between few words, or a phrase that only menus
have), and boilerplate (notices in short lines).  Lines that fail are taken out, and a document is rejected if
more than ``MOST_LOST`` percent of its words went with them, or if it fails the base rules, which look at its
whole text: too few words, or too many in runs of three that occur again.

One pass, row by row, without a shuffle; every document is seen whole, one at a time.

Defined results: a null text is an empty one and fails the base rules; the text given back is the lines that
pass and the lines without a word, in order; repeated rows are judged each; an empty table gives an empty
result.  Only the id and the text are looked at, whatever other columns there are.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from countloom.llm.common import table, text_of, with_batches

# Base rules: words at least; percent of words in repeated runs at most.
FEWEST_WORDS, MOST_REPEATED, RUN_WORDS = 50, 50, 3
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
# Line rules.  Percent of words that may go with failed lines.
MOST_LOST = 30
# A line ends like a sentence: a mark, and perhaps closing quotes or brackets.
SENTENCE_END = r"""[.!?:;…。！？][)"'\]»”’]*[\x20\x09-\x0D]*$"""
PUNCTUATION = r"[!\"#$%&()*+,./:;<=>?@\[\\\]^_`{|}~]"
# A menu has this many separators, and one for every so many words.
SEPARATOR, FEWEST_SEPARATORS, WORDS_PER_SEPARATOR = "[|»›•·>]", 2, 4
MENU_LINE = (
    r"(?i)^[\x20\x09-\x0D]*(home|menu|search|log ?in|log ?out|sign ?in|sign ?up|register|contact( us)?|about( us)?|sitemap|"
    r"skip to( main)? content|next( page| post)?|previous( page| post)?|back( to top)?|read more|show more|load more|"
    r"share( this)?|print( this page)?|reply|tags?|categories)[\x20\x09-\x0D.:!]*$"
)
# Notices, in lines of so many words at most: a long paragraph that mentions one is text.
NOTICE_WORDS = 30
NOTICE = (
    r"(?i)(all rights reserved|copyright (©|\(c\)|[0-9]{4})|©|privacy policy|cookie policy|(use|uses|accept) (of )?cookies|"
    r"terms of (use|service)|terms and conditions|subscribe to|newsletter|enable javascript|powered by|lorem ipsum|click here|"
    r"licensed under|without warranty)"
)
_END, _MARK, _SEPARATOR = re.compile(SENTENCE_END), re.compile(PUNCTUATION), re.compile(SEPARATOR)
_MENU, _NOTICE = re.compile(MENU_LINE), re.compile(NOTICE)
RULES = "punctuation", "navigation", "boilerplate"


def failed_rule(line: str, words: int) -> str | None:
    """The first rule that a line of ``words`` words fails, if any."""
    marks = len(_MARK.findall(line))
    separators = len(_SEPARATOR.findall(line))
    if _MENU.search(line) or (separators >= FEWEST_SEPARATORS and separators * WORDS_PER_SEPARATOR >= words):
        return "navigation"
    if words <= NOTICE_WORDS and _NOTICE.search(line):
        return "boilerplate"
    if marks > words or not _END.search(line):
        return "punctuation"
    return None


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a run of three that occurs twice or more."""
    n = len(words)
    if n <= RUN_WORDS:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    # Runs are numbered from their first words on, so keys stay below ``n * n``.
    run = ids
    for j in range(1, RUN_WORDS):
        _, run = np.unique(run[:-1] * len(number) + ids[j:], return_inverse=True)
    again = np.flatnonzero(np.bincount(run)[run] > 1)
    covered = np.zeros(n, bool)
    for j in range(RUN_WORDS):
        covered[again + j] = True
    return int(covered.sum())


def judge(text: str) -> tuple:
    """``(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lines, lines per rule, words lost, text left)``."""
    words = text.encode().split()
    seen: set[str] = set()
    duplicates = lost = lines = 0
    failures = dict.fromkeys(RULES, 0)
    left = []
    for line in text.split("\n"):
        count = len(line.encode().split())
        if count:
            lines += 1
            duplicates += line in seen
            seen.add(line)
            if rule := failed_rule(line, count):
                failures[rule] += 1
                lost += count
                continue
        left.append(line)
    blanks, symbols = (sum(text.count(c) for c in some) for some in (BLANKS, SYMBOLS))
    return (len(words), len(text) - blanks, symbols, duplicates, repeated_words(words), lines, *failures.values(), lost, "\n".join(left))


COLUMNS = "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines".split() + [f"n_{r}" for r in RULES] + ["words_lost"]


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """Per document the id, the counts ``COLUMNS``, ``base_failed``, ``kept`` and, if asked for, ``clean_text``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def columns(found: Iterable[tuple]) -> list[pa.Array]:
        by_column = list(zip(*found))
        return [pa.array(c, pa.int64()) for c in by_column[:-1]] + [pa.array(by_column[-1], pa.string())] * with_text

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = columns(judge(t) for t in batch.column("text").to_pylist())
        return pa.record_batch([batch.column("doc_id"), *found], names=["doc_id", *COLUMNS, *["clean_text"] * with_text])

    schema = f"doc_id {kind}, {', '.join(f'{c} bigint' for c in COLUMNS)}" + ", clean_text string" * with_text
    judged = with_batches(rows, work, schema)
    base = f"n_words < {FEWEST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words"
    return judged.withColumn("base_failed", F.expr(base)).withColumn(
        "kept", F.expr(f"NOT base_failed AND 100 * words_lost <= {MOST_LOST} * n_words")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_lines(table(spark, sf_dir, "documents"), with_text=False)


def _sql_text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


_WORD = r"'[^\x20\x09-\x0D]+'"


def _found(pattern: str, text: str) -> str:
    return f"len(regexp_extract_all({text}, {_sql_text(pattern)}))"


SQL = rf"""WITH docs AS (
        SELECT row_number() OVER () AS r, doc_id, t, regexp_extract_all(t, {_WORD}) AS ws FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
    lines AS (
        SELECT r, line, row_number() OVER (PARTITION BY r, line ORDER BY pos) > 1 AS again, len(regexp_extract_all(line, {_WORD})) AS w,
            {_found(PUNCTUATION, 'line')} AS marks, {_found(SEPARATOR, 'line')} AS separators
        FROM (SELECT r, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS pos FROM docs)),
    judged AS (
        SELECT r, w, again, CASE
            WHEN regexp_matches(line, {_sql_text(MENU_LINE)})
                OR (separators >= {FEWEST_SEPARATORS} AND separators * {WORDS_PER_SEPARATOR} >= w) THEN 'navigation'
            WHEN w <= {NOTICE_WORDS} AND regexp_matches(line, {_sql_text(NOTICE)}) THEN 'boilerplate'
            WHEN marks > w OR NOT regexp_matches(line, {_sql_text(SENTENCE_END)}) THEN 'punctuation' END AS rule
        FROM lines WHERE w > 0),
    by_doc AS (
        SELECT r, count(*) AS n_lines, count(*) FILTER (again) AS n_dup_lines,
            {', '.join(f"count(*) FILTER (rule = '{rule}') AS n_{rule}" for rule in RULES)},
            coalesce(sum(w) FILTER (rule IS NOT NULL), 0)::BIGINT AS words_lost
        FROM judged GROUP BY r),
    words AS (SELECT r, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM docs),
    runs AS (
        SELECT r, i, count(*) OVER (PARTITION BY r, w, w1, w2) AS times
        FROM (SELECT *, lead(w) OVER doc AS w1, lead(w, 2) OVER doc AS w2 FROM words WINDOW doc AS (PARTITION BY r ORDER BY i)) WHERE w2 IS NOT NULL),
    repeated AS (
        SELECT r, count(DISTINCT pos) AS n FROM (SELECT r, unnest(range(i, i + 3)) AS pos FROM runs WHERE times > 1) GROUP BY r),
    counted AS (
        SELECT doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
            {_found('[' + SYMBOLS + ']', 't')}::BIGINT AS n_symbols, coalesce(repeated.n, 0)::BIGINT AS n_repeat_words,
            {', '.join(f'coalesce({c}, 0)::BIGINT AS {c}' for c in ('n_lines', 'n_dup_lines', *(f'n_{r}' for r in RULES), 'words_lost'))}
        FROM docs LEFT JOIN by_doc USING (r) LEFT JOIN repeated USING (r))
    SELECT *, n_words < {FEWEST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
        NOT base_failed AND 100 * words_lost <= {MOST_LOST} * n_words AS kept
    FROM counted"""
