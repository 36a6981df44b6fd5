import re
from collections import Counter

import pytest

from conftest import SF_SMALL
from countloom.llm import line_rules as q
from countloom.llm.common import table
from text_fixtures import docs, on  # noqa: F401

CLEAN = "\n".join(f"Line{i} says a{i}, b{i} c{i} then d{i} e{i} with f{i} g{i}." for i in range(12))
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    runs = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + j for i in range(len(words) - 2) if runs[tuple(words[i : i + 3])] > 1 for j in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def found(df):
    return {r.doc_id: r for r in df.collect()}


def test_base_counts_by_brute_force(spark, docs, on):
    texts = [None, "", " \n\t ", "a a a a", "a b c", "a b c a b c d", "x\n\nx\n x\nx", "é é |#*$   <b>&amp;", "\x0b\x0c", CLEAN, CLEAN * 300]
    texts += [r.text for r in table(spark, SF_SMALL, "documents").collect()]
    got = found(on(q, spark, documents=docs([(i, t) for i, t in enumerate(texts)])))
    for i, t in enumerate(texts):
        want = base(t)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])


@pytest.mark.parametrize(
    "line, rule",
    [
        ("A sentence, with a comma.", None),
        ('He said "so be it."', None),
        ("What of it?", None),
        ("The, ble.", None),
        ("A title without an end", "punctuation"),
        ("BUY!! NOW!! IT!! IS!! GOOD!!", "punctuation"),
        ("one### two*** three$$$ four%%%.", "punctuation"),
        ("Home | News | Sport | Weather", "navigation"),
        ("Read more", "navigation"),
        ("  sign in.", "navigation"),
        ("A long sentence may use a | here and another | there, since it has so many words around them.", None),
        ("Copyright 2019 Example Ltd. All rights reserved.", "boilerplate"),
        ("We use cookies, see our privacy policy.", "boilerplate"),
        ("The courts read the privacy policy " + "and weighed each of its words with care " * 4 + "in the end.", None),
    ],
)
def test_lines(line, rule):
    assert q.failed_rule(line, len(line.split())) == rule


def test_lines_go_first_then_documents(spark, docs):
    menu = "Home | News | Sport | Weather | Travel | Culture | More"
    rows = [(1, CLEAN), (2, menu + "\n" + CLEAN + "\n\nAll rights reserved."), (3, CLEAN + "\n" + "\n".join([menu] * 10)), (4, "Too short.")]
    rows += [(None, CLEAN), (5, None), (1, CLEAN)]
    got = q.clean_lines(docs(rows))
    kept = sorted((r.doc_id or 0, r.kept, r.clean_text) for r in got.collect())
    both = [(0, True, CLEAN), (1, True, CLEAN), (1, True, CLEAN), (2, True, CLEAN + "\n"), (3, False, CLEAN), (4, False, "Too short."), (5, False, "")]
    assert kept == both
    assert q.clean_lines(docs([])).count() == 0


def test_good_documents_stay_and_poor_ones_go(spark):
    verdict = found(q.clean_lines(table(spark, "/root/testdata/sf0.1", "documents"), with_text=False))
    labels = table(spark, "/root/testdata/sf0.1", "labels").collect()
    good = [verdict[r.doc_id].kept for r in labels if r.quality == 1 and not verdict[r.doc_id].base_failed]
    poor = [verdict[r.doc_id].kept for r in labels if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(poor) <= 0.1 * len(poor)
