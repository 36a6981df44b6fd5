"""Toxicity by a weighted finite-state grammar over clauses.

A lexicon turns the words of a clause into symbols: insult or threat with a weight, person, self, negation, report,
other.  Five weighted transducers read them, one after the other, and ``compose`` makes one machine of them:

* insult: an insult becomes a plain hit;
* threat: a threatening verb becomes a hit if a first person or a target goes before it, or a target comes
  after it, and any other word if not (two ways at once, of which one dies);
* target: hits of a clause that names a person, before or after, are aimed;
* negation: hits in the words after a negation are negated;
* reported speech: hits after a verb of saying are reported.

An arc multiplies the weight of the word it reads by a factor: over 1 if aimed, under 1 if negated or reported.  A
clause is scored by its best path to a final state, as the sum of what that emits; a document by the sum over
its clauses and by the worst of them, with weights that cannot be negative.  So a hit aimed counts more
than the same hit plain, and one negated or reported less.  Words are read whole, in their listed form or with an ending of
inflection, or by a stem that has been seen with several endings; they count only by the path of their clause.

Learned from labelled documents, at most ``SAMPLE_ROWS`` by order of a hash: the insults of any language, which are
words, and beginnings common to ``LEAST_FORMS`` words or more, that are found in toxic documents and hardly in others, with
their log-odds as weights; and the logistic weights of the document's two figures.  Everything else sees
every row and whole texts.

Defined results: a null text is an empty one, which scores as a text without any match; without labels the
priors and the listed words decide; a null id is held out; repeated rows are scored each; only ``doc_id``
and ``text`` are looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from countloom.llm.common import materialise, table, text_of, with_batches
from countloom.llm.labelled import fit_logistic, held_out, labelled_sample

FOLDS, FOLD = 5, 0
SAMPLE_ROWS = 8_000
# Insults: least letters, the least number of toxic documents that show one; letters of a stem, and the least number of
# different words that begin with it.
SHORTEST, LEAST_DOCS = 3, 3
STEM_LETTERS, LEAST_FORMS = range(4, 10), 3
# Innocent words to be expected among those learned.
FALSE_WORDS = 0.2
# Weight of a listed word, and the bounds of a learned one.
LISTED, LEAST_WEIGHT, MOST_WEIGHT = 3.0, 1.0, 6.0
# How many words after a negation are under it.
NEGATED_WORDS = 3
AIMED, NEGATED, REPORTED = 1.5, 0.2, 0.3
# Words seen by a worker whose symbol is remembered.
REMEMBERED = 200_000

# Word lists of the grammar: English, German, French, Spanish.
INSULTS = "idiot moron loser scum stupid pathetic worthless disgusting trash dumb fool bastard jerk".split()
THREATS = "kill hurt destroy murder burn beat stab shoot töten umbringen tuer frapper matar golpear".split()
SELVES = "i we ich wir je nous yo nosotros".split()
PERSONS = "you your he she they him her them these those du ihr sie tu vous ils elles tú usted ellos ellas".split()
NEGATIONS = "not no never isn't aren't wasn't don't nicht kein keine nie pas jamais aucun nunca jamás".split()
REPORTS = "said says wrote claims claimed quoted sagte schrieb behauptet dit écrit affirme dijo escribió afirma".split()
ENDINGS = ("s", "es", "'s", "ed", "d", "ing")

_CLAUSE = re.compile(r"[.!?;:,\n|]+")
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")

KINDS = ("plain", "aimed", "negated", "reported", "threat", "aimed threat")
# Constant; sum over clauses and worst clause, both damped.
FEATURES = 3
PRIOR = np.array([-3.0, 1.0, 2.0])


# -- transducers ----------------------------------------------------------------------------------

State = int | tuple
Way = tuple[str, float, State]


@dataclass(frozen=True)
class Transducer:
    """``arcs[state][symbol]``: the ways on, ``(output, factor, next state)``.  Symbols without an arc pass unchanged."""

    arcs: dict[State, dict[str, tuple[Way, ...]]]
    finals: frozenset
    start: State = 0

    def ways(self, state: State, symbol: str) -> tuple[Way, ...]:
        return self.arcs[state].get(symbol, ((symbol, 1.0, state),))


def compose(first: Transducer, second: Transducer, alphabet: tuple[str, ...]) -> Transducer:
    """The machine that reads ``alphabet`` as ``first`` and what that writes as ``second``: factors multiply."""
    start = (first.start, second.start)
    arcs: dict[State, dict[str, tuple[Way, ...]]] = {}
    waiting = [start]
    while waiting:
        state = waiting.pop()
        if state in arcs:
            continue
        arcs[state] = {
            symbol: tuple(
                (out, f * g, (s, t)) for middle, f, s in first.ways(state[0], symbol) for out, g, t in second.ways(state[1], middle)
            )
            for symbol in alphabet
        }
        waiting += [to for ways in arcs[state].values() for _, _, to in ways]
    return Transducer(arcs, frozenset(s for s in arcs if s[0] in first.finals and s[1] in second.finals), start)


ALPHABET = ("insult", "menace", "person", "self", "negation", "report", "other")
HITS = ("plain", "aimed", "threat", "aimed threat")

INSULT = Transducer({0: {"insult": (("plain", 1.0, 0),)}}, frozenset([0]))

# 0: nobody yet; 1: somebody before; 2: a target is promised and must still come.
_MET = {"person": (("person", 1.0, 1),)}
THREAT = Transducer(
    {
        0: {"menace": (("other", 1.0, 0), ("threat", 1.0, 2)), "self": (("self", 1.0, 1),)} | _MET,
        1: {"menace": (("threat", 1.0, 1),)},
        2: {"menace": (("threat", 1.0, 2),)} | _MET,
    },
    frozenset([0, 1]),
)

_AIM = {"plain": "aimed", "threat": "aimed threat"}
TARGET = Transducer(
    {
        0: {hit: ((hit, 1.0, 0), (aimed, AIMED, 2)) for hit, aimed in _AIM.items()} | _MET,
        1: {hit: ((aimed, AIMED, 1),) for hit, aimed in _AIM.items()},
        2: {hit: ((aimed, AIMED, 2),) for hit, aimed in _AIM.items()} | _MET,
    },
    frozenset([0, 1]),
)

# The state counts the words still under the negation.
NEGATION = Transducer(
    {0: {"negation": (("negation", 1.0, NEGATED_WORDS),)}}
    | {
        left: {symbol: ((symbol, 1.0, left - 1),) for symbol in ("person", "self", "report", "other")}
        | {hit: (("negated", NEGATED, left - 1),) for hit in HITS}
        | {"negation": (("negation", 1.0, NEGATED_WORDS),)}
        for left in range(1, NEGATED_WORDS + 1)
    },
    frozenset(range(NEGATED_WORDS + 1)),
)

REPORT = Transducer(
    {0: {"report": (("report", 1.0, 1),)}, 1: {hit: (("reported", REPORTED, 1),) for hit in HITS}}, frozenset([0, 1])
)

GRAMMAR = (INSULT, THREAT, TARGET, NEGATION, REPORT)
MACHINE = GRAMMAR[0]
for _next in GRAMMAR[1:]:
    MACHINE = compose(MACHINE, _next, ALPHABET)


def best_path(machine: Transducer, symbols: list[tuple[str, float]]) -> list[tuple[str, float]]:
    """What the heaviest path to a final state emits: ``(kind, weight)`` per hit."""
    best: dict[State, tuple[float, tuple]] = {machine.start: (0.0, ())}
    for symbol, weight in symbols:
        ahead: dict[State, tuple[float, tuple]] = {}
        for state, (total, emitted) in best.items():
            for out, factor, to in machine.ways(state, symbol):
                hit = out in KINDS
                reached = (total + weight * factor, (emitted, (out, weight * factor))) if hit else (total, emitted)
                if to not in ahead or reached[0] > ahead[to][0]:
                    ahead[to] = reached
        best = ahead
    # Emissions are linked from the last one back.
    linked = max((best[s] for s in best if s in machine.finals), key=lambda x: x[0])[1]
    out = []
    while linked:
        linked, hit = linked
        out.append(hit)
    return out[::-1]


@dataclass(frozen=True)
class Grammar:
    """The lexicon, by whole words, and the weights of a document's figures."""

    insults: dict[str, float]
    threats: dict[str, float]
    weights: tuple[float, ...] = tuple(PRIOR)
    stems: dict[str, float] = field(default_factory=dict)
    _known: dict = field(default_factory=dict, compare=False, repr=False)

    def __getstate__(self):
        return {"insults": self.insults, "threats": self.threats, "weights": self.weights, "stems": self.stems, "_known": {}}

    def __setstate__(self, state):
        self.__dict__.update(state)

    def _symbol(self, word: str) -> tuple[str, float]:
        for symbol, listed in (("person", PERSONS), ("self", SELVES), ("negation", NEGATIONS), ("report", REPORTS)):
            if word in listed:
                return symbol, 0.0
        for form in (word, *(word[: -len(e)] for e in ENDINGS if word.endswith(e))):
            for symbol, lexicon in (("menace", self.threats), ("insult", self.insults)):
                if form in lexicon:
                    return symbol, lexicon[form]
        for end in STEM_LETTERS:
            if len(word) >= end and word[:end] in self.stems:
                return "insult", self.stems[word[:end]]
        return "other", 0.0

    def symbol(self, word: str) -> tuple[str, float]:
        """Of a word in lower case."""
        known = self._known.get(word)
        if known is None:
            if len(self._known) >= REMEMBERED:
                self._known.clear()
            known = self._known[word] = self._symbol(word)
        return known

    def matches(self, text: str) -> list[list[tuple[str, float]]]:
        """Per clause with a hit, its emissions."""
        found = []
        if not any(self.symbol(w)[1] for w in set(_WORD.findall(text))):
            return found
        for clause in _CLAUSE.split(text):
            symbols = [self.symbol(w) for w in _WORD.findall(clause)]
            if any(weight for _, weight in symbols):
                emitted = best_path(MACHINE, symbols)
                if emitted:
                    found.append(emitted)
        return found

    def features(self, text: str) -> list[float]:
        clauses = [sum(weight for _, weight in clause) for clause in self.matches(text.lower())]
        return [1.0, math.log1p(sum(clauses)), math.log1p(max(clauses, default=0.0))]

    def score(self, texts: list[str]) -> np.ndarray:
        x = np.array([self.features(t) for t in texts]).reshape(-1, FEATURES)
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.weights), -30, 30)))


def _one_of_alike(sample: DataFrame) -> DataFrame:
    """One document of each set that shares the least hash of its words.

    Copies of a toxic document would otherwise vouch for each of its innocent words.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        least = [min((xxhash.xxh64_intdigest(w) >> 1 for w in set(t.split())), default=0) for t in texts]
        return pa.record_batch([batch.column("label"), batch.column("text"), pa.array(least, pa.int64())], names=["label", "text", "least"])

    marked = with_batches(sample.select("label", "text"), work, "label int, text string, least bigint")
    return materialise(marked.groupBy("least").agg(F.max_by("text", F.struct("label", "text")).alias("text"), F.max("label").alias("label")), "alike")


def _stems_of(word: str) -> list[str]:
    return [word[:end] for end in STEM_LETTERS if end <= len(word)]


def _counted(part: DataFrame, wanted: frozenset | None = None) -> DataFrame:
    """``(key, stem, n)``: words, and with ``stem`` true their beginnings, and the documents that show them."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        seen: Counter[tuple[str, bool]] = Counter()
        for text in batch.column("text").to_pylist():
            words = {w for w in _WORD.findall(text.lower()) if len(w) >= SHORTEST}
            keys = {(w, False) for w in words} | {(stem, True) for w in words for stem in _stems_of(w)}
            seen.update(keys if wanted is None else keys & wanted)
        keys = list(seen)
        return pa.record_batch(
            [pa.array([k for k, _ in keys], pa.string()), pa.array([s for _, s in keys], pa.bool_()), pa.array([seen[k] for k in keys], pa.int64())],
            names=["key", "stem", "n"],
        )

    return with_batches(part.select("text"), work, "key string, stem boolean, n bigint").groupBy("key", "stem").agg(F.sum("n").alias("n"))


def _counts(sample: DataFrame) -> tuple[dict[tuple[str, bool], int], dict[tuple[str, bool], int]]:
    """Per word and per stem of several words, the toxic and the clean documents that show it; those of too few toxic
    documents are left out."""
    toxic = materialise(_counted(sample.where("label = 1")), "toxic-words")
    forms = toxic.where("NOT stem").select(F.explode(F.transform(F.lit(list(STEM_LETTERS)), lambda n: F.when(F.length("key") >= n, F.left("key", n)))).alias("key"))
    several = forms.where("key IS NOT NULL").groupBy("key").agg(F.count(F.lit(1)).alias("forms")).where(F.col("forms") >= LEAST_FORMS)
    often = toxic.where(F.col("n") >= LEAST_DOCS)
    kept = often.where("NOT stem").unionByName(often.where("stem").join(several.select("key"), "key", "left_semi"))
    # Bounded by the sample.
    chosen = {(r.key, r.stem): r.n for r in kept.collect()}
    clean = {(r.key, r.stem): r.n for r in _counted(sample.where("label = 0"), frozenset(chosen)).collect()}
    return chosen, clean


def _chance(n: int, m: int, base: float) -> float:
    """Log of a bound on the probability that ``n`` of ``n + m`` documents are toxic by chance (Chernoff)."""
    share = n / (n + m)
    divergence = share * math.log(share / base) + (1 - share) * math.log((1 - share) / (1 - base)) if m else -math.log(base)
    return -(n + m) * divergence if share > base else 0.0


def learn_insults(sample: DataFrame, toxic_docs: int, clean_docs: int) -> tuple[dict[str, float], dict[str, float]]:
    """The words, and the shortest stems, that all but never occur in clean documents, by log-odds.

    So many are looked at that some are in toxic documents only by chance; those are kept out by
    asking that, over all of them, fewer than ``FALSE_WORDS`` be expected.
    """
    if not toxic_docs or not clean_docs:
        return {}, {}
    toxic, clean = _counts(sample)
    base = toxic_docs / (toxic_docs + clean_docs)
    words: dict[str, float] = {}
    stems: dict[str, float] = {}
    for (key, stem), n in sorted(toxic.items(), key=lambda x: (len(x[0][0]), x[0])):
        m = clean.get((key, stem), 0)
        ratio = math.log((n + 0.5) / (toxic_docs + 1)) - math.log((m + 0.5) / (clean_docs + 1))
        if m * 50 <= n and _chance(n, m, base) < math.log(FALSE_WORDS / len(toxic)):
            if not (stem and any(key.startswith(shorter) for shorter in stems)):
                (stems if stem else words)[key] = round(min(max(ratio, LEAST_WEIGHT), MOST_WEIGHT), 4)
    return words, stems


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS) -> Grammar:
    sample = _one_of_alike(labelled_sample(docs, labels, "toxic", FOLDS, FOLD, most))
    sizes = {r.label: r.n for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    words, stems = learn_insults(sample, sizes.get(1, 0), sizes.get(0, 0))
    grammar = Grammar(dict.fromkeys(INSULTS, LISTED) | words, dict.fromkeys(THREATS, LISTED), stems=stems)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [grammar.features(t) for t in batch.column("text").to_pylist()]
        return pa.record_batch([batch.column("label"), pa.array(rows, pa.list_(pa.float64()))], names=["label", "x"])

    # At most ``most`` rows of a few numbers.
    rows = with_batches(sample, work, "label int, x array<double>").toPandas()
    order = sorted(zip(rows["label"], (tuple(v) for v in rows["x"])))
    weights = fit_logistic(np.array([v for _, v in order]).reshape(-1, FEATURES), np.array([k for k, _ in order]), PRIOR)
    # A heavier clause never makes a document less toxic.
    weights[1:] = np.maximum(weights[1:], 0.1)
    return Grammar(grammar.insults, grammar.threats, tuple(float(w) for w in weights), stems)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    grammar = train(docs, table(spark, sf_dir, "labels"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = grammar.score(batch.column("text").to_pylist())
        return pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(scores)], names=["doc_id", "held_out", "score"])

    rows = docs.select("doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"), text_of().alias("text"))
    scored = with_batches(rows, work, "doc_id bigint, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
