"""Quality scores by Bradley-Terry ranking.

A document is described by shares and rates of its whole text.  From labelled documents, pairs of a good
and a bad one are drawn, and the weights of a linear score are those that make the good one win: logistic
loss on the difference of features.  The score is then cut at the quantile that leaves as many of the
training documents above it as are labelled good, and squashed so that the cut is at 0.5.

The fit uses at most ``SAMPLE_ROWS`` labelled documents, taken by order of a hash, and ``PAIRS`` pairs per
document of the larger class; everything else sees every row.

Defined results: a null text is an empty one and gets the score of its features like any other; without
labels of both classes the score is the share of good labels, 0.5 without any; a null id is held out;
repeated rows are scored each; only ``doc_id`` and ``text`` are looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from countloom.llm.common import table, text_of, with_batches
from countloom.llm.labelled import fit_logistic, held_out, labelled_sample

FOLDS, FOLD = 3, 1
SAMPLE_ROWS = 12_000
PAIRS = 4
BLOCK_WORDS = 50

_KINDS = bytes.maketrans(bytes(range(256)), bytes(
    1 if 65 <= b <= 90 else 2 if 48 <= b <= 57 else 3 if b in b".,;:'-" else 4 if 33 <= b < 127 and not chr(b).isalnum() else 0
    for b in range(256)
))
FEATURES = 12


def features(text: str) -> list[float]:
    """Rates that do not depend on length, but for the last."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * FEATURES
    raw = text.encode()
    kinds = np.bincount(np.frombuffer(raw.translate(_KINDS), np.uint8), minlength=5)
    upper, _, stop, symbol = (kinds[1:5] / len(raw)).tolist()
    # Distinct words in blocks, so that long texts are not taken for repetitive ones.
    blocks = [words[i : i + BLOCK_WORDS] for i in range(0, n, BLOCK_WORDS)]
    fresh = sum(len(set(b)) for b in blocks) / n
    same = sum(map(str.__eq__, words, words[1:])) / n
    lines = [line for line in text.split("\n") if line]
    again = 1 - len(set(lines)) / len(lines) if lines else 0.0
    width = len(text) / n
    shouted = 1 - sum(map(str.islower, words)) / n
    return [
        fresh, fresh * fresh, len(set(words)) / n, same, min(symbol, 0.2), min(5 * symbol, 0.1) ** 0.5, min(upper, 0.3),
        shouted, again, min(abs(width - 6), 5), min(stop, 0.2), 1 / n**0.5,
    ]


@dataclass(frozen=True)
class Ranking:
    """A linear score of standardised features; ``cut`` is where it counts as good."""

    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    cut: float
    share: float | None

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, seed: int = 7) -> Ranking:
        good, bad = np.flatnonzero(y == 1), np.flatnonzero(y != 1)
        if not len(good) or not len(bad):
            flat = (0.0,) * FEATURES
            return cls(flat, (1.0,) * FEATURES, flat, 0.0, float(y.mean()) if len(y) else 0.5)
        mean, scale = x.mean(0), x.std(0) + 1e-9
        z = (x - mean) / scale
        rng = np.random.default_rng(seed)
        pairs = PAIRS * max(len(good), len(bad))
        difference = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
        # Each pair both ways round, so that no constant is learned.
        both = np.concatenate([difference, -difference])
        won = np.concatenate([np.ones(pairs), np.zeros(pairs)])
        w = fit_logistic(both, won, np.zeros(FEATURES), strength=1.0)
        ranked = np.sort(z @ w)
        at = len(bad)
        return cls(tuple(mean), tuple(scale), tuple(w), float((ranked[at - 1] + ranked[at]) / 2), None)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.share is not None:
            return np.full(len(x), self.share)
        raw = ((x - np.array(self.mean)) / np.array(self.scale)) @ np.array(self.weights) - self.cut
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.array([features(t) for t in batch.column("text").to_pylist()])


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS) -> Ranking:
    sample = labelled_sample(docs, labels, "quality", FOLDS, FOLD, most)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = _matrix(batch)
        return pa.record_batch([batch.column("label"), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), FEATURES).cast(pa.list_(pa.float64()))], names=["label", "x"])

    # At most ``most`` rows of a dozen numbers.
    rows = with_batches(sample, work, "label int, x array<double>").toPandas()
    order = sorted(zip(rows["label"], (tuple(v) for v in rows["x"])))
    return Ranking.fit(np.array([v for _, v in order]).reshape(-1, FEATURES), np.array([k for k, _ in order]))


def _scored(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """``(row, score)``: the document as one struct beside its score; row by row, no shuffle."""
    packed = docs.select(text_of().alias("text"), F.struct("*").alias("row"))
    schema = packed.select("row").withColumn("score", F.lit(0.0)).schema

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([batch.column("row"), pa.array(ranking.score(_matrix(batch)))], names=["row", "score"])

    return with_batches(packed, work, schema)


def with_quality(docs: DataFrame, ranking: Ranking, name: str = "score") -> DataFrame:
    """``docs`` with a column ``name``."""
    return _scored(docs, ranking).select("row.*", F.col("score").alias(name))


def drop_poor(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """The rows of ``docs`` that the ranking takes for good; columns may have any name."""
    return _scored(docs, ranking).where("score >= 0.5").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranking = train(docs, table(spark, sf_dir, "labels"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(ranking.score(_matrix(batch)))], names=["doc_id", "held_out", "score"])

    rows = docs.select("doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"), text_of().alias("text"))
    scored = with_batches(rows, work, "doc_id bigint, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
