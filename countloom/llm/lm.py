"""Log-probabilities of texts by a two-word model kept in Elias-Fano tries.

Tokens are the lower-cased words of a text and one end.  Single words are counted exactly.  Pairs are held
by tries, sharded by their first word, but for frequent first words, whose pairs are spread over all shards by the
second, as no shard needs their total.  Which are frequent is told by a bounded sample; that shapes the shards
only.  A trie has these levels in one buffer of 64-bit words:

* the contexts (64-bit hashes of first words), rising, in Elias-Fano code, and so the vocabulary of successors;
* the pointers, rising, to where each context's successors begin;
* the successors' ranks in the vocabulary, made rising by the context's rank times its size, with an 8-bit code of the pair's probability:
  its count, that is its probability times the number of tokens, on a scale with steps of 12 % up to 10^13.

A pair is looked up by its context, then by successor search relative to the context.  The task of a shard
writes the buffer to a file and maps it into memory.  With exact counts of words ``c``, a pair of probability code
``q`` and the base probability ``b(w) = (c(w) + 1) / (N + V + 1)``, the model's probability is
``(q(v, w) + m b(w)) / (c(v) + m)``: the Dirichlet prior ``m`` is the one of ``PRIORS`` that gives the
training texts, each pair left out of its own count, the highest likelihood.

How counts travel: documents are dealt to blocks of about ``BLOCK_BYTES`` by a hash.  A block sends each
shard the sorted keys it has, once each, with their training counts, and gets back counts and codes in the
same order; so neither tokens nor models are moved, and no key is hot, since a block sends it once.

Defined results: a null text is an empty one, which is its end alone; a null id is held out; repeated rows
count as often as they occur and are scored each; without training texts every base probability is 1; an
empty table gives an empty result.  Words are told apart by 64 bits of hashes,
pairs by 64 of each word.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F
from xxhash import xxh64_intdigest

from countloom.llm.common import ascii_lower, materialise, table, text_of, with_batches
from countloom.llm.elias_fano import EliasFano
from countloom.llm.files import Output, mapped_words
from countloom.llm.labelled import held_out
from countloom.workspace import shared_folder

FOLDS, FOLD = 7, 2
BLOCK_BYTES = 6 << 20
# Documents and words by which frequent first words are told, and how often a word is met there to be one.
SAMPLE_DOCS, FREQUENT_WORDS, FREQUENT = 1 << 11, 1 << 16, 8
# Of pairs in one number, which only callers with small universes use.
CONTEXT_BITS, SUCCESSOR_BITS = 36, 20
PRIORS = (1.0, 10.0, 100.0, 1e3, 1e4, 1e5)
# Outside the words, which have no white space.
BEGIN, END = b" ", b"\n"


def _levels() -> np.ndarray:
    """What the codes stand for: 0, then exact counts, then steps of 12 %."""
    levels = [0, 1]
    while len(levels) < 256:
        levels.append(max(levels[-1] + 1, int(levels[-1] * 1.12)))
    return np.array(levels)


LEVELS = _levels()


def quantise(counts: np.ndarray) -> np.ndarray:
    """The nearest code, by ratio."""
    upper = np.clip(np.searchsorted(LEVELS, counts), 1, 255)
    lower = upper - 1
    # In doubles: squares of counts leave 64 bits.
    nearer = (counts > 0) & (counts.astype(float) ** 2 < LEVELS[lower].astype(float) * LEVELS[upper])
    return np.where(counts <= 0, 0, np.where(nearer & (lower > 0), lower, upper)).astype(np.uint8)


def _parted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Context and successor of keys that have both in one number."""
    return keys >> np.uint64(SUCCESSOR_BITS), keys & np.uint64((1 << SUCCESSOR_BITS) - 1)


class Trie:
    def __init__(self, words: np.ndarray):
        self.words = words
        self.contexts, at = EliasFano.read(words, 0)
        self.vocabulary, at = EliasFano.read(words, at)
        self.pointers, at = EliasFano.read(words, at)
        self.successors, at = EliasFano.read(words, at)
        self.codes = words[at:].view(np.uint8)

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray) -> Trie:
        """``keys`` rise; a key is a context and a successor in one number."""
        return cls.of_pairs(*_parted(keys), counts)

    @classmethod
    def of_pairs(cls, contexts: np.ndarray, followers: np.ndarray, counts: np.ndarray) -> Trie:
        """Pairs of 64-bit numbers rise by context, then by successor."""
        n = len(contexts)
        new = np.concatenate([np.ones(min(1, n), bool), contexts[1:] != contexts[:-1]])
        rank = np.cumsum(new) - 1
        begins = np.append(np.flatnonzero(new), n)
        vocabulary, follower = np.unique(followers, return_inverse=True)
        size = max(1, len(vocabulary))
        levels = (
            EliasFano.of(contexts[new], 1 << 64),
            EliasFano.of(vocabulary, 1 << 64),
            EliasFano.of(begins, n + 1),
            EliasFano.of(rank.astype(np.uint64) * np.uint64(size) + follower.astype(np.uint64), max(1, len(begins) - 1) * size),
        )
        codes = np.zeros(-(-n // 8) * 8, np.uint8)
        codes[:n] = quantise(counts)
        return cls(np.concatenate([part for level in levels for part in level.parts()] + [codes.view("<u8")]))

    def save(self, address: str) -> None:
        out = Output(address)
        out.write(self.words.tobytes())
        out.close()

    @classmethod
    def mapped(cls, address: str) -> Trie:
        return cls(mapped_words(address))

    def look_up(self, keys: np.ndarray) -> np.ndarray:
        """The code of each key, 0 where it is not known."""
        return self.look_up_pairs(*_parted(keys))

    def look_up_pairs(self, contexts: np.ndarray, followers: np.ndarray) -> np.ndarray:
        out = np.zeros(len(contexts), np.uint8)
        rank, follower = self.contexts.find(contexts), self.vocabulary.find(followers)
        met = np.flatnonzero((rank >= 0) & (follower >= 0))
        rank, follower = rank[met], follower[met]
        first, end = self.pointers.get(rank).astype(np.int64), self.pointers.get(rank + 1).astype(np.int64)
        index = self.successors.find(rank * self.vocabulary.n + follower, first, end)
        out[met[index >= 0]] = self.codes[index[index >= 0]]
        return out


# -- what travels ---------------------------------------------------------------------------------


def packed(values: np.ndarray) -> bytes:
    """Integers as compressed byte planes."""
    return zstandard.compress(values.reshape(-1, 1).view(np.uint8).T.tobytes(), 1)


def unpacked(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def rising_packed(values: np.ndarray) -> bytes:
    return packed(np.diff(values, prepend=values.dtype.type(0)))


def rising_unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, "<u8"), dtype=np.uint64)


@dataclass
class Tally:
    """The tokens of a block, and its distinct words and pairs in order of shard and key."""

    sizes: np.ndarray  # tokens per document
    word: np.ndarray  # per token
    before: np.ndarray  # per token, the word it follows
    pair: np.ndarray  # per token, the index into ``contexts`` and ``followers``
    learnt: np.ndarray  # per token
    hashes: np.ndarray
    word_order: np.ndarray
    word_cuts: np.ndarray
    contexts: np.ndarray  # per pair, the hash of its first word
    followers: np.ndarray  # and of its second
    pair_order: np.ndarray
    pair_cuts: np.ndarray

    @classmethod
    def of(cls, texts: list[str], train: list[bool], shards: int, frequent: np.ndarray | None = None) -> Tally:
        """``frequent``: hashes of first words whose pairs are spread over all shards."""
        number: defaultdict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        number[BEGIN], number[END]
        tokens, sizes = [], []
        for text in texts:
            words = text.encode().lower().split()
            words.append(END)
            sizes.append(len(words))
            tokens.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
        # It refers to itself, and so would stay in memory until the next full collection.
        number.default_factory = None
        word, sizes = np.concatenate(tokens), np.array(sizes)
        before = np.concatenate([[0], word[:-1]])
        before[before == 1] = 0  # after an end comes a beginning
        hashes = np.fromiter(map(xxh64_intdigest, number), np.uint64, len(number))
        # By the numbers of words in the block, so that no two pairs fall together.
        numbered, pair = np.unique(before * len(hashes) + word, return_inverse=True)
        contexts, followers = hashes[numbered // len(hashes)], hashes[numbered % len(hashes)]
        word_shard = hashes % np.uint64(shards)
        spread = np.isin(contexts, hashes[:1])  # of the beginning
        if frequent is not None:
            spread |= np.isin(contexts, frequent)
        pair_shard = np.where(spread, contexts + followers, contexts) % np.uint64(shards)
        edges = np.arange(shards + 1)
        word_order, pair_order = np.lexsort((hashes, word_shard)), np.lexsort((followers, contexts, pair_shard))
        return cls(
            sizes, word, before, pair, np.repeat(np.array(train), sizes), hashes,
            word_order, np.searchsorted(word_shard[word_order], edges), contexts, followers, pair_order, np.searchsorted(pair_shard[pair_order], edges),
        )

    def runs(self, block: int):
        """Per shard with any key: ``(shard, block, words, word counts, contexts, successors each, vocabulary,
        successors, pair counts)``; the successors as places in the vocabulary."""
        word_n = np.bincount(self.word[self.learnt], minlength=len(self.hashes))[self.word_order].astype("<u4")
        pair_n = np.bincount(self.pair[self.learnt], minlength=len(self.contexts))[self.pair_order].astype("<u4")
        words, contexts, followers = self.hashes[self.word_order], self.contexts[self.pair_order], self.followers[self.pair_order]
        for shard in range(len(self.word_cuts) - 1):
            w = slice(*self.word_cuts[shard : shard + 2])
            p = slice(*self.pair_cuts[shard : shard + 2])
            if w.stop > w.start or p.stop > p.start:
                context, each = np.unique(contexts[p], return_counts=True)
                vocabulary, place = np.unique(followers[p], return_inverse=True)
                yield (
                    shard, block, rising_packed(words[w]), packed(word_n[w]), rising_packed(context), packed(each.astype("<u4")),
                    rising_packed(vocabulary), packed(place.astype("<u4")), packed(pair_n[p]),
                )

    def placed(self, answers: dict[int, tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Counts per word and per pair, from the answers of the shards."""
        counts, codes = np.empty(len(self.hashes), np.int64), np.empty(len(self.contexts), np.uint8)
        in_order = [answers[s] for s in sorted(answers)]
        counts[self.word_order] = np.concatenate([a for a, _ in in_order])
        codes[self.pair_order] = np.concatenate([b for _, b in in_order])
        return counts, LEVELS[codes]


def _merged(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys, their total counts, and for each run the indexes of its keys."""
    keys, index = np.unique(np.concatenate([k for k, _ in runs]), return_inverse=True)
    totals = np.zeros(len(keys), np.int64)
    np.add.at(totals, index, np.concatenate([n for _, n in runs]).astype(np.int64))
    return keys, totals, np.split(index, np.cumsum([len(k) for k, _ in runs])[:-1])


def _ranked(runs: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct values, rising, and for each run the ranks of its values."""
    values, rank = np.unique(np.concatenate(runs), return_inverse=True)
    return values, np.split(rank.astype(np.uint64), np.cumsum([len(r) for r in runs])[:-1])


RUNS = "shard int, block int, words binary, word_counts binary, contexts binary, each binary, vocabulary binary, places binary, pair_counts binary"
ANSWERS = "block int, shard int, tokens bigint, types bigint, counts binary, codes binary"
DEALT = "block int, docs binary"
SCORED = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, scores array<double>, left_out array<double>"


def _record(schema: str, rows: list[tuple]) -> pa.Table:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = [field.split() for field in schema.split(", ")]
    return pa.table({name: pa.array([r[i] for r in rows], kinds[kind]) for i, (name, kind) in enumerate(fields)})


def _deal(docs: DataFrame, blocks: int) -> DataFrame:
    """Bundles of documents, compressed, with the block they go to."""
    rows = docs.select(
        "doc_id",
        held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"),
        text_of().alias("text"),
    ).withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        whole = pa.Table.from_batches([batch])
        block = batch.column("block").to_numpy()
        out = []
        for b in np.unique(block):
            part = whole.filter(pa.array(block == b)).select(["doc_id", "held_out", "text"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                stream.write_table(part)
            out.append((int(b), sink.getvalue().to_pybytes()))
        return _record(DEALT, out).combine_chunks().to_batches()[0]

    # Whole batches: the fewer bundles, the better they compress.
    return with_batches(rows, work, DEALT, rows=None)


def _opened(bundles: pa.Table) -> pa.Table:
    """The documents of a block, in an order that does not depend on how they came."""
    docs = pa.concat_tables([pa.ipc.open_stream(b).read_all() for b in bundles.column("docs").to_pylist()])
    return docs.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def _tally(docs: pa.Table, shards: int, frequent: np.ndarray) -> Tally:
    return Tally.of(docs.column("text").to_pylist(), [not h for h in docs.column("held_out").to_pylist()], shards, frequent)


def _frequent(docs: DataFrame, shards: int) -> np.ndarray:
    """Hashes of the words that make up a good part of a shard, by a sample of documents.

    A word met too seldom there to be told has at most a few of ``SAMPLE_DOCS`` texts' worth of the pairs.
    """
    order = F.xxhash64("doc_id", "text")
    last = docs.select(order.alias("h")).orderBy("h").limit(SAMPLE_DOCS).agg(F.max("h").alias("h")).first().h
    sample = docs.where(order <= F.lit(last)).select(text_of().alias("text"))
    words = sample.select(F.explode(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("word"))
    counted = materialise(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "lm-sample")
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    least = max(FREQUENT, total // (4 * shards))
    # Bounded by the parameter.
    top = counted.where(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(FREQUENT_WORDS).collect()
    return np.array([xxh64_intdigest(r.word.encode()) for r in top], np.uint64)


def _answer(folder: str, runs: pa.Table) -> pa.Table:
    """For ``applyInArrow`` by shard: write the trie of the shard, map it and look up every run in it."""
    shard = runs.column("shard")[0].as_py()
    of = lambda name, unpack, *kind: [unpack(x, *kind) for x in runs.column(name).to_pylist()]
    words = list(zip(of("words", rising_unpacked), of("word_counts", unpacked, "<u4")))
    _, totals, places = _merged(words)
    # Dense ranks within the shard stand for the hashes.
    contexts, context_at = _ranked(of("contexts", rising_unpacked))
    followers, follower_at = _ranked(of("vocabulary", rising_unpacked))
    pairs = [
        (np.repeat(c, each) << np.uint64(32) | f[place], n)
        for c, each, f, place, n in zip(context_at, of("each", unpacked, "<u4"), follower_at, of("places", unpacked, "<u4"), of("pair_counts", unpacked, "<u4"))
    ]
    hashes = lambda keys: (contexts[keys >> np.uint64(32)], followers[keys & np.uint64(0xFFFFFFFF)])
    keys, pair_totals, _ = _merged(pairs)
    seen = pair_totals > 0
    address = f"{folder}/shard-{shard:06d}.trie"
    Trie.of_pairs(*hashes(keys[seen]), pair_totals[seen]).save(address)
    trie = Trie.mapped(address)
    # Block -1 tells the sums of the shard.
    rows = [(-1, shard, int(totals.sum()), int((totals > 0).sum()), b"", b"")]
    for block, place, (run, _) in zip(runs.column("block").to_pylist(), places, pairs):
        rows.append((block, shard, 0, 0, packed(totals[place].astype("<u8")), zstandard.compress(trie.look_up_pairs(*hashes(run)).tobytes(), 1)))
    return _record(ANSWERS, rows)


def _scorer(shards: int, frequent: np.ndarray, tokens: int, types: int):
    size = tokens + types + 1

    def score(bundles: pa.Table, answers: pa.Table) -> pa.Table:
        docs = _opened(bundles)
        tally = _tally(docs, shards, frequent)
        got = {
            s: (unpacked(c, "<u8").astype(np.int64), np.frombuffer(zstandard.decompress(q), np.uint8))
            for s, c, q in zip(*(answers.column(n).to_pylist() for n in ("shard", "counts", "codes")))
        }
        counts, pair_counts = tally.placed(got)
        known = counts[tally.word]
        context = counts.copy()
        context[0] = counts[1]  # as many beginnings as ends
        context = context[tally.before].astype(float)
        base = (known + 1) / size
        pair = pair_counts[tally.pair].astype(float)
        begins = np.concatenate([[0], np.cumsum(tally.sizes)[:-1]])
        per_doc = lambda x: np.add.reduceat(x, begins)
        scores = [per_doc(np.log10((pair + m * base) / (context + m))) for m in PRIORS]
        # Each training pair left out of its own count; codes may be a little below the count.
        rest, of = np.maximum(pair - 1, 0), np.maximum(context - 1, 0)
        left_out = [per_doc(np.where(tally.learnt, np.log10((rest + m * base) / (np.maximum(of, rest) + m)), 0.0)) for m in PRIORS]
        lists = pa.list_(pa.float64())
        return pa.table({
            "doc_id": docs.column("doc_id"),
            "held_out": docs.column("held_out"),
            "n_tokens": pa.array(tally.sizes, pa.int64()),
            "n_known": pa.array(per_doc((known > 0).astype(np.int64)), pa.int64()),
            "base": pa.array(per_doc(np.log10(base))),
            "scores": pa.array(list(np.stack(scores, 1)), lists),
            "left_out": pa.array(list(np.stack(left_out, 1)), lists),
        })

    return score


def scored(docs: DataFrame, block_bytes: int = BLOCK_BYTES, tries: str | None = None) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every row.

    The tries are left in the folder ``tries``, by default a fresh one among the shared tables.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text_of())), F.lit(0)).alias("n")).first().n
    blocks = shards = max(1, -(-size // block_bytes))
    frequent = _frequent(docs, shards)

    def count(key: tuple, bundles: pa.Table) -> pa.Table:
        return _record(RUNS, list(_tally(_opened(bundles), shards, frequent).runs(key[0].as_py())))

    runs = _deal(docs, blocks).groupBy("block").applyInArrow(count, RUNS)
    folder = tries or shared_folder(docs.sparkSession, "lm-tries")
    answers = materialise(runs.groupBy("shard").applyInArrow(lambda part: _answer(folder, part), ANSWERS), "lm-answers")
    sums = answers.where("block < 0").agg(F.sum("tokens").alias("tokens"), F.sum("types").alias("types")).first()
    tokens, types = sums.tokens or 0, sums.types or 0
    replies = answers.where("block >= 0").select("block", "shard", "counts", "codes")
    together = _deal(docs, blocks).groupBy("block").cogroup(replies.groupBy("block"))
    rows = materialise(together.applyInArrow(_scorer(shards, frequent, tokens, types), SCORED), "lm-scored")
    fits = rows.agg(*[F.sum(F.col("left_out")[i]).alias(f"m{i}") for i in range(len(PRIORS))]).first()
    best = max(range(len(PRIORS)), key=lambda i: (fits[i] or 0.0, i))
    return rows.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("bigint").alias("train_tokens"),
        F.col("base").alias("base_score"), F.col("scores")[best].alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"))
