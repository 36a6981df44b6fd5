import math
import zlib
from collections import Counter

import numpy as np
import pytest

from conftest import SF_SMALL
from countloom.llm import lm
from countloom.llm.common import table
from countloom.llm.elias_fano import EliasFano
from text_fixtures import docs, on, small_batches  # noqa: F401


@pytest.mark.parametrize("n, universe", [(0, 10), (1, 1), (5, 5), (1000, 1001), (1000, 1 << 20), (4000, 1 << 56), (300, 7000)])
def test_elias_fano(n, universe):
    rng = np.random.default_rng(n)
    values = np.unique(rng.integers(0, universe, n).astype(np.uint64))
    e, _ = EliasFano.read(np.concatenate(EliasFano.of(values, universe).parts()), 0)
    assert (e.get(np.arange(len(values))) == values).all()
    asked = np.unique(np.concatenate([values, rng.integers(0, universe, 2000).astype(np.uint64)]))
    place = {v: i for i, v in enumerate(values.tolist())}
    assert e.find(asked).tolist() == [place.get(v, -1) for v in asked.tolist()]


def test_trie_and_its_file(tmp_path):
    rng = np.random.default_rng(3)
    contexts = rng.integers(0, 1 << lm.CONTEXT_BITS, 300).astype(np.uint64)
    keys = np.unique(rng.choice(contexts, 5000) << np.uint64(lm.SUCCESSOR_BITS) | rng.integers(0, 1 << lm.SUCCESSOR_BITS, 5000).astype(np.uint64))
    counts = rng.zipf(1.5, len(keys)).clip(1, 10**7)
    lm.Trie.of(keys, counts).save(str(tmp_path / "trie"))
    trie = lm.Trie.mapped(str(tmp_path / "trie"))
    codes = trie.look_up(keys)
    assert (np.abs(lm.LEVELS[codes] / counts - 1) < 0.06).all()
    assert (lm.LEVELS[codes][counts <= 10] == counts[counts <= 10]).all()
    absent = np.setdiff1d(keys + np.uint64(1), keys)
    assert not trie.look_up(absent).any()
    assert lm.Trie.of(keys[:0], counts[:0]).look_up(keys).tolist() == [0] * len(keys)


def expect(rows):
    tokens = [(t or "").encode().lower().split() + [None] for _, t in rows]
    train = [d is not None and zlib.crc32(str(d).encode()) % lm.FOLDS != lm.FOLD for d, _ in rows]
    c = Counter(w for t, learnt in zip(tokens, train) if learnt for w in t)
    n, v = c.total(), len(c)
    return sorted(
        ((d, not learnt, len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), 6)) for (d, _), t, learnt in zip(rows, tokens, train)),
        key=repr,
    )


def found(rows):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows), key=repr)


@pytest.mark.parametrize("block_bytes", [lm.BLOCK_BYTES, 20_000])
def test_counts_and_base_scores(spark, docs, block_bytes, small_batches):  # noqa: F811
    rows = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    rows += [(None, "null id"), (1000, None), (1001, ""), (1002, "É Ab aB \x1c x"), (1003, "w " * 60_000), (1002, "É Ab aB \x1c x")]
    got = lm.scored(docs(rows), block_bytes).collect()
    assert found(got) == expect(rows)
    assert all(r.score < 0 for r in got)


def test_no_training_texts_and_no_rows(spark, docs, on):  # noqa: F811
    rows = [(None, "a b"), (None, None)]
    assert found(on(lm, spark, documents=docs(rows)).collect()) == expect(rows)
    assert on(lm, spark, documents=docs([])).count() == 0


def test_the_model_against_sums_by_hand(spark, docs):  # noqa: F811
    """A distribution over all successors of a word sums to one, and held-out texts of the same kind get more."""
    rng = np.random.default_rng(0)
    chain = ["a", "b", "c", "d"]
    rows = []
    for i in range(300):
        at, text = 0, []
        for _ in range(20):
            text.append(chain[at])
            at = (at + (1 if rng.random() < 0.9 else 2)) % 4
        rows.append((i, " ".join(text)))
    got = lm.scored(docs(rows)).collect()
    unseen = [r for r in got if r.held_out]
    assert unseen and sum(r.score for r in unseen) > 0.7 * sum(r.base_score for r in unseen)
    texts = dict(rows)
    train = [texts[r.doc_id].split() for r in got if not r.held_out]
    words, pairs = Counter(w for t in train for w in [*t, None]), Counter(p for t in train for p in zip(["^", *t], [*t, None]))
    words["^"] = words[None]
    size = sum(n for w, n in words.items() if w != "^") + len(words) - 1 + 1
    levels = lm.LEVELS[lm.quantise(np.array([*pairs.values()]))]
    q = dict(zip(pairs, levels.tolist()))
    by_prior = {
        m: {r.doc_id: sum(math.log10((q.get(p, 0) + m * (words[p[1]] + 1) / size) / (words[p[0]] + m)) for p in zip(["^", *texts[r.doc_id].split()], [*texts[r.doc_id].split(), None])) for r in unseen}
        for m in lm.PRIORS
    }
    assert any(all(abs(by_prior[m][r.doc_id] - r.score) < 1e-6 for r in unseen) for m in lm.PRIORS)


def test_a_context_with_over_a_million_successors():
    rng = np.random.default_rng(4)
    followers = np.unique(rng.integers(0, 1 << 64, 2_400_000, dtype=np.uint64))
    known, absent = followers[::2], followers[1::2]
    context = np.full(len(known), (1 << 64) - 5, np.uint64)
    trie = lm.Trie(lm.Trie.of_pairs(context, known, np.full(len(known), 3)).words)
    assert (lm.LEVELS[trie.look_up_pairs(context, known)] == 3).all()
    assert not trie.look_up_pairs(context[: len(absent)], absent).any()
    assert not trie.look_up_pairs(context - np.uint64(1), known).any()


def test_pairs_of_a_hot_word_stay_apart():
    n = 1_100_000
    tally = lm.Tally.of([" ".join(f"hot w{i}" for i in range(n))], [True], 5)
    # From the beginning, to each word, from each word, and to the end.
    assert len(tally.pair_order) == tally.pair.max() + 1 == 2 * n + 1


def test_a_hot_word_is_spread_over_all_shards(spark, docs):  # noqa: F811
    text = " ".join(f"hot w{i}" for i in range(20_000))
    frequent = lm._frequent(docs([(1, text)]), 100)
    tally = lm.Tally.of([text], [True], 100, frequent)
    of_hot = tally.contexts[tally.pair_order] == tally.hashes[2]
    sizes = np.array([of_hot[a:b].sum() for a, b in zip(tally.pair_cuts, tally.pair_cuts[1:])])
    assert sizes.sum() == 20_000 and sizes.min() > 100 and sizes.max() < 400
    # Other contexts stay together, so that each is sent once.
    other = lm.Tally.of([text], [True], 100)
    assert max((other.contexts[other.pair_order] == other.hashes[2])[a:b].sum() for a, b in zip(other.pair_cuts, other.pair_cuts[1:])) == 20_000


def test_codes_of_very_large_counts():
    counts = np.array([0, 1, 12, 10**9, 10**10, 10**12, 2 * 10**12])
    codes = lm.quantise(counts)
    assert (np.diff(codes.astype(int)) > 0).all()
    assert (np.abs(lm.LEVELS[codes[1:]] / counts[1:] - 1) < 0.06).all()
