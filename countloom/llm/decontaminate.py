"""Benchmark windows in documents, by a prefix-filtered join.

Words are compared.  An item of at least ``WINDOW`` words has a window at each of its words that has room
for one; a shorter one is a single window.  The tokens of a window are its runs of three words (of fewer
in a shorter window), ordered from rare to frequent by their number in all documents.  A document that
contains the whole window must contain its rarest token, so the prefix to be joined is that one token:

1. make the different windows of the benchmark, and count their tokens in all documents;
2. choose each window's rarest token; a window whose rarest token is nowhere is in no document;
3. join windows with the places of the chosen tokens in documents;
4. of those pairs keep the ones whose position and length leave room for the window in the document;
5. compare all words of what is left, and merge the hits of each document.

Windows, counts and places are tables and meet in shuffles.  Nothing of the benchmark is on the driver or in
a task whole but two sieves of ``2^SIEVE_BITS`` bits, of 8 MB at any size: a bit per hash of a token, so that
only places of tokens the benchmark may have leave the tasks that read documents.  A larger benchmark fills
the sieve, and more places are shuffled for the same result.  Documents are never shuffled; a place brings
along the words around it.

A chosen token met more than ``1 / HOT`` of all chosen places has its places dealt out by salts, and its
windows repeated once per salt; there are fewer than ``HOT`` such tokens, which the tasks get to know.  Joins of
windows among themselves are spread over ``SPREAD`` parts, as many tokens or items may share one.

Defined results: a null text, or one without a word, has no words, hits and items; a null item id counts as
the item "null"; rows that repeat an item id are one item with the windows of all of them; repeated
documents are reported each; other columns are ignored.  A very long text, or item, is held by one task at a time;
what is found in it leaves the task in batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from xxhash import xxh64_intdigest

from countloom.llm.common import materialise, table, text_of, told_apart, with_batches, without
from countloom.llm.repeats import mix

WINDOW = 10
TOKEN_WORDS = 3
SIEVE_BITS = 26
# A token is hot above this part of all places, and above so many places.
HOT, HOT_PLACES = 4096, 20_000
SPREAD = 16
# Text handled at once by a task, and rows it hands on at once.
CHUNK_BYTES = 2 << 20
BATCH_ROWS = 50_000

# ASCII letters and digits, lower-cased; any other ASCII parts words; bytes of other characters stay.
_CLEAN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_FACTOR = np.uint64(0x4F1BBCDCBFA53E0B)


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_CLEAN).split()


def chunks(texts: list[str], most: int) -> Iterator[tuple[int, list[str]]]:
    """``(first, texts)`` in runs of at most ``most`` characters, or one text."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield first, texts[first:]


def token_words(n: int) -> int:
    """Words of the tokens of a window of ``n`` words."""
    return min(TOKEN_WORDS, n)


def token_keys(hashes: np.ndarray, q: int) -> np.ndarray:
    """A hash of every run of ``q`` words, from the hashes of the words.  Tokens that fall together are told
    apart when words are compared."""
    n = max(0, len(hashes) - q + 1)
    key = np.full(n, np.uint64(q))
    for j in range(q):
        key = key * _FACTOR + hashes[j : n + j]
    return mix(key)


def hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))


class Sieve:
    """A bit for every hash of a token, by the hash's first bits; of one size whatever it holds."""

    def __init__(self, keys: DataFrame):
        self.shift = 64 - SIEVE_BITS
        slot = f"shiftrightunsigned(key, {self.shift})"
        words = keys.selectExpr(f"{slot} AS slot").groupBy(F.expr("shiftright(slot, 6)").alias("at"))
        rows = words.agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 AS int)))").alias("bits")).toArrow()
        bits = np.zeros(1 << (SIEVE_BITS - 6), np.int64)
        bits[rows["at"].to_numpy()] = rows["bits"].to_numpy()
        self.bits = bits.view(np.uint8)

    def passes(self, key: np.ndarray) -> np.ndarray:
        slot = key >> np.uint64(self.shift)
        return (self.bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


class Words:
    """The words of some texts, one after another."""

    def __init__(self, texts: list[str]):
        split = [words_of(t) for t in texts]
        self.sizes = np.array([len(s) for s in split], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.words = list(chain.from_iterable(split))
        self.hashes = hashed(self.words)

    def met(self, q: int, sieve: Sieve) -> tuple[np.ndarray, np.ndarray]:
        """``(place, key)`` of the tokens of ``q`` words that lie within a text and pass the sieve."""
        key = token_keys(self.hashes, q)
        at = np.flatnonzero(sieve.passes(key))
        at = at[at + q <= self.ends[self.owner(at)]]
        return at, key[at].view(np.int64)

    def owner(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, at, side="right")


# -- the benchmark --------------------------------------------------------------------------------


def _windows(benchmark: DataFrame) -> DataFrame:
    """``(item, words, n, tokens)``: every window of every item, the tokens in order."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, text in zip(batch.column("item").to_pylist(), batch.column("text")):
                words = words_of(text.as_py())
                if not words:
                    continue
                n = min(WINDOW, len(words))
                keys = token_keys(hashed(words), token_words(n)).view(np.int64)
                many = n - token_words(n) + 1
                for begin in range(0, len(words) - n + 1, BATCH_ROWS):
                    end = min(begin + BATCH_ROWS, len(words) - n + 1)
                    tokens = np.lib.stride_tricks.sliding_window_view(keys[begin : end - 1 + many], many)
                    yield pa.record_batch(
                        [
                            pa.array([name] * (end - begin), pa.string()),
                            pa.array([b" ".join(words[i : i + n]) for i in range(begin, end)], pa.binary()).cast(pa.string()),
                            pa.array(np.full(end - begin, n), pa.int32()),
                            pa.ListArray.from_arrays(pa.array(np.arange(end - begin + 1) * many, pa.int32()), pa.array(tokens.ravel())),
                        ],
                        names=["item", "words", "n", "tokens"],
                    )

    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), text_of().alias("text"))
    return rows.mapInArrow(each, "item string, words string, n int, tokens array<bigint>")


def _part(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(SPREAD)).cast("int")


def _repeated(df: DataFrame, times: Column | int, name: str) -> DataFrame:
    """Each row once for every ``name`` from 0 on."""
    last = (times if isinstance(times, Column) else F.lit(times)) - 1
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), last.cast("int"))))


def _frequencies(texts: DataFrame, lengths: list[int], sieve: Sieve) -> DataFrame:
    """``(key, n)``: how often the tokens that pass the sieve occur in all documents."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        found = []
        for _, part in chunks(batch.column("text").to_pylist(), CHUNK_BYTES):
            words = Words(part)
            found += [words.met(q, sieve)[1] for q in lengths]
        key, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.empty(0, np.int64),) * 2
        return pa.record_batch([pa.array(key, pa.int64()), pa.array(n, pa.int64())], names=["key", "n"])

    return with_batches(texts.select("text"), work, "key bigint, n bigint", rows=None).groupBy("key").agg(F.sum("n").alias("met"))


def _chosen(windows: DataFrame, frequencies: DataFrame) -> DataFrame:
    """``(words, n, key, at, met)``: of each window the rarest token and its place; ties go to the smaller key."""
    tokens = windows.select("words", "n", F.posexplode("tokens").alias("at", "key")).withColumn("part", _part("words"))
    counted = tokens.join(_repeated(frequencies, SPREAD, "part"), ["key", "part"], "left")
    rarest = counted.groupBy("words").agg(
        F.first("n").alias("n"), F.min(F.struct(F.coalesce("met", F.lit(0)).alias("met"), "key", "at")).alias("t")
    )
    return rarest.select("words", "n", "t.key", "t.at", "t.met").where("met > 0")


# -- documents ------------------------------------------------------------------------------------

_PLACES = "n_words bigint, key bigint, salt int, place bigint, before int, around string"


def _places(texts: DataFrame, lengths: list[int], sieve: Sieve, salts: dict[int, int]) -> DataFrame:
    """Of ``(id, row, text)`` each ``(id, row, n_words)``, and ``(id, n_words, key, salt, place, before, around)`` of
    every token that passes: the words that a window around it can have, ``before`` of them before the token."""

    def spread(key: np.ndarray, at: np.ndarray, id_: np.ndarray) -> np.ndarray:
        salt = np.zeros(len(key), np.int64)
        for i in np.flatnonzero(np.isin(key, list(salts))) if salts else ():
            salt[i] = (int(at[i]) * 31 + int(id_[i])) % salts[int(key[i])]
        return salt

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            for first, part in chunks(batch.column("text").to_pylist(), CHUNK_BYTES):
                text = Words(part)
                many = len(part)
                blank = [pa.nulls(many, t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.string())]
                yield pa.record_batch([batch.column("id").slice(first, many), batch.column("row").slice(first, many), pa.array(text.sizes), *blank], names=names)
                for q in lengths:
                    all_at, all_key = text.met(q, sieve)
                    reach = WINDOW if q == TOKEN_WORDS else q
                    for i in range(0, len(all_at), BATCH_ROWS):
                        at, key = all_at[i : i + BATCH_ROWS], all_key[i : i + BATCH_ROWS]
                        owner = text.owner(at)
                        end, size = text.ends[owner], text.sizes[owner]
                        low, high = np.maximum(end - size, at - (reach - q)), np.minimum(end, at + reach)
                        around = [b" ".join(text.words[a:b]) for a, b in zip(low.tolist(), high.tolist())]
                        id_, place = ids[first + owner], at - (end - size)
                        yield pa.record_batch(
                            [
                                pa.array(id_, pa.int64()),
                                pa.nulls(len(at), batch.column("row").type),
                                pa.array(size),
                                pa.array(key),
                                pa.array(spread(key, place, id_), pa.int32()),
                                pa.array(place),
                                pa.array(at - low, pa.int32()),
                                pa.array(around, pa.binary()).cast(pa.string()),
                            ],
                            names=names,
                        )

    row = texts.schema["row"].dataType.simpleString()
    names = ["id", "row", *(c.split()[0] for c in _PLACES.split(", "))]
    return texts.select("id", "row", "text").mapInArrow(each, f"id bigint, row {row}, {_PLACES}")


def _search(texts: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of ``(id, row, text)`` the ``(id, row, n_words)``, and ``(id, start, n, item)`` of each window's occurrences but
    those of a further item: all items of an occurrence come as rows of ``(id, item)``."""
    emitted = _windows(benchmark)
    windows = materialise(emitted.groupBy("words").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens")), "windows")
    lengths = sorted({token_words(r.n) for r in windows.select("n").distinct().collect()})
    sieve = Sieve(windows.select(F.explode("tokens").alias("key")))
    chosen = materialise(_chosen(windows, _frequencies(texts, lengths, sieve)), "windows-chosen")
    keys = chosen.select("key", "met").distinct()
    per = max(HOT_PLACES, (keys.agg(F.sum("met")).first()[0] or 0) // HOT)
    salts = {r.key: -(-r.met // per) for r in keys.where(F.col("met") > per).collect()}
    found = materialise(_places(texts, lengths, Sieve(keys), salts), "windows-places")

    # A hot token's windows and their items are repeated once for every salt.
    times = F.ceil(F.greatest(F.col("met"), F.lit(1)) / F.lit(per))
    salted = _repeated(chosen, times, "salt")
    start = F.col("place") - F.col("at")
    # The words at the window's place; the position bound has made sure that it is there.
    there = F.slice(F.split("around", " "), F.greatest(F.lit(1), F.col("before") - F.col("at") + 1), F.col("n"))
    pairs = found.where("key IS NOT NULL").drop("row").join(salted, ["key", "salt"])
    room = pairs.where((start >= 0) & (start + F.col("n") <= F.col("n_words")))
    same = room.where(F.array_join(there, " ") == F.col("words"))
    matches = materialise(same.select("id", start.alias("start"), "n", "words", "salt"), "windows-matches")

    owners = emitted.select("words", "item").distinct().withColumn("part", _part("item"))
    owners = owners.join(_repeated(chosen.select("words", "met"), SPREAD, "part"), ["words", "part"])
    owners = _repeated(owners.select("words", "item", "met"), times, "salt").drop("met")
    items = matches.select("id", "words", "salt").distinct().join(owners, ["words", "salt"]).select("id", "item").distinct()
    items = items.groupBy("id").agg(F.sort_array(F.collect_list("item")).alias("items"))
    starts = matches.groupBy("id", "start").agg(F.max("n").alias("n"))
    runs = starts.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("start", "n"))).alias("runs"))
    per_text = with_batches(runs.join(items, "id"), _merged, f"id bigint, spans {_SPANS}, items array<string>")
    return found.where("key IS NULL").select("id", "row", "n_words"), materialise(per_text, "windows-texts")


_SPANS = "array<struct<begin:bigint,end:bigint>>"


def _merged(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Maximal runs of hit words, from starts in order and lengths."""
    lists = batch.column("runs")
    flat = lists.flatten()
    start, n = flat.field("start").to_numpy(), flat.field("n").to_numpy()
    edges = np.cumsum([0, *(len(x) for x in lists)])
    spans = []
    for a, b in zip(edges, edges[1:]):
        begin, end = start[a:b], np.maximum.accumulate(start[a:b] + n[a:b])
        new = np.flatnonzero(np.append(True, begin[1:] > end[:-1]))
        spans.append([{"begin": x, "end": y} for x, y in zip(begin[new].tolist(), end[np.append(new[1:], b - a) - 1].tolist())])
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    return pa.record_batch([batch.column("id"), pa.array(spans, kind), batch.column("items")], names=["id", "spans", "items"])


def contamination(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with ``n_words``, ``spans`` (runs of hit words) and ``items`` (those with a window there)."""
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    texts = docs.select(F.monotonically_increasing_id().alias("id"), row, text_of().alias("text"))
    rows, found = _search(texts, benchmark)
    none = (F.coalesce(c, F.array().cast(t)).alias(c) for c, t in (("spans", _SPANS), ("items", "array<string>")))
    return rows.join(found, "id", "left").select("row.*", "n_words", *none)


def summary(found: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["begin"])
    return found.select(
        *(F.col(f"`{c}`") for c in keep),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any window of an item, their columns as they were."""
    rows = told_apart(docs, "decontaminate-docs")
    texts = rows.select(F.col("row").alias("id"), F.struct("all").alias("row"), text_of("doc.text").alias("text"))
    _, found = _search(texts, benchmark)
    return without(rows, found.withColumnRenamed("id", "row"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = f"""WITH items AS (SELECT coalesce(item_id::VARCHAR, 'null') AS item, {_WORDS} AS ws FROM benchmark),
    windows AS (
        SELECT DISTINCT item, least(len(ws), {WINDOW}) AS n, array_to_string(ws[i : i + least(len(ws), {WINDOW}) - 1], ' ') AS g
        FROM (SELECT item, ws, unnest(range(1, len(ws) - least(len(ws), {WINDOW}) + 2)) AS i FROM items WHERE len(ws) > 0)),
    docs AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
    lengths AS (SELECT DISTINCT n FROM windows),
    found AS (
        SELECT d.doc_id, d.i, d.n, w.item FROM (
            SELECT doc_id, n, i, array_to_string(ws[i : i + n - 1], ' ') AS g
            FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM docs, lengths)) d
        JOIN windows w ON w.n = d.n AND w.g = d.g),
    hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
    named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
        FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
    SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
        sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""
