"""Removal of long repeated substrings by common-prefix intervals of a suffix array.

Every byte covered by a ``LENGTH``-byte string that starts anywhere else as well is removed, in the same
document or another.

Sorting all suffixes of a corpus moves every byte ``LENGTH`` times.  Here the suffix array is sparse: in each
``LENGTH``-byte window the ``ANCHOR``-byte string with the least hash is its anchor, leftmost first.  Equal
windows have equal anchors at equal places, so only suffixes that start at anchors are sorted, and only
against others with the same anchor.  The windows that share one anchor form its context, the bytes from the
first window's start to the last one's end.

1. Anchors: each task lists ``(hash of the anchor, hash of the context, document, place)`` of its texts, one
   place for all equal contexts of a batch.
2. Sorted by those hashes, equal contexts are neighbours: all their windows are repeats, settled without
   looking at a byte.  Anchors met once have no repeat.  What remains are anchors with different contexts,
   and of each different context one place.
3. Those places fetch their bytes.  Per anchor, the suffixes are sorted, adjacent common prefixes computed,
   and the tree of common-prefix intervals scanned with a stack.  At an interval of common prefix ``r`` the
   left extensions are tested: if all are alike every member extends fully, otherwise members are sorted by
   their reversed left side and extend as far as their nearest neighbour.  Left and right extension give the
   maximal repeat of each member with the others, and thus its repeated windows.
4. An anchor with more than ``GROUP_CONTEXTS`` different contexts would be too much for one task; its
   windows are hashed one by one instead and counted in an aggregation.
5. Spans are merged per document and cut out.

Places and hashes move, not texts; texts move twice, compressed, to meet their contexts and their spans.

Defined results: a null text is an empty one; documents shorter than ``LENGTH`` lose nothing; copies lose
everything, repeated rows being copies of each other; rows with a null id are told apart by their text; an
empty table gives an empty result.  Only ``doc_id`` and ``text`` are looked at.  Hashes of contexts have 64
bits besides the 64 of their anchor.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from countloom.llm.common import materialise, table, text_of, with_batches

LENGTH, ANCHOR = 200, 50
REACH = LENGTH - ANCHOR + 1
GROUP_CONTEXTS = 20_000
# Bytes of text hashed at once.
CHUNK_BYTES = 1 << 20
# Contexts sorted at once.
GATHERED = 20_000

_PLACE_BITS = 24
_BASE = 0x9E3779B97F4A7C15
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


# -- anchors --------------------------------------------------------------------------------------


class Rolling:
    """Polynomial hashes, modulo 2^64, of all substrings of a buffer by prefix sums."""

    _powers: tuple[np.ndarray, np.ndarray] = (np.empty(0, np.uint64),) * 2

    def __init__(self, data: np.ndarray):
        n = len(data)
        if len(Rolling._powers[0]) < n + 1:
            both = (np.full(max(n + 1, CHUNK_BYTES + LENGTH), np.uint64(b)) for b in (_BASE, pow(_BASE, -1, 1 << 64)))
            Rolling._powers = tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), b[1:]])) for b in both)
        power, self.inverse = (p[: n + 1] for p in Rolling._powers)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[begin]) * self.inverse[begin]

    def all(self, width: int) -> np.ndarray:
        n = len(self.sums) - width
        return (self.sums[width:] - self.sums[:n]) * self.inverse[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h *= np.uint64(_MIX[0])
    h ^= h >> np.uint64(32)
    h *= np.uint64(_MIX[1])
    return h ^ (h >> np.uint64(29))


def anchors(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """``(first window, last window, anchor, hash of the anchor, hash of the context)`` of the texts that lie
    in ``data`` from ``begins`` to ``ends``."""
    none = (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 2
    long = ends - begins >= LENGTH
    if not long.any():
        return none
    rolling = Rolling(data)
    hashed = mix(rolling.all(ANCHOR))
    # The place in the low bits: equal hashes go to the left, and the least value tells where it is.
    key = (hashed >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | np.arange(len(hashed), dtype=np.uint64)
    padded = np.full(-(-len(key) // REACH) * REACH, np.uint64(2**64 - 1))
    padded[: len(key)] = key
    blocks = padded.reshape(-1, REACH)
    # The least of REACH values in a row: of the end of one block and the beginning of the next.
    upto = np.minimum.accumulate(blocks, axis=1).ravel()
    since = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = len(key) - REACH + 1
    least = np.minimum(since[:windows], upto[REACH - 1 : REACH - 1 + windows])
    inside = np.zeros(len(data) + 1, np.int32)
    np.add.at(inside, begins[long], 1)
    np.add.at(inside, ends[long] - LENGTH + 1, -1)
    window = np.flatnonzero(np.cumsum(inside)[:windows])
    at = (least[window] & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 0) | (np.diff(window) != 1)]))
    first, last, at = window[new], window[np.append(new[1:], len(window)) - 1], at[new]
    context = rolling.of(first, last + LENGTH) * np.uint64(_MIX[1])
    context = mix(context + ((at - first) * 1024 + (last - first)).astype(np.uint64))
    return first, last, at, hashed[at], context


def pieces(texts: Iterable[bytes], most: int = CHUNK_BYTES) -> Iterator[list[tuple[int, int, bytes]]]:
    """Lists of ``(text, offset, bytes)`` of about ``most`` bytes.  A longer text comes in pieces that overlap
    by one byte less than a window, so that every window is in one piece."""
    chunk, size = [], 0
    for i, text in enumerate(texts):
        step = max(most, LENGTH)
        for offset in range(0, max(1, len(text) - LENGTH + 1), step):
            part = text[offset : offset + step + LENGTH - 1]
            if size and size + len(part) > most:
                yield chunk
                chunk, size = [], 0
            chunk.append((i, offset, part))
            size += len(part)
    if chunk:
        yield chunk


def _pack(at: np.ndarray, left: np.ndarray, span: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Anchor place, bytes of context before it, windows in the context, and 17 bits of the text's hash."""
    return (at << 33) | (left << 25) | (span << 17) | mark


def _unpack(place: np.ndarray) -> tuple[np.ndarray, ...]:
    return place >> 33, (place >> 25) & 255, (place >> 17) & 255, place & 0x1FFFF


def _keyed(docs: DataFrame) -> DataFrame:
    """``(doc, mark, text)``; 64 bits of a hash of id and text and 17 of another, of the text alone, tell texts apart,
    also where ids repeat or are null.  Rows that repeat both are one."""
    rows = docs.select("doc_id", text_of().alias("text"))
    return rows.select("doc_id", F.xxhash64("doc_id", "text").alias("doc"), F.expr("xxhash64(text) & 131071").alias("mark"), "text")


def _occurrences(docs: DataFrame) -> DataFrame:
    """``(anchor, context, doc, place, many)``.

    Contexts that a batch has several times are combined before they are dealt out: one place stands for
    them with ``many`` true, and all of them are passed on as settled, ``many`` null, under their document
    instead of their anchor.  So a passage that is everywhere is a row per batch at its anchor.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        doc, mark = batch.column("doc").to_numpy(), batch.column("mark").to_numpy()
        found = []
        for chunk in pieces(x.as_py().encode() for x in batch.column("text")):
            data = np.frombuffer(b"".join(part for _, _, part in chunk), np.uint8)
            ends = np.cumsum([len(part) for _, _, part in chunk])
            begins = np.append(0, ends[:-1])
            first, last, at, anchor, context = anchors(data, begins, ends)
            part = np.searchsorted(ends, first, side="right")
            text = np.array([i for i, _, _ in chunk])[part]
            offset = np.array([o for _, o, _ in chunk])[part] - begins[part]
            place = _pack(at + offset, at - first, last - first + 1, mark[text])
            found.append((anchor.view(np.int64), context.view(np.int64), doc[text], place))
        anchor, context, doc, place = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((context, anchor))
        same = (np.diff(anchor[order]) == 0) & (np.diff(context[order]) == 0)
        repeated_ = np.zeros(len(order), bool)
        repeated_[1:] |= same
        repeated_[:-1] |= same
        begins_run = np.concatenate([np.ones(min(1, len(order)), bool), ~same])
        keyed, settled = order[begins_run], order[repeated_]
        rows = np.concatenate([keyed, settled])
        spread = mix(doc[settled].view(np.uint64)).view(np.int64)
        many = pa.concat_arrays([pa.array(repeated_[begins_run]), pa.nulls(len(settled), pa.bool_())])
        columns = [pa.array(np.concatenate([anchor[keyed], spread])), pa.array(context[rows]), pa.array(doc[rows]), pa.array(place[rows]), many]
        return pa.record_batch(columns, names=["anchor", "context", "doc", "place", "many"])

    schema = "anchor bigint, context bigint, doc bigint, place bigint, many boolean"
    return with_batches(_keyed(docs).select("doc", "mark", "text"), work, schema, rows=None)


# -- equal contexts -------------------------------------------------------------------------------

SETTLED = "doc bigint, mark bigint, begin bigint, end bigint, anchor bigint, place bigint, many boolean"


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by anchor and context: spans of places whose context occurs again, and one place of
    each context whose anchor has several.  Keeps a row and a run at a time, however long the run."""
    names = ("anchor", "context", "doc", "place", "many")
    nothing = np.empty((len(names), 0), np.int64)
    held: np.ndarray | None = None  # the last row, whose successor is not known yet
    held_again = False
    run: np.ndarray | None = None  # the first row of the last run of equal contexts
    run_many = run_joined = False

    def out(rows: np.ndarray, reps: np.ndarray, many: np.ndarray) -> pa.RecordBatch:
        at, left, span, mark = _unpack(rows[3])
        k, r = len(at), reps.shape[1]
        absent = pa.nulls(r, pa.int64())
        columns = [
            pa.array(np.concatenate([rows[2], reps[2]])),
            pa.array(np.concatenate([mark, _unpack(reps[3])[3]])),
            pa.concat_arrays([pa.array(at - left), absent]),
            pa.concat_arrays([pa.array(at - left + span - 1 + LENGTH), absent]),
            pa.concat_arrays([pa.nulls(k, pa.int64()), pa.array(reps[0])]),
            pa.concat_arrays([pa.nulls(k, pa.int64()), pa.array(reps[3])]),
            pa.concat_arrays([pa.nulls(k, pa.bool_()), pa.array(many)]),
        ]
        return pa.record_batch(columns, names=[c.split()[0] for c in SETTLED.split(", ")])

    for batch in batches:
        if not batch.num_rows:
            continue
        many_ = batch.column("many")
        whole = np.stack([*(batch.column(n).to_numpy() for n in names[:4]), pc.fill_null(many_, False).cast(pa.int64()).to_numpy()])
        passed = many_.is_null().to_numpy(zero_copy_only=False)
        if passed.any():
            yield out(whole[:, passed], nothing, np.empty(0, bool))
        rows = whole[:, ~passed]
        if not rows.shape[1]:
            continue
        if held is not None:
            rows = np.concatenate([held, rows], axis=1)
        same = (rows[0, 1:] == rows[0, :-1]) & (rows[1, 1:] == rows[1, :-1])
        again = rows[4].astype(bool)
        again[1:] |= same
        again[:-1] |= same
        again[0] |= held_again
        # Runs that begin here; the first row begins one unless it was held.
        begins = np.flatnonzero(np.concatenate([[run is None], ~same]))
        reps, many = rows[:, begins], again[begins]
        if run is not None:
            run_many |= bool(again[0])
            reps, many = np.concatenate([run, reps], axis=1), np.concatenate([[run_many], many])
        joined = np.zeros(reps.shape[1], bool)
        alike = reps[0, 1:] == reps[0, :-1]
        joined[1:] |= alike
        joined[:-1] |= alike
        joined[0] |= run_joined
        held, held_again = rows[:, -1:], bool(again[-1])
        run, run_many, run_joined = reps[:, -1:], bool(many[-1]), bool(joined[-1])
        # Every row but the last is settled, and every run but the last.
        yield out(rows[:, :-1][:, again[:-1]], reps[:, :-1][:, joined[:-1]], many[:-1][joined[:-1]])
    if held is not None:
        yield out(held[:, [held_again]] if held_again else held[:, :0], run if run_joined else run[:, :0], np.array([run_many] if run_joined else [], bool))


# -- different contexts of an anchor --------------------------------------------------------------


def intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """``(common prefix, first, last)`` of every interval of a suffix array, children before parents;
    ``lcp[i]`` belongs to suffixes ``i - 1`` and ``i``."""
    stack = [(0, 0)]
    for i in range(1, len(lcp) + 1):
        now = lcp[i] if i < len(lcp) else -1
        first = i - 1
        while stack and now < stack[-1][0]:
            value, first = stack.pop()
            yield value, first, i - 1
        if stack and now > stack[-1][0]:
            stack.append((now, first))


def repeated(anchor: np.ndarray, contexts: list[bytes], left: np.ndarray, many: np.ndarray) -> list[tuple[int, int, int]]:
    """``(index, begin, end)`` relative to the anchor: what the contexts share with others of their anchor.

    Contexts that occur several times are partners only; their own spans are known.
    """
    n = len(contexts)
    rights = [c[at : at + LENGTH] for c, at in zip(contexts, left.tolist())]
    heads = anchor.astype(">u8").tobytes()
    # Shorter texts sort before longer ones that begin alike.
    keys = [heads[8 * i : 8 * i + 8] + rights[i].ljust(LENGTH, b"\0") + bytes([len(rights[i])]) for i in range(n)]
    order = sorted(range(n), key=keys.__getitem__)
    table_ = np.frombuffer(b"".join(keys[i] for i in order), np.uint8).reshape(n, -1)
    sizes = np.array([len(rights[i]) for i in order])
    differ = table_[1:, 8 : 8 + LENGTH] != table_[:-1, 8 : 8 + LENGTH]
    common = np.where(differ.any(1), differ.argmax(1), LENGTH)
    common = np.minimum(common, np.minimum(sizes[1:], sizes[:-1]))
    common[(table_[1:, :8] != table_[:-1, :8]).any(1)] = 0
    lefts = [contexts[i][: left[i]][::-1] for i in order]
    numbers = [int.from_bytes(x.ljust(REACH, b"\0")) for x in lefts]
    single = (~many[order]).tolist()

    def extension(i: int, j: int) -> int:
        alike = REACH - ((numbers[i] ^ numbers[j]).bit_length() + 7) // 8
        return min(alike, len(lefts[i]), len(lefts[j]))

    found = []
    for r, first, last in intervals([0, *common.tolist()]):
        least = LENGTH - r
        if least >= REACH or not any(single[first : last + 1]):
            continue
        members = range(first, last + 1)
        if len(set(lefts[first : last + 1])) > 1:
            members = sorted(members, key=lambda i: (numbers[i], len(lefts[i])))
        reach = [extension(i, j) for i, j in zip(members, members[1:])]
        for i, before, after in zip(members, [0, *reach], [*reach, 0]):
            most = max(before, after)
            if single[i] and most >= least:
                found.append((order[i], -most, LENGTH - least))
    return found


SPANS = "doc bigint, mark bigint, begin bigint, end bigint"


def _span_batch(doc, mark, begin, end) -> pa.RecordBatch:
    return pa.record_batch([pa.array(np.asarray(c), pa.int64()) for c in (doc, mark, begin, end)], names=["doc", "mark", "begin", "end"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans from contexts sorted by anchor; whole anchors are gathered, some ``GATHERED`` contexts at once."""
    waiting: list[pa.RecordBatch] = []

    def settle(rows: pa.Table) -> pa.RecordBatch:
        doc, place = rows.column("doc").to_numpy(), rows.column("place").to_numpy()
        at, left, _, mark = _unpack(place)
        found = repeated(rows.column("anchor").to_numpy(), rows.column("bytes").to_pylist(), left, rows.column("many").to_numpy())
        index, begin, end = (np.array(c, np.int64) for c in zip(*found)) if found else (np.empty(0, np.int64),) * 3
        return _span_batch(doc[index], mark[index], at[index] + begin, at[index] + end)

    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        rows = pa.Table.from_batches(waiting)
        if len(rows) >= GATHERED:
            anchor = rows.column("anchor").to_numpy()
            cut = int(np.searchsorted(anchor, anchor[-1]))
            if cut:
                yield settle(rows.slice(0, cut))
            waiting = rows.slice(cut).combine_chunks().to_batches()
    if waiting:
        yield settle(pa.Table.from_batches(waiting))


def _windows(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Two hashes of every window of every context."""
    doc, place = batch.column("doc").to_numpy(), batch.column("place").to_numpy()
    at, left, span, mark = _unpack(place)
    out = []
    for i, context in enumerate(batch.column("bytes").to_pylist()):
        data = np.frombuffer(context, np.uint8)
        a = Rolling(data).all(LENGTH)
        b = Rolling(data[::-1].astype(np.uint8)).all(LENGTH)[::-1]
        begin = at[i] - left[i] + np.arange(span[i])
        out.append((mix(a).view(np.int64), mix(b).view(np.int64), np.full(span[i], doc[i]), np.full(span[i], mark[i]), begin))
    return pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*out)], names=["a", "b", "doc", "mark", "begin"])


# -- texts ----------------------------------------------------------------------------------------


def _packed(docs: DataFrame, *keep: str) -> DataFrame:
    """``(doc, mark, packed)``: texts as they are moved."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        packer = zstandard.ZstdCompressor(level=1)
        texts = [packer.compress(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
        kept = [batch.column(k) for k in ("doc", "mark", *keep)]
        return pa.record_batch([*kept, pa.array(texts, pa.binary())], names=["doc", "mark", *keep, "packed"])

    schema = "doc bigint, mark bigint, " + "".join(f"{k} bigint, " for k in keep) + "packed binary"
    return with_batches(_keyed(docs).select("doc", "mark", *keep, "text"), work, schema)


def _fetch(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted (doc, mark, anchor, place, many)`` with the bytes of each context; places are gathered per
    document, of which there are at most as many as it has bytes."""
    lists = wanted.groupBy("doc", "mark").agg(F.collect_list(F.struct("anchor", "place", "many")).alias("wanted"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        opener = zstandard.ZstdDecompressor()
        lists_ = batch.column("wanted")
        flat, sizes = lists_.flatten(), pc.list_value_length(lists_).to_numpy()
        owner = np.repeat(np.arange(batch.num_rows), sizes)
        place = flat.field("place").to_numpy()
        at, left, span, _ = _unpack(place)
        texts = [opener.decompress(t) for t in batch.column("packed").to_pylist()]
        begin, end = (at - left).tolist(), (at - left + span - 1 + LENGTH).tolist()
        contexts = [texts[o][b:e] for o, b, e in zip(owner.tolist(), begin, end)]
        return pa.record_batch(
            [flat.field("anchor"), batch.column("doc").take(pa.array(owner)), flat.field("place"), flat.field("many"), pa.array(contexts, pa.binary())],
            names=["anchor", "doc", "place", "many", "bytes"],
        )

    joined = _packed(docs).join(lists, ["doc", "mark"])
    return with_batches(joined, work, "anchor bigint, doc bigint, place bigint, many boolean, bytes binary")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``(doc, mark, begin, end)``, overlapping: bytes that are to go."""
    placed = _occurrences(docs).repartition("anchor").sortWithinPartitions("anchor", "context")
    settled = materialise(placed.mapInArrow(_settle, SETTLED), "repeats-settled")
    equal = settled.where("anchor IS NULL").select("doc", "mark", "begin", "end")
    open_ = settled.where("anchor IS NOT NULL").select("doc", "mark", "anchor", "place", "many")
    counts = open_.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    crowded = materialise(counts.where(F.col("n") > GROUP_CONTEXTS).select("anchor"), "repeats-crowded")
    contexts = _fetch(docs, open_)
    spans = equal
    if crowded.limit(1).count():
        contexts = materialise(contexts, "repeats-contexts")
        windows = with_batches(contexts.join(crowded, "anchor", "left_semi"), _windows, "a bigint, b bigint, doc bigint, mark bigint, begin bigint")
        again = windows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        spans = spans.unionByName(windows.join(again, ["a", "b"]).selectExpr("doc", "mark", "begin", f"begin + {LENGTH} AS end"))
        contexts = contexts.join(crowded, "anchor", "left_anti")
    compared = contexts.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_compare, SPANS)
    return spans.unionByName(compared)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, spans, kept)``: the maximal removed runs, and the remaining bytes."""
    spans = materialise(repeated_spans(docs), "repeats-spans")
    lists = spans.groupBy("doc", "mark").agg(F.collect_set(F.struct("begin", "end")).alias("found"))
    joined = _packed(docs, "doc_id").join(lists, ["doc", "mark"], "left").select("doc_id", "packed", "found")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        opener = zstandard.ZstdDecompressor()
        sizes, runs, kept = [], [], []
        for text, found in zip(batch.column("packed").to_pylist(), batch.column("found").to_pylist()):
            text = opener.decompress(text)
            merged: list[list[int]] = []
            for begin, end in sorted((s["begin"], s["end"]) for s in found or ()):
                if merged and begin <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], end)
                else:
                    merged.append([begin, end])
            edges = [0, *(x for span in merged for x in span), len(text)]
            sizes.append(len(text))
            runs.append([{"begin": b, "end": e} for b, e in merged])
            kept.append(b"".join(text[b:e] for b, e in zip(edges[::2], edges[1::2])))
        span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        return pa.record_batch([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(runs, span), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    return with_batches(joined, work, "doc_id bigint, n_bytes bigint, spans array<struct<begin:bigint,end:bigint>>, kept binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
