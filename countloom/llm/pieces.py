"""Encoding with a sentence-piece model of merge type, by backtracking, and decoding.

The model file's pieces and scores are read with the public library; encoding is done here:

* a space becomes ``U+2581`` and one is put in front.  No piece has that sign after another character
  (checked when the model is loaded), and many other pairs of characters are side by side in no piece
  either, so texts fall apart into segments that merge alone, and segments repeat a lot;
* an Aho-Corasick automaton of the pieces finds every match in a segment; at each position the longest is
  tried first.  It may follow its predecessor if merging the two again from single characters gives the
  same two pieces back.  Where nothing fits, the position is marked in a bit field of failures and the
  predecessor gives way to its next shorter match;
* characters without a piece become their UTF-8 bytes.

Defined results: a null text is the empty one, whose ids are begin and end only; repeated rows are encoded
each; other columns pass through.
"""

from __future__ import annotations

import re
from functools import lru_cache
from struct import pack

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession, functions as F

from countloom.llm.common import table, text_of, with_batches

SPACE = "▁"
# Entries of the two caches of a worker; a full cache is emptied.
SEGMENTS, PAIRS = 250_000, 500_000


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Encoder:
    def __init__(self, path: str):
        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bos, self.eos = lib.bos_id(), lib.eos_id()
        self.piece, self.score = {}, {}
        self.automaton = ahocorasick.Automaton()
        self.text: list[str] = [""] * lib.get_piece_size()
        self.byte: dict[int, int] = {}
        for i in range(lib.get_piece_size()):
            text = lib.id_to_piece(i)
            if lib.is_byte(i):
                self.byte[int(text[3:-1], 16)] = i
            elif not (lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)):
                if SPACE in text.lstrip(SPACE):
                    raise ValueError(f"piece {text!r} spans words; its model cannot be cut at spaces")
                self.piece[text], self.text[i] = i, text
                self.score[text] = lib.get_score(i)
                self.automaton.add_word(text, i)
        self.automaton.make_automaton()
        self.length = [len(text) for text in self.text]
        # Pairs of characters that occur side by side in a piece: between any others nothing merges.
        self.beside = {text[i : i + 2] for text in self.piece for i in range(len(text) - 1)}
        self.cut, self.known = self._cuts({c for text in self.piece for c in text} - {SPACE})
        self.segments: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}

    def _cuts(self, known: set[str]) -> tuple[re.Pattern, re.Pattern]:
        """Patterns of a segment and of a character that has a piece.

        ``stops`` are signs that no piece has after a word character, so words end before them.
        """
        stops = {c for c in known if not c.isalpha()}
        while kept := {c for c in stops if not any(a + c in self.beside for a in known - stops)}:
            if kept == stops:
                break
            stops = kept
        word, stop = ("".join(map(re.escape, sorted(x))) for x in (known - stops, stops))
        after_space = f"{SPACE}*[{stop}]+[{word}]*|" if stops else ""
        return re.compile(f"{SPACE}*[{word}]+|{after_space}{SPACE}+|[^{word}{stop}{SPACE}]+"), re.compile(f"[{word}{stop}{SPACE}]")

    def merge(self, text: str) -> list[str]:
        """The pieces of a short text by the definition: always merge the adjacent pair whose union scores
        highest, the leftmost of equals."""
        parts, score = list(text), self.score
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, a: int, b: int) -> bool:
        left, right = self.text[a], self.text[b]
        known = self.merge(left + right) == [left, right]
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        self.pairs[a << 20 | b] = known
        return known

    def segment(self, text: str) -> bytes:
        """Ids of one segment as little-endian unsigned 32-bit integers."""
        if not self.known.match(text):
            return np.array([self.byte[b] for b in text.encode()], "<u4").tobytes()
        beside, begin, found = self.beside, 0, []
        for i in range(1, len(text)):
            if text[i - 1 : i + 1] not in beside:
                found.append(self.backtrack(text[begin:i]))
                begin = i
        found.append(self.backtrack(text[begin:]))
        return b"".join(found)

    def backtrack(self, text: str) -> bytes:
        cached = self.segments.get(text)
        if cached is not None:
            return cached
        n, length, pairs = len(text), self.length, self.pairs
        matches: list[list[int]] = [[] for _ in range(n)]
        for end, i in self.automaton.iter(text):
            matches[end + 1 - length[i]].append(i)
        failed = bytearray(n // 8 + 1)
        ids: list[int] = []
        tried: list[int] = []
        at, k, last = 0, len(matches[0]) - 1, -1
        while at < n:
            options = matches[at]
            while k >= 0:
                i = options[k]
                end = at + length[i]
                if not failed[end >> 3] >> (end & 7) & 1:
                    if last < 0:
                        break
                    fits = pairs.get(last << 20 | i)
                    if fits or fits is None and self.compatible(last, i):
                        break
                k -= 1
            if k >= 0:
                ids.append(i)
                tried.append(k)
                at, last = end, i
                if at < n:
                    k = len(matches[at]) - 1
            else:
                failed[at >> 3] |= 1 << (at & 7)
                at -= length[ids.pop()]
                last = ids[-1] if ids else -1
                k = tried.pop() - 1
        return self.remember(text, pack(f"<{len(ids)}I", *ids))

    def remember(self, text: str, ids: bytes) -> bytes:
        if len(text) <= 64:
            if len(self.segments) >= SEGMENTS:
                self.segments.clear()
            self.segments[text] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids without begin and end."""
        if not text:
            return b""
        found = []
        cache = self.segments
        for part in self.cut.findall(SPACE + text.replace(" ", SPACE)):
            ids = cache.get(part)
            if ids is None:
                ids = self.remember(part, self.segment(part))
            found.append(ids)
        return b"".join(found)

    def decode(self, ids: bytes) -> str:
        return self.library.decode(np.frombuffer(ids, "<u4").tolist())


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker."""
    return Encoder(path)


def encoded(docs: DataFrame, model: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep`` with ``ids binary`` (little-endian unsigned 32-bit, begin and end included) and
    ``decoded string``.  Row by row, no shuffle."""
    path = model or default_model()
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), text_of().alias("text"))
    row = packed.schema["row"].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        e = encoder(path)
        begin, end = (np.array([i], "<u4").tobytes() for i in (e.bos, e.eos))
        ids = [begin + e.encode(t) + end for t in batch.column("text").to_pylist()]
        decoded = [e.decode(i) for i in ids]
        return pa.record_batch([batch.column("row"), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())], names=["row", "ids", "decoded"])

    return with_batches(packed, work, f"row {row}, ids binary, decoded string").select("row.*", "ids", "decoded")


def digests(docs: DataFrame) -> DataFrame:
    """What the query reports of ``encoded``."""
    return encoded(docs, keep=("doc_id",)).select(
        "doc_id",
        F.expr("CAST(octet_length(ids) div 4 AS BIGINT)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
