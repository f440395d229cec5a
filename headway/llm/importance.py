"""Importance resampling towards a target: n-gram features in hashed buckets, Gumbel draw.

Two passes over the texts. The first counts the buckets of all n-grams of the documents and
of the target; a bucket's gain is the logarithm of how much more frequent it is in the
target. The second averages the gains of a document's n-grams to its weight. Both intern the
n-grams of a batch in an open-addressed table: a slot belongs to the n-gram whose xxhash64
led there, the bytes decide whether another one is the same, and a slot holds the bucket and
the count. So a bucket is worked out once per n-gram and batch, and occurrences fetch their
gain by slot. Drawing adds Gumbel noise from a hash of the id and takes the best.

Defined results: a null or empty text has no n-grams and weight 0; a null id draws as the
text ``null`` and loses ties; rows that repeat an id have the same noise, and those that tie
in score too are ranked by weight, then in any order; empty tables give no rows, and an
empty target counts 0 everywhere. Texts of any length go through in pieces of some megabytes
that end between words; only a single word is ever held longer. Other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.grouping import stored
from headway.llm.ordering import with_position
from headway.llm.wordbytes import slices

# A word is a run of digits, lower case letters and whatever is not ASCII.
_SEPARATOR = re.compile(rb"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

# Fixed values of xxhash64.
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (
        0x9E3779B185EBCA87,
        0xC2B2AE3D27D4EB4F,
        0x165667B19E3779F9,
        0x85EBCA77C2B2AE63,
        0x27D4EB2F165667C5,
    )
)
_PIECE = 1 << 21
# The first bytes of an eight-byte lane.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


class Spans:
    """Byte spans of a buffer, read eight bytes at a time."""

    def __init__(self, data: bytes, starts: np.ndarray, ends: np.ndarray):
        self.data, self.starts, self.sizes = data, starts, ends - starts
        padded = np.frombuffer(data + bytes(8), np.uint8)
        self._at = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))

    def lane(self, number: int, which: np.ndarray) -> np.ndarray:
        """Bytes 8 * number and on of the spans, zeros after their end."""
        left = np.minimum(self.sizes[which] - 8 * number, 8)
        return self._at[self.starts[which] + 8 * number] & _FIRST[left]

    def span(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.starts[i] + self.sizes[i]]

    def hashes(self) -> np.ndarray:
        """xxhash64 of every span: short ones together, those of 32 bytes and more singly."""
        sizes = self.sizes
        found = _P5 + sizes.astype(np.uint64)
        for number in range(3):
            which = np.flatnonzero((sizes >= 8 * number + 8) & (sizes < 32))
            mixed = _turned(self.lane(number, which) * _P2, 31) * _P1
            found[which] = _turned(found[which] ^ mixed, 27) * _P1 + _P4
        rest = sizes & 7
        which = np.flatnonzero((rest >= 4) & (sizes < 32))
        four = self._at[self.starts[which] + (sizes[which] & ~7)] & _FIRST[4]
        found[which] = _turned(found[which] ^ (four * _P1), 23) * _P2 + _P3
        for number in range(3):
            which = np.flatnonzero(((rest & 3) > number) & (sizes < 32))
            one = self._at[self.starts[which] + (sizes[which] & ~3) + number] & _FIRST[1]
            found[which] = _turned(found[which] ^ (one * _P5), 11) * _P1
        found = (found ^ (found >> np.uint64(33))) * _P2
        found = (found ^ (found >> np.uint64(29))) * _P3
        found ^= found >> np.uint64(32)
        for i in np.flatnonzero(sizes >= 32).tolist():
            found[i] = xxhash.xxh64_intdigest(self.span(i))
        return found

    def equal(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Whether spans are the same bytes, pair by pair."""
        same = self.sizes[one] == self.sizes[other]
        for number in range(8):
            which = np.flatnonzero(same & (self.sizes[one] > 8 * number))
            if not len(which):
                return same
            same[which] = self.lane(number, one[which]) == self.lane(number, other[which])
        for i in np.flatnonzero(same & (self.sizes[one] > 64)).tolist():
            same[i] = self.span(one[i]) == self.span(other[i])
        return same


class Interned:
    """The distinct spans of a batch: a slot for each, with its bucket and its count."""

    def __init__(self, spans: Spans, buckets: int):
        hashes = spans.hashes()
        n = len(hashes)
        table = np.full(1 << max(4, (2 * n).bit_length()), -1, np.int64)
        last = np.uint64(len(table) - 1)
        place = ((hashes ^ (hashes >> np.uint64(32))) & last).astype(np.int64)
        pending = np.arange(n)
        while len(pending):
            at = place[pending]
            free = table[at] < 0
            # Of several that meet in a free place one gets it; the others compare with it.
            table[at[free]] = pending[free]
            holder = table[at]
            same = hashes[holder] == hashes[pending]
            which = np.flatnonzero(same)
            same[which] = spans.equal(holder[which], pending[which])
            pending = pending[~same]
            place[pending] = (place[pending] + 1) & int(last)
        held = np.flatnonzero(table >= 0)
        number = np.zeros(len(table), np.int64)
        number[held] = np.arange(len(held))
        self.slots = number[place]
        self.counts = np.bincount(self.slots, minlength=len(held))
        texts = (spans.span(i) for i in table[held].tolist())
        self.buckets = np.array([zlib.crc32(t) % buckets for t in texts], np.int64)


def _pieces(rows: list[tuple[int, str]], order: int) -> Iterator[tuple[list, list, list]]:
    """Texts as pieces of bounded size: row numbers, bytes, and words that only lead in."""
    numbers, parts, leads, held = [], [], [], 0
    for number, text in rows:
        data = text.encode()
        at, lead, first = 0, b"", True
        while first or at < len(data):
            cut = _SEPARATOR.search(data, at + _PIECE) if len(data) - at > _PIECE else None
            end = cut.start() if cut else len(data)
            part = lead + b" " + data[at:end]
            if held and held + len(part) > _PIECE:
                yield numbers, parts, leads
                numbers, parts, leads, held = [], [], [], 0
            numbers.append(number)
            parts.append(part)
            leads.append(len(lead.split()))
            held += len(part)
            if order > 1 and end < len(data):
                words = _words(part)
                lead = b" ".join(words[-(order - 1) :])
            at, first = max(end, at + 1), False
    if numbers:
        yield numbers, parts, leads


def _words(data: bytes) -> list[bytes]:
    folded = _LOWER[np.frombuffer(data, np.uint8)]
    return np.where(_IN_WORD[folded], folded, 0x20).astype(np.uint8).tobytes().split()


def _ngrams(parts: list[bytes], leads: list[int], order: int):
    """Spans of all n-grams, the piece of each, and the number of words of each piece.

    Words stand joined by one space, so that an n-gram is a span. One that ends among the
    words that lead in was counted with the piece before.
    """
    raw = _LOWER[np.frombuffer(b"\0".join(parts), np.uint8)]
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = _IN_WORD[raw]
    first = np.flatnonzero(inside[1:] & ~inside[:-1])
    last = np.flatnonzero(inside[:-1] & ~inside[1:])
    sizes = last - first
    offsets = np.cumsum([0, *(len(p) + 1 for p in parts)])[:-1]
    piece = np.searchsorted(offsets, first, "right") - 1
    words = np.bincount(piece, minlength=len(parts))
    start = np.cumsum(sizes + 1) - sizes - 1
    keep = np.zeros(len(raw) + 1, bool)
    keep[:-1] = inside[1:-1]
    joined = np.append(raw, np.uint8(0x20))
    joined[:-1][~inside[1:-1]] = 0x20
    keep[last] = True
    text = joined[keep].tobytes()
    place = np.arange(len(first)) - (np.cumsum(words) - words)[piece]
    lead = np.array(leads, np.int64)
    starts, ends, of = [], [], []
    for n in range(1, order + 1):
        i = np.arange(len(first) - n + 1) if len(first) >= n else np.zeros(0, np.int64)
        i = i[(piece[i] == piece[i + n - 1]) & (place[i + n - 1] >= lead[piece[i]])]
        starts.append(start[i])
        ends.append(start[i + n - 1] + sizes[i + n - 1])
        of.append(piece[i])
    spans = Spans(text, np.concatenate(starts), np.concatenate(ends))
    return spans, np.concatenate(of), words - lead


def _counter(order: int, buckets: int) -> Callable:
    """A task's texts as (bucket, number of n-grams)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in (part for whole in batches for part in slices(whole, "text", 8192)):
            rows = [(0, t) for t in batch.column(0).to_pylist() if t]
            for _, parts, leads in _pieces(rows, order):
                interned = Interned(_ngrams(parts, leads, order)[0], buckets)
                np.add.at(total, interned.buckets, interned.counts)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, order: int, buckets: int) -> np.ndarray:
    """n-grams in each bucket over all texts; `buckets` bounds what comes to the driver."""
    parts = texts.select("text").mapInArrow(_counter(order, buckets), "bucket long, n long")
    found = np.zeros(buckets, dtype=object)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        found[row["bucket"]] = row["n"]
    return found


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's floor(1000 * ln(its share of the target / its share of the corpus))."""
    buckets, s, t = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((b + 1) * (s + buckets) / ((a + 1) * (t + buckets))))
            for a, b in zip(corpus.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def _weigher(order: int, gain: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text", 8192)):
            n = batch.num_rows
            features, words, sums = (np.zeros(n, np.int64) for _ in range(3))
            rows = [(i, t) for i, t in enumerate(batch.column(1).to_pylist()) if t]
            for numbers, parts, leads in _pieces(rows, order):
                spans, piece, own = _ngrams(parts, leads, order)
                interned = Interned(spans, len(gain))
                at = np.array(numbers, np.int64)
                got = gain[interned.buckets][interned.slots]
                np.add.at(sums, at[piece], got)
                np.add.at(features, at, np.bincount(piece, minlength=len(at)))
                np.add.at(words, at, own)
            weight = sums // np.maximum(features, 1)
            columns = [batch.column(0), *(pa.array(x) for x in (features, words, weight))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_features", "n_words", "weight"])

    return run


def gumbel(doc_id: Column, seed: str) -> Column:
    """floor(1000 * a Gumbel variate) from seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(
    documents: DataFrame,
    target: DataFrame,
    percent: int = 10,
    order: int = 1,
    buckets: int = 10_000,
    seed: str = "2024",
    least_words: int = 20,
) -> DataFrame:
    """doc_id, n_features, n_words, weight, score, and rank of the drawn documents.

    Of documents with `least_words` words or more, `percent` in a hundred are drawn, those
    with the highest scores. Only ids and numbers are sorted.
    """
    gain = gains(bucket_counts(documents, order, buckets), bucket_counts(target, order, buckets))
    weighed = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _weigher(order, gain), "doc_id long, n_features long, n_words long, weight long"
    )
    score = F.col("weight") + gumbel(F.col("doc_id"), seed)
    scored = stored(weighed.withColumn("score", score), "weights")
    best_first = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight").desc()]
    ranked = with_position(
        scored.filter(F.col("n_words") >= least_words), [], best_first, "place", "eligible"
    )
    drawn = F.col("place") < F.floor(percent * F.col("eligible") / 100)
    rank = F.when(drawn, F.col("place") + 1).cast("long").alias("rank")
    short = scored.filter(F.col("n_words") < least_words)
    return ranked.select(*scored.columns, rank).union(
        short.select("*", F.lit(None).cast("long").alias("rank"))
    )
