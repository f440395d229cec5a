"""Language-model scores by a weighted backoff automaton.

The model is the hierarchical Dirichlet one. Of words, ``(c + 0.1) / (N + 0.1 * (V + 1))``;
of a word w after a context h of up to `order` - 1 words,
``(c(hw) + prior * p(w after h without its first word)) / (c(h) + prior)``. Seen contexts are
states, seen continuations are arcs with their log-probability, and a state without an arc
for a word fails to the state of its suffix at the cost ``prior / (c(h) + prior)``. A text is
read once from left to right; the state is carried from word to word.

No task holds the whole model, which grows with the corpus. Documents are dealt to blocks of
a quarter of a million words or so. A block sends the 64-bit keys of its distinct n-grams, with how often
they occur in its training texts, to the key ranges; a range adds up and answers each block
with the totals in the order in which it asked, without the keys. From the answers a block
builds the automaton of just its own n-grams, which has every arc that its texts can take,
and reads its texts, many at once, each a word at a time. A frequent n-gram is one entry per block, however often it occurs.

Defined results: null and empty texts have one token, the end. Null ids and rows that repeat
an id are documents of their own. Without training texts N is 0 and every probability of a
token is 1. Empty tables give no rows. Texts of any length are cut between words to pieces of
some megabytes, and a piece starts in the state that the one before ends in, as the words of
that state lead it in. Two different n-grams count as one if their 64-bit keys are equal.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.grouping import stored
from headway.llm.wordbytes import mix, slices

_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_PIECE = 8 << 20
_BLOCK_TOKENS, _BLOCK_BYTES = 1 << 18, 8 << 20
# Texts and blocks go to Python by the megabyte: ten thousand of them are a batch of any size.
_BATCH_BYTES = 4 << 20
_RANGE_NGRAMS = 2 << 20
# Words that are read one after the other; the runs of a block are read side by side.
_RUN = 512
_MORE = np.uint64(0x9E3779B97F4A7C15)
# The end of a text and what stands before it; words have no spaces.
_END, _START = 0, 1
_MARKS = (b" end", b" start")
_ADDED = 0.1

_BLOCK_SQL = (
    "block long, n_tokens long, n_trained long, doc_rows binary, doc_ids array<long>,"
    " trained binary, sizes binary, leads binary, tokens binary, words binary"
)


class _Words(dict):
    """Words of a block to numbers, in the order in which they come."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _planes(values: np.ndarray) -> bytes:
    """Little-endian numbers byte place by byte place: high places are mostly zeros."""
    raw = np.ascontiguousarray(values).view(np.uint8)
    return raw.reshape(len(values), values.itemsize).T.tobytes()


def _numbers(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = np.frombuffer(data, np.uint8).reshape(width, -1)
    return np.ascontiguousarray(raw.T).reshape(-1).view(kind)


class _Block:
    """Documents of one task, as numbers of their words."""

    def __init__(self):
        self.words = _Words((w, i) for i, w in enumerate(_MARKS))
        self.rows, self.ids, self.trained, self.sizes, self.leads = [], [], [], [], []
        self.tokens: list[np.ndarray] = []
        self.n_tokens = self.n_bytes = self.n_trained = 0

    def add(self, row: int, doc_id: int | None, trained: bool, lead: list[bytes], words: list[bytes],
            ends: bool, size: int) -> None:
        number = self.words.__getitem__
        tokens = [*map(number, lead), *map(number, words)]
        if ends:
            tokens.append(_END)
        self.rows.append(row)
        self.ids.append(doc_id)
        self.trained.append(trained)
        self.sizes.append(len(tokens))
        self.leads.append(len(lead))
        self.tokens.append(np.array(tokens, np.int32))
        self.n_tokens += len(tokens)
        self.n_bytes += size
        self.n_trained += trained and lead == [_MARKS[_START]]

    def row(self, block: int) -> pa.RecordBatch:
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in self.words], np.uint64)
        kind = lambda x, k: _planes(np.array(x, k))
        columns = [
            pa.array([block]),
            pa.array([self.n_tokens]),
            pa.array([self.n_trained]),
            pa.array([kind(self.rows, "<i8")], pa.binary()),
            pa.array([self.ids], pa.list_(pa.int64())),
            pa.array([kind(self.trained, "<u1")], pa.binary()),
            pa.array([kind(self.sizes, "<i4")], pa.binary()),
            pa.array([kind(self.leads, "<i4")], pa.binary()),
            pa.array([_planes(np.concatenate(self.tokens))], pa.binary()),
            pa.array([_planes(hashes)], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _BLOCK_SQL.split(", ")])


def _cut(text: str | None, order: int) -> Iterator[tuple[list[bytes], list[bytes], bool, int]]:
    """Pieces of a text: the words that lead in, its words, whether the text ends, its bytes."""
    data = (text or "").encode().lower()
    lead, at = [_MARKS[_START]], 0
    while True:
        cut = _SPACE.search(data, at + _PIECE) if len(data) - at > _PIECE else None
        end = cut.start() if cut else len(data)
        words = data[at:end].split()
        yield lead, words, cut is None, end - at
        if cut is None:
            return
        lead = [*lead, *words[1 - order :]][1 - order :] if order > 1 else []
        at = end


def _blocks(order: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, number, first = _Block(), 0, 0
        for batch in (part for whole in batches for part in slices(whole, "text")):
            for row, doc_id, trained, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # Numbers of rows have the task's number in their upper bits.
                first = row >> 33 << 33
                for lead, words, ends, size in _cut(text, order):
                    block.add(row, doc_id, trained, lead, words, ends, size)
                    if block.n_tokens >= _BLOCK_TOKENS or block.n_bytes >= _BLOCK_BYTES:
                        yield block.row(first + number)
                        block, number = _Block(), number + 1
        if block.n_tokens:
            yield block.row(first + number)

    return run


@dataclass
class _Order:
    """The distinct n-grams of one length in a block."""

    prefix: np.ndarray  # the n-gram without its last word, among those one shorter
    suffix: np.ndarray  # the same without its first word
    last: np.ndarray  # its last word
    keys: np.ndarray
    trained: np.ndarray  # how often in training texts of the block


class _Ngrams:
    """A block read back: tokens by piece, and its n-grams by length."""

    def __init__(self, row: dict, order: int):
        self.order = order
        self.tokens = _numbers(row["tokens"], "<i4").astype(np.int64)
        self.sizes, self.leads = _numbers(row["sizes"], "<i4"), _numbers(row["leads"], "<i4")
        hashes = _numbers(row["words"], "<u8")
        trained = _numbers(row["trained"], "<u1").astype(bool)
        self.ends = np.cumsum(self.sizes)
        piece = np.repeat(np.arange(len(self.sizes)), self.sizes)
        place = np.arange(len(self.tokens)) - (self.ends - self.sizes)[piece]
        own = place >= self.leads[piece]
        counted = own & trained[piece]
        none = np.zeros(len(hashes), np.int64)
        self.own, self.piece = own, piece
        words = np.bincount(self.tokens[counted], minlength=len(hashes))
        self.orders = [
            _Order(none, none, np.arange(len(hashes)), mix(hashes + np.uint64(1)), words)
        ]
        before = self.tokens
        for n in range(2, order + 1):
            at = np.flatnonzero(place >= n - 1)
            pairs = before[at - 1] << 32 | self.tokens[at]
            pairs, number = np.unique(pairs, return_inverse=True)
            some = np.empty(len(pairs), np.int64)
            some[number] = at
            prefix, last = pairs >> 32, pairs & 0xFFFFFFFF
            keys = mix(self.orders[-1].keys[prefix] * _MORE + hashes[last])
            mine = np.bincount(number[counted[at]], minlength=len(pairs))
            self.orders.append(_Order(prefix, before[some], last, keys, mine))
            before = np.zeros(len(self.tokens), np.int64)
            before[at] = number


_ASK_SQL = "n int, part int, block long, keys binary, trained binary"
_ASK = pa.schema(
    [("n", pa.int32()), ("part", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()),
     ("trained", pa.binary())]
)


def _asking(order: int, bits: int) -> Callable:
    """A block's n-grams as one row for each key range: sorted keys as steps, and counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                (row,) = batch.slice(i, 1).to_pylist()
                for n, grams in enumerate(_Ngrams(row, order).orders, 1):
                    sort = np.argsort(grams.keys, kind="stable")
                    keys, trained = grams.keys[sort], grams.trained[sort]
                    parts = (keys >> np.uint64(64 - bits)).astype(np.int64)
                    edges = np.flatnonzero(np.diff(parts, prepend=-1, append=-1))
                    out = []
                    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                        steps = np.diff(keys[a:b], prepend=np.uint64(0))
                        own = (n, int(parts[a]), row["block"], _planes(steps), _planes(trained[a:b]))
                        out.append(dict(zip(_ASK.names, own, strict=True)))
                    yield pa.RecordBatch.from_pylist(out, schema=_ASK)

    return run


_ANSWER_SQL = "n int, part int, block long, totals binary, kinds long, sum long"
_ANSWER = pa.schema(
    [("n", pa.int32()), ("part", pa.int32()), ("block", pa.int64()), ("totals", pa.binary()),
     ("kinds", pa.int64()), ("sum", pa.int64())]
)


def _answering(table: pa.Table) -> pa.Table:
    """One key range: for every block that asks, the totals in the order of its keys.

    kinds and sum, of the range's seen n-grams, stand in one of the rows.
    """
    asked = [np.cumsum(_numbers(k, "<u8"), dtype=np.uint64) for k in table["keys"].to_pylist()]
    sizes = [len(k) for k in asked]
    trained = [_numbers(d, "<i8") for d in table["trained"].to_pylist()]
    kinds, number = np.unique(np.concatenate(asked), return_inverse=True)
    totals = np.zeros(len(kinds), np.int64)
    np.add.at(totals, number, np.concatenate(trained))
    ends = np.cumsum(sizes)
    rows = [_planes(x) for x in np.split(totals[number], ends[:-1])]
    once = lambda x: pa.array([int(x)] + [0] * (len(sizes) - 1))
    columns = [table["n"], table["part"], table["block"], pa.array(rows, pa.binary()),
               once(np.count_nonzero(totals)), once(totals.sum())]
    return pa.table(columns, schema=_ANSWER)


@dataclass
class _Corpus:
    """What every block needs to know of the whole corpus."""

    tokens: int
    words: int
    texts: int

    def of_words(self, counts: np.ndarray) -> np.ndarray:
        return (counts + _ADDED) / (self.tokens + _ADDED * (self.words + 1))


class Automaton:
    """States, arcs and failure arcs of a block's n-grams; state 0 is the one without words."""

    def __init__(self, orders: list[_Order], totals: list[np.ndarray], corpus: _Corpus, prior: float):
        self.width = len(orders[0].last)
        chance = corpus.of_words(totals[0])
        self.word_logs = np.log10(chance)
        contexts = totals[0].copy()
        contexts[_START] = corpus.texts
        # The state of an n-gram: its own if it was seen, else that of its suffix.
        state = np.zeros(self.width, np.int64)
        if len(orders) > 1:
            state = np.where(contexts > 0, 1 + np.arange(self.width), 0)
        self.root_next = state
        back, fail = [np.zeros(1)], [np.zeros(1, np.int64)]
        arcs, logs, following, free = [], [], [], 1
        shorter = np.zeros(self.width, np.int64)
        for n, grams in enumerate(orders[1:], 2):
            back.append(np.log10(prior / (contexts + prior)))
            fail.append(shorter)
            counts = totals[n - 1]
            chance = (counts + prior * chance[grams.suffix]) / (contexts[grams.prefix] + prior)
            shorter = state[grams.suffix]
            own = free + grams.prefix
            free += len(contexts)
            state = shorter
            if n < len(orders):
                state = np.where(counts > 0, free + np.arange(len(counts)), shorter)
            # n-grams are in the order of prefix and last word, so arcs are sorted.
            seen = np.flatnonzero(counts > 0)
            arcs.append((own * self.width + grams.last)[seen])
            logs.append(np.log10(chance[seen]))
            following.append(state[seen])
            contexts = counts
        self.back, self.fail = np.concatenate(back), np.concatenate(fail)
        # A last arc that no word takes ends every search.
        self.arcs = np.concatenate([*arcs, [np.iinfo(np.int64).max]])
        self.logs = np.concatenate([*logs, [0.0]])
        self.following = np.concatenate([*following, [0]]).astype(np.int64)

    def read(
        self, tokens: np.ndarray, begins: np.ndarray, starts: np.ndarray, ends: np.ndarray
    ) -> np.ndarray:
        """Sums of log10 probabilities of many runs of tokens, read side by side.

        Every run goes from left to right and carries its state from word to word. The words
        from begin to start lead in, those from start to end count.
        """
        order = np.argsort(begins - ends, kind="stable")
        begins, leads, sizes = begins[order], (starts - begins)[order], (ends - begins)[order]
        state, total = np.zeros(len(order), np.int64), np.zeros(len(order))
        running = np.searchsorted(-sizes, -np.arange(sizes.max(initial=0)), "left")
        for step, n in enumerate(running.tolist()):
            words, now = tokens[begins[:n] + step], state[:n]
            gained = np.zeros(n)
            todo = np.flatnonzero(now)
            at_root = now == 0
            while len(todo):
                key = now[todo] * self.width + words[todo]
                at = np.searchsorted(self.arcs, key)
                found = self.arcs[at] == key
                hit, at = todo[found], at[found]
                gained[hit] += self.logs[at]
                now[hit] = self.following[at]
                todo = todo[~found]
                failed = now[todo]
                gained[todo] += self.back[failed]
                failed = self.fail[failed]
                now[todo] = failed
                at_root[todo[failed == 0]] = True
                todo = todo[failed > 0]
            at_root = np.flatnonzero(at_root)
            gained[at_root] += self.word_logs[words[at_root]]
            now[at_root] = self.root_next[words[at_root]]
            counted = step >= leads[:n]
            total[:n][counted] += gained[counted]
        out = np.empty(len(order))
        out[order] = total
        return out

    def read_pieces(self, grams: _Ngrams) -> np.ndarray:
        """The sum of each piece: runs of it are read side by side, led in by the words before."""
        own = grams.sizes - grams.leads
        runs = np.maximum(1, -(-own // _RUN))
        piece = np.repeat(np.arange(len(own)), runs)
        number = np.arange(len(piece)) - np.repeat(np.cumsum(runs) - runs, runs)
        first = (grams.ends - grams.sizes)[piece]
        starts = first + grams.leads[piece] + _RUN * number
        ends = np.minimum(starts + _RUN, grams.ends[piece])
        begins = np.maximum(first, starts - (grams.order - 1))
        return np.bincount(piece, self.read(grams.tokens, begins, starts, ends), len(own))


_SCORE_SQL = (
    "doc_row long, doc_id long, trained boolean, n_tokens long, n_known long,"
    " base_score double, score double"
)


def _scoring(order: int, prior: float, corpus: _Corpus) -> Callable:
    """A block and the answers to it: scores of its pieces."""

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        grams = _Ngrams(row, order)
        answers = answers.select(["n", "part", "totals"]).sort_by(
            [("n", "ascending"), ("part", "ascending")]
        )
        parts: list[list[np.ndarray]] = [[] for _ in range(order)]
        for n, data in zip(answers["n"].to_pylist(), answers["totals"].to_pylist(), strict=True):
            parts[n - 1].append(_numbers(data, "<i8"))
        totals = []
        for own, some in zip(grams.orders, parts, strict=True):
            total = np.zeros(len(own.keys), np.int64)
            if some:
                total[np.argsort(own.keys, kind="stable")] = np.concatenate(some)
            totals.append(total)
        model = Automaton(grams.orders, totals, corpus, prior)
        n = len(grams.sizes)
        tokens, piece = grams.tokens[grams.own], grams.piece[grams.own]
        base = np.bincount(piece, model.word_logs[tokens], n)
        known = np.bincount(piece, totals[0][tokens] > 0, n).astype(np.int64)
        columns = [
            pa.array(_numbers(row["doc_rows"], "<i8")),
            pa.array(row["doc_ids"], pa.int64()),
            pa.array(_numbers(row["trained"], "<u1").astype(bool)),
            pa.array((grams.sizes - grams.leads).astype(np.int64)),
            pa.array(known),
            pa.array(base),
            pa.array(model.read_pieces(grams)),
        ]
        return pa.table(columns, names=[c.split()[0] for c in _SCORE_SQL.split(", ")])

    return run


def score_texts(
    documents: DataFrame, trained: Column, order: int = 2, prior: float = 500.0
) -> DataFrame:
    """doc_id, trained, n_tokens, n_known, train_tokens, base_score, score for each document.

    documents: doc_id long, text; `trained` says which rows the model learns from. base_score
    sums the logarithms of the smoothed frequencies of the words, score those of the automaton.
    The default prior is the best of 1, 5, 20, 100, 500, 3000 and 20000 on texts held out.
    """
    spark = documents.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(_BATCH_BYTES))
    rows = documents.select(
        F.monotonically_increasing_id().alias("doc_row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(trained, F.lit(False)).alias("trained"),
        F.col("text"),
    )
    blocks = stored(rows.mapInArrow(_blocks(order), _BLOCK_SQL), "blocks")
    sums = blocks.agg(F.sum("n_tokens").alias("tokens"), F.sum("n_trained").alias("texts")).first()
    ranges = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        (sums["tokens"] or 0) * order // _RANGE_NGRAMS,
    )
    bits = max(1, (ranges - 1).bit_length())
    asked = blocks.mapInArrow(_asking(order, bits), _ASK_SQL)
    answers = stored(asked.groupBy("n", "part").applyInArrow(_answering, _ANSWER_SQL), "answers")
    texts = sums["texts"] or 0
    seen = answers.filter("n = 1").agg(F.sum("kinds").alias("kinds"), F.sum("sum").alias("sum")).first()
    corpus = _Corpus(seen["sum"] or 0, seen["kinds"] or 0, texts)
    pieces = (
        blocks.groupBy("block")
        .cogroup(answers.select("n", "part", "block", "totals").groupBy("block"))
        .applyInArrow(_scoring(order, prior, corpus), _SCORE_SQL)
    )
    added = {c: F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")}
    whole = pieces.groupBy("doc_row", "doc_id", "trained").agg(*added.values())
    return whole.select(
        "doc_id",
        "trained",
        "n_tokens",
        "n_known",
        F.lit(corpus.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
