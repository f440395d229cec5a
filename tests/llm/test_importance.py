"""Importance resampling against a plain version, and its table of n-grams."""

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash

from headway.llm import importance
from headway.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm import brute


def _tables(folder):
    documents = pq.read_table(f"{folder}/documents.parquet").to_pylist()
    target = pq.read_table(f"{folder}/benchmark.parquet").to_pylist()
    return [(r["doc_id"], r["text"]) for r in documents], [r["text"] for r in target]


@pytest.mark.parametrize("which", ["small", "odd"])
def test_query_equals_plain_version(spark, odd, which):
    folder = SMALL if which == "small" else odd
    want = brute.importance(*_tables(folder))
    got = [tuple(r) for r in QUERIES["op12_importance"](spark, folder).collect()]
    key = lambda r: [(x is None, x or 0) for x in r]
    assert sorted(got, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("order", [2, 3])
def test_longer_ngrams(spark, order):
    documents, target = _tables(SMALL)
    frame = spark.createDataFrame(documents, "doc_id long, text string")
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    found = importance.resample(frame, goal, 25, order, 500, "s", 5).drop("n_words").collect()
    want = brute.importance(documents, target, order, 500, 25, "s", 5)
    assert sorted(map(tuple, found), key=lambda r: r[0]) == sorted(want, key=lambda r: r[0])


def test_pieces_lose_and_repeat_nothing(monkeypatch):
    texts = ["One two  three-four " * 30, "", "x" * 300, " " * 90, "été A1.b2 " * 9]
    for order in (1, 2, 3):
        counts = []
        for size in (1 << 21, 64, 11):
            monkeypatch.setattr(importance, "_PIECE", size)
            total, words = {}, np.zeros(len(texts), int)
            for numbers, parts, leads in importance._pieces(list(enumerate(texts)), order):
                spans, piece, own = importance._ngrams(parts, leads, order)
                np.add.at(words, numbers, own)
                for i, p in enumerate(piece.tolist()):
                    key = (numbers[p], spans.span(i))
                    total[key] = total.get(key, 0) + 1
            counts.append((total, words.tolist()))
        assert counts[0] == counts[1] == counts[2]
        assert counts[0][1] == [120, 0, 1, 0, 27]


def test_hashes_and_slots():
    rng = np.random.default_rng(5)
    words = [bytes(rng.integers(97, 123, n).astype(np.uint8)) for n in [*range(1, 80), 500] * 3]
    words += words[:100] + [b"a", b"a", b"b"]
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    spans = importance.Spans(b" ".join(words) + b" ", starts, ends)
    assert spans.hashes().tolist() == [xxhash.xxh64_intdigest(w) for w in words]
    interned = importance.Interned(spans, 10_000)
    of = {}
    for slot, word in zip(interned.slots.tolist(), words, strict=True):
        assert of.setdefault(word, slot) == slot
    assert len(set(of.values())) == len(of) == len(interned.counts)
    assert interned.counts.sum() == len(words)


def test_bytes_decide_when_hashes_agree(monkeypatch):
    monkeypatch.setattr(
        importance.Spans, "hashes", lambda self: np.full(len(self.sizes), 7, np.uint64)
    )
    words = [b"aa", b"ab", b"aa", b"aaaaaaaaa", b"aaaaaaaab", b"ab"]
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    spans = importance.Spans(b" ".join(words) + b" ", ends - [len(w) for w in words], ends)
    slots = importance.Interned(spans, 100).slots.tolist()
    assert slots[0] == slots[2] and slots[1] == slots[5] and len(set(slots)) == 4
