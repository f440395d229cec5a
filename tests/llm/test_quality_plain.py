"""Word vectors and pooled documents against a plain version, word by word."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa

from headway.llm import quality
from headway.llm.wordbytes import RUNS, token_hashes, text_bytes

TEXTS = ["The cat sat. The cat!! ran, ran ran", "é ü-ü x", "", None, "one", "a b a b a b ... a b c_d 12",
         "the\tcat\nsat  on %% the mat"]


def _plain_tokens(text):
    """Runs of letters and digits, runs of ASCII punctuation; a repeated one is 'again'."""
    found = re.findall(r"[!-/:-@\[-`{-~]+|[^!-/:-@\[-`{-~\s]+", text or "")
    out = []
    for i, token in enumerate(found):
        repeated = i > 0 and found[i - 1] == token
        out.append(None if repeated else token)
    return out


def _bucket(token):
    if token is None:
        return int(quality._AGAIN) % quality.BUCKETS
    hashes, _ = token_hashes(*text_bytes(pa.array([token])), classes=RUNS)
    return int(hashes[0]) % quality.BUCKETS


def _plain_vectors():
    places, signs = quality.index_vectors()
    sums = np.zeros((quality.BUCKETS, quality.WIDTH))
    for text in TEXTS:
        buckets = [_bucket(t) for t in _plain_tokens(text)]
        for i, b in enumerate(buckets):
            for j in range(max(0, i - quality.WINDOW), min(len(buckets), i + quality.WINDOW + 1)):
                if i != j:
                    for m in range(quality.MARKS):
                        sums[b, places[buckets[j], m]] += signs[buckets[j], m]
    table = np.sign(sums) * np.sqrt(np.abs(sums))
    norms = np.linalg.norm(table, axis=1, keepdims=True)
    return table / np.where(norms > 0, norms, 1.0)


def test_word_vectors_equal_plain_ones(spark):
    frame = spark.createDataFrame([(t,) for t in TEXTS * 2], "text string").repartition(3)
    table = quality.word_vectors(frame)
    plain = _plain_vectors()
    # Twice the texts, twice the sums: the same unit vectors.
    assert np.allclose(table, plain, atol=1e-6)
    assert np.count_nonzero(table.any(axis=1)) > 10


def test_documents_are_mean_and_spread_of_their_words():
    table = _plain_vectors()
    batch = pa.RecordBatch.from_arrays([pa.array(TEXTS, pa.string())], ["text"])
    got = quality._pooled(batch, table)
    for row, text in zip(got, TEXTS, strict=True):
        vectors = np.array([table[_bucket(t)] for t in _plain_tokens(text)]).reshape(-1, quality.WIDTH)
        if not len(vectors):
            assert not row.any()
            continue
        assert np.allclose(row, np.hstack([vectors.mean(axis=0), vectors.std(axis=0)]), atol=1e-7)


def test_network_learns_what_words_tell():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 6))
    y = (x[:, 0] + 0.6 * x[:, 1] + 0.4 * rng.normal(size=900) > 0).astype(float)
    network = quality.fit_network(x[:600], y[:600])
    scores = network.scores(x[600:])
    assert np.mean((scores > 0.5) == (y[600:] > 0.5)) > 0.85
    # Calibrated: among scores near p about p are of label 1.
    for low in (0.0, 0.5):
        some = (scores >= low) & (scores < low + 0.5)
        assert abs(scores[some].mean() - y[600:][some].mean()) < 0.12
    assert Counter(scores.round(6)).most_common(1)[0][1] < 50
