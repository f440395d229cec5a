"""Quality classifier: random indexing, pooled vectors, a small network, calibration.

Random indexing: every token has a sparse index vector, a few signed places drawn from its
hash; the vector of a token is the sum of the index vectors around it, over all texts.
Tokens are runs of letters and digits and runs of punctuation; a token that repeats the one
before it counts as the token "again". Vectors live in a table of fixed size, by hash.

A document is the mean of its tokens' unit vectors and, for balance, their spread. A
two-layer network learns the label from labelled rows, a temperature fitted on rows set
aside makes its probabilities honest. The network sees nothing but the text.

Defined results: null and empty texts have the zero vector and a score like any other.
Rows that repeat a document are scored alike; labels that contradict count each. Without
labelled rows of both kinds every score is the share of label 1, 0.5 without any.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.grouping import stored
from headway.llm.wordbytes import RUNS, mix, slices, text_bytes, token_hashes

BUCKETS, WIDTH, WINDOW, MARKS = 1 << 13, 32, 2, 2
_AGAIN = np.uint64(0xA6A1)
# Labelled rows the network is fitted on, at most; a hash picks them beyond it.
MOST_LABELLED = 50_000


def _tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all tokens, their documents, and the number of each document."""
    hashes, counts = token_hashes(*text_bytes(batch.column("text")), classes=RUNS)
    owner = np.repeat(np.arange(len(counts)), counts)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    hashes = np.where(again, _AGAIN, hashes)
    return (hashes % np.uint64(BUCKETS)).astype(np.int64), owner, counts


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the index vector of each bucket."""
    draw = mix(np.arange(BUCKETS * MARKS, dtype=np.uint64) + np.uint64(77)).reshape(BUCKETS, MARKS)
    return (draw % np.uint64(WIDTH)).astype(np.int64), 1.0 - 2.0 * ((draw >> np.uint64(40)) & np.uint64(1))


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the index vectors around each bucket over a task's texts."""
    places, signs = index_vectors()
    sums = np.zeros(BUCKETS * WIDTH)
    for whole in batches:
        for batch in slices(whole, "text"):
            token, owner, _ = _tokens(batch)
            for gap in range(1, WINDOW + 1):
                near = owner[gap:] == owner[:-gap]
                left, right = token[:-gap][near], token[gap:][near]
                for a, b in ((left, right), (right, left)):
                    for m in range(MARKS):
                        sums += np.bincount(
                            a * WIDTH + places[b, m], signs[b, m], minlength=BUCKETS * WIDTH
                        )
    table = sums.reshape(BUCKETS, WIDTH)
    used = np.flatnonzero(table.any(axis=1))
    for at in range(0, len(used), 2048):
        some = used[at : at + 2048]
        flat = pa.array(table[some].astype(np.float32).reshape(-1))
        ends = pa.array(np.arange(len(some) + 1) * WIDTH, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.ListArray.from_arrays(ends, flat)],
            names=["bucket", "context"],
        )


def word_vectors(documents: DataFrame) -> np.ndarray:
    """Unit vectors of all buckets, from all texts: a table of fixed size, one megabyte."""
    parts = documents.select("text").mapInArrow(_contexts, "bucket int, context array<float>")
    total = parts.groupBy("bucket").agg(
        F.array(*(F.sum(F.col("context")[i].cast("double")) for i in range(WIDTH))).alias("context")
    )
    table = np.zeros((BUCKETS, WIDTH))
    for row in total.toLocalIterator():
        table[row["bucket"]] = row["context"]
    table = np.sign(table) * np.sqrt(np.abs(table))
    norms = np.linalg.norm(table, axis=1, keepdims=True)
    return table / np.where(norms > 0, norms, 1.0)


def _pooled(batch: pa.RecordBatch, table: np.ndarray) -> np.ndarray:
    """Mean and spread of the word vectors of each document; zeros without words."""
    token, owner, counts = _tokens(batch)
    seen = np.bincount(owner * BUCKETS + token, minlength=len(counts) * BUCKETS)
    sums = seen.reshape(len(counts), BUCKETS).astype(np.float64) @ np.hstack([table, table**2])
    sums /= np.maximum(counts, 1)[:, None]
    mean, square = sums[:, :WIDTH], sums[:, WIDTH:]
    return np.hstack([mean, np.sqrt(np.maximum(square - mean * mean, 0.0))])


@dataclass
class Network:
    """Standardised inputs, one hidden layer of tanh, a logit, a temperature."""

    centre: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.centre) / self.scale @ self.first + self.first_bias)
        return hidden @ self.second + self.second_bias

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40.0, 40.0)))


def fit_network(
    x: np.ndarray, y: np.ndarray, hidden: int = 16, epochs: int = 60, seed: int = 7
) -> Network:
    """Adam on the log loss of four fifths of the rows; the temperature on the others."""
    rng = np.random.default_rng(seed)
    centre, scale = np.zeros(x.shape[1]), np.ones(x.shape[1])
    if len(x):
        centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    start = rng.normal(0.0, 1.0 / np.sqrt(x.shape[1]), (x.shape[1], hidden))
    weights = [start, np.zeros(hidden), rng.normal(0.0, 1.0 / np.sqrt(hidden), hidden), np.zeros(1)]
    if len(np.unique(y)) < 2:
        # Nothing to tell apart: the share of label 1, within what a logit can say.
        share = np.clip(y.mean() if len(y) else 0.5, 0.001, 0.999)
        bias = float(np.log(share / (1 - share)))
        return Network(centre, scale, start, weights[1], np.zeros(hidden), bias)
    order = rng.permutation(len(x))
    aside = order[: max(1, len(x) // 5)]
    train = order[len(aside) :]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    steps = 0
    for _ in range(epochs):
        rng.shuffle(train)
        for at in range(0, len(train), 256):
            rows = train[at : at + 256]
            inputs = (x[rows] - centre) / scale
            hidden_ = np.tanh(inputs @ weights[0] + weights[1])
            error = (_sigmoid(hidden_ @ weights[2] + weights[3][0]) - y[rows]) / len(rows)
            back = np.outer(error, weights[2]) * (1.0 - hidden_**2)
            gradients = [
                inputs.T @ back + 1e-4 * weights[0], back.sum(axis=0),
                hidden_.T @ error + 1e-4 * weights[2], np.array([error.sum()]),
            ]
            steps += 1
            for w, g, (m, v) in zip(weights, gradients, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= 0.005 * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.999**steps)) + 1e-8)
    network = Network(centre, scale, weights[0], weights[1], weights[2], float(weights[3][0]))
    logits = network.logits(x[aside])
    choices = np.geomspace(0.25, 8.0, 60)
    losses = [np.mean(np.logaddexp(0.0, np.where(y[aside] > 0, -1, 1) * logits / t)) for t in choices]
    network.temperature = float(choices[int(np.argmin(losses))])
    return network


def fit_quality(
    documents: DataFrame, labels: DataFrame, most_labelled: int = MOST_LABELLED
) -> tuple[np.ndarray, Network]:
    """Word vectors from all documents, a network from at most `most_labelled` labelled ones.

    documents: doc_id, text; labels: doc_id, quality, without the rows held out.
    """
    table = word_vectors(documents)
    known = labels.filter("quality in (0, 1) and doc_id is not null").select(
        F.col("doc_id").alias("label_id"), "quality"
    )
    n = known.count()
    if n > most_labelled:
        share = int((1 << 30) * most_labelled / n)
        known = known.filter(F.pmod(F.xxhash64("label_id"), F.lit(1 << 30)) < share)
    pool = documents.select("doc_id", "text").mapInArrow(
        _pooling(table, "doc_id"), "doc_id long, features array<float>"
    )
    rows = pool.join(known, F.col("doc_id") == F.col("label_id")).select(
        "doc_id", "quality", "features"
    )
    got = stored(rows, "features").orderBy("doc_id", "quality").toPandas()
    x = np.array(got["features"].tolist(), np.float64).reshape(len(got), 2 * WIDTH)
    return table, fit_network(x, got["quality"].to_numpy(np.float64))


def _pooling(table: np.ndarray, key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", rows=128):
                x = _pooled(batch, table).astype(np.float32)
                ends = pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32())
                features = pa.ListArray.from_arrays(ends, pa.array(x.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key), features], names=[key, "features"]
                )

    return run


def score_quality(
    documents: DataFrame, table: np.ndarray, network: Network, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The columns `keep` of each document and its `score`. No shuffle.

    The table, a megabyte whatever the corpus, and the network go out with the tasks.
    """
    columns = documents.select(*keep, F.col("text").alias("text")) if "text" not in keep else (
        documents.select(*keep)
    )
    kinds = dict(columns.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", rows=128):
                # Rounded, so that the company in a batch cannot change a score.
                scores = np.round(network.scores(_pooled(batch, table)), 9)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in keep), pa.array(scores)], names=[*keep, "score"]
                )

    return columns.mapInArrow(run, schema)
