"""Near-duplicate groups by SuperMinHash, banding, verification and union-find.

A document's set are its distinct five-word shingles. In a SuperMinHash every shingle has
one permutation of the M signature places; at place p it offers its rank of p, plus a
random fraction. Ranks are taken level by level: what a lower level has filled no later
level can better, so work stops once all places of a document are filled. The ranks of one
shingle are a permutation and hence correlated, which lowers the variance against
independent minima. Permutations are affine over a prime field, so they need no memory.

Equal sets are grouped first and stand in once. Signatures are cut into bands; documents
that agree in a band are candidates. Candidates pass a bit digest of the signature (far
wider than its error), and then are compared on their full sets. Links go to union-find.

Within a band bucket not all pairs are looked at. Round one compares the members with the
smallest one of the bucket. Buckets that still hold different groups stay open, and their
documents get two bounds on every similarity, both exact: shingles that no other open
document has cannot be shared; and bits that differ between two parity bitmaps stand for
shingles that only one of two sets has. Round two compares with the member that has fewest
exclusive shingles, the one nearest to what copies were made from; round three takes the
pairs of different groups that are left and within the bounds. Copies by the thousand so cost a few
comparisons each, and no two texts that agree in a band go without one, unless they are in
one group already or cannot be similar.

Defined results: texts without words have an empty set and are linked with nothing; fewer
than five words are one shingle. A null doc_id is linked with nothing, its component is
null and it is kept. Rows that repeat a doc_id stand for one document: links of each count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.grouping import group_links, stored
from headway.llm.wordbytes import LOWER, mix, slices, text_bytes, token_hashes

WORDS = 5
PLACES = 127  # prime
ROWS, BANDS = 4, 31
# Of the digest's 127 bits a pair of similarity 0.75 differs in 16 on average, with a
# standard deviation under 3.7: six of those are allowed.
MOST_BITS = 38
# Bitmaps of 64 * LANES bits: each shingle flips one.
LANES = 16
_GOLD = 0x9E3779B97F4A7C15
_EMPTY = np.uint32(0xFFFFFFFF)


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, counts = token_hashes(*text_bytes(column), fold=LOWER)
    if len(words) >= WORDS:
        rolled = np.zeros(len(words) - WORDS + 1, np.uint64)
        for k in range(WORDS):
            factor = np.uint64(pow(_GOLD, 2 * k + 1, 1 << 64))
            rolled += words[k : len(rolled) + k] * factor
        rolled = mix(rolled)
    out, at = [], 0
    for n in counts:
        if n >= WORDS:
            out.append(np.unique(rolled[at : at + n - WORDS + 1]))
        elif n:
            own = np.uint64(n)
            for word in words[at : at + n]:
                own = mix(np.array([own ^ word]))[0]
            out.append(np.array([own], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def superminhash(sets: list[np.ndarray]) -> np.ndarray:
    """Signatures, a row for each set: level in the high seven bits, fraction below."""
    sizes = np.array([len(s) for s in sets])
    signature = np.full((len(sets), PLACES), _EMPTY, np.uint32)
    flat = signature.reshape(-1)
    value = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    place = (value % np.uint64(PLACES)).astype(np.int64)
    step = ((value >> np.uint64(24)) % np.uint64(PLACES - 1)).astype(np.int64) + 1
    for level in range(PLACES):
        fraction = mix(value + np.uint64((level + 1) * _GOLD % (1 << 64))) >> np.uint64(39)
        offer = fraction.astype(np.uint32) | np.uint32(level << 25)
        np.minimum.at(flat, owner * PLACES + place, offer)
        alive = np.unique(owner)
        done = alive[(signature[alive] != _EMPTY).all(axis=1)]
        if len(done):
            finished = np.zeros(len(sets), bool)
            finished[done] = True
            left = ~finished[owner]
            value, owner, place, step = value[left], owner[left], place[left], step[left]
        if not len(value):
            break
        place = place + step
        place -= PLACES * (place >= PLACES)
    return signature


def _bands(signature: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    parts = signature[:, : ROWS * BANDS].reshape(-1, BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(
        mix(np.arange(BANDS, dtype=np.uint64) + np.uint64(_GOLD)), parts.shape[:2]
    ).copy()
    for r in range(ROWS):
        keys = mix(keys ^ parts[:, :, r])
    return keys.view(np.int64)


def _digests(signature: np.ndarray) -> np.ndarray:
    """One bit of each place, as two 64-bit numbers."""
    bits = np.zeros((len(signature), 128), np.uint8)
    bits[:, :PLACES] = signature & np.uint32(1)
    return np.packbits(bits, axis=1).view(">i8").astype(np.int64)


_SKETCH = (
    "doc_id long, n_shingles long, set_key binary, d1 long, d2 long, bands array<long>"
)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            sets = shingle_sets(batch.column("text"))
            full = [s if len(s) else np.zeros(1, np.uint64) for s in sets]
            signature = superminhash(full)
            digest = _digests(signature)
            keys = [
                hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
                for s in sets
            ]
            bands = pa.ListArray.from_arrays(
                pa.array(np.arange(len(sets) + 1) * BANDS, pa.int32()),
                pa.array(_bands(signature).reshape(-1)),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(keys, pa.binary()), pa.array(digest[:, 0]), pa.array(digest[:, 1]),
                    bands,
                ],
                names=["doc_id", "n_shingles", "set_key", "d1", "d2", "bands"],
            )


def _confirm(share: int):
    """Pairs (a, b, text_a, text_b) that reach the similarity on their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, last_set = None, None
        for whole in batches:
            for batch in slices(whole, "text_b"):
                keep = []
                ones = batch.column("a").to_pylist()
                texts = batch.column("text_a")
                for i, other in enumerate(shingle_sets(batch.column("text_b"))):
                    if last_key != (key := (ones[i], texts[i].as_py())):
                        last_key, last_set = key, shingle_sets(texts.slice(i, 1))[0]
                    both = len(np.intersect1d(last_set, other, assume_unique=True))
                    union = len(last_set) + len(other) - both
                    keep.append(bool(both) and 100 * both >= share * union)
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _close(share: int):
    """Whether sizes, digests and exclusive shingles allow the similarity of x and y."""
    sizes = F.col("x.n") + F.col("y.n")
    common = F.least(F.col("x.n") - F.col("x.own"), F.col("y.n") - F.col("y.own"))
    bits = F.bit_count(F.col("x.d1").bitwiseXOR(F.col("y.d1"))) + F.bit_count(
        F.col("x.d2").bitwiseXOR(F.col("y.d2"))
    )
    apart = sum(
        (F.bit_count(F.col("x.map")[i].bitwiseXOR(F.col("y.map")[i])) for i in range(LANES)),
        F.lit(0),
    )
    overlap = F.coalesce(F.least(common, (sizes - apart) / 2), common)
    return ((100 + share) * overlap >= share * sizes) & (bits <= MOST_BITS)


def near_duplicates(documents: DataFrame, similarity_percent: int = 75) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    similarity_percent must be 75 or more: bands and digests are made for that.
    """
    if similarity_percent < 75:
        raise ValueError("the bands are made for a similarity of 75 percent or more")
    spark = documents.sparkSession
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")
    )
    sketches = stored(docs.mapInArrow(_sketch, _SKETCH), "sketches")
    sets = sketches.filter("set_key is not null and doc_id is not null")
    stands = stored(
        sets.groupBy("set_key").agg(
            F.min("doc_id").alias("id"),
            F.first("n_shingles").alias("n"),
            F.first("d1").alias("d1"),
            F.first("d2").alias("d2"),
            F.first("bands").alias("bands"),
        ),
        "sets",
    )
    rows = stands.select(
        "id", "n", F.lit(0).cast("long").alias("own"), "d1", "d2", F.explode("bands").alias("band")
    )
    shared = rows.groupBy("band").agg(F.count("*").alias("members")).filter("members > 1")
    members = rows.join(shared, "band").drop("members")
    members = stored(members.withColumn("map", F.lit(None).cast("array<long>")), "buckets")
    # Texts are moved by id once; all rounds read what is left of them here.
    ids = members.select(F.col("id").alias("doc_id")).distinct()
    docs = stored(docs.join(ids, "doc_id", "left_semi"), "texts")

    groups = confirmed = tried = None
    for round_ in (1, 2, 3):
        if round_ == 1:
            open_ = members.withColumn("root", F.col("id"))
        else:
            open_ = _still_open(members, groups)
            if open_.isEmpty():
                break
        if round_ == 2:
            members = stored(_with_exclusive(docs, sets, open_), "buckets")
            open_ = members
        member = F.struct("id", "n", "own", "d1", "d2", "map", "root")
        if round_ < 3:
            first = F.min(F.struct("own", "id", member.alias("m"))).alias("first")
            centres = open_.groupBy("band").agg(first).select("band", F.col("first.m").alias("y"))
            pairs = open_.select("band", member.alias("x")).join(centres, "band")
        else:
            pairs = open_.select("band", member.alias("x")).join(
                open_.select("band", member.alias("y")), "band"
            )
            pairs = pairs.filter("x.id < y.id")
        pairs = pairs.filter((F.col("x.root") != F.col("y.root")) & _close(similarity_percent))
        pairs = pairs.select(
            F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")
        ).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        tried = pairs if tried is None else tried.union(pairs)
        links = stored(_confirmed(docs, pairs, similarity_percent), "links")
        confirmed = links if confirmed is None else confirmed.union(links)
        groups = group_links(spark, confirmed)
    return _labelled(spark, sketches, sets, stands, confirmed, groups)


def _still_open(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Members, with their present root, of buckets that hold different groups."""
    up = groups.select(F.col("node").alias("id"), F.col("root").alias("up"))
    named = members.drop("root").join(up, "id", "left")
    named = named.withColumn("root", F.coalesce("up", "id")).drop("up")
    mixed = named.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    return stored(named.join(mixed.filter("low < high").select("band"), "band"), "buckets")


def _with_exclusive(docs: DataFrame, sets: DataFrame, open_: DataFrame) -> DataFrame:
    """Members with `own`, the number of shingles that no other member's set has, and `map`.

    They are 0 and null for documents whose rows have several sets: what they have together
    says nothing about each. Their shingles still count as had, so that none that another
    document shares with one of their texts passes for its own.
    """
    ids = open_.select(F.col("id").alias("doc_id")).distinct()
    # Any of the sets counts here, also one that a smaller id stands for.
    several = sets.select("doc_id", "set_key").join(ids, "doc_id", "left_semi").distinct()
    several = several.groupBy(F.col("doc_id").alias("id")).agg(F.count("*").alias("sets"))
    several = several.filter("sets > 1")
    # Rows that repeat a text are one; texts of one id are told apart by what they hold.
    texts = docs.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    shingles = texts.mapInArrow(_shingle_rows, "id long, shingles array<long>, map array<long>")
    shingles = stored(shingles.filter(F.size("shingles") > 0), "shingles")
    lone = (
        shingles.select("id", F.explode("shingles").alias("shingle"))
        .groupBy("shingle")
        .agg(F.min("id").alias("id"), F.max("id").alias("last"))
        .filter("id = last")
    )
    own = lone.groupBy("id").agg(F.count("*").alias("lone"))
    own = own.join(several, "id", "left_anti")
    maps = shingles.groupBy("id").agg(F.first("map").alias("map"))
    maps = maps.join(several, "id", "left_anti").join(own, "id", "left")
    found = open_.drop("map").join(maps, "id", "left")
    return found.withColumn("own", F.coalesce("lone", F.lit(0).cast("long"))).drop("lone")


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            sets = shingle_sets(batch.column("text"))
            maps = [parity_map(s) for s in sets]
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([s.view(np.int64) for s in sets], lists),
                    pa.array(maps, lists),
                ],
                names=["id", "shingles", "map"],
            )


def parity_map(shingles: np.ndarray) -> np.ndarray:
    """A bit for each residue, set if an odd number of shingles have it.

    Shingles that two sets share cancel out: the maps differ in at most as many bits as
    there are shingles in just one of the sets.
    """
    spots = (shingles >> np.uint64(7)) % np.uint64(64 * LANES)
    odd = (np.bincount(spots.astype(np.int64), minlength=64 * LANES) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def _confirmed(docs: DataFrame, pairs: DataFrame, share: int) -> DataFrame:
    """The pairs that hold on full sets. Only texts that stand in a pair are moved."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = stored(docs.join(ids, "doc_id", "left_semi"), "texts")
    one = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    other = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(other, "b").join(one, "a").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_confirm(share), "a long, b long")


def _labelled(spark: SparkSession, sketches, sets, stands, confirmed, groups) -> DataFrame:
    # Documents whose rows have different texts link the groups of these.
    again = sets.groupBy("doc_id").agg(F.count("*").alias("rows")).filter("rows > 1")
    several = (
        sets.join(again, "doc_id", "left_semi")
        .join(stands.select("set_key", "id"), "set_key")
        .select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
        .filter("a <> b")
    )
    several = stored(several, "links")
    if not several.isEmpty():
        groups = group_links(spark, confirmed.union(several))
    up = groups.select(F.col("node").alias("id"), F.col("root").alias("up"))
    roots = stands.select("set_key", "id").join(up, "id", "left")
    roots = roots.select("set_key", F.coalesce("up", "id").alias("root"))
    own = sketches.select("doc_id", "n_shingles", "set_key").join(roots, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return own.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
