"""Token shards: raw id payloads in blocks, and a minimal perfect hash index over keys.

Folder layout, all written and read by Spark so that any store will do:

* ``payload``: blocks of a few thousand documents in ascending key order; the ids of all
  of them back to back, little-endian, two bytes each if the vocabulary allows, four
  otherwise, with the keys and the number of ids of each document.
* ``shards``: ids per shard (a contiguous key range) and those of all shards before it.
* ``index``: one row per index part. Each holds a minimal perfect hash over the keys that
  hash to it: bit levels give every key a slot of its own, the slot a 32-bit fingerprint
  (another key is told apart but for one in four billion) and the place of the document.

A lookup costs one index part and one block, whatever the size of the corpus.

Defined results: null and empty texts are the end id alone; null keys come first; rows that
repeat a key are copies 0, 1, ... of it, in order of their ids. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.encoding import encoder
from headway.llm.ordering import range_starts, with_range
from headway.llm.wordbytes import mix, slices

_BLOCK_DOCUMENTS, _BLOCK_BYTES = 4096, 4 << 20
_PART_KEYS = 1 << 16
_LEVELS = 48
# Of the encoder's table; a smaller one takes less memory and meets more words anew.
_FRAGMENTS = 1_000_000
_STEP = 0x9E3779B97F4A7C15


def write_token_shards(
    documents: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    width: int = 4,
    key: str = "doc_id",
) -> None:
    """Encode every text and write payload, shards and index below `folder`.

    Ids take `width` bytes, 2 or 4; a vocabulary that does not fit is refused.
    """
    if width not in (2, 4) or max(vocabulary_size(tokenizer), end_id + 1) > 1 << 8 * width:
        raise ValueError(f"the ids of this vocabulary do not fit into {width} bytes")
    spark = documents.sparkSession
    docs = documents.select(F.col(key).cast("long").alias("key"), F.col("text").alias("text"))
    docs = with_range(docs, "key", "shard")
    ids = docs.mapInArrow(_encoded(tokenizer, end_id, width), "shard int, key long, ids binary")
    blocks = (
        ids.repartition("shard")
        .sortWithinPartitions("shard", "key", "ids")
        .mapInArrow(_blocks(width), _BLOCK_SCHEMA)
    )
    blocks.write.option("compression", "zstd").parquet(f"{folder}/payload")
    places = spark.read.parquet(f"{folder}/payload")
    totals = places.groupBy("shard").agg(F.sum("block_ids").alias("ids"))
    starts = range_starts(totals, "shard", "ids", "shard_start")
    totals.join(starts, "shard").write.parquet(f"{folder}/shards")
    _write_index(places, f"{folder}/index")


def vocabulary_size(tokenizer: str) -> int:
    """The number of ids, from 0 on, that a tokenizer file may give."""
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(tokenizer).get_vocab().values(), default=-1) + 1


def _encoded(tokenizer: str, end_id: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4").tobytes()
        encode = encoder(tokenizer, _FRAGMENTS).encode
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                ids = [narrowed(x + end, width) for x in encode(texts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("shard"), batch.column("key"), pa.array(ids, pa.binary())],
                    names=["shard", "key", "ids"],
                )

    return run


def narrowed(ids: bytes, width: int) -> bytes:
    """Ids of four bytes as ids of `width` bytes."""
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def widened(ids: bytes, width: int) -> bytes:
    """Ids of `width` bytes as ids of four bytes."""
    return ids if width == 4 else np.frombuffer(ids, "<u2").astype("<u4").tobytes()


_BLOCK_SCHEMA = (
    "shard int, block int, width int, ids_before long, block_ids long,"
    " keys array<long>, copies array<long>, lengths array<long>, payload binary"
)


def _blocks(width: int):
    """Rows in (shard, key) order to blocks; memory holds one block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = block = before = copy = 0
        last: object = run
        keys, copies, ids, size = [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal block, before, keys, copies, ids, size
            lengths = [len(x) // width for x in ids]
            row = {
                "shard": shard, "block": block, "width": width, "ids_before": before,
                "block_ids": sum(lengths), "keys": keys, "copies": copies, "lengths": lengths,
                "payload": b"".join(ids),
            }
            block, before = block + 1, before + sum(lengths)
            keys, copies, ids, size = [], [], [], 0
            return pa.RecordBatch.from_pylist([row], schema=_BLOCK_ARROW)

        for batch in batches:
            columns = [batch.column(c) for c in ("shard", "key", "ids")]
            for s, k, x in zip(columns[0].to_pylist(), columns[1].to_pylist(), columns[2]):
                if ids and (s != shard or len(ids) >= _BLOCK_DOCUMENTS or size >= _BLOCK_BYTES):
                    yield flush()
                if s != shard:
                    block = before = 0
                    last = run
                shard, copy = s, (copy + 1 if k == last else 0)
                last = k
                keys.append(k)
                copies.append(copy)
                ids.append(x.as_py())
                size += len(ids[-1])
        if ids:
            yield flush()

    return run


_BLOCK_ARROW = pa.schema(
    [
        ("shard", pa.int32()), ("block", pa.int32()), ("width", pa.int32()),
        ("ids_before", pa.int64()), ("block_ids", pa.int64()), ("keys", pa.list_(pa.int64())),
        ("copies", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
        ("payload", pa.binary()),
    ]
)


# The minimal perfect hash


def key_hashes(keys: np.ndarray, null: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """64-bit hashes of (key, copy)."""
    own = mix(keys.astype(np.int64).view(np.uint64) + np.uint64(_STEP))
    own = np.where(null, np.uint64(0x1234567), own)
    return mix(own + copies.astype(np.uint64) * np.uint64(_STEP | 1))


def _spots(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(hashes + np.uint64((level * 0xD1B54A32D192ED03) % (1 << 64))) % np.uint64(size)).astype(
        np.int64
    )


def build_hash(hashes: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Bit levels of a minimal perfect hash; and hashes that no level could place.

    A level has one and a half bits for each hash left; those alone on their bit stay.
    """
    levels, left = [], hashes
    while len(left) and len(levels) < _LEVELS:
        size = max(64, (3 * len(left) // 2 + 7) // 8 * 8)
        spots = _spots(left, len(levels), size)
        alone = np.bincount(spots, minlength=size)[spots] == 1
        bits = np.zeros(size, bool)
        bits[spots[alone]] = True
        levels.append(bits)
        left = left[~alone]
    return levels, np.sort(left)


def slots_of(hashes: np.ndarray, levels: list[np.ndarray], rest: np.ndarray) -> np.ndarray:
    """The slot of each hash; -1 where no level has a bit for it."""
    out = np.full(len(hashes), -1, np.int64)
    open_, base = np.arange(len(hashes)), 0
    for number, bits in enumerate(levels):
        spots = _spots(hashes[open_], number, len(bits))
        hit = bits[spots]
        ranks = np.cumsum(bits) - 1
        out[open_[hit]] = base + ranks[spots[hit]]
        base += int(bits.sum())
        open_ = open_[~hit]
    if len(rest) and len(open_):
        at = np.searchsorted(rest, hashes[open_])
        same = rest[np.minimum(at, len(rest) - 1)] == hashes[open_]
        out[open_[same]] = base + at[same]
    return out


def _fingerprints(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype("<u4")


def _part(parts: int):
    key, copy = F.coalesce(F.col("key"), F.lit(-1)), F.col("copy")
    return F.pmod(F.xxhash64(key, copy), F.lit(parts)).cast("int").alias("part")


def _write_index(payload: DataFrame, folder: str) -> None:
    entries = payload.select(
        "shard",
        "block",
        F.posexplode(F.arrays_zip("keys", "copies")).alias("ordinal", "of"),
    ).select("shard", "block", "ordinal", F.col("of.keys").alias("key"), F.col("of.copies").alias("copy"))
    count = payload.agg(F.sum(F.size("keys")).alias("n")).first()["n"] or 0
    parts = count // _PART_KEYS + 1
    schema = (
        "part int, parts int, n long, level_sizes array<int>, levels binary, rest binary,"
        " fingerprints binary, places binary"
    )

    def build(table: pa.Table) -> pa.Table:
        column = {c: table.column(c).combine_chunks() for c in table.column_names}
        hashes = _hashes_of(column)
        levels, rest = build_hash(hashes)
        slots = slots_of(hashes, levels, rest)
        places = np.zeros((len(hashes), 3), "<i4")
        for i, c in enumerate(("shard", "block", "ordinal")):
            places[slots, i] = column[c].to_numpy()
        prints = np.zeros(len(hashes), "<u4")
        prints[slots] = _fingerprints(hashes)
        row = {
            "part": column["part"][0].as_py(), "parts": parts, "n": len(hashes),
            "level_sizes": [len(b) for b in levels],
            "levels": b"".join(np.packbits(b).tobytes() for b in levels),
            "rest": rest.astype("<u8").tobytes(), "fingerprints": prints.tobytes(),
            "places": places.tobytes(),
        }
        return pa.Table.from_pylist([row], schema=_INDEX_ARROW)

    entries.select("*", _part(parts)).groupBy("part").applyInArrow(build, schema).write.parquet(
        folder
    )


_INDEX_ARROW = pa.schema(
    [
        ("part", pa.int32()), ("parts", pa.int32()), ("n", pa.int64()),
        ("level_sizes", pa.list_(pa.int32())), ("levels", pa.binary()), ("rest", pa.binary()),
        ("fingerprints", pa.binary()), ("places", pa.binary()),
    ]
)


def _hashes_of(column: dict[str, pa.Array]) -> np.ndarray:
    key = column["key"]
    null = key.is_null().to_numpy(zero_copy_only=False)
    return key_hashes(key.fill_null(0).to_numpy(), null, column["copy"].to_numpy())


def read_documents(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """Look keys up in the index and fetch their ids.

    keys: distinct (key long, copy long); copy is 0 unless rows repeat a key. Returns key,
    copy, start (ids of all documents before it) and ids (little-endian, four bytes each,
    whatever the stored width); a row for every key that is there.
    """
    index = spark.read.parquet(f"{folder}/index")
    parts = index.agg(F.max("parts").alias("n")).first()["n"]
    wanted = keys.select(F.col("key").cast("long"), F.col("copy").cast("long"))
    if parts is None:
        parts = 1

    def look(asked: pa.Table, part: pa.Table) -> pa.Table:
        if not asked.num_rows or not part.num_rows:
            return _FOUND_ARROW.empty_table()
        row = {c: part.column(c)[0].as_py() for c in part.column_names}
        levels, at = [], 0
        for size in row["level_sizes"]:
            packed = np.frombuffer(row["levels"], np.uint8, size // 8, at)
            levels.append(np.unpackbits(packed).astype(bool))
            at += size // 8
        hashes = _hashes_of({c: asked.column(c).combine_chunks() for c in ("key", "copy")})
        slots = slots_of(hashes, levels, np.frombuffer(row["rest"], "<u8"))
        prints = np.frombuffer(row["fingerprints"], "<u4")
        there = (slots >= 0) & (prints[np.maximum(slots, 0)] == _fingerprints(hashes))
        place = np.frombuffer(row["places"], "<i4").reshape(-1, 3)[slots[there]]
        mask = pa.array(there)
        return pa.table(
            [asked.column("key").filter(mask), asked.column("copy").filter(mask),
             *(pa.array(place[:, i]) for i in range(3))],
            schema=_FOUND_ARROW,
        )

    found = (
        wanted.select("*", _part(parts))
        .groupBy("part")
        .cogroup(index.groupBy("part"))
        .applyInArrow(look, "key long, copy long, shard int, block int, ordinal int")
    )
    # A block has a bounded number of documents, so the list for a block is bounded too.
    asked = found.groupBy("shard", "block").agg(
        F.collect_list(F.struct("ordinal", "key", "copy")).alias("asked")
    )
    payload = spark.read.parquet(f"{folder}/payload").drop("keys", "copies", "block_ids")
    starts = spark.read.parquet(f"{folder}/shards").select("shard", "shard_start")
    blocks = payload.join(asked, ["shard", "block"]).join(starts, "shard")
    return blocks.select(
        "width", (F.col("shard_start") + F.col("ids_before")).alias("before"), "lengths", "payload", "asked"
    ).mapInArrow(_cut, "key long, copy long, start long, ids binary")


_FOUND_ARROW = pa.schema(
    [("key", pa.int64()), ("copy", pa.int64()), ("shard", pa.int32()), ("block", pa.int32()),
     ("ordinal", pa.int32())]
)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            width, before, lengths, payload, asked = (batch.column(c)[i].as_py() for c in range(5))
            ends = np.cumsum([0, *lengths])
            spans = [(ends[a["ordinal"]], ends[a["ordinal"] + 1]) for a in asked]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([a["key"] for a in asked], pa.int64()),
                    pa.array([a["copy"] for a in asked], pa.int64()),
                    pa.array([before + int(s) for s, _ in spans], pa.int64()),
                    pa.array(
                        [widened(payload[s * width : e * width], width) for s, e in spans],
                        pa.binary(),
                    ),
                ],
                names=["key", "copy", "start", "ids"],
            )
