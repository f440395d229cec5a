"""Packing by binary decomposition.

A document of n ids is cut into pieces whose lengths are powers of two: as many of the
longest as fit, then one for each binary digit of the rest. Every piece is a sequence of
its own, batches are made of equal lengths, so that no sequence crosses documents and
nothing is padded.

Defined results: null and empty texts are the end id alone. Rows that repeat a document
are packed each; their sequences have different ids. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.encoding import encoder
from headway.llm.ordering import with_range
from headway.llm.wordbytes import slices


def piece_lengths(n: int, longest: int) -> list[int]:
    """n as a sum of powers of two, at most `longest`, long ones first."""
    bits = [1 << b for b in range(longest.bit_length() - 2, -1, -1) if (n % longest) >> b & 1]
    return [longest] * (n // longest) + bits


def pack_documents(
    documents: DataFrame,
    tokenizer: str,
    end_id: int,
    longest: int = 2048,
    most_fragments: int = 250_000,
    sums_only: bool = False,
    forget: bool = False,
) -> DataFrame:
    """Pieces: doc_id, start, length, doc_tokens and ids (little-endian, four bytes each).

    With `sums_only` the ids stay where they are and ids_crc32, their check sum, comes instead.

    No shuffle: a document is encoded and cut where it is. `most_fragments` bounds the
    encoder's table of what it has met, and with `forget` a task empties it when it ends
    instead of leaving it to the worker's next one; both change memory and time only.
    """
    if longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    name, kind = ("ids_crc32", "long") if sums_only else ("ids", "binary")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4").tobytes()
        known = encoder(tokenizer, most_fragments)
        encode = known.encode
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                keys, starts, lengths, totals, ids = [], [], [], [], []
                for key, body in zip(batch.column("doc_id").to_pylist(), encode(texts), strict=True):
                    body += end
                    at, n = 0, len(body) // 4
                    for length in piece_lengths(n, longest):
                        keys.append(key)
                        starts.append(at)
                        lengths.append(length)
                        totals.append(n)
                        piece = body[4 * at : 4 * (at + length)]
                        ids.append(crc32(piece) if sums_only else piece)
                        at += length
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.int64()), pa.array(starts, pa.int64()),
                        pa.array(lengths, pa.int64()), pa.array(totals, pa.int64()),
                        pa.array(ids, pa.int64() if sums_only else pa.binary()),
                    ],
                    names=["doc_id", "start", "length", "doc_tokens", name],
                )
        if forget:
            known.forget()

    return docs.mapInArrow(
        cut, f"doc_id long, start long, length long, doc_tokens long, {name} {kind}"
    )


def number_sequences(pieces: DataFrame, tie: str = "ids_crc32") -> DataFrame:
    """Add `sequence_id`, gapless from 0: by length, then document, then place in it.

    pieces must be a stored table, for it is read twice. Counted are pieces per length and
    key range; only those counts meet in one task. Equal pieces of repeated rows may swap
    ids, which changes nothing that can be seen.
    """
    placed = with_range(pieces, "doc_id", "seq_range")
    group = ["length", "seq_range"]
    before = Window.orderBy(*group).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(*group)
        .agg(F.count("*").alias("n"))
        .select(*group, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("seq_start"))
    )
    inside = Window.partitionBy(*group).orderBy("doc_id", "start", tie)
    numbered = placed.withColumn("seq_row", F.row_number().over(inside) - 1).join(starts, group)
    sequence = (F.col("seq_start") + F.col("seq_row")).cast("long")
    return numbered.withColumn("sequence_id", sequence).drop("seq_range", "seq_start", "seq_row")
