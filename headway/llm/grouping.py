"""Union-find grouping of links as Spark jobs.

Tasks first shrink their own links to spanning stars with a union-find each. What is left
is contracted in rounds: every node takes its smallest neighbour as parent, parents are
shortened by pointer jumping, and links are renamed to the roots until none is left. All
state is in tables in the shared folder; the driver sees counts only.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.session import new_folder


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _spanning_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's links as (node, smallest node of its group in this task)."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[p]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > 500_000:  # keep the table small: hand on what is known so far
            yield from _links(parent, root)
            parent.clear()
    yield from _links(parent, root)


def _links(parent: dict[int, int], root) -> Iterator[pa.RecordBatch]:
    pairs = [(x, root(x)) for x in list(parent)]
    pairs = [p for p in pairs if p[0] != p[1]]
    for at in range(0, len(pairs), 10_000):
        part = pairs[at : at + 10_000]
        columns = [pa.array(c, pa.int64()) for c in zip(*part, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def group_links(spark: SparkSession, links: DataFrame) -> DataFrame:
    """links (a long, b long) to (node, root), root the smallest node that is reachable.

    Roots themselves have no row.
    """
    current = stored(
        links.filter("a <> b").mapInArrow(_spanning_stars, "a long, b long").distinct(), "links"
    )
    labels = None
    while not current.isEmpty():
        both = current.union(current.select("b", "a"))
        parents = (
            both.groupBy(F.col("a").alias("node"))
            .agg(F.min("b").alias("root"))
            .filter("root < node")
        )
        parents = stored(parents, "parents")
        while True:
            up = parents.select(F.col("node").alias("root"), F.col("root").alias("above"))
            jumped = parents.join(up, "root", "left").select(
                "node", F.coalesce("above", "root").alias("root"), F.col("above").alias("moved")
            )
            jumped = stored(jumped, "parents")
            parents = jumped.select("node", "root")
            if jumped.filter("moved is not null").isEmpty():
                break
        if labels is None:
            labels = parents
        else:
            up = parents.select(F.col("node").alias("root"), F.col("root").alias("above"))
            moved = labels.join(up, "root", "left").select(
                "node", F.coalesce("above", "root").alias("root")
            )
            labels = stored(moved.union(parents), "labels")
        for side in ("a", "b"):
            up = parents.select(F.col("node").alias(side), F.col("root").alias("above"))
            current = current.join(up, side, "left").withColumn(side, F.coalesce("above", side))
            current = current.select("a", "b")
        current = stored(current.filter("a <> b").distinct(), "links")
    if labels is None:
        return spark.createDataFrame([], "node long, root long")
    return labels
