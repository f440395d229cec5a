"""One row per key, in ways that survive a key with very many rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under ``order``.

    Spark limits each key to its best row before the shuffle, so a key that
    holds a third of the table sends at most one row per input partition.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def keep_last(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """The row with the greatest ``order`` per key."""
    return top_row(df, keys, [F.col(name).desc_nulls_last() for name in order])


def keep_first(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """The row with the smallest ``order`` per key."""
    return top_row(df, keys, [F.col(name).asc_nulls_last() for name in order])
