"""Global order without a global sort: contiguous key ranges of bounded number.

A range holds about one task's share of the rows. Only range totals, one row per
range, ever meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.grouping import stored

# At most this many ranges, so that the bounds stay a few kilobytes.
MOST_RANGES = 2048


def with_range(df: DataFrame, key: str, name: str, ranges: int | None = None) -> DataFrame:
    """Add the number of the key range that a row falls in; null keys are in range -1.

    The bounds are approximate quantiles of the key (a long), so every range holds a
    similar number of rows. Equal keys share a range.
    """
    spark = df.sparkSession
    if ranges is None:
        ranges = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(1, min(MOST_RANGES, ranges))
    at = F.array(*(F.lit(i / ranges) for i in range(1, ranges)))
    bounds = []
    if ranges > 1:
        bounds = df.agg(F.percentile_approx(key, at, 20 * ranges).alias("b")).first()["b"] or []
    if not bounds:
        return df.withColumn(name, F.when(F.col(key).isNull(), -1).otherwise(0))
    return df.withColumn(name, _range_of(key, sorted(set(bounds))))


def _range_of(key: str, bounds: list[int]) -> Column:
    """The number of bounds at or below the key, by halving."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col(key) < bounds[middle], search(low, middle)).otherwise(
            search(middle + 1, high)
        )

    if len(bounds) <= 64:
        found = search(0, len(bounds))
    else:
        values = F.array(*(F.lit(int(b)) for b in bounds))
        found = F.size(F.filter(values, lambda b: b <= F.col(key)))
    return F.when(F.col(key).isNull(), -1).otherwise(found).cast("int")


def range_starts(totals: DataFrame, range_name: str, total: str, start: str) -> DataFrame:
    """For one row per range: the sum of the totals of all ranges before it."""
    before = Window.orderBy(range_name).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        range_name, F.coalesce(F.sum(total).over(before), F.lit(0)).cast("long").alias(start)
    )


# Rows of one range where rows are numbered: they are sorted within a task and may spill.
_RANGE_ROWS = 1_000_000


def with_position(
    df: DataFrame, group: list[str], order: list[Column], place: str, total: str | None = None
) -> DataFrame:
    """Number the rows of each group from 0 in the given order; rows that tie, in any order.

    `group` names columns without nulls. Rows are dealt to ranges of (group, order), as many
    as their number asks for, and sorted there; a last key that no two rows share lets ranges
    cut through ties. A row's place is its place in its range and the number of the group's
    rows in the ranges before, for which a row per range and group is all that meets.
    `total` adds the number of the group's rows.
    """
    spark = df.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // _RANGE_ROWS))
    keys = [*(F.col(g) for g in group), *order, F.col("order_tie")]
    dealt = (
        df.withColumn("order_tie", F.monotonically_increasing_id())
        .repartitionByRange(ranges, *keys)
        .sortWithinPartitions(*keys)
        .drop("order_tie")
        .withColumn("order_own", F.monotonically_increasing_id())
    )
    # The numbers of rows are those of the range and of the row in it.
    dealt = stored(dealt, "ordered").withColumns(
        {
            "order_range": F.shiftright("order_own", 33),
            "order_row": F.col("order_own").bitwiseAND((1 << 33) - 1),
        }
    )
    sizes = dealt.groupBy(*group, "order_range").agg(
        F.count("*").alias("order_size"), F.min("order_row").alias("order_first")
    )
    before = Window.partitionBy(*group).orderBy("order_range")
    earlier = F.coalesce(
        F.sum("order_size").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    added = {"order_start": earlier - F.col("order_first")}
    if total:
        added[total] = F.sum("order_size").over(Window.partitionBy(*group))
    starts = sizes.withColumns(added).drop("order_size", "order_first")
    found = dealt.join(stored(starts, "starts"), [*group, "order_range"])
    last = [F.col(total)] if total else []
    return found.select(*df.columns, (F.col("order_start") + F.col("order_row")).alias(place), *last)
