"""Punctuality by hour of the feed, as a stream that closes its hours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headway.functions import is_late, is_on_time
from headway.operators.reliability import DELAY, share_pct
from headway.streaming.history import trigger


def hourly_punctuality(observations: DataFrame, lateness: str = "2 hours") -> DataFrame:
    """Observations, on-time and late shares per hour of the snapshots.

    An hour is given once, when the newest snapshot is ``lateness`` past its end; rows that
    come after that are dropped, and the state holds the open hours only. Rows combine
    before the shuffle, so an hour is one row per task there.
    """
    measured = observations.filter(F.col(DELAY).isNotNull()).withWatermark("feed_timestamp", lateness)
    delay, n = F.col(DELAY), F.count("*")

    def share(rule):
        return share_pct(F.count(F.when(rule, 1)), n)

    hours = measured.groupBy(F.window("feed_timestamp", "1 hour").alias("hour")).agg(
        n.alias("observations"),
        F.sum(delay).alias("delay_seconds"),
        share(is_on_time(delay)).alias("on_time_pct"),
        share(is_late(delay)).alias("over_5_min_late_pct"),
    )
    return hours.select(
        F.col("hour.start").alias("hour_start"),
        "observations",
        F.round(F.col("delay_seconds") / F.col("observations"), 2).alias("avg_arrival_delay_seconds"),
        "on_time_pct",
        "over_5_min_late_pct",
    )


def start_hourly(
    observations: DataFrame,
    folder: str,
    checkpoint: str,
    lateness: str = "2 hours",
    every_seconds: int | None = None,
) -> StreamingQuery:
    """Write the closed hours as files, each hour once."""
    return (
        hourly_punctuality(observations, lateness)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(every_seconds))
        .start()
    )
