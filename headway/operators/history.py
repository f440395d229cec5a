"""Deduplicated, idempotent history of stop observations.

The history consists of loads. A load writes its rows to partitions of its own and then
enters its snapshots in the ledger, one small file; only what the ledger names is part of the
history. A load that was lost in between left rows that nobody reads, and its retry, which
brings the same snapshots, has the same name and writes over them. Compaction copies the
rows of many loads to one new load and enters that; the last entry of a snapshot counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.functions import utc_date
from headway.operators.picking import top_row
from headway.sources.tables import Catalog

HISTORY_TABLE = "realtime_stop_events"
OBSERVATION_KEY = ("feed_timestamp", "trip_id", "stop_sequence")
# The history is laid out by the day of the snapshot, so a reader of some days opens
# their folders only, and below it by load.
HISTORY_PARTITION = "feed_date"
_LAYOUT = [HISTORY_PARTITION, "load"]


def dedupe_observations(observations: DataFrame) -> DataFrame:
    """One row per snapshot, trip and sequence; a missing sequence is one key.

    Which copy stays is fixed by the remaining columns, so a re-run or another
    input order gives the same rows.
    """
    rest = [name for name in observations.columns if name not in OBSERVATION_KEY]
    return top_row(observations, OBSERVATION_KEY, [F.col(name).asc_nulls_last() for name in rest])


def with_feed_date(observations: DataFrame) -> DataFrame:
    """UTC day of the snapshot, whatever the session's time zone."""
    return observations.withColumn(HISTORY_PARTITION, utc_date(F.col("feed_timestamp")))


def ledger_name(table: str = HISTORY_TABLE) -> str:
    return f"{table}_ledger"


def read_ledger(catalog: Catalog, table: str = HISTORY_TABLE) -> DataFrame:
    """Each finished snapshot with the load that holds it, its rows and NULLs by column."""
    entries = catalog.read(ledger_name(table))
    newest = Window.partitionBy("feed_timestamp").orderBy(F.desc("entry"))
    return entries.withColumn("_place", F.row_number().over(newest)).filter("_place = 1").drop("_place")


def read_history(catalog: Catalog, table: str = HISTORY_TABLE) -> DataFrame:
    """The rows of finished loads. Names of partitions decide, so others are not opened.

    The finished ones are as many as the table has folders, which the driver lists anyway, so
    it is given their names; a join could cost a shuffle of the whole history.
    """

    def part(day: Column) -> Column:
        return F.concat_ws("/", day.cast("string"), F.col("load"))

    finished = read_ledger(catalog, table).select(part(F.col(HISTORY_PARTITION)).alias("part")).distinct()
    names = [row["part"] for row in finished.collect()]
    return catalog.read(table).filter(part(F.col(HISTORY_PARTITION)).isin(names)).drop("load")


def history_exists(catalog: Catalog, table: str = HISTORY_TABLE) -> bool:
    """Whether a load was ever finished."""
    return catalog.exists(ledger_name(table))


def _load_name(snapshots: DataFrame, prefix: str) -> str | None:
    """A name that the same snapshots always get; None without snapshots."""
    seen = snapshots.agg(
        F.count("*").alias("n"),
        *[F.bit_xor(F.xxhash64(F.lit(seed), "feed_timestamp")).alias(seed) for seed in ("a", "b")],
    ).first()
    if not seen["n"]:
        return None
    return f"{prefix}{seen['a'] % 2**64:016x}{seen['b'] % 2**64:016x}"


def _enter(catalog: Catalog, table: str, load: str) -> None:
    """Make a load part of the history: one file, which is there or is not.

    What is entered is what the load's own partitions hold by now: its snapshots, and of
    each the number of rows and of NULLs by column.
    """
    name = ledger_name(table)
    written = catalog.read(table).filter(F.col("load") == load)
    columns = [c for c in written.columns if c not in ("feed_timestamp", *_LAYOUT)]
    nulls = F.array(*[F.count_if(F.col(c).isNull()) for c in columns])
    counted = written.groupBy("feed_timestamp", HISTORY_PARTITION).agg(
        F.count("*").alias("rows"), nulls.alias("nulls")
    )
    # All tasks count; one writes what they have counted.
    snapshots = counted.repartition(1).withColumn(
        "nulls", F.map_from_arrays(F.array(*map(F.lit, columns)), "nulls")
    )
    last = None
    if catalog.exists(name):
        last = catalog.read(name).agg(F.max("entry")).first()[0]
    entry = F.lit(0 if last is None else last + 1).cast("long").alias("entry")
    rows = snapshots.select("*", F.lit(load).alias("load"), entry)
    catalog.append(rows, name)


def unseen_snapshots(batch: DataFrame, finished: DataFrame) -> DataFrame:
    """Times and days of the snapshots in ``batch`` that ``finished`` does not name.

    Only distinct snapshot times of both sides meet, so the size of a snapshot
    does not matter.
    """
    arrived = batch.select("feed_timestamp", HISTORY_PARTITION).distinct()
    return arrived.join(finished.select("feed_timestamp").distinct(), "feed_timestamp", "left_anti")


def append_new_snapshots(
    batch: DataFrame, catalog: Catalog, table: str = HISTORY_TABLE
) -> str | None:
    """Append the snapshots that are not in the history yet; returns the load's name.

    The batch may hold any number of snapshots, of any age. It is read for its snapshot
    times and for its rows, so it is held on disk meanwhile; a lost executor recomputes its
    part. Of what is there already only the ledger is read. One job appends at a time.
    """
    dated = with_feed_date(batch.filter("feed_timestamp is not null"))
    dated = dated.persist(StorageLevel.DISK_ONLY)
    try:
        arrived = fresh = dated.select("feed_timestamp", HISTORY_PARTITION).distinct()
        known = history_exists(catalog, table)
        if known:
            fresh = unseen_snapshots(dated, read_ledger(catalog, table))
        load = _load_name(fresh, "load-")
        if load is None:
            return None
        rows = dated
        # Where every snapshot is new, the rows need not be looked up.
        if known and _load_name(arrived, "load-") != load:
            rows = dated.join(fresh.select("feed_timestamp"), "feed_timestamp", "left_semi")
        catalog.replace_parts(rows.withColumn("load", F.lit(load)), table, _LAYOUT)
    finally:
        dated.unpersist()
    _enter(catalog, table, load)
    return load


def compact_history(
    catalog: Catalog, before: str, table: str = HISTORY_TABLE, most_loads: int = 1
) -> str | None:
    """Rewrite the days before ``before`` (a date) that lie in more than ``most_loads`` loads.

    Their rows become one load, whose files have the size of the session's partitions.
    Readers keep seeing the old loads until the new one is entered, and appends beside it
    write other loads and other snapshots. What was replaced stays for running readers until
    :func:`drop_unread` is called.
    """
    ledger = read_ledger(catalog, table).filter(F.col(HISTORY_PARTITION) < F.lit(before).cast("date"))
    scattered = (
        ledger.groupBy(HISTORY_PARTITION)
        .agg(F.count_distinct("load").alias("loads"))
        .filter(F.col("loads") > most_loads)
    )
    snapshots = ledger.join(scattered, HISTORY_PARTITION, "left_semi")
    load = _load_name(snapshots, "compact-")
    if load is None:
        return None
    # Of a load that was entered, only the snapshots that it still holds are taken.
    held = snapshots.select("feed_timestamp", *_LAYOUT)
    rows = catalog.read(table).join(held, ["feed_timestamp", *_LAYOUT], "left_semi")
    catalog.replace_parts(rows.withColumn("load", F.lit(load)), table, _LAYOUT)
    _enter(catalog, table, load)
    return load


def unread_parts(catalog: Catalog, table: str = HISTORY_TABLE) -> DataFrame:
    """Partitions that no snapshot of the ledger is read from."""
    there = catalog.read(table).select(*_LAYOUT).distinct()
    return there.join(read_ledger(catalog, table).select(*_LAYOUT).distinct(), _LAYOUT, "left_anti")


def drop_unread(catalog: Catalog, table: str = HISTORY_TABLE) -> Sequence[dict]:
    """Remove replaced and lost loads. Not beside an append or a reader of replaced loads.

    The list that comes to the driver is one of folders, as many as were replaced or lost
    since the last call.
    """
    parts = [row.asDict() for row in unread_parts(catalog, table).collect()]
    catalog.drop_parts(table, parts)
    return parts
