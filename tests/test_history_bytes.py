"""Loads and readers of the history move no more rows than they have to."""

import pytest
from pyspark.sql import functions as F

from headway.operators.history import HISTORY_TABLE, append_new_snapshots, read_history
from headway.registry import queries
from headway.sources.tables import FolderCatalog
from tests.conftest import SMALL
from tests.test_history import DAY_SECONDS, batch, content, expected


@pytest.fixture
def never_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def plan(df):
    return df._jdf.queryExecution().toString()


def test_a_reader_does_not_shuffle_the_history(spark, folder, never_broadcast):
    catalog = FolderCatalog(spark, folder)
    for snapshots in ((0, 60), (60, DAY_SECONDS)):
        append_new_snapshots(batch(spark, *snapshots), catalog)
    rows = read_history(catalog)
    assert content(rows) == expected(0, 60, DAY_SECONDS)
    assert "SortMergeJoin" not in plan(rows)


def test_only_loads_with_known_snapshots_look_rows_up(spark, folder, monkeypatch):
    catalog, written = FolderCatalog(spark, folder), []
    replace = FolderCatalog.replace_parts

    def spied(self, df, *rest):
        written.append("LeftSemi" in plan(df))
        return replace(self, df, *rest)

    monkeypatch.setattr(FolderCatalog, "replace_parts", spied)
    for snapshots in ((0, 60), (120, 180), (180, 240)):
        append_new_snapshots(batch(spark, *snapshots), catalog)
    assert written == [False, False, True]
    assert content(read_history(catalog)) == expected(0, 60, 120, 180, 240)
    assert catalog.read(f"{HISTORY_TABLE}_ledger").filter(F.col("entry") == 2).count() == 1


def test_a_batch_of_several_loads_is_computed_once(spark):
    rows = queries.landed_batch(spark, SMALL)
    wanted = queries.dedupe_observations(queries.scoped_history(spark, SMALL))
    assert rows.exceptAll(wanted).count() == 0 and wanted.count() == rows.count()
    assert "Window" not in plan(rows) and "Join" not in plan(rows)


def test_a_refresh_of_the_connector_reads_a_stored_table(spark, monkeypatch):
    plans, publish = [], queries.publish

    def spied(tables, *rest):
        plans.append(plan(tables["route_reliability"]))
        return publish(tables, *rest)

    monkeypatch.setattr(queries, "publish", spied)
    queries.QUERIES["publish_connector"](spark, SMALL)
    assert len(plans) == 2 and not any("Join" in p for p in plans)
