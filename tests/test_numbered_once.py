"""Text ids of the timetable are looked up once, whatever is made of its files."""

from headway.plans import jobs
from headway.registry import tables as t
from headway.sources import FolderCatalog
from tests.conftest import SMALL


def test_numbered_files_feed_all_tables(spark, folder):
    for name, df in t.raw_timetable(spark, SMALL).items():
        rows = t.with_text_ids(df).limit(40)
        rows.write.option("header", True).csv(f"{folder}/gtfs/{name}.txt")
    catalog = FolderCatalog(spark, f"{folder}/lake")
    jobs.run_static(spark, f"{folder}/gtfs", catalog, ["A2", "3"], text_ids=True)
    stop_times = catalog.read(f"{jobs.NUMBERED}stop_times")
    assert dict(stop_times.dtypes)["trip_id"] == "bigint"
    assert stop_times.count() == 40 and stop_times.filter("trip_id is null").count() == 0
    assert catalog.read(jobs.TRIP_STOPS).select("trip_id").exceptAll(
        stop_times.select("trip_id")
    ).count() == 0
