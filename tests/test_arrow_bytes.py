"""Payloads reach Python in batches of bounded size, however many a task has."""

import pyarrow as pa
from pyspark.sql import functions as F

from headway.session import configure


def test_big_payloads_come_few_at_a_time(spark):
    payloads = configure(spark).range(0, 40, 1, 1).select(
        F.expr("cast(repeat('x', 1000000) as binary)").alias("content")
    )

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"size": pa.array([b.nbytes], pa.int64())})

    found = [r["size"] for r in payloads.mapInArrow(sizes, "size long").collect()]
    assert sum(found) >= 40_000_000 and max(found) < 12_000_000
