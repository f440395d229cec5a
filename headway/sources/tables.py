"""Reading and writing of tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from headway.sources.payload_files import file_store

# Names of the five source tables.
SILVER_TABLES = ("routes", "trips", "stop_events", "stops", "realtime_stop_events")


def _literal(value: object) -> str:
    """A partition value as SQL; days and texts are quoted."""
    if value is None:
        return "null"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return str(value)
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def _folder_text(value: object) -> str:
    """A partition value as the name of its folder."""
    return "__HIVE_DEFAULT_PARTITION__" if value is None else quote(str(value), safe=" -_.,()@+")


@dataclass(frozen=True)
class Catalog:
    """Maps the table names used here to a catalog schema.

    ``prefix`` is a schema such as ``lake.silver``, or empty for the current
    one. ``fmt`` may name any table format installed on the cluster; one with
    atomic commits keeps appends whole when a driver is lost.
    """

    spark: SparkSession
    prefix: str = ""
    fmt: str = "parquet"

    def name(self, table: str) -> str:
        return f"{self.prefix}.{table}" if self.prefix else table

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def silver(self) -> dict[str, DataFrame]:
        """The five source tables by name; of the history, what its ledger names."""
        from headway.operators.history import read_history

        tables = {table: self.read(table) for table in SILVER_TABLES[:-1]}
        return {**tables, SILVER_TABLES[-1]: read_history(self)}

    def replace(self, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Replace a table with ``df``, its schema included, and read it back."""
        writer = self._writer(df, partition_by).mode("overwrite")
        self._save(writer.option("overwriteSchema", "true"), table)
        return self.read(table)

    def replace_bucketed(
        self,
        df: DataFrame,
        table: str,
        key: str,
        buckets: int,
        after: Callable[[DataFrame], DataFrame] | None = None,
    ) -> DataFrame:
        """Replace a table with ``df`` in buckets of ``key``, one file each, sorted by it.

        Joins on the key read the buckets side by side without a shuffle of the table.
        ``after`` adds columns to the dealt rows; it must leave rows where they are.
        """
        dealt = df.repartition(buckets, key)
        if after is not None:
            dealt = after(dealt)
        writer = dealt.write.format(self.fmt).mode("overwrite").bucketBy(buckets, key).sortBy(key)
        writer.saveAsTable(self.name(table))
        return self.read(table)

    def replace_parts(
        self,
        df: DataFrame,
        table: str,
        partition_by: Sequence[str],
        whole: Sequence[object] | None = None,
    ) -> DataFrame:
        """Replace the partitions that ``df`` has rows for.

        ``whole`` lists values of the one partition column that ``df`` stands for as a
        whole: those of them without a row lose their partition. Which have rows is
        observed while they are written.
        """
        if not self.exists(table):
            return self.replace(df, table, partition_by)
        in_order = df.select(*self.read(table).columns)
        seen = Observation()
        if whole is not None:
            (column,) = partition_by
            in_order = in_order.observe(seen, F.collect_set(column).alias("values"))
        self._save_parts(in_order.hint("rebalance", *partition_by), table, partition_by)
        if whole is not None:
            written = seen.get["values"]
            self.drop_parts(table, [{column: v} for v in whole if v not in written])
        return self.read(table)

    def drop_parts(self, table: str, parts: Sequence[Mapping[str, object]]) -> None:
        """Remove partitions, named by the values of their columns, where they exist."""
        for part in parts:
            where = ", ".join(f"{name} = {_literal(value)}" for name, value in part.items())
            self.spark.sql(f"alter table {self.name(table)} drop if exists partition ({where})")

    def append(self, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
        """Append rows, creating the table on first use."""
        self._save(self._writer(df, partition_by).mode("append"), table)

    def _writer(self, df: DataFrame, partition_by: Sequence[str]) -> DataFrameWriter:
        # The hint gathers a partition value into few, well-sized files; adaptive
        # execution splits a value that is too big for one writing task.
        if not partition_by:
            return df.write.format(self.fmt)
        shaped = df.hint("rebalance", *partition_by)
        return shaped.write.format(self.fmt).partitionBy(*partition_by)

    def _save(self, writer: DataFrameWriter, table: str) -> None:
        # Kept with the table, where later inserts look it up.
        writer.option("partitionOverwriteMode", "dynamic").saveAsTable(self.name(table))

    def _save_parts(self, df: DataFrame, table: str, partition_by: Sequence[str]) -> None:
        # A plain overwrite would drop the table; an insert keeps the other
        # partitions. The table knows its partition columns.
        df.write.mode("overwrite").insertInto(self.name(table))


@dataclass(frozen=True)
class FolderCatalog(Catalog):
    """The same tables as folders below ``prefix``, without a metastore."""

    def name(self, table: str) -> str:
        return f"{self.prefix.rstrip('/')}/{table}"

    def read(self, table: str) -> DataFrame:
        return self.spark.read.format(self.fmt).load(self.name(table))

    def exists(self, table: str) -> bool:
        try:
            return bool(self.read(table).schema)
        except AnalysisException as problem:
            if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return False
            raise

    def _save(self, writer: DataFrameWriter, table: str) -> None:
        writer.save(self.name(table))

    def replace_bucketed(
        self,
        df: DataFrame,
        table: str,
        key: str,
        buckets: int,
        after: Callable[[DataFrame], DataFrame] | None = None,
    ) -> DataFrame:
        # Buckets need a metastore; sorted files still let a scan skip by the key's range.
        shaped = df.repartitionByRange(buckets, key).sortWithinPartitions(key)
        if after is not None:
            shaped = after(shaped)
        shaped.write.format(self.fmt).mode("overwrite").save(self.name(table))
        return self.read(table)

    def drop_parts(self, table: str, parts: Sequence[Mapping[str, object]]) -> None:
        store, root = file_store(self.name(table))
        for part in parts:
            where = "/".join(f"{name}={_folder_text(value)}" for name, value in part.items())
            store.delete_dir_contents(f"{root}/{where}", missing_dir_ok=True)

    def _save_parts(self, df: DataFrame, table: str, partition_by: Sequence[str]) -> None:
        writer = df.write.format(self.fmt).mode("overwrite").partitionBy(*partition_by)
        writer.option("partitionOverwriteMode", "dynamic").save(self.name(table))
