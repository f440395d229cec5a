"""Payloads as files, byte for byte: a sink for landing folders and archives.

Spark's own writers wrap rows in a file format. This one writes the bytes of ``content``
to the file named by ``file``, below the path of ``save``. Tasks write side by side; a file
gets its name only when it is whole, so a reader never meets a part of one, and a repeated
task writes the same bytes to the same names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import Row, StructType

FORMAT = "payload_files"


def file_store(path: str):
    """The file system of a path, and the path within it."""
    from pyarrow import fs

    plain = path.removeprefix("file:") if path.startswith("file:/") else path
    if "://" in plain:
        return fs.FileSystem.from_uri(plain)
    return fs.LocalFileSystem(), plain


@dataclass
class _Written(WriterCommitMessage):
    files: int


class _PayloadWriter(DataSourceWriter):
    def __init__(self, base: str):
        self.base = base

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        store, root = file_store(self.base)
        made, files = set(), 0
        for row in iterator:
            folder, _, name = f"{root.rstrip('/')}/{row['file']}".rpartition("/")
            if folder not in made:
                store.create_dir(folder, recursive=True)
                made.add(folder)
            # Names with a dot in front are no files to Spark's readers.
            part = f"{folder}/.{name}.{uuid.uuid4().hex}"
            with store.open_output_stream(part) as out:
                out.write(bytes(row["content"]))
            store.move(part, f"{folder}/{name}")
            files += 1
        return _Written(files)


class PayloadFiles(DataSource):
    """``df.write.format("payload_files").mode("append").save(folder)``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "file string, content binary"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("payload files are only added; a name that exists is replaced")
        return _PayloadWriter(self.options["path"])


def write_payload_files(payloads: DataFrame, base: str) -> None:
    """Write rows of ``(file, content)``; a row without content is an empty file."""
    register(payloads.sparkSession)
    rows = payloads.selectExpr("file", "coalesce(content, cast('' as binary)) as content")
    rows.write.format(FORMAT).mode("append").save(base)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PayloadFiles)
