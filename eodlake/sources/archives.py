"""Zip archives of CSV files as a data source: one partition an entry, lines streamed out of the decompressor."""

from __future__ import annotations

import contextlib
import io
import uuid
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Lines of one Arrow batch.
LINES = 4096
SCHEMA = pa.schema([("archive", pa.string()), ("entry", pa.string()), ("line", pa.int64()), ("value", pa.string())])


@dataclass
class Entry(InputPartition):
    archive: str
    entry: str

    def __post_init__(self) -> None:
        super().__init__(self.entry)


class ArchiveReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Entry]:
        """The CSV entries of every archive under the path, from the archives' directories alone; empty files and pages of markup have none."""
        store, root = fs.FileSystem.from_uri(self.path)
        found = []
        for info in sorted(store.get_file_info(fs.FileSelector(root, recursive=True)), key=lambda i: i.path):
            if info.type == fs.FileType.File and info.size and info.base_name.lower().endswith(".zip"):
                with store.open_input_file(info.path) as f, contextlib.suppress(zipfile.BadZipFile, pa.ArrowInvalid):
                    found += [Entry(info.path, n) for n in zipfile.ZipFile(f).namelist() if n.lower().endswith(".csv")]
        return found or [Entry("", "")]

    def read(self, partition: Entry) -> Iterator[pa.RecordBatch]:
        if not partition.archive:
            return
        store, _ = fs.FileSystem.from_uri(self.path)
        with store.open_input_file(partition.archive) as f, zipfile.ZipFile(f) as z, z.open(partition.entry) as raw:
            held, n = [], 0
            for line in io.TextIOWrapper(raw, "utf-8-sig", "replace"):
                held.append(line.rstrip("\r\n"))
                if len(held) == LINES:
                    yield self._batch(partition, n, held)
                    held, n = [], n + len(held)
            if held:
                yield self._batch(partition, n, held)

    @staticmethod
    def _batch(p: Entry, first: int, lines: list[str]) -> pa.RecordBatch:
        k = len(lines)
        return pa.RecordBatch.from_arrays([pa.array([p.archive] * k), pa.array([p.entry] * k), pa.array(range(first, first + k), pa.int64()), pa.array(lines)], schema=SCHEMA)


class Archives(DataSource):
    @classmethod
    def name(cls) -> str:
        return "csv_archives"

    def schema(self) -> str:
        return "archive string, entry string, line long, value string"

    def reader(self, schema: object) -> ArchiveReader:
        return ArchiveReader(self.options["path"])


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, value) of all entries, as ``prices.from_lines`` takes them. The path is a folder in any store that Arrow reads."""
    spark.dataSource.register(Archives)
    rows = spark.read.format("csv_archives").option("path", path).load()
    return rows.select(F.concat_ws("/", "archive", "entry").alias("file"), F.col("line").alias("at"), "value")


def writer(root: str, header: str) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Of a group of lines (name, row_a, value) one archive under ``root`` with an entry a name, ``header`` on top of each."""

    def write(rows: pd.DataFrame) -> pd.DataFrame:
        store, folder = fs.FileSystem.from_uri(root)
        store.create_dir(folder, recursive=True)
        path = f"{folder}/{uuid.uuid4().hex}.zip"
        with store.open_output_stream(path) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for name, part in rows.sort_values("row_a").groupby("name"):
                z.writestr(name, "\n".join([header, *part["value"]]) + "\n")
        return pd.DataFrame({"archive": [path]})

    return write
