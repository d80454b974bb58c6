"""One sorted output in several files, with a manifest that says where each key lies.

Every task writes the rows of its range as one CSV file.  When all have, the commit
writes ``manifest.json``: the files in order, each with its first and last key, its rows,
its bytes and where these start in the whole sequence.  A reader of a range of keys opens
only the files that can hold it; put end to end, the files are the single sorted file.
Without a manifest there is no output: a failed attempt leaves none.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import csv, fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "addressable_csv"
MANIFEST = "manifest.json"


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, as executors and driver both see it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


@dataclass
class _Part(WriterCommitMessage):
    """What one task has written."""

    partition: int
    file: str
    rows: int
    bytes: int
    first: list
    last: list


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, keys: list[str], schema: str) -> None:
        self.path, self.keys, self.schema = path, keys, schema

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, folder = _opened(self.path)
        partition = TaskContext.get().partitionId()
        # A name of its own for each attempt: two attempts of a task never write to one file.
        name = f"part-{partition:05d}-{uuid.uuid4().hex}.csv"
        rows, first, last, sink = 0, [], [], None
        for batch in iterator:
            if not batch.num_rows:
                continue
            if sink is None:
                system.create_dir(folder, recursive=True)
                sink = system.open_output_stream(f"{folder}/{name}")
                first = [batch.column(k)[0].as_py() for k in self.keys]
            last = [batch.column(k)[batch.num_rows - 1].as_py() for k in self.keys]
            csv.write_csv(batch, sink, csv.WriteOptions(include_header=False))
            rows += batch.num_rows
        if sink is None:
            return _Part(partition, "", 0, 0, [], [])
        size = sink.tell()
        sink.close()
        return _Part(partition, name, rows, size, first, last)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        files, offset = [], 0
        for part in sorted((m for m in messages if m is not None and m.rows), key=lambda m: m.partition):
            files.append({k: getattr(part, k) for k in ("file", "rows", "bytes", "first", "last")} | {"offset": offset})
            offset += part.bytes
        text = json.dumps({"keys": self.keys, "schema": self.schema, "files": files}, indent=1)
        system, folder = _opened(self.path)
        system.create_dir(folder, recursive=True)
        with system.open_output_stream(f"{folder}/{MANIFEST}.new") as sink:
            sink.write(text.encode())
        system.move(f"{folder}/{MANIFEST}.new", f"{folder}/{MANIFEST}")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        system, folder = _opened(self.path)
        for part in messages:
            if part is not None and part.rows:
                system.delete_file(f"{folder}/{part.file}")


class AddressableCsv(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        return _Writer(self.options["path"], json.loads(self.options["keys"]), ddl)


# Keys are written to the manifest as JSON.
_KEY_TYPES = {"tinyint", "smallint", "int", "bigint", "string", "double", "float", "boolean"}


def write_addressable(df: DataFrame, path: str, keys: list[str]) -> None:
    """Write ``df`` in total order of ``keys`` (nulls first) as CSV files and a manifest.

    ``orderBy`` range-partitions; nothing passes through one task, and only one small
    record a file comes to the driver.  ``path`` must not have a manifest yet.
    Nulls of other columns and empty strings are both written as empty fields.
    """
    kinds = dict(df.dtypes)
    if not keys or any(kinds[k] not in _KEY_TYPES for k in keys):
        raise ValueError(f"keys must be some columns of types {sorted(_KEY_TYPES)}")
    system, folder = _opened(path)
    if system.get_file_info(f"{folder}/{MANIFEST}").type != fs.FileType.NotFound:
        raise FileExistsError(f"{path} has a manifest")
    spark = df.sparkSession
    spark.dataSource.register(AddressableCsv)
    sorted_rows = df.orderBy(*[F.asc_nulls_first(k) for k in keys])
    sorted_rows.write.format(FORMAT).mode("append").option("keys", json.dumps(keys)).save(path)


def read_manifest(spark: SparkSession, path: str) -> dict:
    """The manifest, read through Spark; without one, an error."""
    text = spark.read.text(f"{path.rstrip('/')}/{MANIFEST}", wholetext=True).first()
    return json.loads(text.value)


def _order(key: list | tuple) -> list:
    return [(value is not None, value) for value in key]


def files_of_range(manifest: dict, low: tuple = (), high: tuple = ()) -> list[str]:
    """Files that can hold keys from ``low`` to ``high``, both included; bounds may name the first keys only."""

    def holds(entry: dict) -> bool:
        first, last = (_order(entry[k]) for k in ("first", "last"))
        return last[: len(low)] >= _order(low) and first[: len(high)] <= _order(high)

    return [entry["file"] for entry in manifest["files"] if holds(entry)]


def read_range(spark: SparkSession, path: str, low: tuple = (), high: tuple = ()) -> DataFrame:
    """Rows with keys from ``low`` to ``high``, both included, from the files that can hold them.

    A bound is a tuple of values of the first keys; an empty one is open.
    """
    manifest = read_manifest(spark, path)
    files = [f"{path.rstrip('/')}/{name}" for name in files_of_range(manifest, low, high)]
    if not files:
        return spark.createDataFrame([], manifest["schema"])
    rows = spark.read.schema(manifest["schema"]).csv(files)

    def key(values: tuple) -> tuple[Column, Column]:
        names = manifest["keys"][: len(values)]
        kinds = [rows.schema[n].dataType for n in names]
        return F.struct(*names), F.struct(*[F.lit(v).cast(t).alias(n) for v, t, n in zip(values, kinds, names)])

    if low:
        own, bound = key(low)
        rows = rows.filter(own >= bound)
    if high:
        own, bound = key(high)
        rows = rows.filter(own <= bound)
    return rows
