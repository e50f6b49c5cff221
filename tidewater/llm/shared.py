"""Intermediate tables and files in the shared folder.

Tables are written as Parquet below ``spark.checkpoint.dir`` and read again,
so that a lost executor costs a read and never a recomputation. Files in a
format of our own are written by tasks through ``pyarrow.fs``: to a name of
the attempt first and then moved to the final name, so a retried or
speculative task leaves one whole file.
"""

from __future__ import annotations

import ctypes
import uuid
from contextlib import suppress

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

from tidewater.session import arrow_uri, shared_path


#: Folders made by this driver and not deleted yet.
_made: list[str] = []


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    _made.append(shared_path(spark, f"llm/{name}-{uuid.uuid4().hex[:12]}"))
    return _made[-1]


def saved(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    schema = df.schema
    return spark.read.schema(schema).parquet(path)


def drop_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    if folder in _made:
        _made.remove(folder)


def drop(*tables: DataFrame) -> None:
    """Delete saved tables that no later plan reads."""
    for df in tables:
        for file in df.inputFiles()[:1]:
            for folder in [f for f in _made if f"/{f.rsplit('/', 1)[-1]}/" in file]:
                drop_folder(df.sparkSession, folder)


class Leftovers:
    """Folders made while a function built its result, to be deleted once the
    caller has written that result."""

    def __init__(self):
        self.folders: list[str] = []

    def release(self, spark: SparkSession) -> None:
        for folder in self.folders:
            drop_folder(spark, folder)
        self.folders = []

    def __enter__(self) -> None:
        self.before = set(_made)

    def __exit__(self, *_) -> None:
        self.folders += [f for f in _made if f not in self.before]


def trim() -> None:
    """Give freed memory back at the end of a task; an idle worker then holds
    little besides its caches."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # only where the C library can
        ctypes.CDLL(None).malloc_trim(0)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a Hadoop URI and the path inside it."""
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri.removeprefix("file:")
    if uri.startswith("file://"):
        return pafs.LocalFileSystem(), uri.removeprefix("file://")
    return pafs.FileSystem.from_uri(arrow_uri(uri))


class NewFile:
    """Output stream that appears under its final name only when closed well."""

    def __init__(self, uri: str):
        self.fs, self.path = filesystem(uri)
        self.fs.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.temp = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.out = self.fs.open_output_stream(self.temp, compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def __enter__(self) -> NewFile:
        return self

    def __exit__(self, kind, value, trace) -> None:
        self.out.close()
        if kind is None:
            self.fs.move(self.temp, self.path)
        else:
            self.fs.delete_file(self.temp)


def open_file(uri: str):
    """Random-access input file (seek and read)."""
    fs, path = filesystem(uri)
    return fs.open_input_file(path)
