"""What several operators share: batch sizes, scratch tables, files that tasks write."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql import types as T

import tidemark

from tidemark.runtime import materialize, scratch_path

BATCH_BYTES = 16 * 2**20  # of one Arrow batch sent to a Python worker
BATCH_ROWS = 2_000

_SHIPPED: set[str] = set()

__all__ = ["bounded_batches", "materialize", "scratch_path", "rows_of_bytes", "open_store", "unique_name"]


def ship_package(spark: SparkSession) -> None:
    """Give executors this package, once for each application, as ``--py-files`` would."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(tidemark.__file__)
    archive = os.path.join(tempfile.mkdtemp(), "tidemark.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def lean_disk(spark: SparkSession) -> None:
    """Shuffle files go when the query that made them ends; operators read written tables from then on."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def bounded_batches(spark: SparkSession) -> None:
    """Ready for Python tasks: Arrow batches stay small whatever the texts' length, and workers find this package."""
    ship_package(spark)
    lean_disk(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def rows_of_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 of a string column, null as empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path behind a folder that all executors share (file, hdfs, s3, gs, abfs)."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def unique_name(stem: str, suffix: str) -> str:
    """A file name that no other attempt of the same task uses.

    A task may run twice; only the names in the committed output of its stage count.
    """
    return f"{stem}-{uuid.uuid4().hex}{suffix}"


def nullable(kind: T.DataType) -> T.DataType:
    """The type with every field and element nullable, as Python results come back."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType), True) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(nullable(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(nullable(kind.keyType), nullable(kind.valueType), True)
    return kind
