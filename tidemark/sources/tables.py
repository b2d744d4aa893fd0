"""Keyed parquet tables whose cells are rewritten one generation at a time.

A cell is the unit of rewrite: a bucket of key hashes, optionally split further by a period
column, so that a key with much history rewrites only its recent part. A commit names the
generation of every cell; readers follow the newest commit, so a batch shows as a whole or
not at all. A generation left behind by a lost job is named by no commit and overwritten.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.runtime import Files, materialize

CELL = "_cell"
OPEN = "open"


def ensure_table(spark: SparkSession, path: str, schema: T.StructType | str) -> None:
    """Write an empty table of that schema when the path has no data."""
    if not Files(spark).has_data(path):
        spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(path)


def truncate(spark: SparkSession, path: str) -> None:
    """Remove all rows, keeping the schema."""
    schema = spark.read.parquet(path).schema
    spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(path)


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder name for NULL


def replace_partitions(df: DataFrame, path: str, by: str, emptied: Sequence[str | None] = ()) -> None:
    """Overwrite the partitions ``df`` holds; drop those in ``emptied`` (None for NULL) that it does not."""
    df = materialize(df, "partitions")
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(path)
    )
    if not emptied:
        return
    filled = {r[0] for r in df.select(F.col(by).cast("string")).distinct().collect()}
    gone, files = set(emptied) - filled, Files(df.sparkSession)
    for name in files.list(path):
        if name.startswith(f"{by}="):
            value = unquote(name.split("=", 1)[1])  # folders bear special characters as %XX
            if (None if value == NO_VALUE else value) in gone:
                files.delete(f"{path}/{name}")


class KeyedTable:
    """A table addressed by key, kept as cells."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        buckets: int = 64,
        period: str | None = None,
        period_format: str = "yyyyMM",
    ):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.buckets, self.period, self.period_format = buckets, period, period_format
        self.files = Files(spark)

    # --- cells ---

    def cell(self) -> Column:
        """Cell of a row: bucket, then the period of its time column (``open`` where NULL)."""
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("string")
        if not self.period:
            return bucket
        return F.concat_ws("-", bucket, F.coalesce(F.date_format(self.period, self.period_format), F.lit(OPEN)))

    def with_cell(self, df: DataFrame) -> DataFrame:
        return df.withColumn(CELL, self.cell())

    def cells_of(self, *frames: DataFrame) -> list[str]:
        """Cells that rows of these frames fall into: at most buckets times periods names."""
        found = None
        for df in frames:
            part = self.with_cell(df).select(CELL)
            found = part if found is None else found.unionByName(part)
        return sorted(r[0] for r in found.distinct().collect())

    # --- commits ---

    def _commits(self) -> list[str]:
        return [n for n in self.files.list(f"{self.path}/_commits") if n.endswith(".json") and not n.startswith(".")]

    def _head(self) -> dict | None:
        return self.files.latest(f"{self.path}/_commits")

    def version(self) -> int:
        """Number of the newest commit; -1 before the first."""
        names = self._commits()
        return int(names[-1].removesuffix(".json")) if names else -1

    def schema(self) -> T.StructType | None:
        head = self._head()
        return T.StructType.fromJson(head["schema"]) if head else None

    # --- reading and writing ---

    def read(self, cells: Sequence[str] | None = None, schema: T.StructType | None = None) -> DataFrame:
        """All rows, or those of some cells; unknown cells are empty."""
        head = self._head()
        schema = schema or (T.StructType.fromJson(head["schema"]) if head else None)
        if schema is None:
            raise FileNotFoundError(f"{self.path} has no commit and no schema was given")
        current = head["cells"] if head else {}
        wanted = sorted(current) if cells is None else [c for c in cells if c in current]
        paths = [f"{self.path}/{current[c]}/{CELL}={c}" for c in wanted]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def known_cells(self) -> list[str]:
        head = self._head()
        return sorted(head["cells"]) if head else []

    def _write(self, rows: DataFrame, path: str) -> None:
        """Files by cell: small cells share a task, a large cell is split over several."""
        tagged = self.with_cell(rows)
        tagged.hint("rebalance", F.col(CELL)).write.mode("overwrite").partitionBy(CELL).parquet(path)

    def replace(self, rows: DataFrame, cells: Sequence[str]) -> int:
        """Commit ``rows`` as the content of ``cells`` and of cells that did not exist, all at once."""
        head = self._head() or {"cells": {}}
        version = self.version() + 1
        generation = f"gen={version}"
        self._write(rows, f"{self.path}/{generation}")
        names = self.files.list(f"{self.path}/{generation}")
        written = {n.split("=", 1)[1] for n in names if n.startswith(f"{CELL}=")}
        current = {c: g for c, g in head["cells"].items() if c not in set(cells)}
        clash = written & set(current)
        if clash:
            raise ValueError(f"rows fall into cells that were not given for replacement: {sorted(clash)[:5]}")
        current.update({c: generation for c in written})
        commit = {"cells": current, "schema": rows.schema.jsonValue()}
        self.files.supersede(f"{self.path}/_commits", commit)
        return version

    # --- a log of batches beside the table ---

    def append(self, rows: DataFrame, generation: int) -> None:
        """Add rows to the log as one generation; writing it again replaces it."""
        self._write(rows, f"{self.path}/log/gen={generation}")

    def read_log(
        self, schema: T.StructType, cells: Sequence[str] | None = None, generation: int | None = None
    ) -> DataFrame:
        """Rows added by ``append``: all, those of some cells or those of one generation."""
        where = f"{self.path}/log" if generation is None else f"{self.path}/log/gen={generation}"
        if not self.files.has_data(where):
            return self.spark.createDataFrame([], schema)
        parts = [T.StructField("gen", T.LongType())] if generation is None else []
        wide = T.StructType([*schema.fields, *parts, T.StructField(CELL, T.StringType())])
        log = self.spark.read.schema(wide).parquet(where)
        if cells is not None:
            log = log.filter(F.col(CELL).isin(*cells))
        return log.select(*[f"`{f.name}`" for f in schema.fields])

    def expire(self, keep: int = 2) -> None:
        """Drop commits but the newest ``keep`` and the generations that none of them names."""
        names = self._commits()
        live = set()
        for n in names[-keep:]:
            live |= set(self.files.read_json(f"{self.path}/_commits/{n}")["cells"].values())
        for n in names[:-keep]:
            self.files.delete(f"{self.path}/_commits/{n}")
        for n in self.files.list(self.path):
            if n.startswith("gen=") and n not in live:
                self.files.delete(f"{self.path}/{n}")
