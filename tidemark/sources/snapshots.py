"""The state behind a source that is only seen as snapshots, and what changes from one to the next.

Beside its rows the table keeps a digest for each bucket of key hashes, which does not depend on the rows' order. A new
snapshot is digested alike; only buckets whose digests differ are read and joined, so an unchanged part of the
table costs one narrow aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.changes import AFTER, BEFORE, CHANGE, CHANGED, DELETE, VERSION, snapshot_diff
from tidemark.operators.merge import widen
from tidemark.runtime import Files, materialize
from tidemark.sources.runs import BUCKET_BYTES, GONE, NEWEST, RunTable

ROWS_PER_DIGEST = 32  # about; more make fewer digests, of which a change spoils a larger share
MOST_BITS = 40
BUCKET = "_digest"


class SnapshotTable:
    """Rows by key as of the last snapshot taken, kept in a table of runs."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], bucket_bytes: int = BUCKET_BYTES):
        self.spark, self.path, self.keys, self.files = spark, path.rstrip("/"), list(keys), Files(spark)
        self.rows = RunTable(spark, f"{self.path}/rows", keys, NEWEST, bucket_bytes=bucket_bytes)

    def read(self) -> DataFrame:
        return self.rows.read()

    def schema(self):
        return self.rows.schema()

    def version(self) -> int:
        return self.rows.version()

    def bucket(self, bits: int) -> Column:
        """The first bits of the hash that also places rows in runs."""
        return F.shiftrightunsigned(F.xxhash64(*[F.col(k) for k in self.keys]), 64 - bits)

    def digests(self, df: DataFrame, columns: Sequence[str], bits: int) -> DataFrame:
        """(bucket, rows, two digests): equal, but for chance of 2**-128, exactly where a bucket's rows are."""
        cells = [x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
        return df.groupBy(self.bucket(bits).alias(BUCKET)).agg(
            F.count(F.lit(1)).alias("n"),
            F.bit_xor(F.xxhash64(F.lit(1), *cells)).alias("d1"),
            F.bit_xor(F.xxhash64(F.lit(2), *cells)).alias("d2"),
        )

    def changes(self, snapshot: DataFrame, version: int | None = None) -> tuple[DataFrame, DataFrame, int]:
        """(what changes as ``snapshot_diff`` tells it, the snapshot's digests, their bits)."""
        version = self.version() + 1 if version is None else version
        facts, held = self.rows.facts(), self.schema()
        if held is None:
            rows = snapshot.count()
            bits = min(MOST_BITS, max(1, (max(rows, 1) // ROWS_PER_DIGEST).bit_length()))
            old = snapshot.limit(0)
            return snapshot_diff(old, snapshot, self.keys, version), self._stored(snapshot, snapshot.columns, bits), bits
        bits = facts["bits"]
        columns = [*held.names, *[c for c in snapshot.columns if c not in held.names]]
        wide = widen(snapshot, self.spark.createDataFrame([], held)).select(*columns)
        fresh = self._stored(wide, columns, bits)
        if set(columns) != set(facts["columns"]):  # digests of other columns say nothing
            return snapshot_diff(self.read(), snapshot, self.keys, version), fresh, bits
        before = self.spark.read.parquet(f"{self.path}/digests/{facts['digests']}")
        apart = fresh.join(before.toDF(BUCKET, "_n", "_d1", "_d2"), BUCKET, "full_outer")
        same = F.col("n").eqNullSafe(F.col("_n")) & F.col("d1").eqNullSafe(F.col("_d1")) & F.col("d2").eqNullSafe(F.col("_d2"))
        spoiled = materialize(apart.filter(~same).select(BUCKET), "changed-buckets")
        old = self.rows.in_buckets(spoiled, self.bucket(bits), BUCKET, bits)
        new = wide.withColumn(BUCKET, self.bucket(bits)).join(spoiled, BUCKET, "left_semi").drop(BUCKET)
        return snapshot_diff(widen(old, wide).select(*columns), new, self.keys, version), fresh, bits

    def _stored(self, df: DataFrame, columns: Sequence[str], bits: int) -> DataFrame:
        name = f"{self.version() + 1:08d}"
        self.digests(df, sorted(columns), bits).write.mode("overwrite").parquet(f"{self.path}/digests/{name}")
        return self.spark.read.parquet(f"{self.path}/digests/{name}")

    def sync(self, snapshot: DataFrame, feed: str) -> None:
        """Take a snapshot: its changes go to ``feed`` as ``version=<n>``, then into the table. Doing so again adds no change."""
        version = self.version() + 1
        found, _, bits = self.changes(snapshot, version)
        path = f"{feed}/version={version}"
        found.write.mode("overwrite").parquet(path)
        found = self.spark.read.schema(found.schema).parquet(path)
        gone = F.col(CHANGE) == DELETE
        rows = found.filter(F.col(CHANGE) != BEFORE).withColumn(GONE, gone).drop(CHANGE, VERSION, CHANGED)
        columns = sorted({*(self.schema().names if self.schema() else []), *snapshot.columns})
        self.rows.commit(rows, facts={"bits": bits, "digests": f"{version:08d}", "columns": columns})
        for name in self.files.list(f"{self.path}/digests"):
            if name < f"{version:08d}":
                self.files.delete(f"{self.path}/digests/{name}")
