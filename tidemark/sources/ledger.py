"""Which files a table has taken in, whatever stream brought them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.runtime import Files
from tidemark.sources.runs import NEWEST, RunTable

LEDGER_BUCKET_BYTES = 8 * 2**20
NAMES = "_files"  # inside a committed batch: the names of the files it holds


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps for as long as its checkpoint."""
    return Files(spark).read_json(f"{checkpoint.rstrip('/')}/metadata")["id"]


class FileLedger:
    """File names by hash, in a table of runs: adding a batch's names costs what they are.

    A stream never brings a file twice, but for the batch it was stopped in, and of that the ledger knows the number. So names are
    looked up only for a stream that was not the first, and then only in the buckets they fall into.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.table = RunTable(spark, path, ["file"], NEWEST, bucket_bytes=LEDGER_BUCKET_BYTES)

    def last(self) -> dict[str, int]:
        """The last batch of each stream."""
        return self.table.facts().get("streams", {})

    def has(self, stream: str, batch: int) -> bool:
        return self.last().get(stream, -1) >= batch

    def missing(self, files: DataFrame, stream: str) -> DataFrame:
        """Those of ``files`` (file) that no batch holds."""
        files = files.select("file").distinct()
        if not set(self.last()) - {stream} or self.table.schema() is None:
            return files
        known = self.table.near(files).select("file")
        return files.join(known, "file", "left_anti")

    def add(self, files: DataFrame, stream: str, batch: int) -> None:
        self.table.commit(files.select("file"), facts={"streams": {**self.last(), stream: batch}})

    def catch_up(self, committed: dict[str, tuple[str, int]]) -> None:
        """Take in batches (folder: stream and number) that were committed by a job that ended before it told the ledger."""
        for folder, (stream, batch) in sorted(committed.items(), key=lambda x: x[1]):
            if not self.has(stream, batch):
                self.add(self.spark.read.schema("file string").parquet(f"{folder}/{NAMES}"), stream, batch)


def write_names(files: DataFrame, folder: str) -> None:
    files.select(F.col("file")).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{NAMES}")
