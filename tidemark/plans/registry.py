"""Named queries over a directory of tables, each with the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.runtime import materialize, pin_utc, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


@dataclass(frozen=True)
class Tables:
    """The tables of one directory by name, and scratch space for queries that write."""

    spark: SparkSession
    folder: str

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def scratch(self, purpose: str) -> str:
        return scratch_path(self.spark, purpose)

    def keep(self, df: DataFrame, purpose: str) -> DataFrame:
        return materialize(df, purpose)


def query(name: str, sql: str | None = None, decimals: Sequence[str] = (), days: Sequence[str] = ()):
    """Register ``fn(tables) -> DataFrame`` under a name, with its SQL.

    Values are computed as decimals and dates. Only the output shows ``decimals`` as doubles and
    ``days`` as text, on both sides, since clients render those two types differently.
    """
    shown = {**dict.fromkeys(decimals, ("double", "DOUBLE")), **dict.fromkeys(days, ("string", "VARCHAR"))}

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            pin_utc(spark)
            df = fn(Tables(spark, folder))
            return df.withColumns({c: F.col(c).cast(t) for c, (t, _) in shown.items()}) if shown else df

        QUERIES[name] = run
        if sql is not None:
            casts = ", ".join(f"CAST({c} AS {t}) AS {c}" for c, (_, t) in shown.items())
            SQL[name] = f"SELECT * REPLACE ({casts}) FROM ({sql})" if shown else sql
        return fn

    return register
