"""A stored table of which ranges of one column are replaced, reading only the parts that such a range cuts through."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.merge import widen
from tidemark.runtime import Files, materialize
from tidemark.sources.tables import NO_VALUE

KEPT_COMMITS = 4
PART = "_part"
IN, OUT, CUT = "in", "out", "cut"


class PartTable:
    """Rows in parts, each a folder; the commit holds every part's least and greatest value of ``column`` and its NULLs.

    ``split`` is a SQL expression that tells rows of different parts apart, such as the month of ``column``; it only decides how much
    a replacement must read, and may be NULL or hold any character. Ranges are half open, either end may be None; a NULL lies in no
    range. A replacement is one commit: readers see it as a whole or not at all, and one that failed leaves
    folders that no commit names.
    """

    def __init__(self, spark: SparkSession, path: str, column: str, split: str):
        self.spark, self.path, self.column, self.split = spark, path.rstrip("/"), column, split
        self.files = Files(spark)

    def _head(self) -> dict:
        return self.files.latest(f"{self.path}/_commits") or {"version": -1, "parts": [], "schema": None}

    def schema(self) -> T.StructType | None:
        held = self._head()["schema"]
        return T.StructType.fromJson(held) if held else None

    def parts(self) -> list[dict]:
        """Folder, least, greatest (as text), NULLs and rows of each part."""
        return self._head()["parts"]

    # --- reading ---

    def _read(self, parts: Sequence[dict], schema: T.StructType) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{p['folder']}" for p in parts])

    def read(self, low=None, high=None) -> DataFrame:
        """All rows, or those of a range, for which only parts that reach into it are read."""
        head, schema = self._head(), self.schema()
        if schema is None:
            raise FileNotFoundError(f"{self.path} has no commit")
        if low is None and high is None:
            return self._read(head["parts"], schema)
        placed = self._placed(head["parts"], schema[self.column].dataType, low, high)
        return self._read([p for p, where in zip(head["parts"], placed) if where != OUT], schema).filter(self._within(low, high))

    def _within(self, low, high, value: Column | None = None) -> Column:
        value = F.col(self.column) if value is None else value
        inside = value.isNotNull()
        if low is not None:
            inside = inside & (value >= F.lit(low))
        if high is not None:
            inside = inside & (value < F.lit(high))
        return F.coalesce(inside, F.lit(False))

    def _placed(self, parts: Sequence[dict], kind: T.DataType, low, high) -> list[str]:
        """For each part whether all, none or some of its rows lie in the range; told from the commit alone."""
        if not parts:
            return []
        rows = [(i, p["low"], p["high"], p["nulls"], p["rows"]) for i, p in enumerate(parts)]
        stats = self.spark.createDataFrame(rows, "i int, low string, high string, nulls long, rows long")
        least, most = F.col("low").cast(kind), F.col("high").cast(kind)
        below = F.lit(False) if low is None else most < F.lit(low)
        above = F.lit(False) if high is None else least >= F.lit(high)
        whole = self._within(low, high, least) & self._within(low, high, most) & (F.col("nulls") == 0)
        none = F.col("low").isNull() | below | above
        told = stats.select("i", F.when(none, OUT).when(whole, IN).otherwise(CUT).alias("where"))
        return [r.where for r in sorted(told.collect(), key=lambda r: r.i)]

    # --- writing ---

    def _write(self, rows: DataFrame, version: int) -> list[dict]:
        folder = f"gen={version}"
        tagged = rows.withColumn(PART, F.expr(self.split).cast("string"))
        tagged.hint("rebalance", F.col(PART)).write.mode("overwrite").partitionBy(PART).parquet(f"{self.path}/{folder}")
        schema = T.StructType([*rows.schema.fields, T.StructField(PART, T.StringType())])
        stored = self.spark.read.schema(schema).parquet(f"{self.path}/{folder}")
        c = F.col(self.column)
        stats = stored.groupBy(PART).agg(
            F.min(c).cast("string").alias("low"),
            F.max(c).cast("string").alias("high"),
            F.count_if(c.isNull()).alias("nulls"),
            F.count(F.lit(1)).alias("rows"),
        )
        by = {r[PART]: r for r in stats.collect()}  # a row for each part
        parts = []
        for name in self.files.list(f"{self.path}/{folder}"):
            if not name.startswith(f"{PART}="):
                continue
            value = unquote(name.split("=", 1)[1])
            r = by.get(None if value == NO_VALUE else value)
            if r is not None:
                parts.append({"folder": f"{folder}/{name}", "low": r.low, "high": r.high, "nulls": r.nulls, "rows": r.rows})
        return parts

    def _commit(self, parts: Sequence[dict], schema: T.StructType, version: int) -> int:
        self.files.supersede(f"{self.path}/_commits", {"version": version, "parts": list(parts), "schema": schema.jsonValue()})
        names = [n for n in self.files.list(f"{self.path}/_commits") if n.endswith(".json") and not n.startswith(".")]
        live = set()
        for n in names[-KEPT_COMMITS:]:
            live |= {p["folder"] for p in self.files.read_json(f"{self.path}/_commits/{n}")["parts"]}
        for n in names[:-KEPT_COMMITS]:
            self.files.delete(f"{self.path}/_commits/{n}")
        for gen in self.files.list(self.path):
            if gen.startswith("gen="):
                held = [n for n in self.files.list(f"{self.path}/{gen}") if n.startswith(f"{PART}=")]
                for n in held:
                    if f"{gen}/{n}" not in live:
                        self.files.delete(f"{self.path}/{gen}/{n}")
                if not any(f"{gen}/{n}" in live for n in held):
                    self.files.delete(f"{self.path}/{gen}")
        return version

    def append(self, rows: DataFrame) -> int:
        head = self._head()
        version = head["version"] + 1
        held = self.schema()
        if held:
            rows = widen(rows, self.spark.createDataFrame([], held))
            rows = rows.select(*held.names, *[c for c in rows.columns if c not in held.names])
        return self._commit([*head["parts"], *self._write(rows, version)], rows.schema, version)

    def replace_range(self, source: DataFrame, low=None, high=None, override: tuple | None = None) -> int:
        """Rows of the range give way to the source's rows of the range; other source rows are left out.

        ``override`` is another range for this run, to backfill it. Parts within the range go without being read, parts that it cuts
        through are read and written again without its rows, all others stay as they are.
        """
        low, high = override if override is not None else (low, high)
        if low is None and high is None:
            raise ValueError("a range needs at least one end")
        head, held = self._head(), self.schema()
        if held is None:
            raise FileNotFoundError(f"{self.path} has no commit")
        kind = held[self.column].dataType
        placed = self._placed(head["parts"], kind, low, high)
        cut = [p for p, where in zip(head["parts"], placed) if where == CUT]
        stay = [p for p, where in zip(head["parts"], placed) if where == OUT]
        kept = widen(self._read(cut, held), source).filter(~self._within(low, high))
        fresh = widen(source, kept).filter(self._within(low, high))
        rows = materialize(kept.unionByName(fresh.select(*kept.columns)), "replacement")
        version = head["version"] + 1
        parts = [*stay, *([] if rows.isEmpty() else self._write(rows, version))]
        return self._commit(parts, rows.schema, version)
