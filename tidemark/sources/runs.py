"""Keyed tables whose upkeep costs what a batch brings.

A batch is added as one small run of sorted rows; nothing older is rewritten. Where a key has rows in several runs, a rule
decides on read which of them count. Runs of about one size are merged when there are FAN of them, so a row is
rewritten a few times as the table grows a thousandfold, and the number of runs stays small. A commit names the runs; readers follow
the newest one. Large runs are laid out by hash prefix, as finely as their size asks for, so that the rows of some keys are found
without reading the others. Folders that no recent commit names are removed with each commit.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.merge import widen_schema
from tidemark.operators.scd import scd1
from tidemark.runtime import Files

FAN = 4  # runs of one size class that are merged into one
SMALL_BYTES = 64 * 1024  # runs up to this size are one class; each further class is FAN times larger
BUCKET_BYTES = 256 * 2**20  # a run holds about so much for each hash prefix
MOST_BITS = 12  # of a prefix
KEPT_COMMITS = 4  # readers may hold on to these

RUN, GONE, PREFIX = "_run", "_gone", "_prefix"
NEWEST, LATEST, GROUP, SUM = "newest", "latest", "group", "sum"


class RunTable:
    """Rows addressed by ``keys``, placed by the hash of ``by`` (the keys by default). The rule says which rows count:

    ``newest``: of each key the row of the newest run; ``latest``: the one with the greatest ``sequence``, ties to the greatest other
    columns, so that the order of arrival is moot; ``group``: all rows that the newest run has for the key; ``sum``: one row with
    the other columns added up. A NULL in a key is a value like others. Rows marked gone hide the rows they win against; they stay until
    all runs are merged, and with ``latest`` for good, since an older event may still come.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        rule: str = NEWEST,
        sequence: str | None = None,
        by: Sequence[str] = (),
        bucket_bytes: int = BUCKET_BYTES,
    ):
        if rule not in (NEWEST, LATEST, GROUP, SUM) or (rule == LATEST) != (sequence is not None):
            raise ValueError("rule must be newest, latest (with a sequence), group or sum")
        self.spark, self.path, self.keys, self.by = spark, path.rstrip("/"), list(keys), list(by or keys)
        self.rule, self.sequence, self.bucket_bytes = rule, sequence, bucket_bytes
        self.files = Files(spark)

    # --- commits ---

    def _names(self) -> list[str]:
        return [n for n in self.files.list(f"{self.path}/_commits") if n.endswith(".json") and not n.startswith(".")]

    def _head(self) -> dict:
        return self.files.latest(f"{self.path}/_commits") or {"rows": [], "log": [], "facts": {}, "batch": -1}

    def version(self) -> int:
        """Number of batches so far, less one; merging runs does not count."""
        return self._head()["batch"]

    def schema(self) -> T.StructType | None:
        held = self._head().get("schema")
        return T.StructType.fromJson(held) if held else None

    def facts(self) -> dict:
        """What the newest commit says beside its rows."""
        return self._head()["facts"]

    def folders(self) -> int:
        return len(self.files.list(f"{self.path}/runs"))

    # --- writing ---

    def _prefix(self, bits: int) -> Column:
        """The first ``bits`` bits of the hash of a row's placing columns."""
        return F.shiftrightunsigned(F.xxhash64(*[F.col(c) for c in self.by]), 64 - bits).cast("int")

    def _write(self, rows: DataFrame, name: str, bits: int = 0) -> dict:
        path, order = f"{self.path}/runs/{name}", [c for c in self.by if c in rows.columns]
        if bits:
            placed = rows.withColumn(PREFIX, self._prefix(bits)).hint("rebalance", F.col(PREFIX))
            placed.sortWithinPartitions(PREFIX, *order).write.mode("overwrite").partitionBy(PREFIX).parquet(path)
        else:
            rows.hint("rebalance").sortWithinPartitions(*order).write.mode("overwrite").parquet(path)
        return {"name": name, "bits": bits, "bytes": self.files.size(path)}

    def stage_log(self, rows: DataFrame) -> dict:
        """Write rows of the log beside the table; they belong to it from the commit that names the run."""
        return self._write(rows, f"{self.version() + 1:08d}-log")

    def commit(
        self, rows: DataFrame | None, log: dict | None = None, replace: bool = False, facts: dict | None = None
    ) -> int:
        """Add ``rows``, which may bear a GONE column, as one run; ``replace`` makes them all there is.

        ``rule`` decides between them and older rows, so adding the same rows again changes nothing, except under ``sum``.
        """
        head = self._head()
        version = head["batch"] + 1
        held = self.schema()
        added = []
        if rows is not None:
            gone = F.coalesce(F.col(GONE), F.lit(False)) if GONE in rows.columns else F.lit(False)
            data = rows.drop(GONE)
            held = widen_schema(held, [data.schema])
            stamped = rows.select(*[F.col(f"`{c}`") for c in data.columns], gone.alias(GONE), F.lit(version).cast("long").alias(RUN))
            added.append(self._write(stamped, f"{version:08d}"))
        log_schema = self._log_schema(head)
        if log:
            log_schema = widen_schema(log_schema, [self.read_run(log).schema])
        head = {
            "batch": version,
            "rows": ([] if replace else head["rows"]) + added,
            "log": head["log"] + ([log] if log else []),
            "facts": {**head["facts"], **(facts or {})},
            "schema": held.jsonValue() if held else None,
            "log_schema": log_schema.jsonValue() if log_schema else None,
        }
        self.files.supersede(f"{self.path}/_commits", head)
        self._merge(head)
        self._expire()
        return version

    @staticmethod
    def _log_schema(head: dict) -> T.StructType | None:
        held = head.get("log_schema")
        return T.StructType.fromJson(held) if held else None

    @staticmethod
    def _crowd(runs: Sequence[dict]) -> list[dict]:
        """The runs of the smallest size class that has FAN of them."""
        classes: dict[int, list[dict]] = {}
        for run in runs:
            size, level = run["bytes"], 0
            while size > SMALL_BYTES:
                size, level = size / FAN, level + 1
            classes.setdefault(level, []).append(run)
        full = [level for level, members in classes.items() if len(members) >= FAN]
        return classes[min(full)] if full else []

    def _merge(self, head: dict) -> None:
        changed, step = False, 0
        for part in ("rows", "log"):
            while crowd := self._crowd(head[part]):
                total = sum(r["bytes"] for r in crowd)
                bits = min(MOST_BITS, max(0, -(-total // self.bucket_bytes) - 1).bit_length())
                name = f"{head['batch']:08d}-{part}-{step}"
                if part == "rows":
                    merged = self._resolved(self._union(crowd, self._stored_schema(head)), hide=False)
                    if len(crowd) == len(head["rows"]) and self.rule in (NEWEST, GROUP):
                        merged = merged.filter(~F.col(GONE))
                else:
                    merged = self._union(crowd, T.StructType.fromJson(head["log_schema"]))
                new = self._write(merged, name, bits)
                names = {r["name"] for r in crowd}
                head[part] = [r for r in head[part] if r["name"] not in names] + [new]
                changed, step = True, step + 1
        if changed:
            self.files.supersede(f"{self.path}/_commits", head)

    def _expire(self) -> None:
        names, live = self._names(), set()
        for n in names[-KEPT_COMMITS:]:
            held = self.files.read_json(f"{self.path}/_commits/{n}")
            live |= {r["name"] for r in held["rows"] + held["log"]}
        for n in names[:-KEPT_COMMITS]:
            self.files.delete(f"{self.path}/_commits/{n}")
        for n in self.files.list(f"{self.path}/runs"):
            if n not in live:
                self.files.delete(f"{self.path}/runs/{n}")

    # --- reading ---

    def _stored_schema(self, head: dict) -> T.StructType:
        data = T.StructType.fromJson(head["schema"])
        return T.StructType([*data.fields, T.StructField(GONE, T.BooleanType()), T.StructField(RUN, T.LongType())])

    def _union(self, runs: Sequence[dict], schema: T.StructType, near: DataFrame | None = None) -> DataFrame:
        """The rows of some runs; with ``near`` only of the prefixes that its rows fall into."""
        wanted: dict[int, list[int]] = {}
        if near is not None:
            for bits in {r["bits"] for r in runs if r["bits"]}:
                found = near.select(self._prefix(bits).alias("p")).distinct().collect()  # 2**MOST_BITS at most
                wanted[bits] = [r.p for r in found]
        frames = []
        for run in runs:
            read = schema
            if run["bits"]:
                read = T.StructType([*schema.fields, T.StructField(PREFIX, T.IntegerType())])
            df = self.spark.read.schema(read).parquet(f"{self.path}/runs/{run['name']}")
            if run["bits"] and near is not None:
                df = df.filter(F.col(PREFIX).isin(*wanted[run["bits"]]))
            frames.append(df.select(*[F.col(f"`{f.name}`") for f in schema.fields]))
        return reduce(DataFrame.unionByName, frames) if frames else self.spark.createDataFrame([], schema)

    def _resolved(self, rows: DataFrame, hide: bool = True) -> DataFrame:
        """Which of the rows of each key count; ``hide`` leaves out those that are gone."""
        keys = [F.col(f"`{k}`") for k in self.keys]
        if self.rule == LATEST:
            rows = scd1(rows, self.keys, self.sequence)
        elif self.rule == NEWEST:
            newest = Window.partitionBy(*keys).orderBy(F.desc(RUN))
            rows = rows.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")
        elif self.rule == GROUP:
            last = rows.groupBy(*keys).agg(F.max(RUN).alias("_last")).toDF(*[f"_k{i}" for i in range(len(keys))], "_last")
            same = [rows[k].eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(self.keys)]
            rows = rows.join(last, [*same, rows[RUN] == F.col("_last")], "left_semi")
        else:
            kinds = {f.name: f.dataType for f in rows.schema.fields}
            added = [c for c in rows.columns if c not in (*self.keys, GONE, RUN)]
            rows = rows.groupBy(*keys).agg(
                *[F.sum(f"`{c}`").cast(kinds[c]).alias(c) for c in added], F.lit(False).alias(GONE), F.max(RUN).alias(RUN)
            )
        return rows.filter(~F.col(GONE)) if hide else rows

    def raw(self) -> DataFrame:
        """All rows of all runs, those that count and those that no longer do, with RUN and GONE."""
        head = self._head()
        return self._union(head["rows"], self._stored_schema(head))

    def _rows(
        self, schema: T.StructType | None, near: DataFrame | None, hide: bool, only: DataFrame | None = None
    ) -> DataFrame:
        head = self._head()
        if head.get("schema") is None:
            if schema is None:
                raise FileNotFoundError(f"{self.path} has no commit and no schema was given")
            empty = self.spark.createDataFrame([], schema)
            return empty if hide else empty.withColumn(GONE, F.lit(False))
        rows = self._union(head["rows"], self._stored_schema(head), near)
        if only is not None:
            rows = rows.join(only, only.columns, "left_semi")
        if len(head["rows"]) == 1 and (self.rule != SUM):  # a run holds what counted when it was written
            rows = rows.filter(~F.col(GONE)) if hide else rows
        else:
            rows = self._resolved(rows, hide)
        return rows.drop(RUN, GONE) if hide else rows.drop(RUN)

    def read(self, schema: T.StructType | None = None, only: DataFrame | None = None) -> DataFrame:
        """The rows that count; ``schema`` serves before the first commit. ``only`` holds the values of some key columns to which the
        rows are restricted before it is decided which count, so that other rows are not shuffled.
        """
        return self._rows(schema, None, True, only)

    def near(self, frame: DataFrame, schema: T.StructType | None = None, gone: bool = False) -> DataFrame:
        """The rows that share a prefix with rows of ``frame``: all those with their placing columns, and others."""
        return self._rows(schema, frame, not gone)

    def in_buckets(self, wanted: DataFrame, bucket: Column, name: str, bits: int) -> DataFrame:
        """The rows that count among those whose ``bucket``, the first ``bits`` of their hash, is in ``wanted`` (name: long).

        Runs laid out by prefix are read only where wanted buckets lie, and no other rows are shuffled.
        """
        head = self._head()
        frames = []
        for run in head["rows"]:
            df = self._union([run], self._stored_schema(head))
            if run["bits"]:
                up = min(run["bits"], bits)
                prefixes = wanted.select(F.shiftrightunsigned(name, bits - up).cast("int").alias("p")).distinct().collect()
                low = [r.p << (run["bits"] - up) for r in prefixes]
                every = [p + i for p in low for i in range(1 << (run["bits"] - up))]
                schema = T.StructType([*self._stored_schema(head).fields, T.StructField(PREFIX, T.IntegerType())])
                df = self.spark.read.schema(schema).parquet(f"{self.path}/runs/{run['name']}").filter(F.col(PREFIX).isin(*every)).drop(PREFIX)
            frames.append(df)
        rows = reduce(DataFrame.unionByName, frames)
        rows = rows.withColumn(name, bucket).join(wanted.select(name), name, "left_semi").drop(name)
        return self._resolved(rows).drop(RUN, GONE)

    def read_log(self, schema: T.StructType | None = None, near: DataFrame | None = None, staged: dict | None = None) -> DataFrame:
        """All rows of the log, or those of prefixes that rows of ``near`` fall into; ``staged`` adds a run that is not committed."""
        head = self._head()
        held = widen_schema(self._log_schema(head), [schema] if schema else [])
        return self._union(head["log"] + ([staged] if staged else []), held, near)

    def read_run(self, run: dict) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/runs/{run['name']}")
