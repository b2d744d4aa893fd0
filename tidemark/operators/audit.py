"""Invariant checks over tables: one row per check, never an exception.

Checks that are plain aggregates of one table share a single pass. Checks that need a
grouping return their own one-row frame.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.hotkeys import by_heat, neighbours
from tidemark.operators.scd import END, START
from tidemark.operators.summaries import shares_vs_target

SCHEMA = "check string, observed string, expected string, passed boolean"


@dataclass(frozen=True)
class Check:
    """Either ``value`` (an aggregate over the table) or ``frame`` (a one-row frame with ``value``)."""

    name: str
    expected: str
    passes: Callable[[Column], Column]
    value: Column | None = None
    frame: Callable[[DataFrame], DataFrame] | None = None


def _zero(name: str, bad: Column) -> Check:
    return Check(name, "0", lambda v: v == 0, value=F.count_if(bad))


def _zero_of(name: str, frame: Callable[[DataFrame], DataFrame]) -> Check:
    return Check(name, "0", lambda v: v == 0, frame=frame)


def row_count(n: int) -> Check:
    return Check("row_count", str(n), lambda v: v == n, value=F.count(F.lit(1)))


def not_empty(name: str = "not_empty") -> Check:
    """Guards against a source that delivers nothing and looks like deletes of everything."""
    return Check(name, "> 0", lambda v: v > 0, value=F.count(F.lit(1)))


def in_domain(col: str, values: Sequence[str]) -> Check:
    return _zero(f"domain:{col}", ~F.coalesce(F.col(col).isin(*values), F.lit(False)))


def in_range(col: str, low=None, high=None) -> Check:
    ok = F.lit(True)
    if low is not None:
        ok = ok & (F.col(col) >= F.lit(low))
    if high is not None:
        ok = ok & (F.col(col) <= F.lit(high))
    return _zero(f"range:{col}", ~F.coalesce(ok, F.lit(False)))


def arithmetic(name: str, left: Column, right: Column, scale: int = 6) -> Check:
    """Both sides agree at ``scale`` decimals, NULL agreeing with NULL."""
    return _zero(f"arithmetic:{name}", ~F.round(left, scale).eqNullSafe(F.round(right, scale)))


def attribution(col: str, ts: str, boundary, before, after, where: str = "true") -> Check:
    """Rows before the boundary carry one value, from it on another."""
    want = F.when(F.col(ts) < F.lit(boundary), F.lit(before)).otherwise(F.lit(after))
    return _zero(f"attribution:{col}", F.expr(where) & ~F.col(col).eqNullSafe(want))


def masked_unless(col: str, granted: Column, glyph: str) -> Check:
    """Every value that is not granted shows the glyph."""
    return _zero(f"masked:{col}", ~F.coalesce(granted, F.lit(False)) & ~F.col(col).eqNullSafe(F.lit(glyph)))


def holds(name: str, predicate: str) -> Check:
    return _zero(name, ~F.coalesce(F.expr(predicate), F.lit(False)))


def unique(keys: Sequence[str]) -> Check:
    def frame(df: DataFrame) -> DataFrame:
        return df.groupBy(*keys).count().agg(F.count_if(F.col("count") > 1).alias("value"))

    return _zero_of(f"unique:{','.join(keys)}", frame)


def one_open_row(keys: Sequence[str]) -> Check:
    def frame(df: DataFrame) -> DataFrame:
        opened = df.filter(F.col(END).isNull()).groupBy(*keys).count()
        return opened.agg(F.count_if(F.col("count") > 1).alias("value"))

    return _zero_of(f"one_open_row:{','.join(keys)}", frame)


def windows_disjoint(keys: Sequence[str]) -> Check:
    """Windows are ordered and do not overlap: each ends by the time the next begins."""

    def frame(df: DataFrame) -> DataFrame:
        span = df.select(*keys, F.col(START).alias("_s"), F.col(END).alias("_e"))

        def plan(rows: DataFrame, segment: str | None) -> DataFrame:
            rows = neighbours(rows, keys, ["_s"], F.struct(F.col("_s").alias("s")), segment, None, "_next")
            return rows.select("_s", "_e", "_next")

        linked = by_heat(span, keys, ["_s"], plan)
        overlap = F.col("_next").isNotNull() & (F.col("_e").isNull() | (F.col("_next.s") < F.col("_e")))
        backwards = F.coalesce(F.col("_e") <= F.col("_s"), F.lit(False))
        return linked.agg(F.count_if(overlap | backwards).alias("value"))

    return _zero_of(f"windows_disjoint:{','.join(keys)}", frame)


def none_in(name: str, frame: Callable[[DataFrame], DataFrame]) -> Check:
    """A frame that must be empty, such as orphans or rows outside the grants."""
    return _zero_of(name, lambda df: frame(df).agg(F.count(F.lit(1)).alias("value")))


def count_between(name: str, low: DataFrame | int, high: DataFrame, strict: bool = False) -> Check:
    """Row count above ``low`` and at most (or strictly below) that of ``high``."""

    def frame(df: DataFrame) -> DataFrame:
        n = df.agg(F.count(F.lit(1))).scalar()
        bound = high.agg(F.count(F.lit(1)).alias("_bound"))
        inside = (n < F.col("_bound")) if strict else (n <= F.col("_bound"))
        return bound.select(F.when(inside & (n > F.lit(low)), 0).otherwise(1).alias("value"))

    return _zero_of(name, frame)


def same_count(name: str, other: DataFrame) -> Check:
    """As many rows as another table; the value is the difference."""

    def frame(df: DataFrame) -> DataFrame:
        n = df.agg(F.count(F.lit(1))).scalar()
        return other.agg((n - F.count(F.lit(1))).alias("value"))

    return _zero_of(name, frame)


def shares(col: str, target: Mapping[str, float], tol: float) -> Check:
    def frame(df: DataFrame) -> DataFrame:
        return shares_vs_target(df, col, target, tol).agg(F.count_if(~F.col("within")).alias("value"))

    return _zero_of(f"shares:{col}", frame)


def same_content(name: str, other: DataFrame, expect_equal: bool = True) -> Check:
    """Whether two tables hold the same rows, by an order-free fingerprint of all columns."""

    def frame(df: DataFrame) -> DataFrame:
        mine = fingerprint(df).scalar()
        return fingerprint(other).select(
            F.when(F.col("fingerprint").eqNullSafe(mine), 0).otherwise(1).alias("value")
        )

    if expect_equal:
        return _zero_of(name, frame)
    return Check(name, "1", lambda v: v == 1, frame=frame)


def fingerprint(df: DataFrame) -> DataFrame:
    """Sum of row hashes and the row count in one decimal: no sort, no shuffle of rows."""
    total = F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)]).cast("decimal(38,0)"))
    return df.agg((F.coalesce(total, F.lit(0)) + F.count(F.lit(1))).cast("decimal(38,0)").alias("fingerprint"))


def audit(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(check, observed, expected, passed) per check."""
    plain = [c for c in checks if c.value is not None]
    parts = []
    if plain:
        once = df.agg(*[c.value.alias(f"_{i}") for i, c in enumerate(plain)])
        rows = [_row(c, F.col(f"_{i}")) for i, c in enumerate(plain)]
        parts.append(once.select(F.inline(F.array(*rows))))
    for c in checks:
        if c.frame is not None:
            parts.append(c.frame(df).select(F.inline(F.array(_row(c, F.col("value"))))))
    return reduce(DataFrame.unionByName, parts)


def _row(check: Check, value: Column) -> Column:
    return F.struct(
        F.lit(check.name).alias("check"),
        value.cast("string").alias("observed"),
        F.lit(check.expected).alias("expected"),
        F.coalesce(check.passes(value), F.lit(False)).alias("passed"),
    )


def schema_contract(
    df: DataFrame, present: Mapping[str, str] | None = None, absent: Sequence[str] = ()
) -> DataFrame:
    """Columns that must exist with a type, and columns that must not; no data is read."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = [
        (f"column:{c}", have.get(c, "absent"), t, have.get(c) == t) for c, t in (present or {}).items()
    ] + [(f"no_column:{c}", have.get(c, "absent"), "absent", c not in have) for c in absent]
    return df.sparkSession.createDataFrame(rows, SCHEMA)


def rates_increase(spark, rates: Mapping[str, str], ladder: Sequence[str]) -> DataFrame:
    """Rates rise strictly along the ladder; a property of the mapping, no data is read."""
    values = [float(rates[t]) for t in ladder]
    drops = sum(b <= a for a, b in zip(values, values[1:]))
    return spark.createDataFrame([("rates_increase", str(drops), "0", drops == 0)], SCHEMA)


def require_passed(report: DataFrame) -> DataFrame:
    """Raise with the failed checks, of which a report holds at most one row each."""
    failed = report.filter(~F.col("passed")).collect()
    if failed:
        raise AssertionError("; ".join(f"{r.check}: {r.observed}, expected {r.expected}" for r in failed))
    return report
