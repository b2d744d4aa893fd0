"""Projections that stay stable while the upstream schema grows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_except(df: DataFrame, drop: Iterable[str] = (), **new: Column) -> DataFrame:
    """Every column except ``drop``; replaced columns move to the end, new upstream columns pass."""
    gone = set(drop) | set(new)
    missing = set(drop) - set(df.columns)
    if missing:
        raise ValueError(f"no such columns: {sorted(missing)}")
    kept = [F.col(f"`{c}`") for c in df.columns if c not in gone]
    return df.select(*kept, *[expr.alias(name) for name, expr in new.items()])


def project_typed(df: DataFrame, spec: Mapping[str, str | None]) -> DataFrame:
    """A fixed column list in order, cast where a type is given; a value that does not fit raises."""
    return df.select(*[(F.col(c).cast(t) if t else F.col(c)).alias(c) for c, t in spec.items()])


def count_where(df: DataFrame, **predicates: Column | str) -> DataFrame:
    """One row with a conditional count per named predicate."""
    as_col = {n: F.expr(p) if isinstance(p, str) else p for n, p in predicates.items()}
    return df.agg(*[F.count_if(p).alias(n) for n, p in as_col.items()])


def top_n(df: DataFrame, order, n: int) -> DataFrame:
    """The first ``n`` rows in order: each task keeps its own n before they are merged."""
    return df.orderBy(*order).limit(n)


def sample_rows(df: DataFrame, n: int, key: str) -> DataFrame:
    """``n`` rows chosen by a hash of the key: the same rows on every run and any layout."""
    pick = F.md5(F.col(key).cast("string"))
    return df.orderBy(pick, F.col(key)).limit(n)
