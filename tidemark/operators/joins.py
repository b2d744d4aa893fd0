"""Joins between facts, versioned dimensions and grants."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expressions import END, START
from tidemark.operators.hotkeys import by_heat, carried



def join_current(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Each fact with the open row of its key. The planner picks the strategy from sizes."""
    return fact.join(dim.filter(F.col(END).isNull()), key)


def not_in(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key ``other`` lacks."""
    return df.join(other.select(*keys).distinct(), list(keys), "left_anti")


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Facts that refer to no dimension row."""
    return not_in(fact, dim, [key])


def granted_values(grants: DataFrame, user, column: str, user_col: str = "email") -> DataFrame:
    """The distinct non-null values granted to a user; several grant rows never multiply data."""
    who = user if isinstance(user, Column) else F.lit(user)
    return grants.filter((F.col(user_col) == who) & F.col(column).isNotNull()).select(column).distinct()


def semi_granted(
    df: DataFrame, grants: DataFrame, user, col: str, grant_col: str | None = None, user_col: str = "email"
) -> DataFrame:
    """Rows whose value is in the user's granted set."""
    allowed = granted_values(grants, user, grant_col or col, user_col).toDF("_granted")
    return df.join(allowed, F.col(f"`{col}`") == F.col("_granted"), "left_semi")


def mark_granted(
    df: DataFrame,
    grants: DataFrame,
    user,
    col: str,
    flag: str,
    grant_col: str | None = None,
    user_col: str = "email",
) -> DataFrame:
    """All rows, with a boolean telling whether the value is granted (an outer join splits on skew)."""
    allowed = granted_values(grants, user, grant_col or col, user_col).toDF("_granted")
    return (
        df.join(allowed, F.col(f"`{col}`") == F.col("_granted"), "left")
        .withColumn(flag, F.col("_granted").isNotNull())
        .drop("_granted")
    )


def as_of_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str | Sequence[str],
    ts: str,
    start: str = START,
    end: str = END,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Each fact with the dimension row whose [start, end) holds its time; others are left out.

    Both sides are interleaved by time and each fact takes the latest version that has begun, if that has
    not ended: linear in both, however many versions a key has. So where windows overlap, the one that starts last counts. Keys
    with more than ``rows_per_task`` rows are cut into segments, also between facts of one instant.
    """
    keys = [key] if isinstance(key, str) else list(key)
    shared = [c for c in dim.columns if c in fact.columns and c not in keys]
    if shared:
        raise ValueError(f"columns on both sides: {shared}")
    extra = [c for c in dim.columns if c not in keys]
    # A version sorts before a fact of the same instant: start is inclusive.
    own = [c for c in fact.columns if c not in keys]
    facts = fact.select(
        *keys, F.col(ts).alias("_at"), F.lit(1).alias("_side"), F.xxhash64(*own).alias("_spread"), F.struct(*own).alias("_fact")
    )
    versions = dim.select(
        *keys, F.col(start).alias("_at"), F.lit(0).alias("_side"), F.xxhash64(*extra).alias("_spread"), F.struct(*extra).alias("_version")
    )
    both = versions.unionByName(facts, allowMissingColumns=True)
    for k in keys:
        both = both.filter(F.col(k).isNotNull())

    order = ["_at", "_side", "_spread"]  # the last cuts many facts of one instant apart

    def plan(rows: DataFrame, segment: str | None) -> DataFrame:
        return (
            carried(rows, keys, order, "_version", segment, "_state")
            .filter("_side = 1 AND _state IS NOT NULL")
            .select(
                *[F.col(c) if c in keys else F.col("_fact").getField(c).alias(c) for c in fact.columns],
                *[F.col("_state").getField(c).alias(c) for c in extra],
            )
            .filter(F.col(end).isNull() | (F.col(ts) < F.col(end)))
        )

    return by_heat(both, keys, order, plan, rows_per_task)
