"""Keyed and predicate-scoped merges, each a function from (target, source) to the new target.

Parquet has no MERGE; ``tidemark.sources.tables`` writes results and swaps them in.
Anti joins keep every row of the target side, so a target key with many rows is split by
adaptive skew handling, never gathered.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class DuplicateKeys(ValueError):
    """A source that must hold one row per key holds several."""


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a key occurs twice; counts are combined before the shuffle."""
    twice = df.groupBy(*keys).count().filter("count > 1").limit(1)
    if not twice.isEmpty():
        raise DuplicateKeys(f"more than one source row for a key of {list(keys)}")


def _true(pred: Column | str) -> Column:
    cond = F.expr(pred) if isinstance(pred, str) else pred
    return F.coalesce(cond, F.lit(False))


def _keys_of(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def widen(target: DataFrame, source: DataFrame) -> DataFrame:
    """The target with the columns that only ``source`` has, NULL in every row."""
    new = [f for f in source.schema.fields if f.name not in target.columns]
    return target.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in new]) if new else target


def widen_schema(known: T.StructType | None, found: Iterable[T.StructType]) -> T.StructType:
    """The known columns as they are, followed by new ones in order of appearance; names differ by more than case."""
    fields = {f.name.lower(): f for f in (known.fields if known else [])}
    for schema in found:
        for f in schema.fields:
            fields.setdefault(f.name.lower(), T.StructField(f.name, f.dataType, True))
    return T.StructType(list(fields.values()))


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], delete_when: str | None = None
) -> DataFrame:
    """Matched rows are replaced, new rows added; rows where ``delete_when`` holds only remove.

    Here and below, columns that only the source has are added to the target, NULL in its other rows.
    """
    require_unique(source, keys)
    target = widen(target, source)
    incoming = source.filter(~_true(delete_when)) if delete_when else source
    return target.join(source.select(*keys), list(keys), "left_anti").unionByName(
        incoming.select(*target.columns)
    )


def insert_if_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Only source rows whose key the target lacks are added."""
    require_unique(source, keys)
    target = widen(target, source)
    fresh = source.join(_keys_of(target, keys), list(keys), "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def guarded_update(df: DataFrame, where: Column | str, assignments: Mapping[str, Column]) -> DataFrame:
    """Assign columns in rows that satisfy the guard; all assignments see the old values."""
    guard = _true(where)
    return df.select(
        *[
            F.when(guard, assignments[c]).otherwise(F.col(f"`{c}`")).alias(c) if c in assignments else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def merge_full(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Update matched, insert new, delete target rows the source lacks: the result is the source's rows.

    Columns that only the target has keep their values in matched rows and are NULL in new ones. Applied per micro-batch, the target ends as the last batch's contents, so use it only
    where every batch is a full snapshot.
    """
    require_unique(source, keys)
    own = [c for c in target.columns if c not in source.columns]
    wide = widen(target, source).columns
    if own:
        source = source.join(target.select(*keys, *own), list(keys), "left")
    return source.select(*wide)


def merge_full_counts(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many rows ``merge_full`` updates, inserts and deletes, as one row."""
    t = target.select(*keys).withColumn("_t", F.lit(1))
    s = source.select(*keys).withColumn("_s", F.lit(1))
    return t.join(s, list(keys), "full_outer").agg(
        F.count_if(F.col("_t").isNotNull() & F.col("_s").isNotNull()).alias("updated"),
        F.count_if(F.col("_t").isNull()).alias("inserted"),
        F.count_if(F.col("_s").isNull()).alias("deleted"),
    )


def delete_insert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop every target row whose key occurs in the batch, then add all batch rows."""
    target = widen(target, batch)
    return target.join(_keys_of(batch, keys), list(keys), "left_anti").unionByName(
        batch.select(*target.columns)
    )


def replace_where(
    target: DataFrame, source: DataFrame, pred: Column | str, override: Column | str | None = None
) -> DataFrame:
    """Rows of the target matching the predicate give way to matching source rows, by name.

    ``override`` replaces the predicate for one run, to backfill another range.
    """
    hit = _true(pred if override is None else override)
    target = widen(target, source)
    return target.filter(~hit).unionByName(source.filter(hit).select(*target.columns))


def window_predicate(column: str, low, high) -> Column:
    """Half-open range on one column."""
    return (F.col(column) >= F.lit(low)) & (F.col(column) < F.lit(high))


def replace_window(target: DataFrame, source: DataFrame, column: str, low, high) -> DataFrame:
    """``replace_where`` on the half-open range [low, high)."""
    return replace_where(target, source, window_predicate(column, low, high))


def delete_where(df: DataFrame, pred: Column | str) -> DataFrame:
    """Rows for which the predicate is not true."""
    return df.filter(~_true(pred))
