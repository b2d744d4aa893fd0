"""Ordered work per key when one key may hold a large share of all rows.

A window partitioned by key sends the whole key to one task. ``cut_hot`` draws a thin sample, finds in it the keys that
one task should not hold alone, and gives their rows a segment number by binary search in sampled bounds. All rows then go
through one plan and one shuffle, by key and segment; ``neighbours`` and ``carried`` link the segments of a
key through one summary row each. How these are joined is left to the planner, which sees their size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.runtime import estimated_bytes, materialize

ROWS_PER_TASK = 4_000_000  # rows of one key that one task still sorts comfortably
ROW_BYTES = 8  # an input estimated below so much for each of these rows needs no sample: one task could hold all of it
DRAWN = 32  # rows drawn, on average, of ROWS_PER_TASK
STEP = 8  # drawn rows between two bounds, so a segment holds a quarter of ROWS_PER_TASK, and more than all of it once in 10**9
SEGMENT = "_segment"


def _bounds(df: DataFrame, keys: Sequence[str], order: Sequence[str], bar: int) -> DataFrame:
    """(keys, cuts, steps): the bounds of each key that may have more than ``bar`` rows, a few for each ``bar`` rows of it.

    Of 10**12 rows about 8 million are drawn, which leaves at most a million bounds.
    """
    thin = bar > DRAWN
    rows = df.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.struct(*order).alias("_order"))
    if thin:
        rows = rows.filter(F.rand() < DRAWN / bar)
    hot_keys = [f"_hot_{k}" for k in keys]
    most, step = (STEP, STEP) if thin else (bar, max(1, bar // 4))
    counted = rows.withColumns(
        {
            "_n": F.count(F.lit(1)).over(Window.partitionBy(*hot_keys)),
            "_i": F.row_number().over(Window.partitionBy(*hot_keys).orderBy("_order")),
        }
    )
    cuts = counted.filter((F.col("_n") > most) & (F.col("_i") % step == 0))
    cuts = cuts.groupBy(*hot_keys).agg(F.sort_array(F.collect_set("_order")).alias("_cuts"))
    depth = F.floor(F.log2(F.size("_cuts"))).cast("int")
    powers = F.transform(F.sequence(depth, F.lit(0), F.lit(-1)), lambda i: F.pow(F.lit(2), i).cast("int"))
    return materialize(cuts.withColumn("_steps", powers), "bounds")


def cut_hot(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_task: int | None = None
) -> tuple[DataFrame, str | None]:
    """``df`` with a segment number for each row of a large key, -1 for others; without large keys ``df`` as it is and None."""
    bar = rows_per_task or ROWS_PER_TASK
    if estimated_bytes(df) < bar * ROW_BYTES:
        return df, None
    bounds = _bounds(df, keys, order, bar)
    if bounds.isEmpty():
        return df, None
    at = F.struct(*order)

    def deeper(low: Column, step: Column) -> Column:
        return F.when(F.get("_cuts", low + step - 1) <= at, low + step).otherwise(low)

    place = F.when(F.col("_cuts").isNull(), -1).otherwise(F.aggregate("_steps", F.lit(0), deeper))
    marked = df.join(F.broadcast(bounds), _same(keys, "_hot_"), "left").withColumn(SEGMENT, place)
    return marked.drop("_cuts", "_steps", *[f"_hot_{k}" for k in keys]), SEGMENT


def _same(keys: Sequence[str], prefix: str) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return cond


def by_heat(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    plan: Callable[[DataFrame, str | None], DataFrame],
    rows_per_task: int | None = None,
    collapse: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``plan(rows, segment_column)`` over all rows, with large keys in segments; without any the segment is None.

    ``collapse`` may reduce the rows beforehand where there are segments, for an order that cannot tell all rows of a key apart.
    """
    rows, segment = cut_hot(df, keys, order, rows_per_task)
    if segment is None:
        return plan(rows, None)
    rows = collapse(rows) if collapse else rows
    return plan(rows.repartition(*keys, segment), segment)  # the summaries read this shuffle again


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    segment: str | None,
    back: str | None = None,
    ahead: str | None = None,
) -> DataFrame:
    """Add the non-null struct ``value`` of the row before (``back``) and after (``ahead``)."""
    part = [*keys, segment] if segment else list(keys)
    w = Window.partitionBy(*part).orderBy(*order)
    named = {}
    if back:
        named[back] = F.lag("_value").over(w)
    if ahead:
        named[ahead] = F.lead("_value").over(w)
    rows = df.withColumn("_value", value)
    if segment is None:
        return rows.withColumns(named).drop("_value")

    at = F.struct(*order)
    across = Window.partitionBy(*keys).orderBy(segment)
    edges = (
        rows.filter(F.col(segment) >= 0)
        .groupBy(*part)
        .agg(F.min_by("_value", at).alias("_first"), F.max_by("_value", at).alias("_last"))
        .select(
            *[F.col(k).alias(f"_edge_{k}") for k in part],
            F.lag("_last").over(across).alias("_before"),
            F.lead("_first").over(across).alias("_after"),
        )
    )
    rows = rows.withColumns(named).join(edges, _same(part, "_edge_"), "left")
    if back:
        rows = rows.withColumn(back, F.coalesce(back, "_before"))
    if ahead:
        rows = rows.withColumn(ahead, F.coalesce(ahead, "_after"))
    return rows.drop("_value", "_before", "_after", *[f"_edge_{k}" for k in part])


def carried(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, segment: str | None, name: str
) -> DataFrame:
    """Add the latest non-null ``value`` at or before each row."""
    part = [*keys, segment] if segment else list(keys)
    so_far = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = df.withColumn(name, F.last(value, ignorenulls=True).over(so_far))
    if segment is None:
        return rows

    earlier = Window.partitionBy(*keys).orderBy(segment).rowsBetween(Window.unboundedPreceding, -1)
    at = F.when(F.col(value).isNotNull(), F.struct(*order))
    edges = (
        df.filter(F.col(segment) >= 0)
        .groupBy(*part)
        .agg(F.max_by(value, at).alias("_last"))
        .select(
            *[F.col(k).alias(f"_edge_{k}") for k in part],
            F.last("_last", ignorenulls=True).over(earlier).alias("_entering"),
        )
    )
    return (
        rows.join(edges, _same(part, "_edge_"), "left")
        .withColumn(name, F.coalesce(name, "_entering"))
        .drop("_entering", *[f"_edge_{k}" for k in part])
    )
