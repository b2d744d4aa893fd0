"""Change events from snapshots, and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.merge import widen

CHANGE, VERSION, CHANGED = "_change_type", "_commit_version", "_changed_columns"
INSERT, BEFORE, AFTER, DELETE = "insert", "update_preimage", "update_postimage", "delete"


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], version: int) -> DataFrame:
    """Row-level changes between two snapshots; a key that either holds twice raises when the result is computed.

    An update yields its row before and after; ``_changed_columns`` lists what differs,
    compared null-safely. A column only one side has reads NULL on the other.
    """
    on = list(keys)
    columns = [*new.columns, *[c for c in old.columns if c not in new.columns]]
    types = {f.name: f.dataType for f in [*old.schema.fields, *new.schema.fields]}
    values = [c for c in columns if c not in on]

    def side(df: DataFrame, name: str) -> DataFrame:
        cells = [(F.col(f"`{c}`") if c in df.columns else F.lit(None)).cast(types[c]).alias(c) for c in values]
        one = df.select(*on, F.struct(F.lit(True).alias("_present"), *cells).alias(name))
        # the join needs rows by key anyway, so counting them costs no further shuffle
        twice = F.raise_error(F.lit(f"more than one row for a key of {on}"))
        return one.groupBy(*on).agg(F.when(F.count(F.lit(1)) > 1, twice).otherwise(F.first(name)).alias(name))

    both = side(old, "_old").join(side(new, "_new"), on, "full_outer")
    was, now = F.col("_old"), F.col("_new")
    differing = F.filter(
        F.array(
            *[
                F.when(~was.getField(c).eqNullSafe(now.getField(c)), F.lit(c))
                for c in values
            ]
        ),
        lambda c: c.isNotNull(),
    )
    paired = was.isNotNull() & now.isNotNull()
    both = both.withColumn(CHANGED, F.when(paired, differing).otherwise(F.array().cast("array<string>")))

    def image(cond, kind, row):
        return F.when(cond, F.struct(F.lit(kind).alias("kind"), row.alias("row")))

    updated = paired & (F.size(CHANGED) > 0)
    images = F.filter(
        F.array(
            image(was.isNull(), INSERT, now),
            image(updated, BEFORE, was),
            image(updated, AFTER, now),
            image(now.isNull(), DELETE, was),
        ),
        lambda i: i.isNotNull(),
    )
    return both.select(*on, CHANGED, F.explode(images).alias("_image")).select(
        *[F.col(f"`{c}`") if c in on else F.col("_image.row").getField(c).alias(c) for c in columns],
        F.col("_image.kind").alias(CHANGE),
        F.lit(version).cast("bigint").alias(VERSION),
        CHANGED,
    )


def read_changes(df: DataFrame, kinds: Sequence[str] = (INSERT, AFTER)) -> DataFrame:
    """The events of the given kinds; by default the new state of each changed row."""
    return df.filter(F.col(CHANGE).isin(*kinds))


def apply_changes(snapshot: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The snapshot after ``changes``: rows of changed keys go, new states come in.

    A column that only the changes have is added, NULL in rows that did not change.
    """
    on = list(keys)
    snapshot = widen(snapshot, changes.drop(CHANGE, VERSION, CHANGED))
    changes = widen(changes, snapshot)
    post = changes.filter(F.col(CHANGE) != BEFORE)
    last = post.groupBy(*on).agg(
        F.max_by(F.struct(CHANGE, *[F.col(f"`{c}`") for c in snapshot.columns if c not in on]), VERSION).alias("_row")
    )
    current = last.filter(F.col("_row").getField(CHANGE) != DELETE).select(
        *[F.col(f"`{c}`") if c in on else F.col("_row").getField(c).alias(c) for c in snapshot.columns]
    )
    return snapshot.join(last.select(*on), on, "left_anti").unionByName(current)
