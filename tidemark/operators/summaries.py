"""Counts, shares, duplicates and order statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def value_counts(df: DataFrame, *cols: str) -> DataFrame:
    """Rows per value, most frequent first; NULL is a value of its own."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), *cols)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with the number of distinct non-null values of each column.

    Each column is counted on its own, so no row is copied once per column.
    """
    counts = [df.agg(F.countDistinct(c).alias("_n")).select(F.lit(i).alias("_i"), "_n") for i, c in enumerate(cols)]
    together = reduce(DataFrame.unionByName, counts)
    return together.agg(*[F.max(F.when(F.col("_i") == i, F.col("_n"))).alias(c) for i, c in enumerate(cols)])


def shares_vs_target(df: DataFrame, col: str, target: Mapping[str, float], tol: float) -> DataFrame:
    """Per target value: count, share, target share and whether it is within tolerance.

    Values outside the target are pooled as NULL with a target share of zero. The counts are
    conditional aggregates over a fixed list, so one pass and one row leave each task.
    """
    c, n = F.col(col), F.col("_rows")
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(c == v).alias(f"_{i}") for i, v in enumerate(target)],
        F.count_if(~F.coalesce(c.isin(*target), F.lit(False))).alias("_other"),
    )

    def row(value, count, share):
        actual = F.when(n > 0, (count / n).cast("decimal(9,6)"))
        goal = F.lit(Decimal(str(share))).cast("decimal(9,6)")
        return F.struct(
            F.lit(value).cast("string").alias(col),
            count.alias("n"),
            actual.alias("share"),
            goal.alias("target"),
            F.coalesce(F.abs(actual - goal) <= F.lit(Decimal(str(tol))), F.lit(False)).alias("within"),
        )

    rows = [row(v, F.col(f"_{i}"), s) for i, (v, s) in enumerate(target.items())]
    return counted.select(F.inline(F.array(*rows, row(None, F.col("_other"), 0))))


BINS = 1 << 12  # counts that a task of a selection step may hand on, and that reach the driver


def ordered_code(value: Column, kind: T.DataType) -> Column:
    """A whole number that orders like the value: whole numbers, decimals, dates, times, float and double."""
    if isinstance(kind, T.DecimalType):
        if kind.precision <= 18:
            return (value.cast(f"decimal(38,{kind.scale})") * F.lit(10**kind.scale)).cast("long")
        return F.replace(value.cast("string"), F.lit("."), F.lit("")).cast("decimal(38,0)")  # all its digits
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return value.cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp"))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        # the bits of a double, turned round for negative ones; adding 0.0 makes -0.0 equal to 0.0
        bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value.cast("double") + F.lit(0.0))
        bits = bits.cast("long")
        return F.when(bits < 0, F.bitwise_not(bits) - F.lit((1 << 63) - 1) - F.lit(1)).otherwise(bits)
    raise ValueError(f"no order-preserving code for {kind.simpleString()}")


def nth_value(values: DataFrame, rank: int, lowest: int, highest: int):
    """The value at ``rank`` (from 0) among the rows (v, code), exact; all codes lie between the two given.

    Digit selection: counts by BINS equal parts of the codes' range tell which part holds the rank, and only that part is
    counted again, in finer ones: six times at most for 64 bits, twice for most amounts. Tasks count before anything is shuffled, so
    neither values nor samples of them move.
    """
    found = None
    while found is None or lowest < highest:
        wide = highest - lowest >= 1 << 63 or values.schema["code"].dataType != T.LongType()
        kind = "DECIMAL(38,0)" if wide else "BIGINT"
        low, high = (f"CAST('{x}' AS {kind})" for x in (lowest, highest))
        step = max(1, -(-(highest - lowest + 1) // BINS))
        inside = values.filter(f"CAST(code AS {kind}) BETWEEN {low} AND {high}")
        part = F.expr(f"(CAST(code AS {kind}) - {low}) DIV CAST('{step}' AS {kind})")
        if lowest < 0 <= highest and highest - lowest >= 10**38:  # beyond what a decimal holds: the sign first
            part = F.when(F.col("code") < 0, 0).otherwise(1)
        bins = inside.groupBy(part.alias("bin")).agg(
            F.count(F.lit(1)).alias("n"), F.min("code").alias("lo"), F.max("code").alias("hi"), F.min("v").alias("v")
        )
        for r in sorted(bins.collect(), key=lambda r: r.bin):
            if rank < r.n:
                lowest, highest, found = int(r.lo), int(r.hi), r.v
                break
            rank -= r.n
    return found


def amount_stats(df: DataFrame, col: str) -> DataFrame:
    """Count, min, max and the element at index n // 2 of the sorted non-null values, all exact."""
    kind = df.schema[col].dataType
    values = df.select(F.col(f"`{col}`").alias("v")).filter("v IS NOT NULL").withColumn("code", ordered_code(F.col("v"), kind))
    all_ = values.agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.min("code"), F.max("code")).first()
    median = nth_value(values, all_.n // 2, int(all_[3]), int(all_[4])) if all_.n else None
    schema = T.StructType([T.StructField("n", T.LongType()), *[T.StructField(c, kind) for c in ("lowest", "median", "highest")]])
    return values.sparkSession.createDataFrame([(all_.n, all_.lo, median, all_.hi)], schema)
