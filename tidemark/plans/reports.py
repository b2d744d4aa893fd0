"""The two sales reports and their incremental upkeep."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expressions import TIER_RATES, money, month_of, rate_lookup
from tidemark.operators.joins import as_of_join
from tidemark.operators.scd import scd2_current

TOTALS = ("total_vendas", "qtde_pedidos")


def rep_months(fact: DataFrame, key: str, ts: str, amount: str, order_key: str) -> DataFrame:
    """Sales per rep and month. One row per rep and month leaves each task, however busy a rep is."""
    return fact.groupBy(key, month_of(ts).alias("mes")).agg(
        F.sum(money(amount)).cast("decimal(38,2)").alias("total_vendas"),
        F.count(order_key).alias("qtde_pedidos"),
    )


def sales_rollup(months: DataFrame, dim: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """Sales by attributes of the rep's current row, and month.

    Facts are summed per rep before they meet the dimension, so the join sees rep-months,
    not orders.
    """
    current = scd2_current(dim).select(key, *by)
    return (
        months.join(current, key)
        .groupBy(*by, "mes")
        .agg(
            F.sum("total_vendas").cast("decimal(38,2)").alias("total_vendas"),
            F.sum("qtde_pedidos").alias("qtde_pedidos"),
        )
    )


def refresh_rep_months(months: DataFrame, removed: DataFrame, added: DataFrame, key: str) -> DataFrame:
    """Rep-months after orders changed: subtract old versions, add new ones, drop empty months.

    ``removed`` and ``added`` are rep-months of the touched orders before and after.
    """
    return _combine(months, removed, added, [key, "mes"])


def refresh_rollup(
    rollup: DataFrame,
    months_before: DataFrame,
    months_after: DataFrame,
    dim_before: DataFrame,
    dim_after: DataFrame,
    touched: DataFrame,
    key: str,
    by: Sequence[str],
) -> DataFrame:
    """The rollup after reps in ``touched`` changed: their old contributions out, the new ones in.

    A rep's move shifts all their months at once, but only rep-months are read, never orders.
    """
    who = touched.select(key).distinct()

    def part(months: DataFrame, dim: DataFrame) -> DataFrame:
        return sales_rollup(months.join(who, key, "left_semi"), dim.join(who, key, "left_semi"), key, by)

    return _combine(rollup, part(months_before, dim_before), part(months_after, dim_after), [*by, "mes"])


def _combine(base: DataFrame, minus: DataFrame, plus: DataFrame, groups: Sequence[str]) -> DataFrame:
    def signed(df: DataFrame, sign: int) -> DataFrame:
        return df.select(
            *groups,
            (F.col("total_vendas") * F.lit(sign)).cast("decimal(38,2)").alias("total_vendas"),
            (F.col("qtde_pedidos") * F.lit(sign)).alias("qtde_pedidos"),
        )

    return (
        signed(base, 1)
        .unionByName(signed(minus, -1))
        .unionByName(signed(plus, 1))
        .groupBy(*groups)
        .agg(
            F.sum("total_vendas").cast("decimal(38,2)").alias("total_vendas"),
            F.sum("qtde_pedidos").alias("qtde_pedidos"),
        )
        .filter("qtde_pedidos <> 0")
    )


def asof_commission(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    order_key: str,
    ts: str,
    amount: str,
    tier: str = "tier",
    rates: Mapping[str, str] = TIER_RATES,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Per order, the tier valid when it was placed and the commission due; unmatched orders are left out."""
    facts = fact.select(order_key, key, ts, money(amount).alias(amount))
    versions = dim.select(key, "__START_AT", "__END_AT", F.col(tier).alias("tier_no_momento_do_pedido"))
    matched = as_of_join(facts, versions, key, ts, rows_per_task=rows_per_task)
    due: Column = F.col(amount) * rate_lookup("tier_no_momento_do_pedido", rates)
    return matched.select(
        order_key, key, ts, amount, "tier_no_momento_do_pedido", due.cast("decimal(24,6)").alias("comissao_devida")
    )


def refresh_asof(
    report: DataFrame,
    fact: DataFrame,
    dim: DataFrame,
    touched_orders: DataFrame,
    touched_reps: DataFrame,
    key: str,
    order_key: str,
    ts: str,
    **commission,
) -> DataFrame:
    """The commission report after orders or dimension rows changed.

    ``touched_reps`` holds the key and ``since``, the earliest instant whose attribution may
    differ: orders of the rep before it are left alone, so a promotion of a rep with a long
    history recomputes only its recent orders.
    """
    orders = touched_orders.select(order_key).distinct()
    since = touched_reps.groupBy(key).agg(F.min("since").alias("_since"))

    def affected(df: DataFrame) -> DataFrame:
        marked = df.join(since, key, "left").join(
            orders.withColumn("_hit", F.lit(True)), order_key, "left"
        )
        return marked.withColumn(
            "_redo",
            F.coalesce(F.col("_hit"), F.lit(False)) | F.coalesce(F.col(ts) >= F.col("_since"), F.lit(False)),
        ).drop("_since", "_hit")

    kept = affected(report).filter(~F.col("_redo")).drop("_redo")
    redo = affected(fact).filter("_redo").drop("_redo")
    again = asof_commission(redo, dim, key, order_key, ts, **commission)
    return kept.unionByName(again.select(*kept.columns))
