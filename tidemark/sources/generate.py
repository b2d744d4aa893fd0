"""Deterministic synthetic data with planted defects, generated by Spark jobs.

Every value depends on the seed and the row's id only, so the same seed gives the same rows
on any number of tasks, and a million files cost no more coordination than one.
"""

from __future__ import annotations

from datetime import date, timedelta
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.expressions import (
    cpf_from_base,
    draw,
    draw_below,
    lognormal,
    uniform,
    weighted_pick,
)

# The contracts of the generated data.
HERO_ID, HERO_BEFORE, HERO_AFTER = 42, "bronze", "prata"
HERO_CHANGE = date(2026, 2, 1)
HERO_ORDERS = 24
MALFORMED_ID, MALFORMED_CPF = 7, "ABC123XX99"
REPS, ORDERS, ORDERS_PER_FILE = 500, 50_000, 1_000
NEGATIVE_AMOUNTS, FUTURE_DATES, FUTURE_YEAR = 5, 3, 2099
WINDOW_DAYS = 24 * 30
AMOUNT_MU, AMOUNT_SIGMA = 5.5, 0.8
ACTIVE_SHARE = 0.97
CADASTRO_DAYS = 3 * 365
REP_TODAY = date(2026, 5, 8)
HERO_CADASTRO, PINNED_CADASTRO = date(2024, 1, 15), date(2025, 9, 1)
EVOLVED_FIRST_ID, EVOLVED_ROWS, EVOLVED_SEED = 1_000_000, 100, 909
TIER_SHARES = {"semente": 0.40, "bronze": 0.30, "prata": 0.18, "ouro": 0.10, "diamante": 0.02}
STATUS_SHARES = {"entregue": 0.70, "enviado": 0.15, "confirmado": 0.08, "cancelado": 0.05, "criado": 0.02}
PAYMENT_SHARES = {"pix": 0.50, "cartao": 0.30, "boleto": 0.20}
CHANNEL_SHARES = {"app": 0.60, "web": 0.30, "whatsapp": 0.10}
REGIONS = ("Sudeste", "Sul", "Nordeste", "Centro-Oeste", "Norte")

FIRST_NAMES = ("Ana", "Beatriz", "Camila", "Débora", "Estela", "Flávia", "Glória", "Íris", "Júlia", "Conceição")
LAST_NAMES = ("Silva", "Souza", "Costa", "Santos", "Oliveira", "Pereira", "Rodrigues", "Almeida", "Lima", "Gomes")


def _plus_days(day: date, days: Column) -> Column:
    return F.date_add(F.lit(day), days.cast("int")).cast("timestamp_ntz")


def _plus_hours(at: Column, hours: Column) -> Column:
    return at + F.make_dt_interval(F.lit(0), hours.cast("int"))


def _one_of(names, picked: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (picked + 1).cast("int"))


def _order_ids(spark: SparkSession, first: int, n: int) -> DataFrame:
    return spark.range(first, first + n).select(F.col("id").alias("pedido_id"))


def hero_day(order: Column, seed: int, today: date) -> Column:
    """The day of the hero's order number ``order`` (from 1): half lie before the tier change, half after it.

    Each side is cut into equal stretches of days, and every order takes one day of its own stretch, so that
    no two fall on one day. A side too short for that reaches beyond the window.
    """
    half = HERO_ORDERS // 2
    earlier = order <= half
    slot = F.when(earlier, order - 1).otherwise(order - 1 - half)

    def days(side: int, count: int, purpose: str) -> Column:
        stretch = max(1, side // count)
        return slot * stretch + draw_below(stretch, seed, purpose, order) + 1

    opened = today - timedelta(days=WINDOW_DAYS)
    back = days((HERO_CHANGE - opened).days, half, "hero, earlier")
    ahead = days((today - HERO_CHANGE).days, HERO_ORDERS - half, "hero, later")
    return _plus_days(HERO_CHANGE, F.when(earlier, -back).otherwise(ahead))


def _ordinary(ids: DataFrame, seed: int, today: date, pool: int) -> DataFrame:
    """Orders without planted rows, before ``updated_at``. Each draw is computed once per row."""
    i = F.col("pedido_id")
    start = today - timedelta(days=WINDOW_DAYS)
    draws = ids.select(
        i, uniform(seed, "status", i).alias("_status"), uniform(seed, "payment", i).alias("_payment")
    )
    return draws.select(
        i,
        (draw_below(pool, seed, "rep", i) + 1).cast("int").alias("consultora_id"),
        _plus_days(start, draw_below(WINDOW_DAYS, seed, "day", i)).alias("data_pedido"),
        lognormal(AMOUNT_MU, AMOUNT_SIGMA, seed, "amount", i).alias("valor_total"),
        weighted_pick(F.col("_status"), STATUS_SHARES).alias("status"),
        weighted_pick(F.col("_payment"), PAYMENT_SHARES).alias("forma_pagamento"),
    )


def _touched(orders: DataFrame, seed: int) -> DataFrame:
    """``updated_at`` lies 0 to 71 hours after the order."""
    hours = draw_below(72, seed, "hours", F.col("pedido_id"))
    return orders.withColumn("updated_at", _plus_hours(F.col("data_pedido"), hours))


def generate_orders(
    spark: SparkSession,
    n: int = ORDERS,
    seed: int = 42,
    today: date | None = None,
    pool: int = REPS,
    ids: DataFrame | None = None,
) -> DataFrame:
    """``n`` orders: the hero's straddle the tier change, the last eight are defective.

    ``ids`` (column ``pedido_id``, 1 to n) may come from a table instead of a range.
    """
    today = today or date.today()
    planted = HERO_ORDERS + NEGATIVE_AMOUNTS + FUTURE_DATES
    if n <= 0:
        raise ValueError("n must be positive")
    if pool < HERO_ID:
        raise ValueError(f"the pool must hold rep {HERO_ID}")
    if n < planted:
        raise ValueError(f"{n} orders cannot hold {planted} planted ones")
    base = _ordinary(ids if ids is not None else _order_ids(spark, 1, n), seed, today, pool)

    i = F.col("pedido_id")
    hero = i <= HERO_ORDERS
    negative = (i > n - NEGATIVE_AMOUNTS - FUTURE_DATES) & (i <= n - FUTURE_DATES)
    future = i > n - FUTURE_DATES

    placed = (
        F.when(hero, hero_day(i, seed, today))
        .when(future, _plus_days(date(FUTURE_YEAR, 1, 1), draw_below(365, seed, "future", i)))
        .otherwise(F.col("data_pedido"))
    )
    orders = base.select(
        i,
        F.when(hero, F.lit(HERO_ID)).otherwise(F.col("consultora_id")).alias("consultora_id"),
        placed.alias("data_pedido"),
        F.when(negative, F.lit(-1.0)).otherwise(F.col("valor_total")).alias("valor_total"),
        F.when(hero, F.lit("entregue")).otherwise(F.col("status")).alias("status"),
        F.when(hero, F.lit("pix")).otherwise(F.col("forma_pagamento")).alias("forma_pagamento"),
    )
    return _touched(orders, seed)


def generate_evolved_orders(
    spark: SparkSession,
    n: int = EVOLVED_ROWS,
    seed: int = EVOLVED_SEED,
    today: date | None = None,
    first_id: int = EVOLVED_FIRST_ID,
    pool: int = REPS,
    ids: DataFrame | None = None,
) -> DataFrame:
    """Orders with the extra column ``canal_origem`` and no defects."""
    if n <= 0:
        raise ValueError("n must be positive")
    base = _ordinary(ids if ids is not None else _order_ids(spark, first_id, n), seed, today or date.today(), pool)
    drawn = _touched(base, seed).withColumn("_channel", uniform(seed, "channel", F.col("pedido_id")))
    return drawn.withColumn("canal_origem", weighted_pick(F.col("_channel"), CHANNEL_SHARES)).drop("_channel")


def hash_rank(df: DataFrame, seed: int, purpose: str, key: str, name: str) -> DataFrame:
    """Add a global rank (from 1) in hash order without sorting everything in one task.

    Rows are ranked within 4,096 hash ranges; the ranges' counts give each its offset.
    """
    tagged = df.withColumn("_h", draw(seed, purpose, key)).withColumn("_range", F.floor(F.col("_h") / F.lit(2**40)))
    sizes = tagged.groupBy("_range").count()
    before = F.sum("count").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_offset"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy("_h", key))
    return (
        tagged.withColumn("_rank", within)
        .join(F.broadcast(offsets), "_range")
        .withColumn(name, F.col("_rank") + F.col("_offset"))
        .drop("_h", "_range", "_rank", "_offset")
    )


def tier_quotas(n: int) -> dict[str, int]:
    """Rows per tier for exactly ``n`` reps: whole shares, then one each by largest remainder, earlier tiers first."""
    exact = {t: Fraction(str(share)) * n for t, share in TIER_SHARES.items()}
    quotas = {t: int(x) for t, x in exact.items()}
    by_remainder = sorted(exact, key=lambda t: quotas[t] - exact[t])
    for t in by_remainder[: n - sum(quotas.values())]:
        quotas[t] += 1
    return quotas


def generate_reps(
    spark: SparkSession, n: int = REPS, seed: int = 42, ids: DataFrame | None = None
) -> DataFrame:
    """``n`` reps with exact tier quotas in shuffled order and one malformed CPF.

    ``ids`` (column ``consultora_id``, 1 to n) may come from a table instead of a range.
    """
    if n < HERO_ID:
        raise ValueError(f"the pool must hold rep {HERO_ID}")
    if ids is None:
        ids = spark.range(1, n + 1).select(F.col("id").cast("int").alias("consultora_id"))
    i = F.col("consultora_id")
    ranked = hash_rank(ids, seed, "tier", "consultora_id", "_place")

    tier, reached = None, 0
    for name, quota in tier_quotas(n).items():
        reached += quota
        hit = F.col("_place") <= reached
        tier = F.when(hit, F.lit(name)) if tier is None else tier.when(hit, F.lit(name))

    first = _one_of(FIRST_NAMES, draw_below(len(FIRST_NAMES), seed, "first name", i))
    last = _one_of(LAST_NAMES, draw_below(len(LAST_NAMES), seed, "last name", i))
    plain = F.translate(F.lower(F.split("nome", " ").getItem(0)), "ãáéíóúç", "aaeiouc")
    digits = F.lpad((draw(seed, "cpf", i) % F.lit(10**9)).cast("string"), 9, "0")
    joined = (
        F.when(i == HERO_ID, F.lit(HERO_CADASTRO).cast("timestamp_ntz"))
        .when((i % 10 == 0) & (i != MALFORMED_ID), F.lit(PINNED_CADASTRO).cast("timestamp_ntz"))
        .otherwise(_plus_days(REP_TODAY, -draw_below(CADASTRO_DAYS + 1, seed, "joined", i)))
    )
    named = ranked.select(
        i, "_place", digits.alias("_digits"), F.concat_ws(" ", first, last).alias("nome"), joined.alias("data_cadastro")
    )
    return named.select(
        i,
        F.when(i == MALFORMED_ID, F.lit(MALFORMED_CPF)).otherwise(cpf_from_base(F.col("_digits"))).alias("cpf"),
        "nome",
        F.concat(plain, F.lit("."), i.cast("string"), F.lit("@example.com.br")).alias("email"),
        _one_of(REGIONS, F.pmod(i - 1, F.lit(len(REGIONS)))).alias("regiao"),
        F.when(i == HERO_ID, F.lit(HERO_BEFORE)).otherwise(tier).alias("tier"),
        "data_cadastro",
        (uniform(seed, "active", i) < ACTIVE_SHARE).alias("ativo"),
        F.col("data_cadastro").alias("updated_at"),
    )
