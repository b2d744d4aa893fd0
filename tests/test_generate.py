"""Contracts of the generated data."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.functions.expressions import CPF_FORMAT, cpf_from_base, cpf_is_valid
from tidemark.operators.audit import fingerprint
from tidemark.plans.direct_sales import promote_reps
from tidemark.sources import generate as G

TODAY = date(2026, 5, 8)


@pytest.fixture(scope="module")
def orders(spark):
    df = G.generate_orders(spark, 5000, today=TODAY).cache()
    yield df
    df.unpersist()


@pytest.fixture(scope="module")
def reps(spark):
    df = G.generate_reps(spark).cache()
    yield df
    df.unpersist()


def content(df):
    return fingerprint(df).first()[0]


def test_order_schema(orders):
    assert orders.dtypes == [
        ("pedido_id", "bigint"),
        ("consultora_id", "int"),
        ("data_pedido", "timestamp_ntz"),
        ("valor_total", "double"),
        ("status", "string"),
        ("forma_pagamento", "string"),
        ("updated_at", "timestamp_ntz"),
    ]


def test_same_seed_same_rows_on_any_layout(spark, orders):
    again = G.generate_orders(spark, 5000, today=TODAY, ids=spark.range(1, 5001, 1, 13).toDF("pedido_id"))
    assert content(again) == content(orders)
    assert content(G.generate_orders(spark, 5000, seed=43, today=TODAY)) != content(orders)


def test_planted_defects(orders):
    assert orders.filter("valor_total = -1.0").count() == 5
    assert orders.filter("year(data_pedido) = 2099").count() == 3
    assert orders.filter("pedido_id <= 4992 AND (valor_total <= 0 OR year(data_pedido) > 2026)").isEmpty()


def test_hero_straddles_the_change(orders):
    hero = orders.filter("consultora_id = 42")
    edge = F.lit(G.HERO_CHANGE)
    assert hero.filter(F.col("data_pedido") < edge).count() >= 12
    assert hero.filter(F.col("data_pedido") >= edge).count() >= 12
    first = orders.filter("pedido_id <= 24")
    assert first.select("data_pedido").distinct().count() == 24
    assert {tuple(r) for r in first.select("status", "forma_pagamento").distinct().collect()} == {("entregue", "pix")}


def test_ranges_and_shares(orders):
    stats = orders.filter("valor_total > 0 AND year(data_pedido) < 2099").agg(
        F.percentile_approx("valor_total", 0.5).alias("median"),
        F.min("data_pedido").alias("first"),
        F.max("data_pedido").alias("last"),
        F.min("consultora_id").alias("low"),
        F.max("consultora_id").alias("high"),
    ).first()
    assert 200 < stats.median < 300
    assert stats.first.date() >= date(2024, 5, 18) and stats.last.date() <= TODAY
    assert (stats.low, stats.high) == (1, 500)
    for column, target in (("status", G.STATUS_SHARES), ("forma_pagamento", G.PAYMENT_SHARES)):
        shares = {r[0]: r[1] / 5000 for r in orders.groupBy(column).count().collect()}
        assert set(shares) == set(target)
        assert all(abs(shares[k] - v) < 0.05 for k, v in target.items())
    lag = orders.select((F.unix_micros(F.col("updated_at").cast("timestamp")) - F.unix_micros(F.col("data_pedido").cast("timestamp"))).alias("d"))
    assert lag.agg(F.min("d"), F.max("d")).first() == (0, 71 * 3600 * 10**6)


def test_evolved_orders(spark):
    df = G.generate_evolved_orders(spark, today=TODAY)
    assert df.count() == 100 and df.columns[-1] == "canal_origem"
    assert df.agg(F.min("pedido_id"), F.max("pedido_id")).first() == (1_000_000, 1_000_099)
    assert {r[0] for r in df.select("canal_origem").distinct().collect()} <= {"app", "web", "whatsapp"}
    assert df.filter("valor_total <= 0 OR data_pedido > '2026-05-08'").isEmpty()


@pytest.mark.parametrize(
    "options", [{"n": 0}, {"n": 31}, {"n": 100, "pool": 41}]
)
def test_bad_arguments(spark, options):
    with pytest.raises(ValueError):
        G.generate_orders(spark, today=TODAY, **options)


def test_other_bad_arguments(spark):
    with pytest.raises(ValueError):
        G.generate_evolved_orders(spark, 0)
    with pytest.raises(ValueError):
        G.generate_reps(spark, 41)


def test_reps(reps):
    assert reps.count() == 500 and reps.select("consultora_id").distinct().count() == 500
    quotas = {r.tier: r["count"] for r in reps.groupBy("tier").count().collect()}
    # Exact quotas, but for the hero, who is moved to bronze whatever the draw.
    want = {"semente": 200, "bronze": 150, "prata": 90, "ouro": 50, "diamante": 10}
    assert sum(abs(quotas[t] - n) for t, n in want.items()) in (0, 2)
    assert all(r["count"] == 100 for r in reps.groupBy("regiao").count().collect())
    hero = reps.filter("consultora_id = 42").first()
    assert hero.tier == "bronze" and hero.data_cadastro.date() == date(2024, 1, 15)
    assert reps.filter(~F.col("cpf").rlike(CPF_FORMAT)).select("consultora_id").collect() == [(7,)]
    assert reps.filter("consultora_id <> 7").filter(~cpf_is_valid("cpf")).isEmpty()
    assert reps.filter("consultora_id % 10 = 0 AND updated_at <> '2025-09-01'").isEmpty()
    assert not reps.filter("email RLIKE '^[a-z]+[.][0-9]+@example[.]com[.]br$'").count() < 500


def test_promotions(reps):
    once = promote_reps(reps)
    moved = once.join(reps.select("consultora_id", F.col("tier").alias("was")), "consultora_id").filter("tier <> was")
    top = reps.filter("tier = 'diamante' AND consultora_id % 10 = 0").count()
    assert moved.count() == 1 + 50 - top
    assert once.filter("consultora_id = 42").first().tier == "prata"
    assert promote_reps(once).exceptAll(once).isEmpty()


def test_known_check_digits(spark):
    df = spark.createDataFrame([("111444777",), ("529982247",)], "b string")
    assert sorted(r[0] for r in df.select(cpf_from_base(F.col("b"))).collect()) == ["11144477735", "52998224725"]
    bad = spark.createDataFrame([("11144477736",), ("1114447773",), (None,)], "c string")
    assert {r[0] for r in bad.select(cpf_is_valid("c")).collect()} == {False}
