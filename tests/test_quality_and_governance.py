from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions.expressions import CPF_MASK, TIER_LADDER, TIER_RATES, money, rate_lookup
from tidemark.operators import audit as A
from tidemark.operators.governance import (
    GRANT_SCHEMA,
    GovernedTable,
    add_grant,
    mask_column,
    mask_tiered,
    member,
    policy,
    reset_grants,
    row_filter,
    row_filter_groups,
    thousands,
    user_like,
)
from tidemark.operators.merge import delete_where
from tidemark.operators.projection import project_typed, select_except
from tidemark.operators.quality import (
    ExpectationFailed,
    apply_expectations,
    expect,
    expect_or_drop,
    expect_or_fail,
    expectation_report,
    write_checked,
)
from tidemark.operators.summaries import amount_stats, shares_vs_target, value_counts
from tidemark.runtime import Files, scratch_path

ME, ADMIN = "me@example.com", "admin@demo.invalid"
REGIONS = ["Sudeste", "Sul", "Nordeste", "Centro-Oeste", "Norte"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- rates ---


@pytest.mark.parametrize("tier,rate", [*TIER_RATES.items(), ("platina", None), (None, None)])
def test_rates(spark, tier, rate):
    df = spark.createDataFrame([(tier,)], "tier string").select(rate_lookup("tier").alias("r"))
    assert df.schema["r"].dataType.simpleString() == "decimal(5,4)"
    assert df.first().r == (Decimal(rate) if rate else None)


def test_product_of_money_and_rate_keeps_six_decimals(spark):
    df = spark.sql("SELECT CAST(10.33 AS DECIMAL(18,2)) AS v, 'ouro' AS t")
    assert df.select((F.col("v") * rate_lookup("t")).alias("d")).schema["d"].dataType.simpleString() == "decimal(24,6)"


# --- expectations ---


def test_rules_see_the_output_row_and_null_violates(spark):
    raw = spark.createDataFrame([(1, 0.004), (2, 0.006), (3, -1.0), (4, None)], "id int, valor_total double")
    typed = select_except(raw, valor_total=money("valor_total"))
    kept = apply_expectations(typed, [expect_or_drop("positive", "valor_total > 0")])
    assert [r.id for r in kept.collect()] == [2]


def test_report_counts_every_rule(spark):
    df = spark.createDataFrame([(1, "12345678901", None, True), (2, "ABC123XX99", "e", True)], "id int, cpf string, email string, ativo boolean")
    rules = [
        expect_or_fail("pk", "id IS NOT NULL"),
        expect_or_drop("cpf", "cpf RLIKE '^[0-9]{11}$'"),
        expect("email", "email IS NOT NULL OR ativo = FALSE"),
    ]
    assert rows(expectation_report(df, rules)) == [("cpf", "drop", 1, 1), ("email", "warn", 1, 1), ("pk", "fail", 2, 0)]
    assert [r.id for r in apply_expectations(df, rules).collect()] == [1]


def test_fail_rule_beats_drop_rule_on_the_same_row(spark):
    df = spark.createDataFrame([(None, "bad"), (1, "ok")], "id int, v string")
    rules = [expect_or_drop("v", "v = 'ok'"), expect_or_fail("pk", "id IS NOT NULL")]
    with pytest.raises(ExpectationFailed, match="pk"):
        apply_expectations(df, rules)


def test_checked_write_is_all_or_nothing(spark):
    root, files = scratch_path(spark, "test-checked"), Files(spark)
    df = spark.createDataFrame([(1, 5), (2, -5), (None, 7)], "id int, v int")
    rules = [expect_or_fail("pk", "id IS NOT NULL"), expect_or_drop("positive", "v > 0")]
    with pytest.raises(ExpectationFailed):
        write_checked(df, rules, f"{root}/batch=0")
    assert not files.exists(f"{root}/batch=0")
    counts = write_checked(df.filter("id IS NOT NULL"), rules, f"{root}/batch=0")
    assert counts == {"_rows": 2, "pk": 0, "positive": 1}
    assert rows(spark.read.parquet(f"{root}/batch=0")) == [(1, 5)]


def test_projections(spark):
    df = spark.createDataFrame([(1, 2.5, "x", "new")], "id int, v double, junk string, added string")
    assert select_except(df, drop=["junk"], v=money("v")).columns == ["id", "added", "v"]
    with pytest.raises(ValueError):
        select_except(df, drop=["absent"])
    assert project_typed(df, {"id": "bigint", "junk": None}).dtypes == [("id", "bigint"), ("junk", "string")]
    bad = spark.createDataFrame([("x",)], "id string")
    with pytest.raises(Exception):
        project_typed(bad, {"id": "int"}).collect()


# --- row filters and masks ---


@pytest.fixture
def reps(spark):
    return spark.createDataFrame(
        [(i, f"{i:011d}", r, Decimal("1234.56")) for i, r in enumerate([*REGIONS, "Sudeste", None])],
        "id int, cpf string, regiao string, salario decimal(10,2)",
    )


def grants(spark, *given):
    return spark.createDataFrame(list(given), GRANT_SCHEMA)


def test_no_grant_no_rows(spark, reps):
    assert row_filter(reps, grants(spark, (ADMIN, "Sudeste", None)), ME, "regiao").isEmpty()


def test_only_granted_regions(spark, reps):
    given = grants(spark, (ME, "Sudeste", None), (ME, "Norte", None), (ME, "Norte", None), (ME, None, None))
    assert rows(row_filter(reps, given, ME, "regiao").select("id")) == [(0,), (4,), (5,)]


def test_mask_needs_the_exact_value(spark, reps):
    given = grants(spark, (ME, "Sudeste", "00000000003"), (ME, "Sul", None), (ADMIN, "Sul", "00000000001"))
    shown = mask_column(reps, "cpf", given, ME)
    assert rows(shown.filter(F.col("cpf") != CPF_MASK).select("id", "cpf")) == [(3, "00000000003")]
    assert shown.columns == reps.columns and shown.count() == reps.count()


def test_region_and_cpf_grants_are_independent(spark, reps):
    """The value may be granted by a row of another region."""
    table = GovernedTable(lambda: reps, lambda: grants(spark, (ME, "Sul", None), (ME, "Norte", "00000000001")))
    table.set_filter("regiao").set_mask("cpf")
    assert rows(table.read(ME).select("id", "cpf")) == [(1, "00000000001"), (4, CPF_MASK)]


def test_mask_by_another_masked_column_keeps_type(spark, reps):
    table = GovernedTable(lambda: reps, lambda: grants(spark, (ME, "Sudeste", "00000000005")))
    table.set_filter("regiao").set_mask("cpf").set_mask("salario", by="cpf", masked=F.lit(0))
    out = table.read(ME)
    assert out.schema["salario"].dataType.simpleString() == "decimal(10,2)"
    assert rows(out.select("id", "cpf", "salario")) == [
        (0, CPF_MASK, Decimal("0.00")),
        (5, "00000000005", Decimal("1234.56")),
    ]
    # The user's own predicate sees the masked value.
    assert out.filter(F.col("cpf") == "00000000000").isEmpty()


def test_policies_attach_again_and_detach(spark, reps):
    table = GovernedTable(lambda: reps, lambda: grants(spark, (ME, "Sul", None)))
    for _ in range(2):
        table.set_filter("regiao").set_mask("cpf")
    assert table.read(ME).count() == 1
    table.drop_mask("cpf").drop_mask("cpf").drop_filter()
    assert rows(table.read(ME)) == rows(reps)


def test_grants_take_effect_on_the_next_read(spark, reps):
    path = scratch_path(spark, "test-grants")
    reset_grants(spark, path, [(ADMIN, "Sudeste", None)])
    table = GovernedTable(lambda: reps, lambda: spark.read.parquet(path)).set_filter("regiao").set_mask("cpf")
    assert table.read(ME).isEmpty()
    add_grant(spark, path, (ME, "Sudeste", None))
    assert rows(table.read(ME).select("id", "cpf")) == [(0, CPF_MASK), (5, CPF_MASK)]
    add_grant(spark, path, (ME, "Sudeste", "00000000005"))
    assert rows(table.read(ME).select("id", "cpf")) == [(0, CPF_MASK), (5, "00000000005")]
    assert delete_where(spark.read.parquet(path), F.col("email") == ME).count() == 1
    reset_grants(spark, path, [(ADMIN, "Sudeste", None)])
    assert table.read(ME).isEmpty() and spark.read.parquet(path).count() == 1


def test_groups_and_tiers(spark, reps):
    groups = spark.createDataFrame([("fin", "finance_read"), ("boss", "admin"), ("sul", "Sul"), ("sul", None)], "email string, grupo string")
    assert rows(row_filter_groups(reps, groups, "sul", "regiao").select("id")) == [(1,)]
    assert row_filter_groups(reps, groups, "boss", "regiao").count() == reps.count()
    assert row_filter_groups(reps, groups, "nobody", "regiao").isEmpty()

    def salary(user):
        rules = [(member(groups, user, "admin"), F.col("salario")), (member(groups, user, "finance_read"), thousands("salario"))]
        return mask_tiered(reps, "salario", rules).select("salario").distinct().collect()[0][0]

    assert [salary(u) for u in ("boss", "fin", "sul")] == [Decimal("1234.56"), Decimal("1000.00"), Decimal("0.00")]
    allowed = member(groups, "sul", "admin") | (member(groups, "sul", "Sul") & user_like("sul", "s%") & (F.col("regiao") == "Norte"))
    assert rows(policy(reps, allowed).select("id")) == [(4,)]


# --- summaries and audits ---


@pytest.mark.parametrize("values", [[5], [3, 1, 2], [4, 1, 3, 2], [7] * 9 + [1], list(range(999, 0, -1))])
def test_median_is_the_element_at_half(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    s = sorted(values)
    assert rows(amount_stats(df, "v")) == [(len(s), s[0], s[len(s) // 2], s[-1])]


@pytest.mark.parametrize("bins", [1 << 16, 5])
def test_median_narrows_in_steps(spark, monkeypatch, bins):
    from tidemark.operators import summaries

    monkeypatch.setattr(summaries, "BINS", bins)
    df = spark.range(200_000).select(((F.col("id") * 7919) % 200_003).alias("v"))
    want = sorted((i * 7919) % 200_003 for i in range(200_000))[100_000]
    assert amount_stats(df, "v").first().median == want


@pytest.mark.parametrize(
    "kind,values",
    [
        ("double", [1e300, -1e300, 0.0, -0.0, 5e-324, -5e-324, 1.5, float("inf"), float("-inf"), 2.5, -7.25]),
        ("float", [1.5, -2.5, 0.25, 2.0**100, -(2.0**-100)]),
        ("bigint", [2**63 - 1, -(2**63), 0, 5, -5, 7]),
        ("decimal(38,4)", [Decimal("9" * 34), Decimal("-" + "9" * 34), Decimal("0.0001"), Decimal("0.0002"), Decimal("-1")]),
        ("decimal(18,2)", [Decimal("9" * 16 + ".99"), Decimal("-0.01"), Decimal("0.01"), Decimal("5.00")]),
        ("date", [date(1500, 1, 1), date(2024, 2, 29), date(1969, 12, 31), date(9999, 12, 31)]),
        ("timestamp_ntz", [datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(2024, 1, 1), datetime(1, 1, 1), datetime(2024, 1, 1, 0, 0, 0, 1)]),
    ],
)
def test_median_of_every_type(spark, monkeypatch, kind, values):
    from tidemark.operators import summaries

    monkeypatch.setattr(summaries, "BINS", 300)
    for n in range(1, len(values) + 1):
        if n not in (1, 2, len(values) - 1, len(values)):
            continue
        part = values[:n]
        df = spark.createDataFrame([(v,) for v in [*part, None]], f"v {kind}")
        s = sorted(part)
        assert tuple(amount_stats(df, "v").first()) == (n, s[0], s[n // 2], s[-1])


def test_median_of_nothing(spark):
    assert amount_stats(spark.createDataFrame([], "v int"), "v").first().n == 0


def test_counts_and_shares(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("z",)], "v string")
    assert [tuple(r) for r in value_counts(df, "v").collect()] == [("a", 2), (None, 1), ("z", 1)]
    out = {r.v: (r.n, r.within) for r in shares_vs_target(df, "v", {"a": 0.5, "b": 0.1}, 0.05).collect()}
    assert out == {"a": (2, True), "b": (0, False), None: (2, False)}


def test_failed_checks_are_rows_and_can_raise(spark):
    dim = spark.createDataFrame(
        [(1, 1, 5), (1, 4, None), (2, 1, None), (2, 3, None)], "k int, __START_AT int, __END_AT int"
    )
    report = A.audit(
        dim,
        [A.row_count(4), A.unique(["k"]), A.one_open_row(["k"]), A.windows_disjoint(["k"]), A.in_domain("k", [1])],
    )
    assert {r.check: (r.observed, r.passed) for r in report.collect()} == {
        "row_count": ("4", True),
        "unique:k": ("2", False),
        "one_open_row:k": ("1", False),
        "windows_disjoint:k": ("2", False),
        "domain:k": ("2", False),
    }
    with pytest.raises(AssertionError, match="unique:k"):
        A.require_passed(report)


def test_contracts_and_content(spark, reps):
    contract = A.schema_contract(reps, {"id": "int", "cpf": "int"}, absent=["canal_origem", "id"])
    assert {r.check: r.passed for r in contract.collect()} == {
        "column:id": True,
        "column:cpf": False,
        "no_column:canal_origem": True,
        "no_column:id": False,
    }
    same = A.audit(reps, [A.same_content("same", reps.repartition(5).select(*reversed(reps.columns)))])
    other = A.audit(reps, [A.same_content("same", reps.withColumn("id", F.col("id") + 1))])
    assert same.first().passed and not other.first().passed
    rates = {"semente": "0.02", "bronze": "0.03", "prata": "0.03", "ouro": "0.08", "diamante": "0.12"}
    assert not A.rates_increase(spark, rates, TIER_LADDER).first().passed
