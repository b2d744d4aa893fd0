"""Stored tables that follow changes: parts, snapshots, file ledgers, grants and policies, and the two reports."""

from __future__ import annotations

import random
import shutil
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.changes import CHANGE, snapshot_diff
from tidemark.operators.governance import GrantTable, PolicyTable
from tidemark.operators.quality import expect_or_drop
from tidemark.plans.maintained import SalesReports
from tidemark.plans.reports import asof_commission, rep_months, sales_rollup
from tidemark.runtime import Files
from tidemark.sources.files import BronzeTable, ingest_files, rescue_misfits, stream_table
from tidemark.sources.ledger import FileLedger
from tidemark.sources.parts import PartTable
from tidemark.sources.snapshots import SnapshotTable
from tidemark.sources.tables import replace_partitions
from tidemark.streaming.flows import SOURCE, scd1_runs, scd2_runs, stream_expect, stream_scd


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))


# --- parts ---


def dated(spark, n, seed=1):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["a:b", "c/d", "", None]), rng.choice([None, *[date(2024, m, d) for m in range(1, 13) for d in (1, 15, 28)]])) for i in range(n)]
    return spark.createDataFrame(rows, "id int, what string, day date"), rows


@pytest.mark.parametrize("split", ["date_format(day, 'yyyy-MM')", "what", "CAST(NULL AS STRING)"])
def test_ranges_replaced_in_any_layout(spark, root, split):
    df, rows = dated(spark, 200)
    table = PartTable(spark, f"{root}/t", "day", split)
    table.append(df)
    other, new = dated(spark, 150, 2)
    ranges = [(date(2024, 3, 10), date(2024, 6, 1)), (None, date(2024, 2, 1)), (date(2024, 11, 20), None), (date(2030, 1, 1), None)]
    for low, high in ranges:
        inside = lambda r: r[2] is not None and (low is None or r[2] >= low) and (high is None or r[2] < high)
        rows = [r for r in rows if not inside(r)] + [r for r in new if inside(r)]
        table.replace_range(other, date(1990, 1, 1), date(1990, 2, 1), override=(low, high))
        assert got(table.read()) == sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))
        assert table.read(low, high).count() == sum(map(inside, rows))
    assert len(Files(spark).list(f"{root}/t/_commits")) <= 4
    with pytest.raises(ValueError):
        table.replace_range(other)


def test_parts_beside_and_within_the_range_are_not_read(spark, root):
    """Their files are taken away: the replacement needs neither."""
    table = PartTable(spark, f"{root}/t", "day", "date_format(day, 'yyyy-MM')")
    df = spark.createDataFrame([(m, date(2024, m, d)) for m in range(1, 13) for d in (1, 15)], "id int, day date")
    table.append(df)
    for part in table.parts():
        if not part["folder"].endswith(("2024-03", "2024-07")):
            for f in Files(spark).list(f"{root}/t/{part['folder']}"):
                Files(spark).delete(f"{root}/t/{part['folder']}/{f}")
    table.replace_range(df.withColumn("id", -F.col("id")), date(2024, 3, 10), date(2024, 7, 10))
    kept = [p["folder"].split("=")[-1] for p in table.parts() if p["folder"].startswith("gen=0")]
    assert kept == ["2024-01", "2024-02", "2024-08", "2024-09", "2024-10", "2024-11", "2024-12"]
    fresh = [p["folder"] for p in table.parts() if p["folder"].startswith("gen=1")]
    assert [f.split("=")[-1] for f in fresh] == ["2024-03", "2024-04", "2024-05", "2024-06", "2024-07"]
    assert got(table.read(date(2024, 3, 1), date(2024, 4, 1)).select("id")) == [(-3,), (3,)]


def test_emptied_partitions_with_any_name_go(spark, root):
    df = spark.createDataFrame([(1, "a:b"), (2, None), (3, "c d"), (4, "x")], "id int, p string")
    df.write.partitionBy("p").parquet(f"{root}/t")
    replace_partitions(df.filter("id = 3").withColumn("id", F.lit(30)), f"{root}/t", "p", emptied=["a:b", None, "c d"])
    assert got(spark.read.parquet(f"{root}/t")) == [(30, "c d"), (4, "x")]


# --- snapshots ---


def test_only_changed_buckets_are_compared(spark, root, monkeypatch):
    table = SnapshotTable(spark, f"{root}/s", ["k"], bucket_bytes=40_000)
    first = spark.range(20_000).select(F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("v"), F.lit(None).cast("int").alias("w"))
    table.sync(first, f"{root}/feed")
    k = F.col("k")
    second = first.filter("k <> 77").withColumn("v", F.when(k.isin(5, 900), "new").otherwise(F.col("v")))
    second = second.withColumn("w", F.when(k == 12, 0)).unionByName(first.filter("k < 3").withColumn("k", k + 50_000))
    seen = {}
    kept = table.rows.in_buckets

    def counted(*args):
        seen["old"] = kept(*args)
        return seen["old"]

    monkeypatch.setattr(table.rows, "in_buckets", counted)
    diff, _, _ = table.changes(second)
    want = snapshot_diff(first, second, ["k"], 1)
    assert got(diff) == got(want) and diff.count() == 3 * 2 + 1 + 3
    assert seen["old"].count() < 20_000 / 100
    table.sync(second, f"{root}/feed")
    assert got(table.read().select(*second.columns)) == got(second)
    assert table.changes(second.repartition(7))[0].isEmpty()
    wide = second.withColumn("x", F.lit(1))
    table.sync(wide, f"{root}/feed")
    assert got(table.read().select(*wide.columns)) == got(wide) and table.changes(wide)[0].isEmpty()
    assert spark.read.parquet(f"{root}/feed/version=2").filter(F.col(CHANGE) == "update_postimage").count() == wide.count()


# --- files ---


def test_ledger_looks_names_up_for_other_streams_only(spark, root, monkeypatch):
    ledger = FileLedger(spark, f"{root}/ledger")
    names = lambda *n: spark.createDataFrame([(x,) for x in n], "file string")
    assert got(ledger.missing(names("a", "b", "a"), "one")) == [("a",), ("b",)]
    ledger.add(names("a", "b"), "one", 0)
    monkeypatch.setattr(ledger.table, "near", lambda *_: pytest.fail("its own stream never brings a file twice"))
    assert got(ledger.missing(names("c"), "one")) == [("c",)]
    monkeypatch.undo()
    assert got(ledger.missing(names("a", "c"), "two")) == [("c",)]
    ledger.add(names("c"), "two", 0)
    assert ledger.has("one", 0) and ledger.has("two", 0) and not ledger.has("one", 1)


def test_a_job_that_ended_before_it_told_the_ledger(spark, root):
    df = spark.createDataFrame([(1, 5), (2, 6)], "id int, v int")
    df.coalesce(1).write.mode("append").parquet(f"{root}/landing")
    rules = [expect_or_drop("positive", "v > 0")]

    def run(checkpoint):
        stream = stream_table(spark, f"{root}/landing", df.schema).withColumn(SOURCE, F.col("_metadata.file_path"))
        return stream_expect(stream, rules, f"{root}/silver", f"{root}/{checkpoint}", source=SOURCE)

    assert run("one") == [{"_rows": 2, "positive": 0}]
    shutil.rmtree(f"{root}/silver/_ledger")
    spark.createDataFrame([(3, 7), (4, -7)], df.schema).coalesce(1).write.mode("append").parquet(f"{root}/landing")
    assert run("two") == [{"_rows": 2, "positive": 1}]
    assert got(spark.read.schema(df.schema).parquet(f"{root}/silver/batch=*")) == [(1, 5), (2, 6), (3, 7)]
    assert run("two") == [] and run("three") == [{"_rows": 0, "positive": 0}]

    for checkpoint in ("a", "b"):
        bronze = ingest_files(spark, f"{root}/landing", f"{root}/bronze", f"{root}/cp-{checkpoint}")
        if checkpoint == "a":
            shutil.rmtree(f"{root}/bronze/_ledger")
    assert bronze.read().count() == 4 and BronzeTable(spark, f"{root}/bronze").batches() == [0]


@pytest.mark.parametrize(
    "kind,kept,lost",
    [
        ("decimal(18,2)", ["1.23", "+01.230", " -5 ", ".5", "7."], ["1.234", "1e3", "x", "0.001"]),
        ("int", ["7", "-007", "+3"], ["1.5", "99999999999", ""]),
        ("date", ["2025-01-01", "2025-01-01 00:00:00", "2025-01-01T00:00:00"], ["2025-01-01 10:00:00", "2025-13-01"]),
        ("timestamp_ntz", ["2025-01-01 10:00:00.123456", "2025-01-01", "2025-01-01 10:00:00.1000000"], ["2025-01-01 10:00:00.1234567", "2025-01-01T10:00:00Z", "2025-01-01 10:00:00+03:00"]),
        ("timestamp", ["2025-01-01T10:00:00Z", "2025-01-01 10:00:00.5"], ["2025-01-01 10:00:00.1234567"]),
        ("double", ["1.5", "1e300"], ["one"]),
    ],
)
def test_text_is_cast_without_loss_or_rescued(spark, kind, kept, lost):
    df = spark.createDataFrame([(x,) for x in [*kept, *lost, None]], "v string")
    out = rescue_misfits(df, T.StructType.fromDDL(f"v {kind}")).collect()
    assert all(r.v is not None and r._rescued_data is None for r in out[: len(kept)]), out
    assert all(r.v is None and r._rescued_data is not None for r in out[len(kept) : -1]), out
    assert out[-1].v is None and out[-1]._rescued_data is None


# --- grants and policies ---


def test_grants_and_policies_are_followed_on_read(spark, root):
    grants = GrantTable(spark, f"{root}/grants")
    policies = PolicyTable(spark, f"{root}/policies", grants)
    df = spark.createDataFrame([(1, "S", "111", 9.5), (2, "N", "222", 8.5)], "id int, regiao string, cpf string, pay double")
    assert got(policies.read("reps", df, "u")) == got(df)
    policies.set_filter("reps", "regiao").set_mask("reps", "cpf", shown="*").set_mask("reps", "pay", by="cpf", shown="0")
    assert got(policies.read("reps", df, "u")) == []
    grants.grant([("u", "S", None), ("u", "N", "222"), ("u", "S", None), ("v", "S", "111")])
    assert got(policies.read("reps", df, "u")) == [(1, "S", "*", 0.0), (2, "N", "222", 8.5)]
    grants.revoke([("u", "S", None), ("nobody", "S", None)])
    assert got(policies.read("reps", df, "u")) == [(2, "N", "222", 8.5)]
    policies.drop_filter("reps", "regiao").drop_mask("reps", "pay").drop_mask("reps", "pay")
    assert got(policies.read("reps", df, "u")) == [(1, "S", "*", 9.5), (2, "N", "222", 8.5)]
    grants.reset([("admin", "S", "111")])
    assert got(grants.read()) == [("admin", "S", "111")]
    assert got(policies.read("reps", df, "u")) == [(1, "S", "*", 9.5), (2, "N", "*", 8.5)]
    assert got(policies.read("other", df, "u")) == got(df)
    with pytest.raises(ValueError, match="not there"):
        policies.set_filter("reps", "gone").read("reps", df, "u")
    assert got(policies.drop_filter("reps", "gone").read("reps", df).select("cpf")) == [("*",), ("*",)]  # the session's own user


# --- reports ---

ORDER = "id int, rep int, at timestamp_ntz, amount double, status string, updated timestamp_ntz"
REP = "rep int, tier string, regiao string, since timestamp_ntz"


def test_reports_follow_changes_removals_and_late_versions(spark, root):
    rng, start = random.Random(6), datetime(2024, 1, 1)
    when = lambda: start + timedelta(hours=rng.randrange(24 * 150))
    fact, dim = scd1_runs(spark, f"{root}/fact", ["id"], "updated"), scd2_runs(spark, f"{root}/dim", ["rep"])
    feeds = (f"{root}/feeds/fact", f"{root}/feeds/dim")
    reports = SalesReports(spark, f"{root}/reports", fact, dim, feeds, "rep", "id", "at", "amount", ["regiao", "tier"])
    reports.refresh()  # nothing there yet
    held = {}
    for step in range(4):
        orders = []
        for i in rng.sample(range(60), 25):
            status = "gone" if step and rng.random() < 0.2 else "ok"
            orders.append((i, rng.randint(0, 8), when(), float(rng.randint(1, 99)), status, start + timedelta(days=200 + step)))
        reps = [(rng.randint(0, 7), rng.choice(["bronze", "prata"]), rng.choice("SN"), when()) for _ in range(5)]
        held.update({o[0]: o for o in orders})
        for rows, schema, name in ((orders, ORDER, "orders"), (reps, REP, "reps")):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/{name}")
        stream_scd(
            stream_table(spark, f"{root}/orders", T.StructType.fromDDL(ORDER)), fact, 1, "updated", f"{root}/cp-f", delete_when="status = 'gone'", feed=feeds[0]
        )
        if step != 2:
            stream_scd(
                stream_table(spark, f"{root}/reps", T.StructType.fromDDL(REP)), dim, 2, "since", f"{root}/cp-d", track=["tier", "regiao"], feed=feeds[1]
            )
        if step == 1:
            continue  # two batches at once
        reports.refresh()
        now = fact.read()
        assert sorted(r.id for r in now.collect()) == sorted(i for i, o in held.items() if o[4] != "gone")
        months = rep_months(now, "rep", "at", "amount", "id")
        assert got(reports.read_rollup()) == got(sales_rollup(months, dim.read(), "rep", ["regiao", "tier"]))
        want = asof_commission(now, dim.read(), "rep", "id", "at", "amount").drop("at")
        assert got(reports.read_commission().select(*want.columns)) == got(want)
    at = reports.commission.version()
    reports.refresh()  # up to date: nothing is written
    assert reports.commission.version() == at


def test_a_refresh_that_stopped_halfway_is_completed(spark, root, monkeypatch):
    def stopped(*_, **__):
        raise RuntimeError("stopped")

    start = datetime(2024, 1, 1)
    fact, dim = scd1_runs(spark, f"{root}/fact", ["id"], "updated"), scd2_runs(spark, f"{root}/dim", ["rep"])
    feeds = (f"{root}/feeds/fact", f"{root}/feeds/dim")
    reports = SalesReports(spark, f"{root}/reports", fact, dim, feeds, "rep", "id", "at", "amount", ["regiao", "tier"])
    for step in range(2):
        orders = [(i, i % 2, start + timedelta(days=i + 9 * step), 10.0 * (step + 1), "ok", start + timedelta(days=step)) for i in range(10)]
        reps = [(r, "bronze" if r == step else "prata", "S", start + timedelta(days=4 * step)) for r in range(2)]
        for rows, schema, name in ((orders, ORDER, "orders"), (reps, REP, "reps")):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/{name}")
        stream_scd(stream_table(spark, f"{root}/orders", T.StructType.fromDDL(ORDER)), fact, 1, "updated", f"{root}/cp-f", feed=feeds[0])
        stream_scd(stream_table(spark, f"{root}/reps", T.StructType.fromDDL(REP)), dim, 2, "since", f"{root}/cp-d", track=["tier"], feed=feeds[1])
        with monkeypatch.context() as m:
            m.setattr(reports.months, "commit", stopped)
            with pytest.raises(RuntimeError, match="stopped"):
                reports.refresh()
        reports.refresh()
        months = rep_months(fact.read(), "rep", "at", "amount", "id")
        assert got(reports.read_rollup()) == got(sales_rollup(months, dim.read(), "rep", ["regiao", "tier"]))
