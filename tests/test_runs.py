"""Tables of runs: what counts on read, how much is written, which files are read, and the flows on top."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators.scd import END, START, scd1, scd2
from tidemark.runtime import Files
from tidemark.sources import runs
from tidemark.sources.files import stream_table
from tidemark.sources.runs import GONE, GROUP, LATEST, NEWEST, SUM, RunTable
from tidemark.streaming.flows import append_flow, merge_sink, read_feed, scd1_runs, scd2_runs, stream_scd


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))


SCHEMA = "k int, v int, at int"


def batches_of(rng, n, keys, many=False):
    for _ in range(n):
        rows = {}
        for _ in range(rng.randint(1, 12)):
            k = rng.choice([None, *range(keys)])
            rows.setdefault(k, []).append((k, rng.randint(0, 9), rng.randint(0, 30)))
        yield [r for v in rows.values() for r in (v if many else v[:1])], rng.choice([*rows])


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))


@pytest.mark.parametrize("rule", [NEWEST, LATEST, GROUP, SUM])
def test_rules_against_plain_python(spark, root, monkeypatch, rule):
    monkeypatch.setattr(runs, "FAN", 3)
    rng, want = random.Random(rule), {}
    table = RunTable(spark, f"{root}/t", ["k"], rule, "at" if rule == LATEST else None, bucket_bytes=2000)
    for rows, gone in batches_of(rng, 9, 12, rule == GROUP):
        df = spark.createDataFrame(rows, SCHEMA)
        if rule != SUM:
            df = df.withColumn(GONE, F.col("k").eqNullSafe(F.lit(gone)) & F.lit(rule != GROUP))
        table.commit(df)
        for k in {r[0] for r in rows}:
            mine = [r for r in rows if r[0] == k]
            hidden = rule not in (GROUP, SUM) and k == gone
            if rule == GROUP:
                want[k] = mine
            elif rule == NEWEST:
                want[k] = [] if hidden else mine
            elif rule == LATEST:
                new = ((mine[0][2], mine[0][1], hidden), mine[0])
                want[k] = max(want.get(k, new), new, key=lambda x: x[0])
            else:
                old = want.get(k, [(k, 0, 0)])[0]
                want[k] = [(k, old[1] + mine[0][1], old[2] + mine[0][2])]
        flat = [v[1] for v in want.values() if not v[0][2]] if rule == LATEST else [r for v in want.values() for r in v]
        assert got(table.read()) == ordered(flat)
    assert table.version() == 8


def test_a_batch_again_changes_nothing_and_new_columns_come_in(spark, root):
    table = RunTable(spark, f"{root}/t", ["k"])
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    with pytest.raises(FileNotFoundError):
        table.read()
    for _ in range(6):
        table.commit(first)
    assert got(table.read()) == [(1, "a"), (2, "b")]
    table.commit(spark.createDataFrame([(2, "c", True)], "k int, v string, w boolean"))
    assert got(table.read()) == [(1, "a", None), (2, "c", True)]
    with pytest.raises(ValueError):
        RunTable(spark, f"{root}/t", ["k"], LATEST)


def test_twenty_small_batches_cost_what_they_bring(spark, root):
    """A table of 40,000 rows, then 20 batches of 100 keys: the large run is never written again, and folders stay few."""
    table = RunTable(spark, f"{root}/t", ["k"])
    table.commit(spark.range(40_000).select(F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("v")))
    files, seen, written = Files(spark), {}, 0
    large = {r["name"]: r["bytes"] for r in table._head()["rows"]}
    most = 0
    for i in range(20):
        table.commit(spark.range(100).select((F.col("id") * 397 + i).alias("k"), F.lit(f"n{i}").alias("v")))
        for r in table._head()["rows"]:
            if r["name"] not in seen and r["name"] not in large:
                seen[r["name"]] = r["bytes"]
        most = max(most, table.folders())
    assert set(large) <= {r["name"] for r in table._head()["rows"]}
    batch = min(seen.values())
    assert sum(seen.values()) < 20 * batch * 6 < sum(large.values()) + 20 * batch * 6
    assert most <= 20 and len(files.list(f"{root}/t/_commits")) <= runs.KEPT_COMMITS + 2
    assert table.read().count() == 40_000 + table.read().filter("k >= 40000").count()


def test_rows_are_found_by_prefix(spark, root, monkeypatch):
    monkeypatch.setattr(runs, "FAN", 2)
    table = RunTable(spark, f"{root}/t", ["k"], bucket_bytes=20_000)
    for i in range(2):
        table.commit(spark.range(20_000).select(F.col("id").alias("k"), F.md5(F.concat_ws("x", "id", F.lit(i))).alias("v")))
    (run,) = table._head()["rows"]
    assert run["bits"] >= 4
    few = spark.createDataFrame([(7,), (11,)], "k long")
    near, whole = table.near(few), table.read()
    files = [df.select(F.input_file_name()).distinct().count() for df in (near, whole)]
    assert files[0] * 4 <= files[1]
    assert near.filter("k IN (7, 11)").count() == 2 and whole.count() == 20_000


# --- flows ---

LOG = "k int, tier string, note string, at timestamp_ntz"


def log_rows(seed, n=150, days=120):
    rng, start = random.Random(seed), datetime(2024, 1, 1)
    return [
        (rng.randint(0, 15), rng.choice("ABC"), f"n{i}", start + timedelta(hours=rng.randint(0, 24 * days))) for i in range(n)
    ]


def drops(spark, root, made, parts):
    for i in range(parts):
        df = spark.createDataFrame(made[i::parts], LOG)
        df.coalesce(1).write.mode("append").parquet(f"{root}/src")
        yield stream_table(spark, f"{root}/src", df.schema, maxFilesPerTrigger=1)


def replayed(feed, keys):
    """The rows that a feed leads to."""
    state = {}
    for r in feed.collect():
        for row, there in ((r.was, False), (r.now, True)):
            if row is not None:
                key = tuple(row[k] for k in keys)
                if there:
                    state[key] = tuple(row)
                else:
                    assert state.pop(key) == tuple(row)
    return ordered(state.values())


@pytest.mark.parametrize("delete_when", [None, "note LIKE '%7'"])
def test_stream_scd2_equals_batch(spark, root, delete_when):
    made = log_rows(1)
    table = scd2_runs(spark, f"{root}/dim", ["k"])
    for stream in drops(spark, root, made, 5):
        stream_scd(
            stream, table, 2, "at", f"{root}/checkpoint", track=["tier"], delete_when=delete_when, feed=f"{root}/feed"
        )
    df = spark.createDataFrame(made, LOG)
    want = scd2(df, ["k"], "at", ["tier"], delete_when)
    assert got(table.read()) == got(want)
    assert got(table.read_log()) == got(df)
    assert replayed(read_feed(spark, f"{root}/feed"), ["k", START]) == got(want)
    assert read_feed(spark, f"{root}/feed", since=4) is None
    # a lost checkpoint replays everything and changes nothing
    stream = stream_table(spark, f"{root}/src", df.schema)
    stream_scd(stream, table, 2, "at", f"{root}/other", track=["tier"], delete_when=delete_when, feed=f"{root}/feed")
    assert got(table.read()) == got(want) and read_feed(spark, f"{root}/feed", since=4).isEmpty()


def test_stream_scd2_writes_what_changes(spark, root):
    """Late events for one key: the run that they add holds that key's changed rows and nothing else."""
    made = log_rows(2, 400)
    table = scd2_runs(spark, f"{root}/dim", ["k"])
    late = [(3, "Z", "late", datetime(2024, 2, 1, 0, 30))]
    for part in (made, late):
        spark.createDataFrame(part, LOG).coalesce(1).write.mode("append").parquet(f"{root}/src")
        stream = stream_table(spark, f"{root}/src", spark.createDataFrame(part, LOG).schema)
        stream_scd(stream, table, 2, "at", f"{root}/checkpoint", track=["tier"])
    added = spark.read.parquet(f"{root}/dim/runs/{table._head()['rows'][-1]['name']}")
    assert added.select("k").distinct().collect() == [(3,)] and added.count() <= 3
    assert got(table.read()) == got(scd2(spark.createDataFrame(made + late, LOG), ["k"], "at", ["tier"]))


def test_stream_scd1_with_feed_and_deletes(spark, root):
    made = log_rows(3, 200, 20)
    table = scd1_runs(spark, f"{root}/fact", ["k"], "at")
    for stream in drops(spark, root, made, 5):
        stream_scd(stream, table, 1, "at", f"{root}/cp", delete_when="tier = 'C'", feed=f"{root}/feed")
    want = got(scd1(spark.createDataFrame(made, LOG), ["k"], "at").filter("tier <> 'C'"))
    assert got(table.read()) == want and 0 < len(want) < 16
    assert replayed(read_feed(spark, f"{root}/feed"), ["k"]) == want
    plain = scd1_runs(spark, f"{root}/plain", ["k"], "at")
    stream_scd(stream_table(spark, f"{root}/src", spark.createDataFrame(made, LOG).schema), plain, 1, "at", f"{root}/cp2")
    assert got(plain.read()) == got(scd1(spark.createDataFrame(made, LOG), ["k"], "at"))


@pytest.mark.parametrize(
    "strategy,want",
    [
        ("merge_full", [(2, "B"), (4, "D")]),
        ("upsert", [(1, "a"), (2, "B"), (4, "D")]),
        ("insert_if_absent", [(1, "a"), (2, "b"), (4, "D")]),
        ("delete_insert", [(1, "a"), (2, "B"), (4, "D")]),
    ],
)
def test_merge_sinks(spark, root, strategy, want):
    table = RunTable(spark, f"{root}/target", ["k"], GROUP if strategy == "delete_insert" else NEWEST)
    for batch in ([(1, "a"), (2, "b")], [(2, "B"), (4, "D")]):
        df = spark.createDataFrame(batch, "k int, v string")
        df.coalesce(1).write.mode("append").parquet(f"{root}/landing")
        append_flow(stream_table(spark, f"{root}/landing", df.schema), merge_sink(table, strategy), f"{root}/cp")
    assert got(table.read()) == want


def test_open_rows_stay_one_for_each_key(spark, root):
    table = scd2_runs(spark, f"{root}/dim", ["k"])
    for stream in drops(spark, root, log_rows(9, 60), 3):
        stream_scd(stream, table, 2, "at", f"{root}/checkpoint", track=["tier"])
    assert table.read().filter(F.col(END).isNull()).groupBy("k").count().filter("count > 1").isEmpty()
