from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators.changes import CHANGED, apply_changes, read_changes, snapshot_diff
from tidemark.operators.merge import (
    DuplicateKeys,
    delete_insert,
    delete_where,
    guarded_update,
    insert_if_absent,
    merge_full,
    merge_full_counts,
    replace_where,
    replace_window,
    upsert,
)
from tidemark.functions.expressions import ladder_step

S = "k int, v string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_diff_kinds_and_changed_columns(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, None, 2), (3, "c", 3), (4, None, 4)], "k int, v string, w int")
    new = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (4, None, 4), (5, "e", 5)], "k int, v string, w int")
    diff = snapshot_diff(old, new, ["k"], 7)
    assert rows(diff.select("k", "v", "_change_type", F.concat_ws(",", CHANGED))) == [
        (2, "b", "update_postimage", "v"),
        (2, None, "update_preimage", "v"),
        (3, "c", "delete", ""),
        (5, "e", "insert", ""),
    ]
    assert {r._commit_version for r in diff.collect()} == {7}
    assert rows(read_changes(diff).select("k")) == [(2,), (5,)]
    assert rows(apply_changes(old, diff, ["k"])) == rows(new)


def test_diff_with_a_new_column(spark):
    old = spark.createDataFrame([(1, "a")], S)
    new = spark.createDataFrame([(1, "a", "app")], "k int, v string, channel string")
    diff = snapshot_diff(old, new, ["k"], 1)
    assert rows(read_changes(diff).select("k", "v", "channel")) == [(1, "a", "app")]


def test_equal_snapshots_have_no_diff(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], S)
    assert snapshot_diff(df, df, ["k"], 1).isEmpty()


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], S)


def test_upsert_insert_and_delete(spark, target):
    source = spark.createDataFrame([(2, "B"), (4, "D")], S)
    assert rows(upsert(target, source, ["k"])) == [(1, "a"), (2, "B"), (3, "c"), (4, "D")]
    assert rows(upsert(target, source, ["k"], delete_when="v = 'B'")) == [(1, "a"), (3, "c"), (4, "D")]
    assert rows(insert_if_absent(target, source, ["k"])) == [(1, "a"), (2, "b"), (3, "c"), (4, "D")]


def test_full_merge_keeps_only_the_source(spark, target):
    source = spark.createDataFrame([(2, "B"), (4, "D")], S)
    assert rows(merge_full(target, source, ["k"])) == [(2, "B"), (4, "D")]
    assert rows(merge_full_counts(target, source, ["k"])) == [(1, 1, 2)]


def test_duplicate_source_keys_raise(spark, target):
    twice = spark.createDataFrame([(2, "x"), (2, "y")], S)
    for merge in (upsert, insert_if_absent, merge_full):
        with pytest.raises(DuplicateKeys):
            merge(target, twice, ["k"])


def test_delete_insert_allows_many_rows_per_key(spark, target):
    batch = spark.createDataFrame([(2, "x"), (2, "y")], S)
    assert rows(delete_insert(target, batch, ["k"])) == [(1, "a"), (2, "x"), (2, "y"), (3, "c")]


# The toy table of five reps: replace-where from February on touches ids 3, 4 and 5.
TOY = "consultora_id int, nome string, valor_total double, data_pedido timestamp"


def test_replace_where_and_override(spark):
    days = ["2026-01-01", "2026-01-15", "2026-02-01", "2026-02-10", "2026-03-01"]
    toy = spark.createDataFrame(list(enumerate(days, 1)), "consultora_id int, d string").select(
        "consultora_id", F.col("d").cast("timestamp").alias("data_pedido"), F.lit("old").alias("v")
    )
    fresh = toy.withColumn("v", F.lit("new"))
    recent = "data_pedido >= TIMESTAMP'2026-02-01'"
    out = rows(replace_where(toy, fresh, recent).select("consultora_id", "v"))
    assert out == [(1, "old"), (2, "old"), (3, "new"), (4, "new"), (5, "new")]
    assert rows(replace_where(toy.limit(0), fresh, recent).select("consultora_id")) == [(3,), (4,), (5,)]
    backfill = replace_where(toy, fresh, recent, override="data_pedido < TIMESTAMP'2026-01-10'")
    assert rows(backfill.filter("v = 'new'").select("consultora_id")) == [(1,)]
    from datetime import datetime

    window = replace_window(toy, fresh, "data_pedido", datetime(2026, 1, 15), datetime(2026, 2, 1))
    assert rows(window.filter("v = 'new'").select("consultora_id")) == [(2,)]


def test_null_predicates_leave_rows_alone(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], S)
    assert rows(delete_where(df, "v = 'b'")) == [(1, None)]
    assert rows(replace_where(df, df, "v = 'b'")) == [(1, None), (2, "b")]
    assert rows(guarded_update(df, "v = 'b'", {"v": F.lit("z")})) == [(1, None), (2, "z")]


def test_guarded_update_sees_old_values_and_repeats_safely(spark):
    df = spark.createDataFrame([(1, "semente", 1), (2, "diamante", 1), (3, "ouro", 9)], "k int, tier string, at int")
    step = {"tier": ladder_step("tier"), "at": F.lit(5)}
    guard = (F.col("at") < 5) & (F.col("tier") != "diamante")
    once = guarded_update(df, guard, step)
    assert rows(once) == [(1, "bronze", 5), (2, "diamante", 1), (3, "ouro", 9)]
    assert rows(guarded_update(once, guard, step)) == rows(once)


def test_columns_added_upstream_are_taken_over(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(2, "B", 9), (3, "c", 8)], "k int, v string, extra int")
    everything = [(1, "a", None), (2, "B", 9), (3, "c", 8)]
    assert sorted(map(tuple, upsert(target, source, ["k"]).collect())) == everything
    assert sorted(map(tuple, delete_insert(target, source, ["k"]).collect())) == everything
    added = insert_if_absent(target, source, ["k"])
    assert sorted(map(tuple, added.collect())) == [(1, "a", None), (2, "b", None), (3, "c", 8)]
    replaced = replace_where(target, source, "k >= 2")
    assert sorted(map(tuple, replaced.collect())) == everything
    own = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, own string")
    assert sorted(map(tuple, merge_full(own, source, ["k"]).collect())) == [(2, "B", "y", 9), (3, "c", None, 8)]


def test_a_new_source_column_is_synced_once(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(1, "a", 5), (2, "b", None)], "k int, v string, extra int")
    state = apply_changes(old, snapshot_diff(old, new, ["k"], 1), ["k"])
    assert sorted(map(tuple, state.collect())) == [(1, "a", 5), (2, "b", None)]
    assert snapshot_diff(state, new, ["k"], 2).isEmpty()


def test_snapshots_must_have_unique_keys(spark):
    one = spark.createDataFrame([(1, "a")], "k int, v string")
    two = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    for pair in ((one, two), (two, one)):
        with pytest.raises(Exception, match="more than one row"):
            snapshot_diff(*pair, ["k"], 1).collect()
