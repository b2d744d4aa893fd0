from __future__ import annotations

import random

import pytest

from tidemark.operators.joins import as_of_join, join_current, mark_granted, not_in, orphans, semi_granted
from tidemark.operators.scd import END, START

DIM = f"k int, tier string, {START} int, {END} int"
FACT = "id int, k int, at int"


def as_of(facts, dim):
    return sorted(
        (i, k, at, tier)
        for i, k, at in facts
        for kk, tier, s, e in dim
        if k == kk and at is not None and s <= at and (e is None or at < e)
    )


@pytest.fixture(scope="module")
def sample():
    rng = random.Random(2)
    dim = []
    for k in range(20):
        edges = sorted(rng.sample(range(100), rng.randint(1, 8)))
        for s, e in zip(edges, [*edges[1:], None]):
            if rng.random() < 0.8:  # the others leave a gap
                dim.append((k, f"t{s}", s, e))
    facts = [(i, rng.randint(0, 22), rng.choice([None, *range(100)])) for i in range(600)]
    facts += [(1000 + n, k, s) for n, (k, _, s, _) in enumerate(dim)]  # exactly at each start
    return facts, dim


@pytest.mark.parametrize("bar", [None, 1, 7])
def test_as_of_matches_with_any_segments(spark, sample, bar):
    facts, dim = sample
    out = as_of_join(
        spark.createDataFrame(facts, FACT), spark.createDataFrame(dim, DIM), "k", "at", rows_per_task=bar
    )
    assert sorted(tuple(r) for r in out.select("id", "k", "at", "tier").collect()) == as_of(facts, dim)
    assert out.columns == ["id", "k", "at", "tier", START, END]


def test_boundaries_are_half_open(spark):
    dim = spark.createDataFrame([(1, "old", 10, 20), (1, "new", 20, None)], DIM)
    facts = spark.createDataFrame([(i, 1, at) for i, at in enumerate([9, 10, 19, 20, 99])], FACT)
    out = as_of_join(facts, dim, "k", "at").select("at", "tier")
    assert sorted(map(tuple, out.collect())) == [(10, "old"), (19, "old"), (20, "new"), (99, "new")]


@pytest.mark.parametrize("many", [1, 300])
def test_of_overlapping_windows_the_last_begun_counts(spark, many):
    dim = [(1, "wide", 0, None), (1, "short", 10, 20), *[(2, "x", i, None) for i in range(many)]]
    facts = spark.createDataFrame([(i, 1, at) for i, at in enumerate([5, 15, 25])], FACT)
    out = as_of_join(facts, spark.createDataFrame(dim, DIM), "k", "at").select("at", "tier")
    assert sorted(map(tuple, out.collect())) == [(5, "wide"), (15, "short")]


def test_facts_of_one_instant_are_cut_apart(spark):
    dim = spark.createDataFrame([(1, "old", 0, 50), (1, "new", 50, None)], DIM)
    facts = spark.createDataFrame([(i, 1, 60) for i in range(500)], FACT)
    out = as_of_join(facts, dim, "k", "at", rows_per_task=20)
    assert out.filter("tier = 'new'").count() == 500


def test_shared_columns_are_refused(spark):
    dim = spark.createDataFrame([(1, 5, 0, None)], f"k int, id int, {START} int, {END} int")
    with pytest.raises(ValueError, match="both sides"):
        as_of_join(spark.createDataFrame([(1, 1, 1)], FACT), dim, "k", "at")


def test_current_and_missing(spark):
    dim = spark.createDataFrame([(1, "old", 10, 20), (1, "new", 20, None)], DIM)
    facts = spark.createDataFrame([(1, 1, 12), (2, 9, 12), (3, None, 1)], FACT)
    assert [(r.id, r.tier) for r in join_current(facts, dim, "k").collect()] == [(1, "new")]
    assert sorted(r.id for r in orphans(facts, dim, "k").collect()) == [2, 3]
    assert not_in(facts, facts, ["id"]).isEmpty()


def test_grants_never_multiply_rows(spark):
    grants = spark.createDataFrame(
        [("u", "S"), ("u", "S"), ("u", None), ("v", "N")], "email string, regiao string"
    )
    df = spark.createDataFrame([(1, "S"), (2, "N"), (3, None)], "id int, regiao string")
    assert [r.id for r in semi_granted(df, grants, "u", "regiao").collect()] == [1]
    flagged = mark_granted(df, grants, "u", "regiao", "ok").orderBy("id").collect()
    assert [r.ok for r in flagged] == [True, False, False]
