"""Type 1 and 2 dimensions against a plain Python statement of the contract."""

from __future__ import annotations

import random

import pytest

from pyspark.sql import functions as F

from tidemark.operators.hotkeys import cut_hot
from tidemark.operators.scd import END, START, scd1, scd1_merge, scd2, scd2_as_of, scd2_current, scd2_merge
from tidemark.runtime import materialize

SCHEMA = "k int, tier string, email string, note string, at int"
TRACK = ["tier", "email"]


def order(event):
    """Sequence first, then the other columns in schema order; NULL is smallest."""
    k, tier, email, note, at = event
    return (at, *[(v is not None, v or "") for v in (tier, email, note)])


def expected_scd2(events, gone=lambda e: False):
    out = []
    for k in {e[0] for e in events}:
        last = {}
        for e in sorted((e for e in events if e[0] == k), key=order):
            last[e[4]] = e
        seq = [last[at] for at in sorted(last)]
        runs = []
        for e in seq:
            state = (gone(e), e[1], e[2])
            if runs and runs[-1]["state"] == state:
                runs[-1]["last"] = e
            else:
                runs.append({"state": state, "first": e, "last": e})
        for i, run in enumerate(runs):
            if run["state"][0]:
                continue
            end = runs[i + 1]["first"][4] if i + 1 < len(runs) else None
            _, tier, email, note, at = run["last"]
            out.append((k, tier, email, note, at, run["first"][4], end))
    return sorted(out, key=str)


def random_events(seed, keys=60, most=9):
    rng = random.Random(seed)
    return [
        (k, rng.choice("AB"), rng.choice(["x", None]), rng.choice(["n1", "n2", None]), rng.randint(1, 12))
        for k in range(keys)
        for _ in range(rng.randint(1, most))
    ]


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def events():
    return random_events(7)


def test_runs_not_values(spark):
    log = [(1, t, None, None, i) for i, t in enumerate("ABBA", 1)]
    dim = scd2(spark.createDataFrame(log, SCHEMA), ["k"], "at", TRACK)
    assert got(dim.select("tier", START, END)) == [("A", 1, 2), ("A", 4, None), ("B", 2, 4)]


def test_untracked_changes_update_in_place(spark):
    log = [(1, "A", "x", n, i) for i, n in enumerate(["first", "second", "third"], 1)]
    dim = scd2(spark.createDataFrame(log, SCHEMA), ["k"], "at", TRACK)
    assert got(dim) == [(1, "A", "x", "third", 3, 1, None)]


def test_null_tracked_values_compare_null_safely(spark):
    log = [(1, None, None, None, 1), (1, None, None, None, 2), (1, "A", None, None, 3)]
    dim = scd2(spark.createDataFrame(log, SCHEMA), ["k"], "at", TRACK)
    assert got(dim.select("tier", START, END)) == [("A", 3, None), (None, 1, 3)]


def test_full_run_matches_contract(spark, events):
    df = spark.createDataFrame(events, SCHEMA)
    assert got(scd2(df, ["k"], "at", TRACK)) == expected_scd2(events)


@pytest.mark.parametrize("bar", [1, 3])
def test_segments_change_nothing(spark, events, bar):
    """Every key is cut into pieces, down to one row each."""
    df = spark.createDataFrame(events, SCHEMA)
    assert got(scd2(df, ["k"], "at", TRACK, rows_per_task=bar)) == expected_scd2(events)


def test_segments_with_a_long_run_across_many(spark):
    log = [(1, "A", "x", str(i), i) for i in range(1, 41)] + [(1, "B", "x", "b", 41), (2, "A", None, None, 5)]
    df = spark.createDataFrame(log, SCHEMA)
    assert got(scd2(df, ["k"], "at", TRACK, rows_per_task=5)) == expected_scd2(log)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_split_in_any_order_equals_one_run(spark, seed):
    log = random_events(seed)
    rng = random.Random(seed * 31)
    rng.shuffle(log)
    cut = sorted(rng.sample(range(1, len(log)), 3))
    batches = [log[a:b] for a, b in zip([0, *cut], [*cut, len(log)])]
    dim, seen = None, []
    for batch in batches:
        seen += batch
        b = spark.createDataFrame(batch, SCHEMA)
        dim = (
            scd2(b, ["k"], "at", TRACK)
            if dim is None
            else scd2_merge(dim, spark.createDataFrame(seen, SCHEMA), b, ["k"], "at", TRACK)
        )
        dim = materialize(dim, "test-dim")
        assert got(dim) == expected_scd2(seen)


def test_deletes_close_and_merge_incrementally(spark):
    log = random_events(11)
    rng = random.Random(5)
    rng.shuffle(log)
    half = len(log) // 2
    gone = lambda e: e[3] == "n2"
    first, rest = spark.createDataFrame(log[:half], SCHEMA), spark.createDataFrame(log[half:], SCHEMA)
    whole = spark.createDataFrame(log, SCHEMA)
    options = {"delete_when": "note = 'n2'"}
    dim = materialize(scd2(first, ["k"], "at", TRACK, **options), "test-dim")
    assert got(dim) == expected_scd2(log[:half], gone)
    merged = scd2_merge(dim, whole, rest, ["k"], "at", TRACK, **options)
    assert got(merged) == expected_scd2(log, gone)


def test_in_order_batches_do_not_need_the_log(spark):
    """With an empty log the open rows alone must carry the history."""
    log = sorted(random_events(13), key=lambda e: e[4])
    early, late = [e for e in log if e[4] <= 6], [e for e in log if e[4] > 6]
    dim = materialize(scd2(spark.createDataFrame(early, SCHEMA), ["k"], "at", TRACK), "test-dim")
    nothing = spark.createDataFrame([], SCHEMA)
    merged = scd2_merge(dim, nothing, spark.createDataFrame(late, SCHEMA), ["k"], "at", TRACK)
    assert got(merged) == expected_scd2(log)


def test_late_events_beside_rows_do_not_need_the_log(spark):
    """Rows of one event each: late ones that come before, between, extend or join them are spliced in without any log."""
    rng = random.Random(17)
    log = [(k, f"t{i % 3}", None, f"n{i}", 10 * i) for k in range(40) for i in range(1, 9)]
    rng.shuffle(log)
    dim = materialize(scd2(spark.createDataFrame(log, SCHEMA), ["k"], "at", TRACK), "test-dim")
    late = [(k, f"t{rng.randrange(3)}", None, f"m{i}", rng.randint(0, 95)) for k in range(40) for i in range(6)]
    merged = scd2_merge(dim, spark.createDataFrame([], SCHEMA), spark.createDataFrame(late, SCHEMA), ["k"], "at", TRACK)
    assert got(merged) == expected_scd2(log + late)


@pytest.mark.parametrize("bar", [None, 4, 40])
def test_many_events_of_one_instant(spark, bar):
    """A large key with few instants: one winner each is left before segments are cut."""
    rng = random.Random(23)
    log = [(0, rng.choice("AB"), None, f"n{rng.randrange(10**6)}", rng.randint(1, 3)) for _ in range(600)] + random_events(5)
    assert got(scd2(spark.createDataFrame(log, SCHEMA), ["k"], "at", TRACK, rows_per_task=bar)) == expected_scd2(log)


@pytest.mark.parametrize("bar", [5, 60, 300])
def test_no_segment_exceeds_the_bar(spark, bar):
    rng = random.Random(29)
    rows = [(0 if rng.random() < 0.4 else rng.randint(1, 500), rng.randint(0, 10**6)) for _ in range(12_000)]
    df = spark.createDataFrame(rows, "k int, at int")
    cut, segment = cut_hot(df, ["k"], ["at"], bar)
    sizes = cut.filter(F.col(segment) >= 0).groupBy("k", segment).agg(F.count("*").alias("n"), F.min("at").alias("lo"), F.max("at").alias("hi"))
    found = sizes.orderBy("k", segment).collect()
    assert found and max(r.n for r in found) <= bar and sum(r.n for r in found if r.k == 0) == sum(k == 0 for k, _ in rows)
    assert all(a.hi <= b.lo for a, b in zip(found, found[1:]) if a.k == b.k)
    left = cut.filter(F.col(segment) < 0).groupBy("k").count().agg(F.max("count")).first()[0]
    assert (left or 0) <= bar


def test_a_batch_applied_twice_changes_nothing(spark, events):
    df = spark.createDataFrame(events, SCHEMA)
    dim = materialize(scd2(df, ["k"], "at", TRACK), "test-dim")
    assert got(scd2_merge(dim, df, df, ["k"], "at", TRACK)) == got(dim)


def test_null_sequence_is_refused(spark):
    df = spark.createDataFrame([(1, "A", None, None, None)], SCHEMA)
    for run in (lambda: scd2(df, ["k"], "at", TRACK), lambda: scd1(df, ["k"], "at")):
        with pytest.raises(Exception, match="must not be NULL"):
            run().collect()


def test_views_of_a_dimension(spark):
    log = [(1, t, None, None, i * 10) for i, t in enumerate("AB", 1)]
    dim = scd2(spark.createDataFrame(log, SCHEMA), ["k"], "at", TRACK)
    assert got(scd2_current(dim).select("tier")) == [("B",)]
    assert [got(scd2_as_of(dim, at).select("tier")) for at in (9, 10, 19, 20)] == [[], [("A",)], [("A",)], [("B",)]]


def expected_scd1(events):
    last = {}
    for e in sorted(events, key=order):
        last[e[0]] = e
    return sorted(last.values(), key=str)


def test_scd1_and_its_merge(spark, events):
    df = spark.createDataFrame(events, SCHEMA)
    assert got(scd1(df, ["k"], "at")) == expected_scd1(events)
    shuffled = events[:]
    random.Random(3).shuffle(shuffled)
    third = len(shuffled) // 3
    state = scd1(spark.createDataFrame(shuffled[:third], SCHEMA), ["k"], "at")
    for part in (shuffled[third : 2 * third], shuffled[2 * third :]):
        state = scd1_merge(state, spark.createDataFrame(part, SCHEMA), ["k"], "at")
    assert got(state) == expected_scd1(events)


def test_scd1_merge_takes_new_columns(spark):
    old = spark.createDataFrame([(1, "A", 1), (2, "B", 5)], "k int, v string, at int")
    new = spark.createDataFrame([(2, "late", 3, "app"), (1, "C", 2, "web")], "k int, v string, at int, channel string")
    assert got(scd1_merge(old, new, ["k"], "at")) == [(1, "C", 2, "web"), (2, "B", 5, None)]
