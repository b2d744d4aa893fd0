"""Physical plans stay the ones intended: shuffles, pushed filters, no cross joins."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.operators.merge import delete_insert, upsert
from tidemark.operators.scd import scd1, scd2
from tidemark.plans.history_queries import changes_of, lines_of, months_of, purchases_of
from tidemark.plans.registry import Tables
from tidemark.runtime import shuffle_tasks

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def count(df, node: str) -> int:
    return len(re.findall(rf"[-:] (?:\*\(\d+\) )?{node}\b", plan(df)))


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, FOLDER)


def test_scd2_shuffles_and_sorts_once(t):
    dim = scd2(changes_of(t), ["user_id"], "ts", ["tier"])
    assert (count(dim, "Exchange"), count(dim, "Sort"), count(dim, "Window")) == (1, 1, 3)


def test_scd1_reduces_before_its_one_shuffle(t):
    latest = scd1(lines_of(t), ["l_orderkey", "l_linenumber"], "l_shipdate")
    assert (count(latest, "Exchange"), count(latest, "WindowGroupLimit")) == (1, 2)


def test_rollup_sums_before_the_shuffle_and_reads_few_columns(t):
    text = plan(months_of(purchases_of(t)))
    assert "partial_sum" in text and "EqualTo(event_type,purchase)" in text
    assert "props" not in text


def test_a_late_filter_reaches_the_scan(t):
    text = plan(upsert(t.orders, t.orders, ["o_orderkey"]).filter(F.col("o_orderkey") > 100))
    assert text.count("GreaterThan(o_orderkey,100)") >= 2


def test_delete_insert_gathers_no_target_rows(t):
    text = plan(delete_insert(t.orders, t.orders, ["o_custkey"]))
    assert "LeftAnti" in text and "collect_list" not in text


WRITERS = ("stream", "foreach", "ingest", "landing", "skewed", "rescued", "schema_evolution", "audit", "full_refresh")


@pytest.mark.parametrize("name", [n for n in entry.queries() if not n.startswith(WRITERS) and "skewed" not in n])
def test_no_cross_join_and_no_row_wise_python(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert node not in text


def test_shuffle_sizes():
    assert shuffle_tasks(10**9) == 200
    assert shuffle_tasks(10 * 2**40) == 81_920
    assert shuffle_tasks(100 * 2**40) == 819_200
