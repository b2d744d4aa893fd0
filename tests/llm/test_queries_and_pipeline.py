"""Registered queries against SQL, and the pipeline over a small corpus with planted cases."""

from __future__ import annotations

import os
import random
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

import corpus_pipeline  # noqa: E402
from compare import compare, connect  # noqa: E402
from tidemark.llm import queries, sql  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")


@tables
@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_equals_sql(spark, name):
    verdict, _ = compare(spark, connect(FOLDER), FOLDER, name)
    assert verdict.startswith("ok"), verdict


@tables
def test_archives_equal_sql(spark):
    """All pages differ there, so ``refers_to`` is all null, which clients render in several ways: compared apart."""
    want = connect(FOLDER).execute(sql.OP3).fetchall()
    got = queries.QUERIES["op3_warc"](spark, FOLDER)
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, got.select(*columns).collect()), key=str) == sorted(want, key=str)


@tables
def test_one_row_for_each_document_and_page(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").count()
    for name, rows in (("op2_ngram_jaccard_join", docs), ("op5_token_files", docs), ("op8_url_filters", pages), ("op3_warc", pages)):
        assert queries.QUERIES[name](spark, FOLDER).count() == rows


def prose(rng, n):
    words = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.randrange(1000)}" for _ in range(n)]
    return " ".join(words) + "."


def test_pipeline_keeps_clean_documents_and_catches_planted_ones(spark, tmp_path):
    rng = random.Random(8)
    item = prose(rng, 40)
    clean = {i: "\n".join(prose(rng, 30) for _ in range(4)) for i in range(10)}
    long_line = prose(rng, 300)
    near = long_line.split(" ")
    near[150] = "changed"
    rows = [(i, t) for i, t in clean.items()]
    rows += [(20, clean[3]), (21, long_line), (22, " ".join(near)), (23, f"{prose(rng, 30)}\n{item}"), (24, None), (25, "")]
    rows += [(26, "\n".join(f"$$$ {w}!!" for w in prose(rng, 60).split())), (None, prose(rng, 30))]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.withColumnRenamed("lang", "lang").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    ids = [r.doc_id for r in out.select("doc_id").distinct().collect()]
    kept = set(ids)
    assert {0, 1, 2, 4, 5, 6, 7, 8, 9, None} <= kept and len(kept & {3, 20}) == 1 and len(kept & {21, 22}) == 1
    assert not kept & {23, 24, 25, 26}
    columns = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, columns.limit(0), str(tmp_path)).columns == columns.columns, name
