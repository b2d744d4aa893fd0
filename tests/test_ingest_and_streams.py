from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import audit as A
from tidemark.operators.quality import ExpectationFailed, expect_or_drop, expect_or_fail
from tidemark.operators.scd import scd1, scd2
from tidemark.plans.direct_sales import DirectSales, promote_reps
from tidemark.runtime import Files, scratch_path
from tidemark.sources import generate as G
from tidemark.sources.files import (
    BronzeTable,
    discover_schema,
    ingest_files,
    read_jdbc_snapshot,
    read_widened,
    rescue_misfits,
    stream_table,
    widen_schema,
    write_chunked,
)
from tidemark.sources.tables import KeyedTable, ensure_table, replace_partitions, truncate
from tidemark.streaming.flows import append_flow, merge_sink, refresh, scd2_table, stream_expect, stream_scd

TODAY = date(2026, 5, 8)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def root(spark):
    return scratch_path(spark, "test")


def land(df, root):
    df.coalesce(1).write.mode("append").parquet(f"{root}/landing")


def ingest(spark, root, **options):
    return ingest_files(spark, f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint", **options)


# --- ingest ---


def test_ingest_evolves_rescues_and_reads_once(spark, root):
    land(spark.createDataFrame([(1,), (2,)], "id int"), root)
    assert ingest(spark, root).read().count() == 2

    land(spark.createDataFrame([(3,), (2**40,)], "id bigint"), root)
    land(spark.createDataFrame([("x1", "app"), ("7", None)], "id string, canal string"), root)
    bronze = ingest(spark, root)
    assert rows(bronze.read().select("id", "canal", "_rescued_data")) == [
        (1, None, None),
        (2, None, None),
        (3, None, None),
        (7, None, None),
        (None, "app", '{"id":"x1"}'),
        (None, None, f'{{"id":{2**40}}}'),
    ]
    assert ingest(spark, root).read().count() == 6
    assert bronze.read().filter("_ingest_file_path IS NULL OR _ingest_file_mtime IS NULL OR _ingest_ts IS NULL").isEmpty()
    assert bronze.schema().simpleString() == "struct<id:int,canal:string>"


def test_a_replayed_batch_is_skipped(spark, root):
    land(spark.createDataFrame([(1,)], "id int"), root)
    bronze = ingest(spark, root)
    paths = spark.read.format("binaryFile").load(f"{root}/landing/*.parquet").select("path")
    bronze.append(paths, 0)
    assert bronze.read().count() == 1


def test_backdated_files_come_in(spark, root):
    land(spark.createDataFrame([(1,)], "id int"), root)
    ingest(spark, root)
    old = set(Files(spark).tree(f"{root}/landing"))
    land(spark.createDataFrame([(2,)], "id int"), root)
    for name in set(Files(spark).tree(f"{root}/landing")) - old:
        Files(spark).set_modified(name, 1_000_000_000_000)
    assert rows(ingest(spark, root).read().select("id")) == [(1,), (2,)]


def test_a_new_checkpoint_loses_and_repeats_nothing(spark, root):
    land(spark.createDataFrame([(1,)], "id int"), root)
    ingest_files(spark, f"{root}/landing", f"{root}/bronze", f"{root}/cp-a")
    land(spark.createDataFrame([(2,)], "id int"), root)
    bronze = ingest_files(spark, f"{root}/landing", f"{root}/bronze", f"{root}/cp-b")
    assert rows(bronze.read().select("id")) == [(1,), (2,)]


def test_stream_expect_on_a_new_checkpoint(spark, root):
    land(spark.createDataFrame([(1,)], "id int"), root)
    schema = spark.read.parquet(f"{root}/landing").schema
    for cp in ("a", "a", "b"):
        stream_expect(stream_table(spark, f"{root}/landing", schema), [], f"{root}/out", f"{root}/cp-{cp}")
        land(spark.createDataFrame([(2 if cp == "a" else 3,)], "id int"), root)
    ids = {r.id for r in spark.read.parquet(f"{root}/out").collect()}
    assert ids == {1, 2}
    stream_expect(stream_table(spark, f"{root}/landing", schema), [], f"{root}/out", f"{root}/cp-b")
    assert {r.id for r in spark.read.parquet(f"{root}/out").collect()} == {1, 2, 3}


def test_few_files_per_batch(spark, root):
    for i in range(3):
        land(spark.createDataFrame([(i,)], "id int"), root)
    bronze = ingest(spark, root, max_files=1)
    assert rows(bronze.read().select("id")) == [(0,), (1,), (2,)]
    assert len([n for n in Files(spark).list(bronze.path) if n.startswith("ingest_batch=")]) == 3


def test_empty_landing(spark, root):
    spark.createDataFrame([], "id int").write.parquet(f"{root}/landing")
    assert ingest(spark, root).read().count() == 0
    assert BronzeTable(spark, f"{root}/nowhere").read().count() == 0


def test_discovered_schema_never_narrows(spark, root):
    land(spark.createDataFrame([(1, "a")], "id int, new string"), root)
    known = T.StructType([T.StructField("id", T.LongType()), T.StructField("gone", T.StringType())])
    assert discover_schema(spark, f"{root}/landing", known).simpleString() == "struct<id:bigint,gone:string,new:string>"
    assert widen_schema(None, []).fields == []


def test_rescue_keeps_fractions(spark):
    df = spark.createDataFrame([(1.0,), (1.5,), (None,)], "v double")
    out = rescue_misfits(df, T.StructType([T.StructField("v", T.IntegerType())]))
    assert rows(out) == [(1, None), (None, '{"v":1.5}'), (None, None)]


def test_rescue_keeps_what_a_narrower_type_would_lose(spark):
    df = spark.sql("SELECT 1.2345D AS a, 9007199254740993L AS b, TIMESTAMP'2024-01-01 10:00:00' AS c, 2.5D AS d, DATE'2024-01-01' AS e")
    target = "a decimal(18,2), b double, c date, d decimal(18,2), e timestamp"
    out = rescue_misfits(df, spark.createDataFrame([], target).schema).first()
    assert (out.a, out.b, out.c) == (None, None, None) and str(out.d) == "2.50" and out.e is not None
    assert '"a":1.2345' in out._rescued_data and '"b":9007199254740993' in out._rescued_data and '"c"' in out._rescued_data


def test_names_that_differ_in_case_are_one_column(spark, root):
    land(spark.createDataFrame([(1, "a")], "id int, v string"), root)
    ingest(spark, root)
    land(spark.createDataFrame([("b", 2)], "V string, ID int"), root)
    bronze = ingest(spark, root)
    assert rows(bronze.read().select("id", "v")) == [(1, "a"), (2, "b")]
    assert bronze.schema().names == ["id", "v"]


def test_paths_with_blanks_and_percent_signs(spark, root):
    root = f"{root}/a b%20c"
    land(spark.createDataFrame([(1,)], "id int"), root)
    assert rows(ingest(spark, root).read().select("id")) == [(1,)]


def test_widened_read(spark, root):
    land(spark.createDataFrame([(1,)], "id int"), root)
    land(spark.createDataFrame([(2**40,)], "id bigint"), root)
    wide = T.StructType([T.StructField("id", T.LongType())])
    assert rows(read_widened(spark, f"{root}/landing", wide)) == [(1,), (2**40,)]


def test_chunks(spark, root):
    write_chunked(spark.range(2500).coalesce(1), f"{root}/chunks", 1000)
    sizes = spark.read.parquet(f"{root}/chunks").groupBy(F.col("_metadata.file_name")).count().collect()
    assert sorted(r["count"] for r in sizes) == [500, 1000, 1000]


def test_jdbc_options(spark, monkeypatch):
    """No database here: only what is asked of the reader."""
    seen = {}
    monkeypatch.setattr(type(spark.read), "jdbc", lambda self, url, table, **o: seen.update(o, url=url, table=table))
    read_jdbc_snapshot(spark, "jdbc:x", "reps", "id", (1, 500), 4)
    assert (seen["column"], seen["lowerBound"], seen["upperBound"], seen["numPartitions"]) == ("id", 1, 500, 4)


# --- tables ---


def test_ensure_truncate_and_partitions(spark, root):
    path = f"{root}/t"
    ensure_table(spark, path, "id int, p string")
    assert spark.read.parquet(path).count() == 0
    spark.createDataFrame([(1, "a")], "id int, p string").write.mode("append").parquet(path)
    ensure_table(spark, path, "id int, p string")
    assert spark.read.parquet(path).count() == 1
    truncate(spark, path)
    assert spark.read.parquet(path).dtypes == [("id", "int"), ("p", "string")]

    parts = f"{root}/p"
    spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, p string").write.partitionBy("p").parquet(parts)
    replace_partitions(spark.createDataFrame([(9, "a")], "id int, p string"), parts, "p", emptied=["a", "b"])
    assert rows(spark.read.parquet(parts)) == [(3, "c"), (9, "a")]


def test_keyed_table_commits(spark, root):
    table = KeyedTable(spark, f"{root}/t", ["k"], 4)
    df = spark.createDataFrame([(k, f"v{k}") for k in range(20)], "k int, v string")
    table.replace(df, [])
    assert rows(table.read()) == rows(df)
    one = spark.createDataFrame([(3, "new")], "k int, v string")
    cells = table.cells_of(one)
    before = table.read(cells)
    assert 0 < before.count() < 20
    table.replace(before.filter("k <> 3").unionByName(one), cells)
    assert table.read().filter("k = 3").first().v == "new" and table.read().count() == 20
    with pytest.raises(ValueError, match="not given"):
        table.replace(df, cells)
    assert table.version() == 1
    assert table.replace(table.read(cells).limit(0), cells) == 2
    table.expire(keep=1)
    assert table.read().count() == 20 - before.count()


# --- streams ---

LOG = "k int, tier string, note string, at timestamp_ntz"


def log_rows(spark, seed, n=150):
    import random
    from datetime import datetime, timedelta

    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    made = [
        (rng.randint(0, 15), rng.choice("ABC"), f"n{i}", start + timedelta(hours=rng.randint(0, 24 * 120)))
        for i in range(n)
    ]
    return spark.createDataFrame(made, LOG), made


def drops(spark, root, made, parts):
    for i in range(parts):
        df = spark.createDataFrame(made[i::parts], LOG)
        df.coalesce(1).write.mode("append").parquet(f"{root}/src")
        yield stream_table(spark, f"{root}/src", df.schema, maxFilesPerTrigger=1)


@pytest.mark.parametrize("bar", [None, 4])
def test_stream_scd2_over_months_equals_batch(spark, root, bar):
    df, made = log_rows(spark, 1)
    table = scd2_table(spark, f"{root}/dim", ["k"], 3)
    for stream in drops(spark, root, made, 3):
        stream_scd(stream, table, 2, "at", f"{root}/checkpoint", track=["tier"], rows_per_task=bar)
    assert rows(table.read()) == rows(scd2(df, ["k"], "at", ["tier"]))
    assert len(table.known_cells()) > 6  # buckets split by the month a row ended in


def test_stream_scd2_rewrites_recent_cells_only(spark, root):
    _, made = log_rows(spark, 2)
    made.sort(key=lambda r: r[3])
    table = scd2_table(spark, f"{root}/dim", ["k"], 2)
    cells = []
    for part in (made[:140], made[140:]):
        spark.createDataFrame(part, LOG).coalesce(1).write.mode("append").parquet(f"{root}/src")
        stream = stream_table(spark, f"{root}/src", spark.createDataFrame(part, LOG).schema)
        stream_scd(stream, table, 2, "at", f"{root}/checkpoint", track=["tier"])
        cells.append(dict(table._head()["cells"]))
    old = [c for c in cells[0] if c.endswith(("202401", "202402"))]
    assert old and all(cells[1][c] == cells[0][c] for c in old)
    df = spark.createDataFrame(made, LOG)
    assert rows(table.read()) == rows(scd2(df, ["k"], "at", ["tier"]))


def test_stream_scd1_and_replays(spark, root):
    df, made = log_rows(spark, 3)
    table = KeyedTable(spark, f"{root}/fact", ["k"], 4)
    for stream in drops(spark, root, made, 2):
        stream_scd(stream, table, 1, "at", f"{root}/checkpoint")
    want = rows(scd1(df, ["k"], "at"))
    assert rows(table.read()) == want
    # A lost checkpoint replays everything, here with one event that was not seen before.
    late = spark.createDataFrame([(99, "A", "new", made[0][3])], LOG)
    late.write.mode("append").parquet(f"{root}/src")
    stream_scd(stream_table(spark, f"{root}/src", df.schema), table, 1, "at", f"{root}/other")
    assert rows(table.read()) == rows(scd1(df.unionByName(late), ["k"], "at")) and len(want) + 1 == table.read().count()


def test_scd2_replay_changes_nothing(spark, root):
    df, made = log_rows(spark, 4)
    table = scd2_table(spark, f"{root}/dim", ["k"], 2)
    for checkpoint in ("one", "two"):
        for stream in drops(spark, f"{root}/{checkpoint}", made, 2):
            stream_scd(stream, table, 2, "at", f"{root}/{checkpoint}/checkpoint", track=["tier"])
    assert rows(table.read()) == rows(scd2(df, ["k"], "at", ["tier"]))


def test_stream_expectations(spark, root):
    df = spark.createDataFrame([(1, 5), (2, -5)], "id int, v int")
    land(df, root)
    rules = [expect_or_fail("pk", "id IS NOT NULL"), expect_or_drop("positive", "v > 0")]

    def run():
        stream = stream_table(spark, f"{root}/landing", df.schema)
        return stream_expect(stream, rules, f"{root}/silver", f"{root}/checkpoint")

    assert run() == [{"_rows": 2, "pk": 0, "positive": 1}]
    assert run() == []
    land(spark.createDataFrame([(None, 1), (3, 1)], "id int, v int"), root)
    with pytest.raises(Exception) as failure:
        run()
    assert "pk" in str(failure.value) and ExpectationFailed.__name__ in str(failure.value)
    assert rows(spark.read.parquet(f"{root}/silver").select("id")) == [(1,)]


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
    table = KeyedTable(spark, f"{root}/target", ["k"], 2)
    for batch in ([(1, "a"), (2, "b")], [(2, "B"), (4, "D")]):
        df = spark.createDataFrame(batch, "k int, v string")
        land(df, root)
        append_flow(stream_table(spark, f"{root}/landing", df.schema), merge_sink(table, strategy), f"{root}/cp")
    assert rows(table.read()) == want


def test_refresh_incremental_and_full(spark, root):
    def copy(out, checkpoint):
        stream = stream_table(spark, f"{root}/landing", spark.range(1).schema)
        append_flow(stream, lambda b, i: b.write.mode("overwrite").parquet(f"{out}/batch={i}"), checkpoint)
        return out

    land(spark.range(3), root)
    first = refresh({"copy": copy}, f"{root}/out", spark)["copy"]
    land(spark.range(3, 5), root)
    assert refresh({"copy": copy}, f"{root}/out", spark)["copy"] == first
    assert spark.read.parquet(first).count() == 5
    full = refresh({"copy": copy}, f"{root}/out", spark, full=True)["copy"]
    assert full != first and spark.read.parquet(full).count() == 5


# --- the pipeline on generated data ---


def test_pipeline_end_to_end(spark, root):
    n = 3000
    sales = DirectSales(spark, f"{root}/tables", today=TODAY)
    write_chunked(G.generate_orders(spark, n, today=TODAY).coalesce(1), f"{root}/landing", 1000)
    counts = sales.run_orders(f"{root}/landing")
    assert sum(c["valor_positivo"] for c in counts) == 5 and sum(c["data_passada"] for c in counts) == 3
    assert sales.fact.read().count() == n - 8

    reps = G.generate_reps(spark)
    for snapshot in (reps, promote_reps(reps)):
        sales.sync_reps(snapshot)
        sales.run_reps()
    # 499 well-formed reps, one more event per promotion.
    events = sales.silver_reps().count()
    dim = sales.dim.read()
    assert dim.count() == events and sales.reps.read().count() == 500
    hero = rows(dim.filter("consultora_id = 42").select("tier", "__END_AT"))
    assert [h[0] for h in hero] == ["bronze", "prata"] and hero[1][1] is None

    report = sales.commission()
    assert 0 < report.count() < n - 8
    A.require_passed(
        A.audit(dim, [A.unique(["consultora_id", "__START_AT"]), A.one_open_row(["consultora_id"]), A.windows_disjoint(["consultora_id"])])
    )
    mine = "consultora_id = 42"
    edge = F.lit(G.HERO_CHANGE).cast("timestamp_ntz")
    A.require_passed(
        A.audit(report, [A.unique(["pedido_id"]), A.attribution("tier_no_momento_do_pedido", "data_pedido", edge, "bronze", "prata", mine)])
    )
    orphan_free = sales.sales_by_region().agg(F.sum("qtde_pedidos")).first()[0]
    assert orphan_free == sales.fact.read().filter("consultora_id <> 7").count()

    write_chunked(G.generate_evolved_orders(spark, today=TODAY).coalesce(1), f"{root}/landing", 1000, "append")
    sales.run_orders(f"{root}/landing")
    fact = sales.fact.read()
    assert fact.filter("canal_origem IS NOT NULL").count() == 100 and fact.count() == n - 8 + 100
    with pytest.raises(AssertionError, match="source_not_empty"):
        sales.sync_reps(reps.limit(0))
