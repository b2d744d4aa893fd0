"""Queries that write: files arrive in drops, flows pick them up, the result is read back."""

from __future__ import annotations

import time
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import audit as A
from tidemark.operators.quality import expect, expect_or_drop
from tidemark.plans.direct_sales import DirectSales
from tidemark.plans.history_queries import (
    DIM_SQL,
    LATEST_LINES,
    LINE_KEY,
    changes_of,
    lines_of,
    plain_windows,
)
from tidemark.plans.registry import Tables, query
from tidemark.plans.table_queries import MERGE, source_orders, target_orders, typed_orders
from tidemark.runtime import Files
from tidemark.sources.files import ingest_files, read_widened, stream_table, write_chunked
from tidemark.sources.runs import GROUP, NEWEST, RunTable
from tidemark.sources.tables import ensure_table, replace_partitions, truncate
from tidemark.streaming.flows import (
    SOURCE,
    append_flow,
    merge_sink,
    refresh,
    scd1_runs,
    scd2_runs,
    stream_expect,
    stream_scd,
)


def drop(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


ORDERS_BY_THREE = "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_totalprice FROM orders"


@query("widened_read", "SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer")
def _(t: Tables) -> DataFrame:
    """Files written with INT and with BIGINT under one schema."""
    path = t.scratch("widen")
    cut = t.customer.select("c_custkey", "c_nationkey")
    drop(cut.filter("c_custkey % 2 = 0"), path)
    drop(cut.filter("c_custkey % 2 = 1").withColumn("c_nationkey", F.col("c_nationkey").cast("bigint")), path)
    wide = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_nationkey", T.LongType())])
    return read_widened(t.spark, path, wide)


@query(
    "schema_evolution",
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS o_orderpriority FROM orders""",
)
def _(t: Tables) -> DataFrame:
    """A column that appears with the second drop reads NULL for the first."""
    root = t.scratch("evolve")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    bronze = None
    for half, columns in ((0, ["o_orderkey", "o_custkey"]), (1, orders.columns)):
        drop(orders.filter(F.col("o_orderkey") % 2 == half).select(*columns), f"{root}/landing")
        bronze = ingest_files(t.spark, f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint")
    return bronze.read().select("o_orderkey", "o_custkey", "o_orderpriority")


@query(
    "rescued_data",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 AND o_orderkey % 7 = 0 THEN -1 ELSE o_custkey END AS o_custkey,
  CASE WHEN o_orderkey % 3 = 2 AND o_orderkey % 7 = 0 THEN '{"o_custkey":"x' || o_custkey || '"}' ELSE '' END AS rescued
FROM orders""",
)
def _(t: Tables) -> DataFrame:
    """BIGINT first, then INT and text in one batch: text that is no number is rescued."""
    root = t.scratch("rescue")
    orders = t.orders.select("o_orderkey", "o_custkey")
    part = F.col("o_orderkey") % 3
    text = F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit("x"), "o_custkey")).otherwise(
        F.col("o_custkey").cast("string")
    )
    landing = f"{root}/landing"

    def run():
        return ingest_files(t.spark, landing, f"{root}/bronze", f"{root}/checkpoint")

    drop(orders.filter(part == 0), landing)
    run()
    drop(orders.filter(part == 1).withColumn("o_custkey", F.col("o_custkey").cast("int")), landing)
    drop(orders.filter(part == 2).withColumn("o_custkey", text), landing)
    rows = run().read()
    return rows.select(
        "o_orderkey",
        F.coalesce("o_custkey", F.lit(-1)).alias("o_custkey"),
        F.coalesce("_rescued_data", F.lit("")).alias("rescued"),
    )


@query(
    "rescued_lossy",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 1 THEN -1 ELSE CAST(o_custkey AS DOUBLE) END AS amount,
  CASE WHEN o_orderkey % 5 = 2 THEN '' ELSE '2020-01-02' END AS day,
  CASE o_orderkey % 5 WHEN 1 THEN '{"amount":"' || o_custkey || '.255"}' WHEN 2 THEN '{"day":"2020-01-02 10:00:00"}' ELSE '' END AS rescued
FROM orders""",
)
def _(t: Tables) -> DataFrame:
    """Text for a decimal and a date: what a cast would round or cut off is rescued, other spellings are taken."""
    root = t.scratch("lossy")
    key, cust = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    typed = T.StructType.fromDDL("o_orderkey bigint, amount decimal(18,2), day date")
    amount = (
        F.when(key % 5 == 0, F.concat(F.lit(" +0"), cust, F.lit(".000 ")))
        .when(key % 5 == 1, F.concat(cust, F.lit(".255")))
        .otherwise(cust)
    )
    day = F.when(key % 5 == 2, "2020-01-02 10:00:00").when(key % 5 == 3, "2020-01-02 00:00:00").otherwise("2020-01-02")
    drop(t.orders.select("o_orderkey", amount.alias("amount"), day.alias("day")), f"{root}/landing")
    rows = ingest_files(t.spark, f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint", seed=typed).read()
    return rows.select(
        "o_orderkey",
        F.coalesce(F.col("amount").cast("double"), F.lit(-1.0)).alias("amount"),
        F.coalesce(F.col("day").cast("string"), F.lit("")).alias("day"),
        F.coalesce("_rescued_data", F.lit("")).alias("rescued"),
    )


@query("ingest_incremental", ORDERS_BY_THREE)
def _(t: Tables) -> DataFrame:
    """Two drops and a run that finds nothing new: each file is read once."""
    root = t.scratch("ingest")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice")
    bronze = None
    for part in (0, 1, None):
        if part is not None:
            drop(orders.filter(F.col("o_orderkey") % 2 == part), f"{root}/landing")
        bronze = ingest_files(t.spark, f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint")
    return bronze.read().select(*orders.columns)


@query("ingest_backdated", ORDERS_BY_THREE)
def _(t: Tables) -> DataFrame:
    """A drop whose files bear a time of a month before the newest file already read."""
    root, files = t.scratch("backdated"), Files(t.spark)
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice")
    bronze = None
    for part in (0, 1):
        before = set(files.tree(f"{root}/landing")) if part else set()
        drop(orders.filter(F.col("o_orderkey") % 2 == part), f"{root}/landing")
        if part:
            for name in set(files.tree(f"{root}/landing")) - before:
                files.set_modified(name, int((time.time() - 30 * 86400) * 1000))
        bronze = ingest_files(t.spark, f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint")
    return bronze.read().select(*orders.columns)


@query("ingest_new_checkpoint", ORDERS_BY_THREE)
def _(t: Tables) -> DataFrame:
    """The checkpoint is lost between two drops: files already held are left out, the new ones come in."""
    root = t.scratch("new-checkpoint")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice")
    bronze = None
    for part in (0, 1):
        drop(orders.filter(F.col("o_orderkey") % 2 == part), f"{root}/landing")
        bronze = ingest_files(t.spark, f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint-{part}")
    return bronze.read().select(*orders.columns)


@query(
    "ingest_metadata",
    "SELECT o_orderkey, o_custkey, true AS path_known, true AS mtime_right, true AS read_later FROM orders",
)
def _(t: Tables) -> DataFrame:
    """Path and time of every row are those of a file that was landed, as a listing of the folder has them."""
    root = t.scratch("metadata")
    drop(t.orders, f"{root}/landing")
    rows = ingest_files(t.spark, f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint").read()
    listing = t.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"{root}/landing")
    listing = listing.select(F.regexp_replace("path", "^file:/+", "/").alias("_path"), F.col("modificationTime").alias("_mtime"))
    rows = rows.withColumn("_path", F.regexp_replace("_ingest_file_path", "^file:/+", "/")).join(listing, "_path", "left")
    return rows.select(
        "o_orderkey",
        "o_custkey",
        F.col("_mtime").isNotNull().alias("path_known"),
        (F.col("_ingest_file_mtime") == F.col("_mtime")).alias("mtime_right"),
        (F.col("_ingest_ts") >= F.col("_mtime")).alias("read_later"),
    )


@query("chunked_sink", "SELECT o_orderkey, o_custkey, o_totalprice, true AS within_cap FROM orders")
def _(t: Tables) -> DataFrame:
    """Every row is in a file of at most a thousand."""
    path = t.scratch("chunks")
    write_chunked(t.orders, path, 1000)
    rows = t.spark.read.parquet(path).select("o_orderkey", "o_custkey", "o_totalprice", F.col("_metadata.file_name").alias("_name"))
    small = rows.groupBy("_name").count().select("_name", (F.col("count") <= 1000).alias("within_cap"))
    return rows.join(small, "_name").drop("_name")


@query("stream_table", ORDERS_BY_THREE)
def _(t: Tables) -> DataFrame:
    """A plain stream over an append-only directory, appended to another."""
    root = t.scratch("stream")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice")
    for part in (0, 1):
        drop(orders.filter(F.col("o_orderkey") % 2 == part), f"{root}/src")
        stream = stream_table(t.spark, f"{root}/src")
        append_flow(
            stream, lambda b, i: b.write.mode("overwrite").parquet(f"{root}/out/batch={i}"), f"{root}/checkpoint"
        )
    return t.spark.read.parquet(f"{root}/out").drop("batch")


@query("stream_scd1", LATEST_LINES, decimals=["l_extendedprice"])
def _(t: Tables) -> DataFrame:
    root = t.scratch("scd1")
    lines = lines_of(t)
    part = F.pmod(F.xxhash64("l_partkey", "l_suppkey"), F.lit(2))
    table = scd1_runs(t.spark, f"{root}/fact", LINE_KEY, "l_shipdate")
    for step in (1, 0):
        drop(lines.filter(part == step), f"{root}/src")
        stream_scd(stream_table(t.spark, f"{root}/src", lines.schema), table, 1, "l_shipdate", f"{root}/checkpoint")
    return table.read()


@query("stream_scd2", DIM_SQL, decimals=["amount"])
def _(t: Tables) -> DataFrame:
    """Drops interleaved in time: late events reopen closed rows."""
    root = t.scratch("scd2")
    log = changes_of(t)
    part = F.pmod(F.xxhash64("event_id"), F.lit(3))
    table = scd2_runs(t.spark, f"{root}/dim", ["user_id"])
    for steps in ((0, 2), (1,)):
        drop(log.filter(part.isin(*steps)), f"{root}/src")
        stream_scd(
            stream_table(t.spark, f"{root}/src", log.schema), table, 2, "ts", f"{root}/checkpoint", track=["tier"]
        )
    return plain_windows(table.read())


@query(
    "stream_expect",
    """SELECT 'kept' AS what, count(*) FILTER (WHERE o_totalprice > 200000 AND o_orderdate <= DATE '1999-06-30') AS n FROM orders
UNION ALL SELECT 'rows', count(*) FROM orders
UNION ALL SELECT 'positive', count(*) FILTER (WHERE NOT o_totalprice > 200000) FROM orders
UNION ALL SELECT 'not_future', count(*) FILTER (WHERE NOT o_orderdate <= DATE '1999-06-30') FROM orders
UNION ALL SELECT 'open', count(*) FILTER (WHERE o_orderstatus <> 'O') FROM orders""",
)
def _(t: Tables) -> DataFrame:
    """Kept rows, and violation counts observed while writing, summed over two drops."""
    root = t.scratch("expect")
    rules = [
        expect_or_drop("positive", "o_totalprice > 200000"),
        expect_or_drop("not_future", "o_orderdate <= DATE'1999-06-30'"),
        expect("open", "o_orderstatus = 'O'"),
    ]
    totals: dict[str, int] = {}
    for part in (0, 1):
        drop(t.orders.filter(F.col("o_orderkey") % 2 == part), f"{root}/src")
        stream = stream_table(t.spark, f"{root}/src", t.orders.schema)
        for counts in stream_expect(stream, rules, f"{root}/out", f"{root}/checkpoint"):
            for name, n in counts.items():
                totals[name] = totals.get(name, 0) + n
    kept = t.spark.read.parquet(f"{root}/out").agg(F.count(F.lit(1)).alias("n")).select(F.lit("kept").alias("what"), "n")
    seen = [("rows" if k == "_rows" else k, v) for k, v in totals.items()]
    return kept.unionByName(t.spark.createDataFrame(seen, "what string, n bigint"))


@query("stream_expect_new_checkpoint", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 1000")
def _(t: Tables) -> DataFrame:
    """The checkpoint is lost between three drops: a curated table takes each file in once, whatever stream brings it."""
    root, rules = t.scratch("expect-again"), [expect_or_drop("positive", "o_totalprice > 1000")]
    orders = t.orders.select("o_orderkey", "o_totalprice")
    for part in (0, 1, 2):
        drop(orders.filter(F.col("o_orderkey") % 3 == part), f"{root}/src")
        stream = stream_table(t.spark, f"{root}/src", orders.schema).withColumn(SOURCE, F.col("_metadata.file_path"))
        stream_expect(stream, rules, f"{root}/out", f"{root}/checkpoint-{min(part, 1)}", source=SOURCE)
    return t.spark.read.schema(orders.schema).parquet(f"{root}/out/batch=*")


def _merged(t: Tables, strategy: str, batches: list[DataFrame], keys: list[str]) -> DataFrame:
    root = t.scratch("merge")
    table = RunTable(t.spark, f"{root}/target", keys, GROUP if strategy == "delete_insert" else NEWEST)
    for batch in batches:
        drop(batch, f"{root}/src")
        stream = stream_table(t.spark, f"{root}/src", batch.schema)
        append_flow(stream, merge_sink(table, strategy), f"{root}/checkpoint")
    return table.read()


@query("foreach_batch_merge", f"{MERGE} SELECT * FROM s", decimals=["o_totalprice"])
def _(t: Tables) -> DataFrame:
    """Overwrite by key treats each batch as the whole: the last one remains."""
    return _merged(t, "merge_full", [target_orders(t), source_orders(t)], ["o_orderkey"])


@query(
    "foreach_batch_upsert",
    f"{MERGE} SELECT * FROM s UNION ALL SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)",
    decimals=["o_totalprice"],
)
def _(t: Tables) -> DataFrame:
    return _merged(t, "upsert", [target_orders(t), source_orders(t)], ["o_orderkey"])


@query(
    "foreach_batch_delete_insert",
    f"{MERGE} SELECT * FROM s UNION ALL SELECT * FROM t WHERE o_custkey NOT IN (SELECT o_custkey FROM s)",
    decimals=["o_totalprice"],
)
def _(t: Tables) -> DataFrame:
    return _merged(t, "delete_insert", [target_orders(t), source_orders(t)], ["o_custkey"])


@query(
    "full_refresh",
    "SELECT 'resumed' AS run, o_orderkey FROM orders UNION ALL SELECT 'rebuilt', o_orderkey FROM orders WHERE o_orderkey % 2 = 1",
)
def _(t: Tables) -> DataFrame:
    """An incremental run after the second drop adds the rest; a full run, when the first drop is gone, has the second alone."""
    root = t.scratch("refresh")
    orders, files = t.orders.select("o_orderkey"), Files(t.spark)

    def copy(out: str, checkpoint: str) -> DataFrame:
        stream = stream_table(t.spark, f"{root}/src/part=*", orders.schema)
        append_flow(stream, lambda b, i: b.write.mode("overwrite").parquet(f"{out}/batch={i}"), checkpoint)
        return t.spark.read.parquet(out)

    for part in (0, 1):
        drop(orders.filter(F.col("o_orderkey") % 2 == part), f"{root}/src/part={part}")
        resumed = refresh({"copy": copy}, f"{root}/tables", t.spark)["copy"]
    files.delete(f"{root}/src/part=0")
    rebuilt = refresh({"copy": copy}, f"{root}/tables", t.spark, full=True)["copy"]
    runs = [(resumed, "resumed"), (rebuilt, "rebuilt")]
    one, two = (df.select(F.lit(name).alias("run"), "o_orderkey") for df, name in runs)
    return one.unionByName(two)


@query(
    "replace_partitions",
    f"""WITH a AS ({ORDERS_BY_THREE})
SELECT o_orderkey, o_orderstatus, o_custkey FROM a WHERE o_orderstatus = 'O'
UNION ALL SELECT o_orderkey, o_orderstatus, -o_custkey FROM a WHERE o_orderstatus = 'F'""",
)
def _(t: Tables) -> DataFrame:
    """One partition rewritten, one emptied, one untouched."""
    path = t.scratch("partitions")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    orders.write.partitionBy("o_orderstatus").parquet(path)
    changed = orders.filter("o_orderstatus = 'F'").withColumn("o_custkey", -F.col("o_custkey"))
    replace_partitions(changed, path, "o_orderstatus", emptied=["F", "P"])
    return t.spark.read.parquet(path).select("o_orderkey", "o_orderstatus", "o_custkey")


@query(
    "ensure_and_truncate",
    "SELECT 'filled' AS step, o_orderkey, o_custkey FROM orders UNION ALL SELECT 'again', o_orderkey, o_custkey FROM orders WHERE o_orderkey % 5 = 0",
)
def _(t: Tables) -> DataFrame:
    """An empty table is filled, left alone by a second call, emptied, and takes rows of the same schema again."""
    path = t.scratch("ensure")
    schema = typed_orders(t).schema
    ensure_table(t.spark, path, schema)
    steps = [t.keep(t.spark.read.parquet(path).select(F.lit("before").alias("step"), "o_orderkey", "o_custkey"), "before")]
    drop(typed_orders(t), path)
    ensure_table(t.spark, path, schema)  # has data: left alone
    steps.append(t.keep(t.spark.read.parquet(path).select(F.lit("filled").alias("step"), "o_orderkey", "o_custkey"), "filled"))
    truncate(t.spark, path)
    steps.append(t.keep(t.spark.read.parquet(path).select(F.lit("after").alias("step"), "o_orderkey", "o_custkey"), "after"))
    drop(typed_orders(t).filter("o_orderkey % 5 = 0"), path)
    steps.append(t.spark.read.parquet(path).select(F.lit("again").alias("step"), "o_orderkey", "o_custkey"))
    return reduce(DataFrame.unionByName, steps)


# --- the whole pipeline -------------------------------------------------------------------------

NATION_REGION = """FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

# Orders stand in for pedidos and customers for consultoras; the second snapshot moves some tiers.
PIPELINE = f"""WITH fact AS (
  SELECT o_orderkey, o_custkey, o_orderdate, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders
  WHERE CAST(o_totalprice AS DECIMAL(18,2)) > 0 AND o_orderdate <= DATE '2000-06-30'),
v AS (
  SELECT c_custkey, r_name, CASE WHEN c_custkey % 2 = 0 THEN 'bronze' ELSE 'semente' END AS old_tier,
    c_custkey % 3 = 0 AS moved {NATION_REGION} WHERE c_custkey % 11 <> 4),
dim AS (
  SELECT c_custkey, r_name, old_tier AS tier, TIMESTAMP '1996-01-01' AS s, CASE WHEN moved THEN TIMESTAMP '1998-01-01' END AS e FROM v
  UNION ALL SELECT c_custkey, r_name, 'prata', TIMESTAMP '1998-01-01', NULL FROM v WHERE moved)"""


def _orders(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("pedido_id"),
        F.col("o_custkey").cast("int").alias("consultora_id"),
        F.col("o_orderdate").alias("data_pedido"),
        F.col("o_totalprice").alias("valor_total"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("forma_pagamento"),
        F.col("o_orderdate").alias("updated_at"),
    )


def _first_drop(orders: DataFrame) -> DataFrame:
    """Every fifth order as it was before it changed its rep, time and amount, and copies of every seventh that will be removed."""
    day, changed = F.expr("INTERVAL 40 DAY"), (F.col("pedido_id") % 5 == 0) & (F.to_date("data_pedido") <= F.lit(date(2000, 6, 30)))
    older = orders.filter(changed).withColumns(
        {
            "consultora_id": (F.col("consultora_id") + 1).cast("int"),
            "data_pedido": F.col("data_pedido") - day,
            "updated_at": F.col("updated_at") - day,
            "valor_total": F.col("valor_total") + 100,
        }
    )
    copies = orders.filter("pedido_id % 7 = 0").withColumn("pedido_id", -F.col("pedido_id") - 1)
    return orders.filter(~changed).unionByName(older).unionByName(copies)


def _second_drop(orders: DataFrame) -> DataFrame:
    """The orders that changed, and the copies marked as removed."""
    gone = orders.filter("pedido_id % 7 = 0").withColumns(
        {"pedido_id": -F.col("pedido_id") - 1, "status": F.lit("gone"), "updated_at": F.col("updated_at") + F.expr("INTERVAL 1 DAY")}
    )
    return orders.filter("pedido_id % 5 = 0").unionByName(gone)


def _reps(t: Tables) -> tuple[DataFrame, DataFrame]:
    """The reps as of 1996, and after some were promoted in 1998."""
    first, second = (F.lit(datetime(y, 1, 1)).cast("timestamp") for y in (1996, 1998))
    key = F.col("c_custkey")
    tier = F.when(key % 2 == 0, "bronze").otherwise("semente")
    reps = (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            key.cast("int").alias("consultora_id"),
            # One in eleven carries a malformed number and is dropped on the way.
            F.when(key % 11 == 4, F.lit("ABC123XX99")).otherwise(F.lpad(key.cast("string"), 11, "0")).alias("cpf"),
            F.col("c_name").alias("nome"),
            F.concat(F.lit("c"), key.cast("string"), F.lit("@example.com")).alias("email"),
            F.col("r_name").alias("regiao"),
            tier.alias("tier"),
            first.alias("data_cadastro"),
            F.lit(True).alias("ativo"),
            first.alias("updated_at"),
        )
    )
    moved = F.col("consultora_id") % 3 == 0
    later = reps.withColumn("tier", F.when(moved, "prata").otherwise(F.col("tier"))).withColumn(
        "updated_at", F.when(moved, second).otherwise(F.col("updated_at"))
    )
    return reps, later


def _deployment(t: Tables) -> DirectSales:
    """Two drops of orders and two snapshots of reps; the reports are brought up to date after each."""
    root = t.scratch("sales")
    sales = DirectSales(t.spark, f"{root}/tables", date(2000, 6, 30), orders_gone="status = 'gone'")
    orders = _orders(t)
    reps, later = _reps(t)
    for part, snapshot in ((_first_drop(orders), reps), (_second_drop(orders), later)):
        write_chunked(part, f"{root}/landing", 100_000, "append")
        sales.run_orders(f"{root}/landing")
        sales.sync_reps(snapshot)
        sales.run_reps()
        sales.reports.refresh()
    return sales


@query(
    "landing_to_commission",
    f"""{PIPELINE} SELECT o_orderkey AS pedido_id, CAST(o_custkey AS INTEGER) AS consultora_id, o_orderdate AS data_pedido, amount AS valor_total,
  tier AS tier_no_momento_do_pedido, CAST(CAST(amount AS DECIMAL(32,2)) * CASE tier WHEN 'semente' THEN CAST(0.02 AS DECIMAL(5,4))
    WHEN 'bronze' THEN CAST(0.03 AS DECIMAL(5,4)) WHEN 'prata' THEN CAST(0.05 AS DECIMAL(5,4)) END AS DECIMAL(24,6)) AS comissao_devida
FROM fact JOIN dim ON o_custkey = c_custkey AND o_orderdate >= s AND (e IS NULL OR o_orderdate < e)""",
    decimals=["valor_total", "comissao_devida"],
)
def _(t: Tables) -> DataFrame:
    """Two drops of landing files and two rep snapshots through every stage to the stored as-of report, which follows the changes."""
    return _deployment(t).commission()


@query(
    "landing_to_rollup",
    f"""{PIPELINE} SELECT r_name AS regiao, tier AS tier_atual, CAST(date_trunc('month', o_orderdate) AS DATE) AS mes,
  CAST(sum(amount) AS DECIMAL(38,2)) AS total_vendas, count(*) AS qtde_pedidos
FROM fact JOIN dim ON o_custkey = c_custkey AND e IS NULL GROUP BY 1, 2, 3""",
    decimals=["total_vendas"],
    days=["mes"],
)
def _(t: Tables) -> DataFrame:
    """The same deployment to the stored current-snapshot report."""
    return _deployment(t).sales_by_region()


@query(
    "pipeline_full_refresh",
    f"""{PIPELINE}, back AS (SELECT o_orderkey, o_custkey, amount FROM fact WHERE o_orderkey % 5 <> 0)
SELECT 'row' AS what, CAST(o_orderkey AS VARCHAR) AS id, CAST(amount AS DOUBLE) AS amount, true AS passed FROM back
UNION ALL SELECT 'report', CAST(o_orderkey AS VARCHAR), CAST(amount AS DOUBLE), true
FROM back JOIN v ON o_custkey = c_custkey JOIN orders USING (o_orderkey) WHERE o_orderdate >= DATE '1996-01-01'
UNION ALL SELECT 'check', 'column:valor_total', 0, true
UNION ALL SELECT 'check', 'no_column:canal_origem', 0, true""",
)
def _(t: Tables) -> DataFrame:
    """A drop with a further column is taken back from the landing folder and everything is built anew: neither its rows nor its column are left."""
    root, orders = t.scratch("full-refresh"), _orders(t)
    sales = DirectSales(t.spark, f"{root}/tables", date(2000, 6, 30))
    evolved = F.col("pedido_id") % 5 == 0
    write_chunked(orders.filter(~evolved), f"{root}/landing/plain", 100_000)
    write_chunked(orders.filter(evolved).withColumn("canal_origem", F.lit("app")), f"{root}/landing/evolved", 100_000)
    sales.run_orders(f"{root}/landing")
    sales.sync_reps(_reps(t)[0])
    sales.run_reps()
    wide = "canal_origem" in sales.fact.schema().names
    Files(t.spark).delete(f"{root}/landing/evolved")
    sales.refresh_all(f"{root}/landing")
    again = DirectSales(t.spark, f"{root}/tables", date(2000, 6, 30))  # another reader sees the new epoch
    fact = again.fact.read()
    rows = fact.select(F.lit("row").alias("what"), F.col("pedido_id").cast("string").alias("id"), F.col("valor_total").cast("double").alias("amount"))
    report = again.commission().select(
        F.lit("report").alias("what"), F.col("pedido_id").cast("string").alias("id"), F.col("valor_total").cast("double").alias("amount")
    )
    checks = A.schema_contract(fact, {"valor_total": "decimal(18,2)"}, ["canal_origem"]).select(
        F.lit("check").alias("what"), F.col("check").alias("id"), F.lit(0.0).alias("amount"), (F.col("passed") & F.lit(wide)).alias("passed")
    )
    return rows.unionByName(report).withColumn("passed", F.lit(True)).unionByName(checks)
