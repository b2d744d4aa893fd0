"""Queries on change history: type 1 and 2 dimensions, as-of joins, reports and their upkeep."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expressions import money
from tidemark.operators.changes import CHANGED, VERSION, apply_changes, read_changes, snapshot_diff
from tidemark.operators.joins import join_current
from tidemark.operators.scd import (
    END,
    START,
    scd1,
    scd1_merge,
    scd2,
    scd2_as_of,
    scd2_current,
    scd2_merge,
)
from tidemark.plans.registry import SQL, Tables, query
from tidemark.plans.reports import (
    asof_commission,
    refresh_asof,
    refresh_rep_months,
    refresh_rollup,
    rep_months,
    sales_rollup,
)
from tidemark.sources.snapshots import SnapshotTable

# Rates for event kinds standing in for tiers; "error" is left out, so its rate is NULL.
EVENT_RATES = {"signup": "0.0200", "view": "0.0300", "click": "0.0500"}
SKEW_BAR = 2_000  # rows beyond which a key is cut, so that the skewed one is on small tables too


def tier_changes(events: DataFrame) -> DataFrame:
    """Every event but purchases, as a log of tier changes per user."""
    return events.filter("event_type <> 'purchase'").select(
        "user_id", F.col("event_type").alias("tier"), "event_id", money("value").alias("amount"), "ts"
    )


def purchases(events: DataFrame) -> DataFrame:
    return events.filter("event_type = 'purchase'").select(
        F.col("event_id").alias("order_id"), "user_id", "ts", money("value").alias("amount")
    )


def changes_of(t: Tables) -> DataFrame:
    return tier_changes(t.events)


def purchases_of(t: Tables) -> DataFrame:
    return purchases(t.events)


def dim_of(t: Tables, **options) -> DataFrame:
    return scd2(changes_of(t), ["user_id"], "ts", ["tier"], **options)


def plain_windows(dim: DataFrame) -> DataFrame:
    return dim.withColumnsRenamed({START: "start_at", END: "end_at"})


LOG = """log AS (
  SELECT user_id, event_type AS tier, event_id, CAST(value AS DECIMAL(18,2)) AS amount, ts
  FROM events WHERE event_type <> 'purchase')"""

DIM = f"""{LOG},
marked AS (
  SELECT *, CASE WHEN lag(tier) OVER w IS DISTINCT FROM tier THEN 1 ELSE 0 END AS opens
  FROM log WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS run FROM marked),
runs AS (
  SELECT user_id, run, min(ts) AS start_at, arg_max(tier, ts) AS tier, arg_max(event_id, ts) AS event_id,
         arg_max(amount, ts) AS amount, max(ts) AS ts
  FROM numbered GROUP BY user_id, run),
dim AS (
  SELECT user_id, tier, event_id, amount, ts, start_at,
         lead(start_at) OVER (PARTITION BY user_id ORDER BY start_at) AS end_at
  FROM runs)"""

COMMISSION = f"""WITH {DIM}
SELECT p.event_id AS order_id, p.user_id, p.ts, CAST(p.value AS DECIMAL(18,2)) AS amount,
       d.tier AS tier_no_momento_do_pedido,
       CAST(CAST(CAST(p.value AS DECIMAL(18,2)) AS DECIMAL(32,2)) * CASE d.tier
         WHEN 'signup' THEN CAST(0.02 AS DECIMAL(5,4)) WHEN 'view' THEN CAST(0.03 AS DECIMAL(5,4))
         WHEN 'click' THEN CAST(0.05 AS DECIMAL(5,4)) END AS DECIMAL(24,6)) AS comissao_devida
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF JOIN dim d ON p.user_id = d.user_id AND p.ts >= d.start_at"""

DIM_SQL = f"WITH {DIM} SELECT user_id, tier, event_id, amount, ts, start_at, end_at FROM dim"


def commission_of(t: Tables, fact: DataFrame, dim: DataFrame, **options) -> DataFrame:
    return asof_commission(
        fact, dim, "user_id", "order_id", "ts", "amount", rates=EVENT_RATES, **options
    )


@query("asof_commission", COMMISSION, decimals=["amount", "comissao_devida"])
def _(t: Tables) -> DataFrame:
    return commission_of(t, purchases_of(t), dim_of(t))


@query("asof_commission_merge", COMMISSION, decimals=["amount", "comissao_devida"])
def _(t: Tables) -> DataFrame:
    """The same from a stored dimension, with a sample drawn for large keys."""
    return commission_of(t, purchases_of(t), t.keep(dim_of(t), "dim"), rows_per_task=SKEW_BAR)


def skewed_events(t: Tables) -> DataFrame:
    """Events of every third user booked on one: a single key holds a third of all rows."""
    one = F.when(F.col("user_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id"))
    return t.events.withColumn("user_id", one.cast("bigint"))


def skewed_sql(sql: str) -> str:
    one = "CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END"
    skewed = f"skewed AS (SELECT * REPLACE ({one} AS user_id) FROM events),\nlog AS ("
    return sql.replace("FROM events", "FROM skewed").replace("log AS (", skewed, 1)


@query("asof_skewed", skewed_sql(COMMISSION), decimals=["amount", "comissao_devida"])
def _(t: Tables) -> DataFrame:
    """Both the dimension and the join cut the large key into segments."""
    events, bar = skewed_events(t), SKEW_BAR
    dim = scd2(tier_changes(events), ["user_id"], "ts", ["tier"], rows_per_task=bar)
    dim = t.keep(dim, "dim")
    return commission_of(t, purchases(events), dim, rows_per_task=bar)


SAME_DAY = skewed_sql(COMMISSION).replace(
    "SELECT * FROM skewed WHERE event_type = 'purchase'",
    "SELECT * REPLACE (date_trunc('day', ts) + INTERVAL 1 DAY AS ts) FROM skewed WHERE event_type = 'purchase'",
)


@query("asof_same_day", SAME_DAY, decimals=["amount", "comissao_devida"])
def _(t: Tables) -> DataFrame:
    """Orders of a large key that fall on a few instants only."""
    events, bar = skewed_events(t), SKEW_BAR
    dim = t.keep(scd2(tier_changes(events), ["user_id"], "ts", ["tier"], rows_per_task=bar), "dim")
    fact = purchases(events).withColumn("ts", F.date_trunc("day", "ts").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY"))
    return commission_of(t, fact, dim, rows_per_task=bar)


@query("scd2_dim", DIM_SQL, decimals=["amount"])
def _(t: Tables) -> DataFrame:
    return plain_windows(dim_of(t))


@query("scd2_skewed", skewed_sql(DIM_SQL), decimals=["amount"])
def _(t: Tables) -> DataFrame:
    log = tier_changes(skewed_events(t))
    return plain_windows(scd2(log, ["user_id"], "ts", ["tier"], rows_per_task=SKEW_BAR))


SAME_INSTANT = """WITH ev AS (
  SELECT CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS user_id, event_type AS tier, event_id,
         CAST(value AS DECIMAL(18,2)) AS amount, date_trunc('day', ts) AS day
  FROM events WHERE event_type <> 'purchase'),
won AS (
  SELECT * FROM ev
  QUALIFY row_number() OVER (PARTITION BY user_id, day ORDER BY tier DESC, event_id DESC, amount DESC) = 1),
marked AS (
  SELECT *, CASE WHEN lag(tier) OVER (PARTITION BY user_id ORDER BY day) IS DISTINCT FROM tier THEN 1 ELSE 0 END AS opens FROM won),
runs AS (
  SELECT user_id, tier, event_id, amount, day, sum(opens) OVER (PARTITION BY user_id ORDER BY day) AS run FROM marked),
rows AS (
  SELECT user_id, run, arg_max(tier, day) AS tier, arg_max(event_id, day) AS event_id, arg_max(amount, day) AS amount,
         max(day) AS day, min(day) AS start_at
  FROM runs GROUP BY user_id, run)
SELECT user_id, tier, event_id, amount, CAST(day AS TIMESTAMP) AS day, CAST(start_at AS TIMESTAMP) AS start_at,
       CAST(lead(start_at) OVER (PARTITION BY user_id ORDER BY start_at) AS TIMESTAMP) AS end_at
FROM rows"""


@query("scd2_same_instant", SAME_INSTANT, decimals=["amount"])
def _(t: Tables) -> DataFrame:
    """Events by day, so that a key with a third of all rows has few instants, each with very many events."""
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    log = tier_changes(skewed_events(t)).select("user_id", "tier", "event_id", "amount", day.alias("day"))
    return plain_windows(scd2(log, ["user_id"], "day", ["tier"], rows_per_task=SKEW_BAR))


@query("scd2_incremental", DIM_SQL, decimals=["amount"])
def _(t: Tables) -> DataFrame:
    """Three batches, interleaved in time, applied one after the other."""
    log = changes_of(t)
    part = F.pmod(F.xxhash64("event_id"), F.lit(3))
    dim = t.keep(scd2(log.filter(part == 2), ["user_id"], "ts", ["tier"]), "dim")
    for step, seen in ((0, [2, 0]), (1, [2, 0, 1])):
        history, batch = log.filter(part.isin(seen)), log.filter(part == step)
        dim = scd2_merge(dim, history, batch, ["user_id"], "ts", ["tier"])
        if step == 0:
            dim = t.keep(dim, "dim")
    return plain_windows(dim)


@query("scd2_in_order", DIM_SQL, decimals=["amount"])
def _(t: Tables) -> DataFrame:
    """Two batches split by time: the second extends open rows without rereading the log."""
    log = changes_of(t)
    edge = F.lit(datetime(2024, 1, 16)).cast("timestamp_ntz")
    dim = t.keep(scd2(log.filter(F.col("ts") < edge), ["user_id"], "ts", ["tier"]), "dim")
    return plain_windows(scd2_merge(dim, log, log.filter(F.col("ts") >= edge), ["user_id"], "ts", ["tier"]))


@query(
    "scd2_deletes",
    f"""WITH {LOG},
marked AS (
  SELECT *, CASE WHEN lag(tier) OVER w IS DISTINCT FROM tier THEN 1 ELSE 0 END AS opens
  FROM log WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
runs AS (
  SELECT user_id, tier, ts AS start_at, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS end_at
  FROM marked WHERE opens = 1)
SELECT * FROM runs WHERE tier <> 'error'""",
)
def _(t: Tables) -> DataFrame:
    """An ``error`` event closes the open row without opening another."""
    dim = dim_of(t, delete_when="tier = 'error'")
    return plain_windows(dim).select("user_id", "tier", "start_at", "end_at")


@query("scd2_current", f"WITH {DIM} SELECT user_id, tier, start_at FROM dim WHERE end_at IS NULL")
def _(t: Tables) -> DataFrame:
    return plain_windows(scd2_current(dim_of(t))).select("user_id", "tier", "start_at")


@query(
    "scd2_as_of",
    f"""WITH {LOG}
SELECT user_id, arg_max(tier, ts) AS tier FROM log
WHERE ts <= TIMESTAMP '2024-01-15 12:00:00' GROUP BY user_id""",
)
def _(t: Tables) -> DataFrame:
    at = F.lit(datetime(2024, 1, 15, 12)).cast("timestamp_ntz")
    return scd2_as_of(dim_of(t), at).select("user_id", "tier")


# --- type 1 -------------------------------------------------------------------------------------

LINE_KEY = ["l_orderkey", "l_linenumber"]


def lines_of(t: Tables) -> DataFrame:
    return t.lineitem.select(
        *LINE_KEY,
        "l_partkey",
        "l_suppkey",
        money("l_extendedprice").alias("l_extendedprice"),
        "l_returnflag",
        "l_shipdate",
    )


LATEST_LINES = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS l_extendedprice,
       l_returnflag, l_shipdate
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, CAST(l_extendedprice AS DECIMAL(18,2)) DESC,
           l_returnflag DESC) = 1"""


@query("scd1_latest", LATEST_LINES, decimals=["l_extendedprice"])
def _(t: Tables) -> DataFrame:
    return scd1(lines_of(t), LINE_KEY, "l_shipdate")


@query("scd1_incremental", LATEST_LINES, decimals=["l_extendedprice"])
def _(t: Tables) -> DataFrame:
    """Three batches in an order unrelated to time; late rows never win."""
    lines = lines_of(t)
    part = F.pmod(F.xxhash64("l_partkey", "l_suppkey"), F.lit(3))
    state = scd1(lines.filter(part == 1), LINE_KEY, "l_shipdate")
    for step in (2, 0):
        state = scd1_merge(state, lines.filter(part == step), LINE_KEY, "l_shipdate")
    return state


# --- reports ------------------------------------------------------------------------------------


def regional_log(t: Tables) -> DataFrame:
    """Tier changes with the user's region."""
    places = (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("c_custkey").alias("user_id"), F.col("r_name").alias("regiao"))
    )
    return changes_of(t).join(places, "user_id")


def regional_dim(t: Tables, log: DataFrame | None = None) -> DataFrame:
    return scd2(regional_log(t) if log is None else log, ["user_id"], "ts", ["tier", "regiao"])


ROLLUP = f"""WITH {LOG},
cur AS (SELECT user_id, arg_max(tier, ts) AS tier FROM log GROUP BY user_id)
SELECT r_name AS regiao, cur.tier, CAST(date_trunc('month', e.ts) AS DATE) AS mes,
       CAST(sum(CAST(e.value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_vendas,
       count(e.event_id) AS qtde_pedidos
FROM events e JOIN cur ON e.user_id = cur.user_id
JOIN customer ON c_custkey = e.user_id JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
WHERE e.event_type = 'purchase' GROUP BY 1, 2, 3"""


def months_of(fact: DataFrame) -> DataFrame:
    return rep_months(fact, "user_id", "ts", "amount", "order_id")


@query("sales_by_region_tier_month", ROLLUP, decimals=["total_vendas"], days=["mes"])
def _(t: Tables) -> DataFrame:
    return sales_rollup(months_of(purchases_of(t)), regional_dim(t), "user_id", ["regiao", "tier"])


@query("sales_rollup_incremental", ROLLUP, decimals=["total_vendas"], days=["mes"])
def _(t: Tables) -> DataFrame:
    """The first half of January, then the rest: orders are added, changed and removed while dimension rows change.

    At first every third order has another amount and time, and orders that never were are there as well.
    """
    edge = F.lit(datetime(2024, 1, 16)).cast("timestamp_ntz")
    fact, log, by = purchases_of(t), regional_log(t), ["regiao", "tier"]
    late, changed = F.col("ts") >= edge, F.col("order_id") % 3 == 0
    early = fact.filter(~late)
    wrong = early.filter(changed).select(
        "order_id", "user_id", (F.col("ts") - F.expr("INTERVAL 20 DAY")).alias("ts"), money(F.col("amount") + 5).alias("amount")
    )
    never = early.filter("order_id % 7 = 0").withColumn("order_id", -F.col("order_id") - 1)
    dim_before = t.keep(regional_dim(t, log.filter(~late)), "dim")
    months_before = t.keep(months_of(early.filter(~changed).unionByName(wrong).unionByName(never)), "months")
    rollup = t.keep(sales_rollup(months_before, dim_before, "user_id", by), "rollup")

    dim_after = t.keep(
        scd2_merge(dim_before, log, log.filter(late), ["user_id"], "ts", ["tier", "regiao"]), "dim"
    )
    removed = months_of(wrong.unionByName(never))
    added = months_of(fact.filter(late).unionByName(early.filter(changed)))
    months_after = t.keep(refresh_rep_months(months_before, removed, added, "user_id"), "months")
    touched = log.filter(late).select("user_id").union(removed.select("user_id")).union(added.select("user_id"))
    return refresh_rollup(rollup, months_before, months_after, dim_before, dim_after, touched, "user_id", by)


@query("asof_incremental", COMMISSION, decimals=["amount", "comissao_devida"])
def _(t: Tables) -> DataFrame:
    """A report over half of the changes and of the orders, brought up to date with the rest."""
    fact, log = purchases_of(t), changes_of(t)
    late_change = F.pmod(F.xxhash64("event_id"), F.lit(4)) == 0
    late_order = F.pmod(F.xxhash64("order_id"), F.lit(4)) == 1
    dim_before = t.keep(scd2(log.filter(~late_change), ["user_id"], "ts", ["tier"]), "dim")
    report = t.keep(commission_of(t, fact.filter(~late_order), dim_before), "report")

    batch = log.filter(late_change)
    dim = t.keep(scd2_merge(dim_before, log, batch, ["user_id"], "ts", ["tier"]), "dim")
    since = batch.select("user_id", F.col("ts").alias("since"))
    return refresh_asof(
        report,
        fact,
        dim,
        fact.filter(late_order),
        since,
        "user_id",
        "order_id",
        "ts",
        amount="amount",
        rates=EVENT_RATES,
    )


LATE_AMOUNT = (
    DIM_SQL.replace("CAST(value AS DECIMAL(18,2)) AS amount", "CASE WHEN event_id % 4 = 0 THEN CAST(value AS DECIMAL(18,2)) END AS amount")
    .replace("arg_max(amount, ts)", "arg_max_null(amount, ts)")
)


@query("scd2_new_column", LATE_AMOUNT, decimals=["amount"])
def _(t: Tables) -> DataFrame:
    """A column that the first events lack and a later batch brings."""
    log, late = changes_of(t), F.col("event_id") % 4 == 0
    early = log.filter(~late).drop("amount")
    dim = t.keep(scd2(early, ["user_id"], "ts", ["tier"]), "dim")
    batch = log.filter(late)
    so_far = early.unionByName(batch, allowMissingColumns=True)
    merged = scd2_merge(dim, so_far, batch, ["user_id"], "ts", ["tier"])
    return plain_windows(merged).select("user_id", "tier", "event_id", "amount", "ts", "start_at", "end_at")


@query(
    "join_current",
    f"""WITH {LOG}, cur AS (SELECT user_id, arg_max(tier, ts) AS tier FROM log GROUP BY user_id)
SELECT e.event_id AS order_id, e.user_id, CAST(e.value AS DECIMAL(18,2)) AS amount, cur.tier
FROM events e JOIN cur ON e.user_id = cur.user_id WHERE e.event_type = 'purchase'""",
    decimals=["amount"],
)
def _(t: Tables) -> DataFrame:
    current = dim_of(t).select("user_id", "tier", START, END)
    return join_current(purchases_of(t), current, "user_id").select("order_id", "user_id", "amount", "tier")


# --- change capture -----------------------------------------------------------------------------

COPY_OFFSET = 1_000_000_000


def old_snapshot(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", "c_name", "c_mktsegment", money("c_acctbal").alias("c_acctbal"))


def new_snapshot(t: Tables) -> DataFrame:
    """Some customers gone, some changed (one attribute to NULL), some new."""
    old, segment, balance = old_snapshot(t), F.col("c_mktsegment"), F.col("c_acctbal")
    changed = old.filter((balance < 0) | (balance > 500)).select(
        "c_custkey",
        "c_name",
        F.when(segment == "FURNITURE", F.lit(None)).otherwise(segment).alias("c_mktsegment"),
        F.when(balance > 9000, money(balance + 10)).otherwise(balance).alias("c_acctbal"),
    )
    added = old.filter(segment == "MACHINERY").withColumn("c_custkey", F.col("c_custkey") + COPY_OFFSET)
    return changed.unionByName(added)


SNAPSHOTS = f"""o AS (
  SELECT c_custkey, c_name, c_mktsegment, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal FROM customer),
n AS (
  SELECT c_custkey, c_name, CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment END AS c_mktsegment,
         CAST(CASE WHEN c_acctbal > 9000 THEN c_acctbal + 10 ELSE c_acctbal END AS DECIMAL(18,2)) AS c_acctbal
  FROM o WHERE c_acctbal < 0 OR c_acctbal > 500
  UNION ALL
  SELECT c_custkey + {COPY_OFFSET}, c_name, c_mktsegment, c_acctbal FROM o WHERE c_mktsegment = 'MACHINERY')"""


@query(
    "snapshot_diff",
    f"""WITH {SNAPSHOTS},
d AS (
  SELECT o.c_custkey, concat_ws(',',
      CASE WHEN o.c_name IS DISTINCT FROM n.c_name THEN 'c_name' END,
      CASE WHEN o.c_mktsegment IS DISTINCT FROM n.c_mktsegment THEN 'c_mktsegment' END,
      CASE WHEN o.c_acctbal IS DISTINCT FROM n.c_acctbal THEN 'c_acctbal' END) AS changed
  FROM o JOIN n ON o.c_custkey = n.c_custkey)
SELECT n.*, 'insert' AS change_type, '' AS changed FROM n ANTI JOIN o ON n.c_custkey = o.c_custkey
UNION ALL SELECT o.*, 'delete', '' FROM o ANTI JOIN n ON n.c_custkey = o.c_custkey
UNION ALL SELECT o.*, 'update_preimage', changed FROM o JOIN d ON o.c_custkey = d.c_custkey WHERE changed <> ''
UNION ALL SELECT n.*, 'update_postimage', changed FROM n JOIN d ON n.c_custkey = d.c_custkey WHERE changed <> ''""",
    decimals=["c_acctbal"],
)
def _(t: Tables) -> DataFrame:
    diff = snapshot_diff(old_snapshot(t), new_snapshot(t), ["c_custkey"], 1)
    return diff.select(
        "c_custkey",
        "c_name",
        "c_mktsegment",
        "c_acctbal",
        F.col("_change_type").alias("change_type"),
        F.concat_ws(",", CHANGED).alias("changed"),
    )


@query("snapshot_diff_pruned", SQL["snapshot_diff"], decimals=["c_acctbal"])
def _(t: Tables) -> DataFrame:
    """The same changes from a stored snapshot, of which only buckets whose digests differ are read."""
    state = SnapshotTable(t.spark, t.scratch("snapshots"), ["c_custkey"])
    state.sync(old_snapshot(t), t.scratch("feed"))
    diff, _, _ = state.changes(new_snapshot(t))
    return diff.select(
        "c_custkey",
        "c_name",
        "c_mktsegment",
        "c_acctbal",
        F.col("_change_type").alias("change_type"),
        F.concat_ws(",", CHANGED).alias("changed"),
    )


@query("apply_changes", f"WITH {SNAPSHOTS} SELECT * FROM n", decimals=["c_acctbal"])
def _(t: Tables) -> DataFrame:
    old = old_snapshot(t)
    return apply_changes(old, snapshot_diff(old, new_snapshot(t), ["c_custkey"], 1), ["c_custkey"])


@query(
    "changes_to_scd2",
    f"""WITH {SNAPSHOTS},
ev AS (
  SELECT o.*, 0 AS v FROM o
  UNION ALL SELECT n.*, 1 FROM n LEFT JOIN o ON n.c_custkey = o.c_custkey
  WHERE o.c_custkey IS NULL OR n.c_mktsegment IS DISTINCT FROM o.c_mktsegment
     OR n.c_acctbal IS DISTINCT FROM o.c_acctbal OR n.c_name IS DISTINCT FROM o.c_name)
SELECT c_custkey, c_name, c_mktsegment, c_acctbal, CAST(v AS BIGINT) AS start_at,
       coalesce(CAST(lead(v) OVER (PARTITION BY c_custkey ORDER BY v) AS VARCHAR), 'open') AS end_at
FROM ev""",
    decimals=["c_acctbal"],
)
def _(t: Tables) -> DataFrame:
    """Two chained diffs as a change feed; a source delete leaves its row open."""
    old, new = old_snapshot(t), new_snapshot(t)
    feed = snapshot_diff(old.limit(0), old, ["c_custkey"], 0).unionByName(
        snapshot_diff(old, new, ["c_custkey"], 1)
    )
    events = read_changes(feed).select(*old.columns, VERSION)
    dim = scd2(events, ["c_custkey"], VERSION, ["c_name", "c_mktsegment", "c_acctbal"])
    return plain_windows(dim.drop(VERSION)).withColumn("end_at", F.coalesce(F.col("end_at").cast("string"), F.lit("open")))
