"""Queries on rules, merges, governed reads, summaries, generated data and audits."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expressions import (
    CPF_FORMAT,
    CPF_MASK,
    TIER_LADDER,
    TIER_RATES,
    align_ts,
    cpf_from_base,
    cpf_is_valid,
    draw,
    ladder_step,
    money,
    rate_lookup,
)
from tidemark.operators import audit as A
from tidemark.operators.governance import (
    GovernedTable,
    GrantTable,
    PolicyTable,
    mask_column,
    mask_tiered,
    member,
    policy,
    row_filter,
    row_filter_groups,
    session_user,
    thousands,
    user_like,
)
from tidemark.operators.joins import mark_granted, not_in, orphans, semi_granted
from tidemark.operators.changes import apply_changes, snapshot_diff
from tidemark.operators.merge import (
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
from tidemark.operators.projection import count_where, project_typed, sample_rows, select_except, top_n
from tidemark.operators.quality import (
    ExpectationFailed,
    apply_expectations,
    expect,
    expect_or_drop,
    expect_or_fail,
    expectation_report,
)
from tidemark.operators.scd import START
from tidemark.operators.summaries import (
    amount_stats,
    distinct_counts,
    distinct_values,
    duplicate_keys,
    shares_vs_target,
    value_counts,
)
from tidemark.plans.direct_sales import promote_reps
from tidemark.plans.history_queries import (
    DIM,
    EVENT_RATES,
    LINE_KEY,
    commission_of,
    dim_of,
    purchases_of,
)
from tidemark.plans.registry import SQL, Tables, query
from tidemark.sources import generate as G
from tidemark.sources.parts import PartTable

# --- rules and projections ----------------------------------------------------------------------

ORDER_RULES = (
    expect_or_drop("positive", "o_totalprice > 200000.005"),
    expect_or_drop("not_future", "o_orderdate <= DATE'1999-06-30'"),
    expect("urgent_is_open", "o_orderpriority <> '1-URGENT' OR o_orderstatus = 'O'"),
    expect_or_fail("key", "o_orderkey IS NOT NULL"),
)


def typed_orders(t: Tables) -> DataFrame:
    return select_except(t.orders, drop=("o_orderpriority",), o_totalprice=money("o_totalprice"))


TYPED_ORDERS = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice
FROM orders"""


@query("select_except_cast", TYPED_ORDERS, decimals=["o_totalprice"])
def _(t: Tables) -> DataFrame:
    return typed_orders(t)


@query(
    "project_typed",
    """SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal FROM customer""",
    decimals=["c_acctbal"],
)
def _(t: Tables) -> DataFrame:
    return project_typed(
        t.customer, {"c_custkey": "int", "c_name": None, "c_nationkey": "string", "c_acctbal": "decimal(18,2)"}
    )


@query(
    "expect_drop",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority,
       CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice FROM orders
WHERE CAST(o_totalprice AS DECIMAL(18,2)) > 200000.005 AND o_orderdate <= DATE '1999-06-30'""",
    decimals=["o_totalprice"],
)
def _(t: Tables) -> DataFrame:
    """Rules see the row after the cast to cents; the fail rule is checked first."""
    return apply_expectations(select_except(t.orders, o_totalprice=money("o_totalprice")), ORDER_RULES)


@query(
    "expect_report",
    """WITH c AS (SELECT count(*) AS n,
  count(*) FILTER (WHERE CAST(o_totalprice AS DECIMAL(18,2)) > 200000.005) AS a,
  count(*) FILTER (WHERE o_orderdate <= DATE '1999-06-30') AS b,
  count(*) FILTER (WHERE o_orderpriority <> '1-URGENT' OR o_orderstatus = 'O') AS d FROM orders)
SELECT 'positive' AS rule, 'drop' AS action, a AS passed, n - a AS failed FROM c
UNION ALL SELECT 'not_future', 'drop', b, n - b FROM c
UNION ALL SELECT 'urgent_is_open', 'warn', d, n - d FROM c
UNION ALL SELECT 'key', 'fail', n, 0 FROM c""",
)
def _(t: Tables) -> DataFrame:
    return expectation_report(select_except(t.orders, o_totalprice=money("o_totalprice")), ORDER_RULES)


@query("expect_fail_ok", "SELECT c_custkey, c_name FROM customer")
def _(t: Tables) -> DataFrame:
    return apply_expectations(t.customer, [expect_or_fail("pk", "c_custkey IS NOT NULL")]).select(
        "c_custkey", "c_name"
    )


@query(
    "expect_fail_aborts",
    "SELECT 'positive_balance' AS rule, CAST(count(*) AS BIGINT) AS violations FROM customer WHERE c_acctbal <= 0",
)
def _(t: Tables) -> DataFrame:
    """What the aborted update reports."""
    counts = {}
    try:
        apply_expectations(t.customer, [expect_or_fail("positive_balance", "c_acctbal > 0")])
    except ExpectationFailed as failure:
        counts = failure.counts
    return t.spark.createDataFrame(list(counts.items()), "rule string, violations bigint")


@query(
    "rate_lookup",
    """SELECT event_id, CASE event_type WHEN 'signup' THEN CAST(0.02 AS DECIMAL(5,4))
  WHEN 'view' THEN CAST(0.03 AS DECIMAL(5,4)) WHEN 'click' THEN CAST(0.05 AS DECIMAL(5,4)) END AS rate,
  event_type IN ('signup', 'view', 'click') AS known
FROM events""",
    decimals=["rate"],
)
def _(t: Tables) -> DataFrame:
    rate = rate_lookup("event_type", EVENT_RATES)
    return t.events.select("event_id", rate.alias("rate"), rate.isNotNull().alias("known"))


@query(
    "ladder_step",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN '4-NOT SPECIFIED' WHEN '4-NOT SPECIFIED' THEN '3-MEDIUM'
  WHEN '3-MEDIUM' THEN '2-HIGH' WHEN '2-HIGH' THEN '1-URGENT' WHEN '1-URGENT' THEN '1-URGENT' END AS next
FROM orders""",
)
def _(t: Tables) -> DataFrame:
    ladder = ("5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT")
    return t.orders.select("o_orderkey", ladder_step("o_orderpriority", ladder).alias("next"))


@query(
    "cpf_digits",
    f"""WITH b AS (SELECT c_custkey, lpad(CAST(CAST('0x' || substr(md5('42:cpf:' || c_custkey), 1, 13) AS BIGINT)
  % 1000000000 AS VARCHAR), 9, '0') AS base FROM customer),
s AS (SELECT *, list_sum([CAST(base[i] AS INTEGER) * (11 - i) FOR i IN range(1, 10)]) AS t1,
  list_sum([CAST(base[i] AS INTEGER) * (12 - i) FOR i IN range(1, 10)]) AS t2 FROM b),
d AS (SELECT *, CASE WHEN t1 % 11 < 2 THEN 0 ELSE 11 - t1 % 11 END AS d1 FROM s),
e AS (SELECT *, t2 + 2 * d1 AS t3 FROM d)
SELECT c_custkey, base || CAST(d1 AS INTEGER) || CAST(CASE WHEN t3 % 11 < 2 THEN 0 ELSE 11 - t3 % 11 END AS INTEGER) AS cpf,
  true AS valid, true AS well_formed FROM e""",
)
def _(t: Tables) -> DataFrame:
    digits = F.lpad((draw(42, "cpf", F.col("c_custkey")) % F.lit(10**9)).cast("string"), 9, "0")
    made = t.customer.select("c_custkey", digits.alias("base")).select(
        "c_custkey", cpf_from_base(F.col("base")).alias("cpf")
    )
    return made.select("c_custkey", "cpf", cpf_is_valid("cpf").alias("valid"), F.col("cpf").rlike(CPF_FORMAT).alias("well_formed"))


@query("align_ts", "SELECT event_id, date_trunc('hour', ts) AS hour FROM events")
def _(t: Tables) -> DataFrame:
    """Zoneless to zoned time and back in UTC changes nothing."""
    return t.events.select("event_id", F.date_trunc("hour", align_ts("ts")).cast("timestamp_ntz").alias("hour"))


# --- merges -------------------------------------------------------------------------------------


def target_orders(t: Tables) -> DataFrame:
    """What the target already has: orders up to a day."""
    return typed_orders(t).filter("o_orderdate < TIMESTAMP_NTZ'2000-07-01'")


def source_orders(t: Tables) -> DataFrame:
    """Finished orders, repriced: some known to the target, some new."""
    repriced = money(F.col("o_totalprice") + 1)
    return typed_orders(t).filter("o_orderstatus = 'F'").withColumn("o_totalprice", repriced)


MERGE = f"""WITH a AS ({TYPED_ORDERS}),
t AS (SELECT * FROM a WHERE o_orderdate < TIMESTAMP '2000-07-01'),
s AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, CAST(o_totalprice + 1 AS DECIMAL(18,2)) AS o_totalprice
      FROM a WHERE o_orderstatus = 'F')"""


@query(
    "upsert",
    f"{MERGE} SELECT * FROM s UNION ALL SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)",
    decimals=["o_totalprice"],
)
def _(t: Tables) -> DataFrame:
    return upsert(target_orders(t), source_orders(t), ["o_orderkey"])


@query(
    "upsert_deletes",
    f"""{MERGE} SELECT * FROM s WHERE NOT o_totalprice < 100000
UNION ALL SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)""",
    decimals=["o_totalprice"],
)
def _(t: Tables) -> DataFrame:
    return upsert(target_orders(t), source_orders(t), ["o_orderkey"], delete_when="o_totalprice < 100000")


@query(
    "insert_if_absent",
    f"{MERGE} SELECT * FROM t UNION ALL SELECT * FROM s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t)",
    decimals=["o_totalprice"],
)
def _(t: Tables) -> DataFrame:
    return insert_if_absent(target_orders(t), source_orders(t), ["o_orderkey"])


@query(
    "guarded_update",
    """SELECT o_orderkey, CASE WHEN g THEN '2-HIGH' ELSE o_orderpriority END AS o_orderpriority,
  CASE WHEN g THEN TIMESTAMP '2000-01-01' ELSE o_orderdate END AS o_orderdate
FROM (SELECT *, o_orderpriority = '3-MEDIUM' AND o_orderkey % 10 = 0 AND o_orderdate < TIMESTAMP '2000-01-01' AS g FROM orders)""",
)
def _(t: Tables) -> DataFrame:
    """One rung up with a fixed date, twice: the second run finds nothing to do."""
    day = F.lit(datetime(2000, 1, 1)).cast("timestamp_ntz")
    orders = t.orders.select("o_orderkey", "o_orderpriority", "o_orderdate")
    guard = (F.col("o_orderpriority") == "3-MEDIUM") & (F.col("o_orderkey") % 10 == 0) & (F.col("o_orderdate") < day)
    for _ in range(2):
        orders = guarded_update(orders, guard, {"o_orderpriority": F.lit("2-HIGH"), "o_orderdate": day})
    return orders


@query("merge_full", f"{MERGE} SELECT * FROM s", decimals=["o_totalprice"])
def _(t: Tables) -> DataFrame:
    return merge_full(target_orders(t), source_orders(t), ["o_orderkey"])


@query(
    "merge_full_counts",
    f"""{MERGE} SELECT count(*) FILTER (WHERE t.o_orderkey IS NOT NULL AND s.o_orderkey IS NOT NULL) AS updated,
  count(*) FILTER (WHERE t.o_orderkey IS NULL) AS inserted, count(*) FILTER (WHERE s.o_orderkey IS NULL) AS deleted
FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey""",
)
def _(t: Tables) -> DataFrame:
    return merge_full_counts(target_orders(t), source_orders(t), ["o_orderkey"])


@query(
    "delete_insert",
    f"{MERGE} SELECT * FROM s UNION ALL SELECT * FROM t WHERE o_custkey NOT IN (SELECT o_custkey FROM s)",
    decimals=["o_totalprice"],
)
def _(t: Tables) -> DataFrame:
    """By customer: every order of a customer in the batch gives way to the batch's orders."""
    return delete_insert(target_orders(t), source_orders(t), ["o_custkey"])


@query(
    "replace_where",
    f"""{MERGE} SELECT * FROM t WHERE NOT (o_orderdate >= TIMESTAMP '1998-01-01')
UNION ALL SELECT * FROM s WHERE o_orderdate >= TIMESTAMP '1998-01-01'""",
    decimals=["o_totalprice"],
)
def _(t: Tables) -> DataFrame:
    return replace_where(target_orders(t), source_orders(t), "o_orderdate >= TIMESTAMP_NTZ'1998-01-01'")


@query(
    "backfill_override",
    f"""{MERGE} SELECT * FROM t WHERE NOT (o_orderdate < TIMESTAMP '1996-01-01')
UNION ALL SELECT * FROM s WHERE o_orderdate < TIMESTAMP '1996-01-01'""",
    decimals=["o_totalprice"],
)
def _(t: Tables) -> DataFrame:
    return replace_where(
        target_orders(t),
        source_orders(t),
        "o_orderdate >= TIMESTAMP_NTZ'1998-01-01'",
        override="o_orderdate < TIMESTAMP_NTZ'1996-01-01'",
    )


@query(
    "replace_window",
    f"""{MERGE} SELECT * FROM t WHERE NOT (o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-07-01')
UNION ALL SELECT * FROM s WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-07-01'""",
    decimals=["o_totalprice"],
)
def _(t: Tables) -> DataFrame:
    low, high = (F.lit(datetime(1997, m, 1)).cast("timestamp_ntz") for m in (1, 7))
    return replace_window(target_orders(t), source_orders(t), "o_orderdate", low, high)


def month_parts(t: Tables, split: str = "date_format(o_orderdate, 'yyyy-MM')") -> PartTable:
    table = PartTable(t.spark, t.scratch("parts"), "o_orderdate", split)
    table.append(target_orders(t))
    return table


@query("replace_where_stored", SQL["replace_window"], decimals=["o_totalprice"])
def _(t: Tables) -> DataFrame:
    """Half a year of a table stored by month is replaced in one commit."""
    table = month_parts(t)
    low, high = (datetime(1997, m, 1) for m in (1, 7))
    table.replace_range(source_orders(t), low, high)
    return table.read()


@query("backfill_stored", SQL["backfill_override"], decimals=["o_totalprice"])
def _(t: Tables) -> DataFrame:
    """The range of one run, on parts of which one is NULL and the others hold a colon; the range cuts through all of them."""
    table = month_parts(t, "CASE WHEN o_orderstatus <> 'P' THEN concat(o_orderstatus, ':', o_custkey % 3) END")
    table.replace_range(source_orders(t), datetime(1998, 1, 1), None, override=(None, datetime(1996, 1, 1)))
    return table.read()


@query("delete_where", f"{MERGE} SELECT * FROM t WHERE NOT (o_orderstatus = 'P' AND o_totalprice > 100000)", decimals=["o_totalprice"])
def _(t: Tables) -> DataFrame:
    return delete_where(target_orders(t), "o_orderstatus = 'P' AND o_totalprice > 100000")


@query("not_in", f"{MERGE} SELECT * FROM s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t)", decimals=["o_totalprice"])
def _(t: Tables) -> DataFrame:
    return not_in(source_orders(t), target_orders(t), ["o_orderkey"])


@query(
    "orphans",
    """SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
)
def _(t: Tables) -> DataFrame:
    """Orders of customers that a drop rule on the balance removed."""
    good = apply_expectations(t.customer, [expect_or_drop("positive_balance", "c_acctbal > 0")])
    known = good.select(F.col("c_custkey").alias("o_custkey"))
    return orphans(t.orders.select("o_orderkey", "o_custkey"), known, "o_custkey")


# --- governed reads -----------------------------------------------------------------------------

USER, STRANGER, ADMIN = "user3@example.com", "nobody@example.com", "user5@example.com"


def reps_of(t: Tables) -> DataFrame:
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("cpf"),
            F.col("r_name").alias("regiao"),
            F.col("c_mktsegment").alias("departamento"),
            money("c_acctbal").alias("salario"),
        )
    )


def grants_of(t: Tables) -> DataFrame:
    """Grants derived from customers: seven users, many duplicates, NULL regions and values."""
    i = F.col("id")
    return reps_of(t).select(
        F.concat(F.lit("user"), (i % 7).cast("string"), F.lit("@example.com")).alias("email"),
        F.when((i % 3 == 0) & F.col("regiao").isin("ASIA", "EUROPE"), F.col("regiao")).alias("regiao"),
        F.when(i % 5 == 0, F.col("cpf")).alias("cpf"),
    )


def memberships_of(t: Tables) -> DataFrame:
    """Users belong to some departments; one is an administrator."""
    i = F.col("id")
    group = F.when(i % 7 == 5, F.lit("admin")).when(
        F.col("departamento").isin("BUILDING", "MACHINERY"), F.col("departamento")
    )
    return reps_of(t).select(
        F.concat(F.lit("user"), (i % 7).cast("string"), F.lit("@example.com")).alias("email"), group.alias("grupo")
    )


REPS = """r AS (
  SELECT c_custkey AS id, c_name AS cpf, r_name AS regiao, c_mktsegment AS departamento,
         CAST(c_acctbal AS DECIMAL(18,2)) AS salario
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
g AS (
  SELECT 'user' || (id % 7) || '@example.com' AS email,
         CASE WHEN id % 3 = 0 AND regiao IN ('ASIA', 'EUROPE') THEN regiao END AS regiao,
         CASE WHEN id % 5 = 0 THEN cpf END AS cpf FROM r),
m AS (
  SELECT 'user' || (id % 7) || '@example.com' AS email,
         CASE WHEN id % 7 = 5 THEN 'admin' WHEN departamento IN ('BUILDING', 'MACHINERY') THEN departamento END AS grupo
  FROM r)"""


def _mine(column: str, user: str = USER) -> str:
    return f"(SELECT {column} FROM g WHERE email = '{user}' AND {column} IS NOT NULL)"


def _in(group: str, user: str) -> str:
    return f"EXISTS (SELECT 1 FROM m WHERE email = '{user}' AND grupo = '{group}')"


@query("rls_region", f"WITH {REPS} SELECT * FROM r WHERE regiao IN {_mine('regiao')}", decimals=["salario"])
def _(t: Tables) -> DataFrame:
    return row_filter(reps_of(t), grants_of(t), USER, "regiao")


@query("rls_no_grant", f"WITH {REPS} SELECT * FROM r WHERE regiao IN {_mine('regiao', STRANGER)}", decimals=["salario"])
def _(t: Tables) -> DataFrame:
    return row_filter(reps_of(t), grants_of(t), STRANGER, "regiao")


@query(
    "mask_exact",
    f"""WITH {REPS} SELECT id, CASE WHEN cpf IN {_mine('cpf')} THEN cpf ELSE '{CPF_MASK}' END AS cpf,
  regiao, departamento, salario FROM r""",
    decimals=["salario"],
)
def _(t: Tables) -> DataFrame:
    return mask_column(reps_of(t), "cpf", grants_of(t), USER)


@query(
    "mask_by_other_column",
    f"""WITH {REPS} SELECT id, cpf, regiao, departamento,
  CASE WHEN cpf IN {_mine('cpf')} THEN salario ELSE CAST(0 AS DECIMAL(18,2)) END AS salario FROM r""",
    decimals=["salario"],
)
def _(t: Tables) -> DataFrame:
    return mask_column(reps_of(t), "salario", grants_of(t), USER, by="cpf", masked=F.lit(0))


@query("semi_granted", f"WITH {REPS} SELECT id FROM r WHERE cpf IN {_mine('cpf')}")
def _(t: Tables) -> DataFrame:
    return semi_granted(reps_of(t), grants_of(t), USER, "cpf").select("id")


@query("mark_granted", f"WITH {REPS} SELECT id, cpf IN {_mine('cpf')} AS clear FROM r")
def _(t: Tables) -> DataFrame:
    return mark_granted(reps_of(t), grants_of(t), USER, "cpf", "clear").select("id", "clear")


@query(
    "rls_groups",
    f"""WITH {REPS} SELECT 'member' AS reader, r.* FROM r
WHERE departamento IN (SELECT grupo FROM m WHERE email = '{USER}' AND grupo IS NOT NULL)
UNION ALL SELECT 'admin', r.* FROM r""",
    decimals=["salario"],
)
def _(t: Tables) -> DataFrame:
    reps, groups = reps_of(t), memberships_of(t)
    mine = row_filter_groups(reps, groups, USER, "departamento").select(F.lit("member").alias("reader"), "*")
    all_rows = row_filter_groups(reps, groups, ADMIN, "departamento").select(F.lit("admin").alias("reader"), "*")
    return mine.unionByName(all_rows)


@query(
    "mask_tiered",
    f"""WITH {REPS} SELECT 'full' AS reader, id, salario FROM r
UNION ALL SELECT 'rounded', id, CAST(CAST(sign(salario) AS BIGINT) * floor((abs(salario) + 500) / 1000) * 1000
  AS DECIMAL(18,2)) FROM r
UNION ALL SELECT 'zero', id, CAST(0 AS DECIMAL(18,2)) FROM r""",
    decimals=["salario"],
)
def _(t: Tables) -> DataFrame:
    """Administrators see the value, members of a department thousands, others zero."""
    reps, groups = reps_of(t), memberships_of(t)
    views = []
    for reader, user in (("full", ADMIN), ("rounded", USER), ("zero", STRANGER)):
        rules = [
            (member(groups, user, "admin"), F.col("salario")),
            (member(groups, user, "BUILDING"), thousands("salario")),
        ]
        views.append(mask_tiered(reps, "salario", rules).select(F.lit(reader).alias("reader"), "id", "salario"))
    return views[0].unionByName(views[1]).unionByName(views[2])


@query(
    "policy_combined",
    f"""WITH {REPS} SELECT id, departamento FROM r
WHERE {_in('admin', USER)} OR ({_in('BUILDING', USER)} AND departamento = 'BUILDING')
   OR ({_in('MACHINERY', USER)} AND '{USER}' LIKE '%@company.com')""",
)
def _(t: Tables) -> DataFrame:
    groups = memberships_of(t)
    allowed = (
        member(groups, USER, "admin")
        | (member(groups, USER, "BUILDING") & (F.col("departamento") == "BUILDING"))
        | (member(groups, USER, "MACHINERY") & user_like(USER, "%@company.com"))
    )
    return policy(reps_of(t), allowed).select("id", "departamento")


@query(
    "governed_read",
    f"""WITH {REPS} SELECT id, CASE WHEN cpf IN {_mine('cpf')} THEN cpf ELSE '{CPF_MASK}' END AS cpf, regiao, departamento,
  CASE WHEN cpf IN {_mine('cpf')} THEN salario ELSE CAST(0 AS DECIMAL(18,2)) END AS salario
FROM r WHERE regiao IN {_mine('regiao')}""",
    decimals=["salario"],
)
def _(t: Tables) -> DataFrame:
    """Filter and two masks attached to one table; a mask reads the raw value of a masked column."""
    table = GovernedTable(lambda: reps_of(t), lambda: grants_of(t))
    table.set_filter("regiao").set_mask("cpf").set_mask("salario", by="cpf", masked=F.lit(0))
    return table.read(USER)


@query(
    "grant_flip",
    f"""WITH {REPS} SELECT 'before' AS step, count(*) AS visible FROM r WHERE false
UNION ALL SELECT 'granted', count(*) FROM r WHERE regiao = 'AFRICA'
UNION ALL SELECT 'revoked', count(*) FROM r WHERE false""",
)
def _(t: Tables) -> DataFrame:
    """A grant is added and withdrawn; each read follows the grants of the moment."""
    current = {"grants": grants_of(t)}
    table = GovernedTable(lambda: reps_of(t), lambda: current["grants"]).set_filter("regiao")

    def visible(step: str) -> DataFrame:
        return table.read(STRANGER).agg(F.count(F.lit(1)).alias("visible")).select(F.lit(step).alias("step"), "visible")

    before = visible("before")
    africa = t.region.filter("r_name = 'AFRICA'").select(
        F.lit(STRANGER).alias("email"), F.col("r_name").alias("regiao"), F.lit(None).cast("string").alias("cpf")
    )
    current["grants"] = current["grants"].unionByName(africa)
    granted = visible("granted")
    current["grants"] = delete_where(current["grants"], F.col("email") == STRANGER)
    return before.unionByName(granted).unionByName(visible("revoked"))


def _stored(t: Tables) -> tuple[GrantTable, PolicyTable]:
    grants = GrantTable(t.spark, t.scratch("grants"))
    return grants, PolicyTable(t.spark, t.scratch("policies"), grants)


@query("policy_stored", SQL["governed_read"], decimals=["salario"])
def _(t: Tables) -> DataFrame:
    """The same policies as rows of a table; one is set twice, another set and dropped again."""
    grants, policies = _stored(t)
    grants.grant(grants_of(t))
    policies.set_filter("reps", "regiao").set_mask("reps", "cpf", shown="?").set_mask("reps", "departamento").set_filter("other", "cpf")
    policies.set_mask("reps", "cpf").drop_mask("reps", "departamento").set_mask("reps", "salario", by="cpf", shown="0")
    return policies.read("reps", reps_of(t), USER)


@query(
    "grant_revoke_stored",
    f"""WITH {REPS} SELECT 'granted' AS step, id, regiao FROM r WHERE regiao IN {_mine('regiao')}
UNION ALL SELECT 'more', id, regiao FROM r WHERE regiao IN {_mine('regiao')} OR regiao = 'AFRICA'
UNION ALL SELECT 'revoked', id, regiao FROM r WHERE regiao IN {_mine('regiao')} AND regiao <> 'ASIA'""",
)
def _(t: Tables) -> DataFrame:
    """A grant is added, another withdrawn; each read follows the table as it then is. The reader is the session's own user."""
    grants, policies = _stored(t)
    policies.set_filter("reps", "regiao")
    me = F.when(F.col("email") == USER, session_user()).otherwise(F.col("email"))
    grants.grant(grants_of(t).withColumn("email", me))
    mine = grants.read().filter(F.col("email") == session_user()).select("email").distinct()

    def visible(step: str) -> DataFrame:
        seen = policies.read("reps", reps_of(t)).select(F.lit(step).alias("step"), "id", "regiao")
        return t.keep(seen, "visible")

    steps = [visible("granted")]
    none = F.lit(None).cast("string").alias("cpf")
    grants.grant(mine.select("email", F.lit("AFRICA").alias("regiao"), none))
    steps.append(visible("more"))
    grants.revoke(mine.select("email", F.lit("AFRICA").alias("regiao"), none))
    grants.revoke(grants.read().filter((F.col("email") == session_user()) & (F.col("regiao") == "ASIA")))
    steps.append(visible("revoked"))
    return steps[0].unionByName(steps[1]).unionByName(steps[2])


@query(
    "grants_reset",
    """SELECT DISTINCT 'admin@example.com' AS email, r_name AS regiao, '' AS cpf FROM region""",
)
def _(t: Tables) -> DataFrame:
    """Whatever was granted before, the baseline alone is left."""
    grants, _ = _stored(t)
    grants.grant(grants_of(t))
    grants.revoke([(USER, "ASIA", None)])
    grants.reset(t.region.select(F.lit("admin@example.com").alias("email"), F.col("r_name").alias("regiao"), F.lit("").alias("cpf")))
    return grants.read()


@query("session_user", f"WITH {REPS} SELECT id, true AS mine FROM r")
def _(t: Tables) -> DataFrame:
    """Rows marked with the name of whoever runs the query are that user's own."""
    marked = reps_of(t).select("id", session_user().alias("owner"))
    return policy(marked, F.col("owner") == session_user()).select("id", F.col("owner").isNotNull().alias("mine"))


@query(
    "gen_refused",
    "SELECT c_custkey, step, true AS refused FROM customer, (VALUES ('no orders'), ('too small a pool'), ('too few orders'), ('too few reps')) v(step)"
    " WHERE c_custkey = (SELECT min(c_custkey) FROM customer)",
)
def _(t: Tables) -> DataFrame:
    """Arguments that cannot hold the planted rows are refused before anything runs; the ids come from a table."""
    first = t.customer.agg(F.min("c_custkey").alias("c_custkey"))
    ids = t.orders.select((F.col("o_orderkey") + 1).alias("pedido_id"))
    calls = {
        "no orders": lambda: G.generate_orders(t.spark, 0, ids=ids),
        "too small a pool": lambda: G.generate_orders(t.spark, 100, pool=41, ids=ids),
        "too few orders": lambda: G.generate_orders(t.spark, 10, ids=ids),
        "too few reps": lambda: G.generate_reps(t.spark, 41),
    }
    rows = None
    for step, call in calls.items():
        try:
            call()
            refused = False
        except ValueError:
            refused = True
        row = first.select("c_custkey", F.lit(step).alias("step"), F.lit(refused).alias("refused"))
        rows = row if rows is None else rows.unionByName(row)
    return rows


# --- summaries ----------------------------------------------------------------------------------


@query(
    "dup_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
)
def _(t: Tables) -> DataFrame:
    return duplicate_keys(t.lineitem, LINE_KEY)


@query("value_counts", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL")
def _(t: Tables) -> DataFrame:
    return value_counts(t.lineitem, "l_returnflag", "l_linestatus")


@query("distinct_values", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def _(t: Tables) -> DataFrame:
    return distinct_values(t.orders, ["o_orderstatus", "o_orderpriority"])


@query(
    "distinct_counts",
    """SELECT count(DISTINCT l_orderkey) AS l_orderkey, count(DISTINCT l_partkey) AS l_partkey,
  count(DISTINCT l_returnflag) AS l_returnflag FROM lineitem""",
)
def _(t: Tables) -> DataFrame:
    return distinct_counts(t.lineitem, ["l_orderkey", "l_partkey", "l_returnflag"])


@query(
    "shares_vs_target",
    """WITH c AS (SELECT count(*) AS n FROM events),
s AS (
  SELECT v.event_type, v.target, (SELECT count(*) FROM events e WHERE e.event_type = v.event_type) AS n
  FROM (VALUES ('click', 0.2), ('view', 0.2), ('signup', 0.3), ('error', 0.1)) v(event_type, target)
  UNION ALL SELECT NULL, 0, count(*) FROM events WHERE event_type NOT IN ('click', 'view', 'signup', 'error'))
SELECT event_type, s.n, CAST(s.n / c.n AS DECIMAL(9,6)) AS share, CAST(target AS DECIMAL(9,6)) AS target,
  abs(CAST(s.n / c.n AS DECIMAL(9,6)) - CAST(target AS DECIMAL(9,6))) <= 0.05 AS within
FROM s, c""",
    decimals=["share", "target"],
)
def _(t: Tables) -> DataFrame:
    return shares_vs_target(t.events, "event_type", {"click": 0.2, "view": 0.2, "signup": 0.3, "error": 0.1}, 0.05)


@query(
    "median_minmax",
    """WITH v AS (SELECT CAST(l_extendedprice AS DECIMAL(18,2)) AS v FROM lineitem),
r AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i, count(*) OVER () AS n FROM v)
SELECT any_value(n) AS n, min(v) AS lowest, max(v) FILTER (WHERE i = n // 2) AS median, max(v) AS highest FROM r""",
    decimals=["lowest", "median", "highest"],
)
def _(t: Tables) -> DataFrame:
    return amount_stats(t.lineitem.select(money("l_extendedprice").alias("v")), "v")


@query(
    "count_if",
    """SELECT count(*) FILTER (WHERE l_quantity > 25) AS large, count(*) FILTER (WHERE l_discount = 0) AS undiscounted,
  count(*) FILTER (WHERE l_shipdate < TIMESTAMP '1997-01-01') AS early,
  count(*) FILTER (WHERE l_shipdate >= TIMESTAMP '1997-01-01') AS late FROM lineitem""",
)
def _(t: Tables) -> DataFrame:
    return count_where(
        t.lineitem,
        large="l_quantity > 25",
        undiscounted="l_discount = 0",
        early="l_shipdate < TIMESTAMP_NTZ'1997-01-01'",
        late="l_shipdate >= TIMESTAMP_NTZ'1997-01-01'",
    )


@query(
    "top_n",
    f"{MERGE} SELECT o_orderkey, o_totalprice FROM a ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
    decimals=["o_totalprice"],
)
def _(t: Tables) -> DataFrame:
    return top_n(typed_orders(t).select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 10)


@query("order_by", "SELECT n_nationkey, n_name FROM nation ORDER BY n_name, n_nationkey")
def _(t: Tables) -> DataFrame:
    return t.nation.select("n_nationkey", "n_name").orderBy("n_name", "n_nationkey")


@query(
    "sample_rows",
    "SELECT o_orderkey, o_custkey FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 100",
)
def _(t: Tables) -> DataFrame:
    return sample_rows(t.orders.select("o_orderkey", "o_custkey"), 100, "o_orderkey")


# --- columns added upstream ---------------------------------------------------------------------


@query(
    "upsert_new_column",
    """SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS o_orderpriority
FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0""",
)
def _(t: Tables) -> DataFrame:
    wide = t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority")
    target = wide.filter("o_orderkey % 3 <> 0").drop("o_orderpriority")
    return upsert(target, wide.filter("o_orderkey % 2 = 0"), ["o_orderkey"])


@query(
    "sync_new_column",
    "SELECT c_custkey, c_acctbal, c_mktsegment, CAST(0 AS BIGINT) AS still_changing FROM customer",
)
def _(t: Tables) -> DataFrame:
    """A snapshot with a further column is taken over; taking it again changes nothing."""
    new = t.customer.select("c_custkey", "c_acctbal", "c_mktsegment")
    old = new.drop("c_mktsegment")
    state = t.keep(apply_changes(old, snapshot_diff(old, new, ["c_custkey"], 1), ["c_custkey"]), "state")
    again = snapshot_diff(state, new, ["c_custkey"], 2).count()
    return state.withColumn("still_changing", F.lit(again).cast("bigint"))


# --- generated data -----------------------------------------------------------------------------

TODAY = date(2026, 5, 8)


def _draw(purpose: str, key: str, seed: int = 42) -> str:
    return f"CAST('0x' || substr(md5('{seed}:{purpose}:' || {key}), 1, 13) AS BIGINT)"


def _uniform(purpose: str, key: str, seed: int = 42) -> str:
    return f"({_draw(purpose, key, seed)} / 4503599627370496.0::DOUBLE)"


def _below(n: int, purpose: str, key: str, seed: int = 42) -> str:
    return f"CAST(floor({_uniform(purpose, key, seed)} * {n}) AS INTEGER)"


def _pick(purpose: str, shares: dict, key: str, seed: int = 42) -> str:
    names, reached, out = list(shares), Decimal(0), "CASE"
    for n in names[:-1]:
        reached += Decimal(str(shares[n]))
        out += f" WHEN {_uniform(purpose, key, seed)} < {float(reached)}::DOUBLE THEN '{n}'"
    return f"{out} ELSE '{names[-1]}' END"


def _ordinary_sql(seed: int, key: str = "pedido_id") -> str:
    amount = (
        f"round(exp(5.5::DOUBLE + 0.8::DOUBLE * sqrt(-2.0::DOUBLE * ln(1.0::DOUBLE - {_uniform('amount/r', key, seed)}))"
        f" * cos(2.0::DOUBLE * pi() * {_uniform('amount/a', key, seed)})), 2)"
    )
    return f"""SELECT pedido_id, {_below(500, 'rep', key, seed)} + 1 AS consultora_id,
  CAST(DATE '2024-05-18' + {_below(720, 'day', key, seed)} AS TIMESTAMP) AS data_pedido, {amount} AS valor_total,
  {_pick('status', G.STATUS_SHARES, key, seed)} AS status, {_pick('payment', G.PAYMENT_SHARES, key, seed)} AS forma_pagamento,
  {_below(72, 'hours', key, seed)} AS h"""


GEN_ORDERS = f"""WITH ids AS (SELECT o_orderkey + 1 AS pedido_id FROM orders), k AS (SELECT count(*) AS n FROM ids),
b AS ({_ordinary_sql(42)} FROM ids),
f AS (SELECT b.*, pedido_id <= 24 AS hero, pedido_id > n - 8 AND pedido_id <= n - 3 AS negative, pedido_id > n - 3 AS future
  FROM b, k),
p AS (SELECT *, CASE
    WHEN pedido_id <= 12 THEN DATE '2026-02-01' - CAST((pedido_id - 1) * 52 + {_below(52, 'hero, earlier', 'pedido_id')} + 1 AS INTEGER)
    WHEN hero THEN DATE '2026-02-01' + CAST((pedido_id - 13) * 8 + {_below(8, 'hero, later', 'pedido_id')} + 1 AS INTEGER)
    WHEN future THEN DATE '2099-01-01' + {_below(365, 'future', 'pedido_id')}
    ELSE CAST(data_pedido AS DATE) END AS placed FROM f)
SELECT pedido_id, CASE WHEN hero THEN 42 ELSE consultora_id END AS consultora_id, CAST(placed AS TIMESTAMP) AS data_pedido,
  CAST(CASE WHEN negative THEN -1.0 ELSE valor_total END AS DECIMAL(18,2)) AS valor_total,
  CASE WHEN hero THEN 'entregue' ELSE status END AS status, CASE WHEN hero THEN 'pix' ELSE forma_pagamento END AS forma_pagamento,
  CAST(placed AS TIMESTAMP) + to_hours(h) AS updated_at FROM p"""


@query("gen_orders", GEN_ORDERS, decimals=["valor_total"])
def _(t: Tables) -> DataFrame:
    """One generated order per row of ``orders``."""
    ids = t.orders.select((F.col("o_orderkey") + 1).alias("pedido_id"))
    made = G.generate_orders(t.spark, ids.count(), today=TODAY, ids=ids)
    return made.withColumn("valor_total", money("valor_total"))


@query(
    "gen_evolved",
    f"""WITH ids AS (SELECT 1000000 + o_orderkey AS pedido_id FROM orders), b AS ({_ordinary_sql(909)},
  {_pick('channel', G.CHANNEL_SHARES, 'pedido_id', 909)} AS canal_origem FROM ids)
SELECT pedido_id, consultora_id, data_pedido, CAST(valor_total AS DECIMAL(18,2)) AS valor_total, status, forma_pagamento,
  data_pedido + to_hours(h) AS updated_at, canal_origem FROM b""",
    decimals=["valor_total"],
)
def _(t: Tables) -> DataFrame:
    ids = t.orders.select((F.col("o_orderkey") + G.EVOLVED_FIRST_ID).alias("pedido_id"))
    return G.generate_evolved_orders(t.spark, today=TODAY, ids=ids).withColumn("valor_total", money("valor_total"))


def _sql_list(names) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


GEN_REPS = f"""ids AS (SELECT CAST(c_custkey + 1 AS INTEGER) AS i FROM customer),
k AS (SELECT count(*) AS n FROM ids),
shares AS (SELECT n, pos, name, pct * n // 100 AS whole, pct * n % 100 AS part FROM k,
  (VALUES (1, 'semente', 40), (2, 'bronze', 30), (3, 'prata', 18), (4, 'ouro', 10), (5, 'diamante', 2)) v(pos, name, pct)),
quotas AS (SELECT pos, name,
  whole + CASE WHEN row_number() OVER (ORDER BY part DESC, pos) <= n - sum(whole) OVER () THEN 1 ELSE 0 END AS quota FROM shares),
q AS (SELECT name, quota, sum(quota) OVER (ORDER BY pos) AS reached FROM quotas),
ranked AS (SELECT i, row_number() OVER (ORDER BY {_draw('tier', 'i')}, i) AS place FROM ids),
named AS (SELECT i, place, lpad(CAST({_draw('cpf', 'i')} % 1000000000 AS VARCHAR), 9, '0') AS base,
  {_sql_list(G.FIRST_NAMES)}[{_below(10, 'first name', 'i')} + 1] AS first,
  {_sql_list(G.LAST_NAMES)}[{_below(10, 'last name', 'i')} + 1] AS last,
  CAST(CASE WHEN i = 42 THEN DATE '2024-01-15' WHEN i % 10 = 0 THEN DATE '2025-09-01'
    ELSE DATE '2026-05-08' - {_below(1096, 'joined', 'i')} END AS TIMESTAMP) AS joined,
  {_uniform('active', 'i')} < 0.97::DOUBLE AS ativo FROM ranked),
s AS (SELECT *, list_sum([CAST(base[j] AS INTEGER) * (11 - j) FOR j IN range(1, 10)]) AS t1,
  list_sum([CAST(base[j] AS INTEGER) * (12 - j) FOR j IN range(1, 10)]) AS t2 FROM named),
c AS (SELECT *, CASE WHEN t1 % 11 < 2 THEN 0 ELSE 11 - t1 % 11 END AS d1 FROM s),
c2 AS (SELECT *, (t2 + 2 * d1) % 11 AS r2 FROM c),
reps AS (SELECT i AS consultora_id, CASE WHEN i = 7 THEN 'ABC123XX99'
    ELSE base || CAST(d1 AS INTEGER) || CAST(CASE WHEN r2 < 2 THEN 0 ELSE 11 - r2 END AS INTEGER) END AS cpf,
  first || ' ' || last AS nome, translate(lower(first), 'ãáéíóúç', 'aaeiouc') || '.' || i || '@example.com.br' AS email,
  {_sql_list(G.REGIONS)}[(i - 1) % 5 + 1] AS regiao,
  CASE WHEN i = 42 THEN 'bronze' ELSE name END AS tier,
  joined AS data_cadastro, ativo, joined AS updated_at FROM c2 JOIN q ON place <= reached AND place > reached - quota)"""


def generated_reps(t: Tables) -> DataFrame:
    ids = t.customer.select((F.col("c_custkey") + 1).cast("int").alias("consultora_id"))
    return G.generate_reps(t.spark, ids.count(), ids=ids)


@query("gen_reps", f"WITH {GEN_REPS} SELECT * FROM reps")
def _(t: Tables) -> DataFrame:
    return generated_reps(t)


@query(
    "promote_reps",
    f"""WITH {GEN_REPS},
g AS (SELECT *, consultora_id <> 42 AND consultora_id % 10 = 0 AND tier <> 'diamante' AND updated_at < TIMESTAMP '2025-11-01'
  AS due FROM reps)
SELECT consultora_id, CASE WHEN consultora_id = 42 THEN 'prata' WHEN NOT due THEN tier WHEN tier = 'semente' THEN 'bronze'
  WHEN tier = 'bronze' THEN 'prata' WHEN tier = 'prata' THEN 'ouro' ELSE 'diamante' END AS tier,
  CASE WHEN consultora_id = 42 THEN TIMESTAMP '2026-02-01' WHEN due THEN TIMESTAMP '2025-11-01' ELSE updated_at END AS updated_at
FROM g""",
)
def _(t: Tables) -> DataFrame:
    """Promotions applied twice equal promotions applied once."""
    return promote_reps(promote_reps(generated_reps(t))).select("consultora_id", "tier", "updated_at")


# --- audits -------------------------------------------------------------------------------------


AUDIT_ROWS = [
    ("dim:column:user_id", "'bigint'", "'bigint'"),
    ("dim:column:__START_AT", "'timestamp_ntz'", "'timestamp_ntz'"),
    ("dim:no_column:canal_origem", "'absent'", "'absent'"),
    ("dim:row_count", "(SELECT CAST(count(*) AS VARCHAR) FROM dim)", "(SELECT CAST(count(*) AS VARCHAR) FROM dim)"),
    ("dim:domain:tier", "'0'", "'0'"),
    ("dim:unique:user_id,__START_AT", "'0'", "'0'"),
    ("dim:one_open_row:user_id", "'0'", "'0'"),
    ("dim:windows_disjoint:user_id", "'0'", "'0'"),
    ("report:not_empty", "(SELECT CAST(count(*) AS VARCHAR) FROM rep)", "'> 0'"),
    ("report:arithmetic:comissao", "'0'", "'0'"),
    ("report:range:amount", "(SELECT CAST(count(*) AS VARCHAR) FROM rep WHERE amount < 0)", "'0'"),
    ("report:attribution:half", "'0'", "'0'"),
    ("report:unique:order_id", "'0'", "'0'"),
    ("report:at most the facts", "'0'", "'0'"),
    ("fact:no orphans", "'0'", "'0'"),
    ("fact:shares:kind", "'0'", "'0'"),
    ("fact:same content", "'0'", "'0'"),
    ("fact:other content", "'1'", "'1'"),
    ("fact:as many as purchases", "'0'", "'0'"),
    ("reps:second run changes nothing", "'0'", "'0'"),
    ("governed:rows granted", "'0'", "'0'"),
    ("governed:masked:cpf", "'0'", "'0'"),
    ("rates:rates_increase", "'0'", "'0'"),
]

AUDIT_SQL = (
    f"WITH {DIM}, rep AS (SELECT CAST(e.value AS DECIMAL(18,2)) AS amount FROM events e "
    "ASOF JOIN dim d ON e.user_id = d.user_id AND e.ts >= d.start_at WHERE e.event_type = 'purchase') "
    + " UNION ALL ".join(
        f"SELECT '{n}' AS \"check\", {o} AS observed, {e} AS expected, "
        + (f"{o} = {e}" if e.startswith("'") and not e.startswith("'>") or "SELECT" in e else "true")
        + " AS passed"
        for n, o, e in AUDIT_ROWS
    )
)


def runs_of(t: Tables) -> int:
    """How many times a user's tier changes, the first one included: the rows that a type 2 dimension must have."""
    events = t.events.filter("event_type <> 'purchase'")
    before = F.lag("event_type").over(Window.partitionBy("user_id").orderBy("ts"))
    return events.select(F.col("event_type").eqNullSafe(before).alias("same")).filter("NOT same").count()


@query("audit_all", AUDIT_SQL)
def _(t: Tables) -> DataFrame:
    """Every kind of check, over whole tables."""
    dim = t.keep(dim_of(t), "dim")
    fact = purchases_of(t)
    edge = F.lit(datetime(2024, 1, 16)).cast("timestamp_ntz")
    report = t.keep(commission_of(t, fact, dim), "report").withColumn(
        "half", F.when(F.dayofyear("ts") <= 15, "old").otherwise("new")
    )
    rate = rate_lookup("tier_no_momento_do_pedido", EVENT_RATES)
    kinds = t.events.filter("event_type <> 'purchase'").select(F.col("event_type").alias("kind"))
    reps = generated_reps(t)
    governed = GovernedTable(lambda: reps_of(t), lambda: grants_of(t)).set_filter("regiao").set_mask("cpf").read(USER)
    shown = mark_granted(
        governed.join(reps_of(t).select("id", F.col("cpf").alias("raw")), "id"), grants_of(t), USER, "raw", "clear", "cpf"
    )
    parts = {
        "dim": [
            A.schema_contract(dim, {"user_id": "bigint", START: "timestamp_ntz"}, ["canal_origem"]),
            A.audit(
                dim,
                [
                    A.row_count(runs_of(t)),
                    A.in_domain("tier", ["signup", "view", "click", "error"]),
                    A.unique(["user_id", START]),
                    A.one_open_row(["user_id"]),
                    A.windows_disjoint(["user_id"]),
                ],
            ),
        ],
        "report": [
            A.audit(
                report,
                [
                    A.not_empty(),
                    A.arithmetic("comissao", F.col("comissao_devida"), F.col("amount") * rate),
                    A.in_range("amount", low=0),
                    A.attribution("half", "ts", edge, "old", "new"),
                    A.unique(["order_id"]),
                    A.count_between("at most the facts", 0, fact),
                ],
            )
        ],
        "fact": [
            A.audit(
                fact,
                [
                    A.none_in(
                        "no orphans",
                        lambda df: orphans(df, t.customer.select(F.col("c_custkey").alias("user_id")), "user_id"),
                    ),
                    A.same_content("same content", purchases_of(t).repartition(3)),
                    A.same_content("other content", fact.withColumn("amount", money(F.col("amount") + 1)), False),
                    A.same_count("as many as purchases", t.events.filter("event_type = 'purchase'")),
                ],
            ),
            A.audit(kinds, [A.shares("kind", dict.fromkeys(("signup", "view", "click", "error"), 0.25), 0.1)]),
        ],
        "reps": [
            A.audit(
                promote_reps(reps),
                [
                    A.none_in(
                        "second run changes nothing",
                        lambda df: promote_reps(df).exceptAll(df),
                    )
                ],
            )
        ],
        "governed": [
            A.audit(
                shown,
                [
                    A.none_in(
                        "rows granted",
                        lambda df: df.join(
                            grants_of(t).filter(F.col("email") == USER).select("regiao").distinct(), "regiao", "left_anti"
                        ),
                    ),
                    A.masked_unless("cpf", F.col("clear"), CPF_MASK),
                ],
            )
        ],
        "rates": [A.rates_increase(t.spark, TIER_RATES, TIER_LADDER)],
    }
    rows = None
    for table, reports in parts.items():
        for r in reports:
            named = r.withColumn("check", F.concat(F.lit(f"{table}:"), F.col("check")))
            rows = named if rows is None else rows.unionByName(named)
    return rows
