"""The two sales reports as stored tables, kept current from the changes of the fact and the dimension."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.expressions import END, START, money, month_of
from tidemark.operators.scd import scd2_current
from tidemark.plans.reports import asof_commission, sales_rollup
from tidemark.runtime import materialize
from tidemark.sources.runs import GONE, NEWEST, SUM, RunTable
from tidemark.streaming.flows import read_feed


@dataclass
class SalesReports:
    """Sales by rep and month, the rollup by attributes of the current rep, and the commission of each order.

    Feeds tell the rows of the fact and of the dimension before and after each batch. Sums take in the old row with minus one and the
    new one with plus one, so changed and removed orders leave the months they were in. Only orders that changed, or that were placed
    while a version that changed was valid, are looked up again. Each table's commit says up to which batch of either feed
    it goes, so a refresh that stopped between two of them is completed by the next.
    """

    spark: SparkSession
    root: str
    fact: RunTable
    dim: RunTable
    feeds: tuple[str, str]  # of the fact, of the dimension
    key: str
    order_key: str
    ts: str
    amount: str
    by: Sequence[str]
    placed: Column | None = None  # the order's time as the dimension has it

    def __post_init__(self):
        self.months = RunTable(self.spark, f"{self.root}/months", [self.key, "mes"], SUM)
        self.rollup = RunTable(self.spark, f"{self.root}/rollup", [*self.by, "mes"], SUM)
        self.commission = RunTable(self.spark, f"{self.root}/commission", [self.order_key], NEWEST)

    def refresh(self) -> None:
        """Bring all tables up to the present commits of the fact and the dimension."""
        goal = {"fact": self.fact.version(), "dim": self.dim.version()}
        if min(goal.values()) < 0:
            return
        self._months_to(self._at(self.rollup))  # the rollup moves first, so the months may lie behind it
        if self._at(self.rollup) != goal:
            self.rollup.commit(self._rollup_changes(goal), facts=goal)
        self._months_to(goal)
        if self._at(self.commission) != goal:
            self.commission.commit(self._commission_changes(goal), facts=goal)

    @staticmethod
    def _at(table: RunTable) -> dict[str, int]:
        return {"fact": -1, "dim": -1, **table.facts()}

    def _signed(self, feed: str, since: int, upto: int) -> DataFrame | None:
        """The feed's rows with ``_sign``: -1 for what a row was, 1 for what it is."""
        changes = read_feed(self.spark, feed, since, upto)
        if changes is None:
            return None
        names = changes.schema["now"].dataType.names
        sides = [("was", -1), ("now", 1)]
        frames = [
            changes.filter(f"{s} IS NOT NULL").select(*[F.col(s).getField(c).alias(c) for c in names], F.lit(n).alias("_sign"))
            for s, n in sides
        ]
        return frames[0].unionByName(frames[1])

    def _month_changes(self, since: int, upto: int) -> DataFrame | None:
        orders = self._signed(self.feeds[0], since, upto)
        if orders is None:
            return None
        sums = orders.groupBy(self.key, month_of(self.ts).alias("mes")).agg(
            F.coalesce(F.sum(money(self.amount) * F.col("_sign")), F.lit(0)).cast("decimal(38,2)").alias("total_vendas"),
            F.sum("_sign").cast("long").alias("qtde_pedidos"),
        )
        return sums.filter("total_vendas <> 0 OR qtde_pedidos <> 0")

    def _months_to(self, goal: dict[str, int]) -> None:
        if self._at(self.months) == goal:
            return
        self.months.commit(self._month_changes(self._at(self.months)["fact"], goal["fact"]), facts=goal)

    def _rollup_changes(self, goal: dict[str, int]) -> DataFrame | None:
        """New months under the reps' present attributes; all months so far of reps whose attributes changed, out and in again."""
        at, parts = self._at(self.rollup), []
        fresh = self._month_changes(at["fact"], goal["fact"])
        if fresh is not None:
            fresh = materialize(fresh, "fresh-months")
            parts.append(sales_rollup(fresh, self.dim.near(fresh), self.key, self.by))
        versions = self._signed(self.feeds[1], at["dim"], goal["dim"])
        if versions is not None and self.months.schema() is not None:
            open_rows = versions.filter(F.col(END).isNull()).groupBy(self.key, *self.by).agg(F.sum("_sign").alias("_sign"))
            moved = materialize(open_rows.filter("_sign <> 0"), "moved")
            months = self.months.read().join(moved, self.key)
            parts.append(
                months.groupBy(*self.by, "mes").agg(
                    F.sum(F.col("total_vendas") * F.col("_sign")).cast("decimal(38,2)").alias("total_vendas"),
                    F.sum(F.col("qtde_pedidos") * F.col("_sign")).cast("long").alias("qtde_pedidos"),
                )
            )
        if not parts:
            return None
        both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        both = both.groupBy(*self.by, "mes").agg(
            F.sum("total_vendas").cast("decimal(38,2)").alias("total_vendas"), F.sum("qtde_pedidos").cast("long").alias("qtde_pedidos")
        )
        return both.filter("total_vendas <> 0 OR qtde_pedidos <> 0")

    def _commission_changes(self, goal: dict[str, int]) -> DataFrame | None:
        at, ids = self._at(self.commission), []
        orders = self._signed(self.feeds[0], at["fact"], goal["fact"])
        if orders is not None:
            ids.append(orders.select(self.order_key))
        versions = self._signed(self.feeds[1], at["dim"], goal["dim"])
        if versions is not None and at["fact"] >= 0:
            kind = versions.schema[START].dataType
            spans = versions.groupBy(self.key).agg(
                F.min(START).alias("_from"), F.max(F.coalesce(END, F.lit("9999-12-31").cast(kind))).alias("_upto")
            )
            spans = materialize(spans, "spans")
            first = spans.agg(F.min("_from")).first()[0]
            if first is not None:
                # no more than the time is known of all orders: it reaches the scan
                placed = self.fact.raw().filter(self._time() >= F.lit(first).cast(kind)).join(spans, self.key)
                ids.append(placed.filter((self._time() >= F.col("_from")) & (self._time() < F.col("_upto"))).select(self.order_key))
        if not ids:
            return None
        touched = ids[0] if len(ids) == 1 else ids[0].unionByName(ids[1])
        touched = materialize(touched.distinct(), "touched")
        again = self.fact.read(only=touched).withColumn("_placed", self._time())
        again = materialize(again, "again")
        dim = self.dim.read().join(again.select(self.key).distinct(), self.key, "left_semi")
        report = materialize(asof_commission(again, dim, self.key, self.order_key, "_placed", self.amount), "commission")
        gone = touched.join(report, self.order_key, "left_anti").withColumn(GONE, F.lit(True))
        return report.withColumn(GONE, F.lit(False)).unionByName(gone, allowMissingColumns=True)

    def _time(self) -> Column:
        return F.col(self.ts) if self.placed is None else self.placed

    # --- reading ---

    def read_rollup(self) -> DataFrame:
        return self.rollup.read().filter("qtde_pedidos <> 0")

    def read_commission(self) -> DataFrame:
        return self.commission.read()
