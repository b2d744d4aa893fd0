"""The direct-sales pipeline: landing files and rep snapshots to reports.

Each stage is one Spark query that hands over a directory; checkpoints make reruns resume.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.expressions import CPF_FORMAT, align_ts, ladder_step, money
from tidemark.operators.audit import audit, not_empty, require_passed
from tidemark.operators.changes import read_changes
from tidemark.operators.merge import guarded_update
from tidemark.operators.projection import project_typed, select_except
from tidemark.operators.quality import Rule, expect, expect_or_drop, expect_or_fail
from tidemark.plans.maintained import SalesReports
from tidemark.runtime import Files
from tidemark.sources.files import INGEST_COLUMNS, RESCUED, BronzeTable, ingest_files, stream_table
from tidemark.sources.generate import HERO_AFTER, HERO_CHANGE, HERO_ID
from tidemark.sources.runs import RunTable
from tidemark.sources.snapshots import SnapshotTable
from tidemark.streaming.flows import SOURCE, scd1_runs, scd2_runs, stream_expect, stream_scd

# Columns of a rep, those whose history is kept, the second promotion date, rule names.
REP_COLUMNS: Mapping[str, str | None] = {
    "consultora_id": "int",
    "cpf": None,
    "nome": None,
    "email": None,
    "regiao": None,
    "tier": None,
    "data_cadastro": "timestamp",
    "ativo": "boolean",
    "updated_at": "timestamp",
}
REP_HISTORY = ("tier", "regiao", "email", "ativo")
PROMOTION_DAY = date(2025, 11, 1)
MAX_FILES = 1000  # of one micro-batch

REP_RULES = (
    expect_or_fail("pk_consultora", "consultora_id IS NOT NULL"),
    expect_or_drop("cpf_format", f"cpf RLIKE '{CPF_FORMAT}'"),
    expect("email_present", "email IS NOT NULL OR ativo = FALSE"),
)


def order_rules(today: date | None = None) -> tuple[Rule, ...]:
    """Rules on curated orders; ``today`` replaces the current date for repeatable runs."""
    day = f"DATE'{today.isoformat()}'" if today else "current_date()"
    return (
        expect_or_drop("valor_positivo", "valor_total > 0"),
        expect_or_drop("data_passada", f"data_pedido <= {day}"),
    )


def curate_orders(bronze: DataFrame) -> DataFrame:
    """Raw orders without ingest columns, money as decimal; columns added upstream pass through."""
    return select_except(bronze, drop=(RESCUED, *INGEST_COLUMNS), valor_total=money("valor_total"))


def curate_reps(changes: DataFrame, *kept: str) -> DataFrame:
    """New states of reps from change events, with fixed columns and types, and those of ``kept`` as they are."""
    return project_typed(read_changes(changes), {**REP_COLUMNS, **dict.fromkeys(kept)})


def promote_reps(reps: DataFrame) -> DataFrame:
    """The two backdated promotions; running them again changes nothing."""
    hero_day = F.lit(HERO_CHANGE).cast(reps.schema["updated_at"].dataType)
    day = F.lit(PROMOTION_DAY).cast(reps.schema["updated_at"].dataType)
    i, tier = F.col("consultora_id"), F.col("tier")
    reps = guarded_update(
        reps, (i == HERO_ID) & (tier != HERO_AFTER), {"tier": F.lit(HERO_AFTER), "updated_at": hero_day}
    )
    due = (i != HERO_ID) & (i % 10 == 0) & (ladder_step("tier") != tier) & (F.col("updated_at") < day)
    return guarded_update(reps, due, {"tier": ladder_step("tier"), "updated_at": day})


@dataclass
class DirectSales:
    """Tables of one deployment below ``root``."""

    spark: SparkSession
    root: str
    today: date | None = None
    orders_gone: str | None = None  # a predicate over order events that remove their order

    def _at(self, *parts: str) -> str:
        """A path of the present epoch; ``refresh_all`` moves all tables to a new one at once."""
        return "/".join([self.root.rstrip("/"), f"epoch={self.epoch}", *parts])

    def __post_init__(self):
        self.epoch = Files(self.spark).latest(f"{self.root.rstrip('/')}/_epoch") or 0

    @property
    def bronze_orders(self) -> BronzeTable:
        return BronzeTable(self.spark, self._at("bronze", "orders"))

    @property
    def fact(self) -> RunTable:
        return scd1_runs(self.spark, self._at("gold", "fact"), ["pedido_id"], "updated_at")

    @property
    def dim(self) -> RunTable:
        return scd2_runs(self.spark, self._at("gold", "dim"), ["consultora_id"])

    @property
    def reps(self) -> SnapshotTable:
        """Current state of the source's rep table; like the change feed beside it, it outlives epochs."""
        return SnapshotTable(self.spark, f"{self.root.rstrip('/')}/source/reps", ["consultora_id"])

    @property
    def reports(self) -> SalesReports:
        return SalesReports(
            self.spark,
            self._at("gold", "reports"),
            self.fact,
            self.dim,
            (self._at("gold", "fact_feed"), self._at("gold", "dim_feed")),
            "consultora_id",
            "pedido_id",
            "data_pedido",
            "valor_total",
            ["regiao", "tier"],
            align_ts("data_pedido"),
        )

    # --- orders ---

    def run_orders(self, landing: str) -> list[dict[str, int]]:
        """New landing files through bronze and curated orders into the fact; returns rule counts.

        Before the first file there is nothing to curate and there are no counts.
        """
        bronze = ingest_files(self.spark, landing, self.bronze_orders.path, self._at("_checkpoints", "bronze"))
        if not bronze.batches():
            return []
        silver, checkpoint = self._at("silver", "orders"), self._at("_checkpoints", "silver_orders")
        raw = bronze.stream(maxFilesPerTrigger=MAX_FILES).withColumn(SOURCE, F.col("_metadata.file_path"))
        counts = stream_expect(curate_orders(raw), order_rules(self.today), silver, checkpoint, source=SOURCE)
        stream_scd(
            stream_table(self.spark, f"{silver}/batch=*", self.silver_schema(), maxFilesPerTrigger=MAX_FILES),
            self.fact,
            1,
            "updated_at",
            self._at("_checkpoints", "fact"),
            delete_when=self.orders_gone,
            feed=self._at("gold", "fact_feed"),
        )
        return counts

    def silver_schema(self):
        empty = self.spark.createDataFrame([], self.bronze_orders.full_schema())
        return curate_orders(empty).schema

    def silver_orders(self) -> DataFrame:
        return self.spark.read.schema(self.silver_schema()).parquet(self._at("silver", "orders")).drop("batch")

    # --- reps ---

    def sync_reps(self, snapshot: DataFrame) -> None:
        """Take a source snapshot: record what changed since the last one, then update the state.

        An empty snapshot is refused, as it would read as the deletion of every rep.
        """
        require_passed(audit(snapshot, [not_empty("source_not_empty")]))
        self.reps.sync(snapshot, self._rep_changes())

    def _rep_changes(self) -> str:
        return f"{self.root.rstrip('/')}/source/rep_changes"

    def run_reps(self) -> list[dict[str, int]]:
        """Change events not seen before through the rules into the versioned dimension."""
        feed = self._rep_changes()
        schema = self.spark.read.parquet(f"{feed}/version=*").schema
        events = stream_table(self.spark, f"{feed}/version=*", schema, maxFilesPerTrigger=MAX_FILES)
        events = events.withColumn(SOURCE, F.col("_metadata.file_path"))
        silver, checkpoint = self._at("silver", "reps"), self._at("_checkpoints", "silver_reps")
        curated = curate_reps(events, SOURCE)
        counts = stream_expect(curated, REP_RULES, silver, checkpoint, source=SOURCE)
        typed = curate_reps(self.spark.createDataFrame([], schema)).schema
        stream_scd(
            stream_table(self.spark, f"{silver}/batch=*", typed, maxFilesPerTrigger=MAX_FILES),
            self.dim,
            2,
            "updated_at",
            self._at("_checkpoints", "dim"),
            track=REP_HISTORY,
            feed=self._at("gold", "dim_feed"),
        )
        return counts

    def change_feed(self) -> DataFrame:
        return self.spark.read.parquet(self._rep_changes()).drop("version")

    def silver_reps(self) -> DataFrame:
        return self.spark.read.parquet(self._at("silver", "reps")).drop("batch")

    # --- reports ---

    def sales_by_region(self) -> DataFrame:
        """Sales by region, current tier and month, from the stored report after its upkeep."""
        self.reports.refresh()
        return self.reports.read_rollup().withColumnRenamed("tier", "tier_atual")

    def commission(self) -> DataFrame:
        """Commission per order at the tier valid when it was placed, from the stored report after its upkeep."""
        self.reports.refresh()
        return self.reports.read_commission().select(
            "pedido_id",
            "consultora_id",
            F.col("_placed").cast("timestamp_ntz").alias("data_pedido"),
            "valor_total",
            "tier_no_momento_do_pedido",
            "comissao_devida",
        )

    # --- starting over ---

    def refresh_all(self, landing: str) -> int:
        """Build every table anew from the landing files and the reps' change feed, and switch to all of them at once.

        The new tables lie in an epoch of their own, schemas included, so columns that no landing file has any more are gone.
        Readers see the old epoch until the pointer moves; an attempt that failed leaves an epoch that nobody
        points to, which the next one skips.
        """
        files = Files(self.spark)
        root = self.root.rstrip("/")
        taken = [int(n.split("=", 1)[1]) for n in files.list(root) if n.startswith("epoch=")]
        fresh = DirectSales(self.spark, self.root, self.today, self.orders_gone)
        fresh.epoch = max(taken, default=-1) + 1
        fresh.run_orders(landing)
        if files.has_data(self._rep_changes()):
            fresh.run_reps()
        fresh.reports.refresh()
        files.supersede(f"{root}/_epoch", fresh.epoch)
        self.epoch = fresh.epoch
        return self.epoch
