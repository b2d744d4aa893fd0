"""Row filters and column masks driven by grants kept as data.

Policies are joins and CASE expressions over the user's own grants. They give the meaning of
governed reads; they are no boundary against a session the user controls.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.expressions import CPF_MASK
from tidemark.operators.joins import granted_values, mark_granted, semi_granted
from tidemark.sources.runs import GONE, NEWEST, RunTable

GRANT_SCHEMA = "email string, regiao string, cpf string"


def row_filter(
    df: DataFrame, grants: DataFrame, user, on: str, grant_col: str | None = None, user_col: str = "email"
) -> DataFrame:
    """Rows whose ``on`` value is granted to the user; without a grant, no rows."""
    return semi_granted(df, grants, user, on, grant_col, user_col)


def mask_column(
    df: DataFrame,
    col: str,
    grants: DataFrame,
    user,
    glyph: str = CPF_MASK,
    by: str | None = None,
    grant_col: str | None = None,
    masked: Column | None = None,
    user_col: str = "email",
) -> DataFrame:
    """Show ``col`` only where the value of ``by`` (itself by default) is granted to the user.

    The result keeps the column's own type, so cents survive.
    """
    hidden = (F.lit(glyph) if masked is None else masked).cast(df.schema[col].dataType)
    flagged = mark_granted(df, grants, user, by or col, "_clear", grant_col or by or col, user_col)
    shown = F.when(F.col("_clear"), F.col(f"`{col}`")).otherwise(hidden)
    return flagged.withColumn(col, shown).drop("_clear")


def member(memberships: DataFrame, user, group: str, user_col: str = "email", group_col: str = "grupo") -> Column:
    """Whether the user belongs to a group: evaluated once per query, not per row."""
    who = user if isinstance(user, Column) else F.lit(user)
    return memberships.filter((F.col(user_col) == who) & (F.col(group_col) == F.lit(group))).exists()


def row_filter_groups(
    df: DataFrame,
    memberships: DataFrame,
    user,
    col: str,
    admins: str = "admin",
    user_col: str = "email",
    group_col: str = "grupo",
) -> DataFrame:
    """Rows whose value names a group of the user; members of ``admins`` see everything."""
    groups = granted_values(memberships, user, group_col, user_col).toDF("_group")
    mine = F.coalesce(F.col(f"`{col}`").isin(groups), F.lit(False))
    return df.filter(member(memberships, user, admins, user_col, group_col) | mine)


def mask_tiered(
    df: DataFrame, col: str, rules: Sequence[tuple[Column, Column]], otherwise: Column | None = None
) -> DataFrame:
    """The first rule whose flag holds gives the value, else ``otherwise`` (zero); type is kept."""
    shown = None
    for flag, value in rules:
        shown = F.when(flag, value) if shown is None else shown.when(flag, value)
    hidden = F.lit(0) if otherwise is None else otherwise
    shown = hidden if shown is None else shown.otherwise(hidden)
    return df.withColumn(col, shown.cast(df.schema[col].dataType))


def thousands(col: str) -> Column:
    """Rounded to thousands."""
    return F.round(F.col(col), -3)


@dataclass
class GovernedTable:
    """A table with policies attached as data.

    ``table`` and ``grants`` are read anew on each call, so a grant that changes takes effect
    on the next read. Setting a policy again replaces it; dropping one that is absent is fine.
    """

    table: Callable[[], DataFrame]
    grants: Callable[[], DataFrame]
    filter_on: tuple[str, str] | None = None
    masks: dict[str, dict] = field(default_factory=dict)

    def set_filter(self, on: str, grant_col: str | None = None) -> "GovernedTable":
        self.filter_on = (on, grant_col or on)
        return self

    def drop_filter(self) -> "GovernedTable":
        self.filter_on = None
        return self

    def set_mask(self, col: str, **policy) -> "GovernedTable":
        """``policy`` takes the keyword arguments of ``mask_column``."""
        self.masks[col] = policy
        return self

    def drop_mask(self, col: str) -> "GovernedTable":
        self.masks.pop(col, None)
        return self

    def read(self, user) -> DataFrame:
        """The rows and values this user may see; the user's own predicates see masked values."""
        df, grants = self.table(), self.grants()
        columns = df.columns
        if self.filter_on:
            df = row_filter(df, grants, user, *self.filter_on)
        # Masks read raw values, also of columns that another mask hides.
        for col, policy in self.masks.items():
            by = policy.get("by") or col
            if by != col and by in self.masks:
                df = df.withColumn(f"_raw_{by}", F.col(f"`{by}`"))
        for col, policy in self.masks.items():
            by = policy.get("by") or col
            raw = f"_raw_{by}" if f"_raw_{by}" in df.columns else by
            settings = {**policy, "by": raw, "grant_col": policy.get("grant_col") or by}
            df = mask_column(df, col, grants, user, **settings)
        return df.select(*[F.col(f"`{c}`") for c in columns])


def grant_rows(spark, rows: Sequence[tuple], schema: str = GRANT_SCHEMA) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def add_grant(spark, path: str, row: tuple, schema: str = GRANT_SCHEMA) -> None:
    """Grants are few; each addition is one small file."""
    grant_rows(spark, [row], schema).coalesce(1).write.mode("append").parquet(path)


def reset_grants(spark, path: str, baseline: Sequence[tuple], schema: str = GRANT_SCHEMA) -> None:
    """Overwrite the grant table with the baseline rows, leaving no other grant."""
    grant_rows(spark, baseline, schema).coalesce(1).write.mode("overwrite").parquet(path)


def policy(df: DataFrame, condition: Column) -> DataFrame:
    """Rows where a combination of memberships, row values and user patterns holds."""
    return df.filter(F.coalesce(condition, F.lit(False)))


def user_like(user, pattern: str) -> Column:
    """Whether the user's name fits a LIKE pattern."""
    who = user if isinstance(user, Column) else F.lit(user)
    return who.like(pattern)


def session_user() -> Column:
    return F.current_user()



class GrantTable:
    """Grants as a stored table that is changed while others read it; later entries win over earlier ones."""

    def __init__(self, spark: SparkSession, path: str, schema: str = GRANT_SCHEMA):
        self.spark, self.empty = spark, spark.createDataFrame([], schema)
        self.log = RunTable(spark, path, self.empty.columns, NEWEST)

    def _rows(self, rows: DataFrame | Sequence[tuple]) -> DataFrame:
        if not isinstance(rows, DataFrame):
            rows = self.spark.createDataFrame(list(rows), self.empty.schema)
        return rows.select(*self.empty.columns).distinct()

    def grant(self, rows: DataFrame | Sequence[tuple]) -> None:
        """Add grants; those already there stay once."""
        self.log.commit(self._rows(rows))

    def revoke(self, rows: DataFrame | Sequence[tuple]) -> None:
        """Withdraw grants; whoever reads from now on does without them."""
        self.log.commit(self._rows(rows).withColumn(GONE, F.lit(True)))

    def reset(self, baseline: DataFrame | Sequence[tuple]) -> None:
        """Leave the baseline and no other grant."""
        self.log.commit(self._rows(baseline), replace=True)

    def read(self) -> DataFrame:
        return self.log.read(self.empty.schema)


FILTER, MASK = "filter", "mask"
POLICY_SCHEMA = "table string, kind string, column string, by string, grant_column string, shown string"


class PolicyTable:
    """Policies as rows beside the tables they govern, compiled into filters and masks when a table is read."""

    def __init__(self, spark: SparkSession, path: str, grants: GrantTable):
        self.spark, self.grants = spark, grants
        self.rows = RunTable(spark, path, ["table", "kind", "column"], NEWEST)

    def _put(self, row: tuple, gone: bool = False) -> "PolicyTable":
        df = self.spark.createDataFrame([row], POLICY_SCHEMA)
        self.rows.commit(df.withColumn(GONE, F.lit(gone)))
        return self

    def set_filter(self, table: str, on: str, grant_column: str | None = None) -> "PolicyTable":
        return self._put((table, FILTER, on, on, grant_column or on, None))

    def drop_filter(self, table: str, on: str) -> "PolicyTable":
        return self._put((table, FILTER, on, None, None, None), True)

    def set_mask(
        self, table: str, column: str, by: str | None = None, grant_column: str | None = None, shown: str | None = CPF_MASK
    ) -> "PolicyTable":
        """``shown`` stands in for values that the reader may not see, cast to the column's type; None for NULL."""
        return self._put((table, MASK, column, by or column, grant_column or by or column, shown))

    def drop_mask(self, table: str, column: str) -> "PolicyTable":
        return self._put((table, MASK, column, None, None, None), True)

    def read(self, table: str, df: DataFrame, user: str | Column | None = None) -> DataFrame:
        """The rows and values of ``df`` that a user, by default the session's own, may see. Every filter of the table must let a row pass."""
        user = session_user() if user is None else user
        held = self.rows.read(self.spark.createDataFrame([], POLICY_SCHEMA).schema)
        policies = held.filter(F.col("table") == table).orderBy("column").collect()  # few: one for each governed column
        for p in policies:
            if p.kind == FILTER and p.column not in df.columns:
                raise ValueError(f"{table} has a filter on {p.column}, which is not there")
        filters = [p for p in policies if p.kind == FILTER]
        governed = GovernedTable(lambda: df, self.grants.read)
        for p in policies:
            if p.kind == MASK and p.column in df.columns:
                governed.set_mask(p.column, by=p.by, grant_col=p.grant_column, masked=F.lit(p.shown))
        rows = df
        for p in filters:
            rows = row_filter(rows, self.grants.read(), user, p.column, p.grant_column)
        governed.table = lambda: rows
        return governed.read(user)
