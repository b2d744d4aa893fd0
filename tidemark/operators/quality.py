"""Row-level expectations that warn, drop or fail. A rule passes only where it is TRUE."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.runtime import Files

WARN, DROP, FAIL = "warn", "drop", "fail"


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str
    action: str = WARN

    @property
    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))

    @property
    def violations(self) -> Column:
        return F.count_if(~self.holds)


def expect(name: str, predicate: str) -> Rule:
    """Keep violating rows, count them."""
    return Rule(name, predicate, WARN)


def expect_or_drop(name: str, predicate: str) -> Rule:
    """Keep only rows where the predicate holds."""
    return Rule(name, predicate, DROP)


def expect_or_fail(name: str, predicate: str) -> Rule:
    """Abort the update on any violating row, before anything is committed."""
    return Rule(name, predicate, FAIL)


class ExpectationFailed(RuntimeError):
    def __init__(self, counts: dict[str, int]):
        self.counts = counts
        super().__init__("violated: " + ", ".join(f"{n} ({c} rows)" for n, c in sorted(counts.items())))


def _metrics(rules: Sequence[Rule]) -> list[Column]:
    return [F.count(F.lit(1)).alias("_rows"), *[r.violations.alias(r.name) for r in rules]]


def observe_rules(df: DataFrame, rules: Sequence[Rule], observation: Observation | str) -> DataFrame:
    """Count violations of every rule while the rows pass through to a later action."""
    return df.observe(observation, *_metrics(rules))


def raise_on_failures(rules: Sequence[Rule], counts: dict[str, int]) -> None:
    broken = {r.name: counts[r.name] for r in rules if r.action == FAIL and counts.get(r.name)}
    if broken:
        raise ExpectationFailed(broken)


def keep_passing(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Only rows that satisfy every drop rule."""
    for rule in rules:
        if rule.action == DROP:
            df = df.filter(rule.holds)
    return df


def apply_expectations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Check fail rules with one aggregate, then drop. Rules see the columns of ``df`` as given.

    The check reads only the rules' columns. To avoid reading an expensive input twice, use
    ``write_checked``, which counts during the write.
    """
    fatal = [r for r in rules if r.action == FAIL]
    if fatal:
        raise_on_failures(fatal, df.agg(*_metrics(fatal)).first().asDict())
    return keep_passing(df, rules)


def write_checked(
    df: DataFrame,
    rules: Sequence[Rule],
    path: str,
    name: str = "expectations",
    beside: Callable[[str], None] | None = None,
) -> dict[str, int]:
    """Write passing rows to ``path`` in one pass; on a violated fail rule nothing appears there.

    Rows go to a staging directory first and move into place once the counts are known, with what ``beside`` adds to it.
    Returns the rows seen and the violations per rule.
    """
    files = Files(df.sparkSession)
    parent, leaf = path.rstrip("/").rsplit("/", 1)
    staged = f"{parent}/_staged/{leaf}"
    seen = Observation(name)
    keep_passing(observe_rules(df, rules, seen), rules).write.mode("overwrite").parquet(staged)
    counts = dict(seen.get)
    try:
        raise_on_failures(rules, counts)
    except ExpectationFailed:
        files.delete(staged)
        raise
    if beside:
        beside(staged)
    if files.exists(path):
        files.delete(path)
    files.rename(staged, path)
    return counts


def expectation_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: name, action, rows passed, rows failed. One pass over the data."""
    counted = df.agg(*_metrics(rules))
    rows = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit(r.action).alias("action"),
                (F.col("_rows") - F.col(f"`{r.name}`")).alias("passed"),
                F.col(f"`{r.name}`").alias("failed"),
            )
            for r in rules
        ]
    )
    return counted.select(F.inline(rows))
