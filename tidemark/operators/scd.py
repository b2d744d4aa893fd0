"""Slowly changing dimensions of type 1 and 2 from change events, in any arrival order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.expressions import END, START, required
from tidemark.operators.hotkeys import SEGMENT, by_heat, neighbours
from tidemark.operators.joins import as_of_join
from tidemark.operators.merge import widen
from tidemark.runtime import materialize


def scd1(events: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """The last row per key. Ties go to the greatest remaining columns, so arrival order is moot.

    Spark keeps only the first rank per key in each input task before the shuffle, so a key
    with a third of all events costs no more than any other.
    """
    at = required(sequence, events.schema[sequence].dataType, sequence)
    rest = [F.col(f"`{c}`").desc() for c in events.columns if c not in keys and c != sequence]
    newest = Window.partitionBy(*keys).orderBy(at.desc(), *rest)
    return events.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def _latest(columns: Sequence[str], keys: Sequence[str], sequence: str, seq_type) -> Column:
    """A struct that orders by sequence, then by the other columns in schema order."""
    rest = [F.col(f"`{c}`") for c in columns if c not in keys and c != sequence]
    return F.struct(required(sequence, seq_type, sequence).alias(sequence), *rest)


def scd1_merge(target: DataFrame, batch: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """Target with the batch applied; an older event never overwrites a newer row.

    The target holds one row per key and the batch is reduced to one first, so a full outer
    join sees no skew; ``greatest`` skips the side that has no row.
    """
    columns = [*target.columns, *[c for c in batch.columns if c not in target.columns]]
    types = {f.name: f.dataType for f in [*batch.schema.fields, *target.schema.fields]}

    def side(df: DataFrame, name: str) -> DataFrame:
        wide = df.select(
            *[(F.col(f"`{c}`") if c in df.columns else F.lit(None)).cast(types[c]).alias(c) for c in columns]
        )
        row = _latest(columns, keys, sequence, types[sequence])
        return wide.select(*keys, row.alias(name))

    old = side(target, "_old")
    new = side(scd1(batch, keys, sequence), "_new")
    return old.join(new, list(keys), "full_outer").select(
        *[
            F.col(f"`{c}`") if c in keys else F.greatest("_old", "_new").getField(c).alias(c)
            for c in columns
        ]
    )


def scd2(
    events: DataFrame,
    keys: Sequence[str],
    sequence: str,
    track: Sequence[str],
    delete_when: str | None = None,
    rows_per_task: int | None = None,
) -> DataFrame:
    """One row per run of equal tracked values, with the half-open window [start, end).

    Tracked values compare null-safely; other columns carry the run's last values. A source
    delete does not close a row unless ``delete_when`` (a predicate over events) says so.
    """
    seq_type = events.schema[sequence].dataType
    placed = events.withColumn("_at", required(sequence, seq_type, sequence))
    return _runs(placed, events.columns, keys, track, delete_when, rows_per_task)


def _runs(
    placed: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    track: Sequence[str],
    delete_when: str | None,
    rows_per_task: int | None,
) -> DataFrame:
    """Runs of events placed in time by ``_at``: one shuffle and one sort per key.

    Only the first and the last event of a run matter. The first carries the start, the last
    carries the untracked values and, as the next event opens the next run, the end.
    """
    gone = F.coalesce(F.expr(delete_when), F.lit(False)) if delete_when else F.lit(False)
    rest = [c for c in columns if c not in keys]
    carry = [c for c in rest if c not in track]

    def plan(rows: DataFrame, segment: str | None) -> DataFrame:
        part = [*keys, segment] if segment else list(keys)
        ordered = Window.partitionBy(*part).orderBy("_at", *[F.col(f"`{c}`") for c in rest])
        rows = (
            rows.withColumns({"_gone": gone, "_tie": F.lead("_at").over(ordered)})
            .filter("_tie IS NULL OR _tie <> _at")
            .drop("_tie")
        )
        state = F.struct(F.col("_gone"), *[F.col(f"`{c}`") for c in track])
        rows = neighbours(
            rows, keys, ["_at"], F.struct(F.col("_at").alias("at"), state.alias("state")), segment, "_back", "_ahead"
        )
        rows = rows.withColumns(
            {
                "_opens": ~F.coalesce(F.col("_back.state").eqNullSafe(state), F.lit(False)) | F.col("_back").isNull(),
                "_closes": ~F.coalesce(F.col("_ahead.state").eqNullSafe(state), F.lit(False))
                | F.col("_ahead").isNull(),
                "_end": F.col("_ahead.at"),
            }
        ).filter("_opens OR _closes")
        rows = rows.drop("_back", "_ahead")
        if segment:
            rows = materialize(rows, "run-edges")
        own = F.struct(F.col("_end"), *[F.col(f"`{c}`") for c in carry])
        rows = neighbours(rows, keys, ["_at"], own, segment, None, "_mate").filter("_opens AND NOT _gone")
        closing = F.when(F.col("_closes"), own).otherwise(F.col("_mate"))
        return rows.withColumn("_closing", closing).select(
            *[
                F.col("_closing").getField(c).alias(c) if c in carry else F.col(f"`{c}`")
                for c in columns
            ],
            F.col("_at").alias(START),
            F.col("_closing._end").alias(END),
        )

    def winners(rows: DataFrame) -> DataFrame:
        """One event for each key and instant, reduced before the shuffle: segments are cut between instants only."""
        by = [*keys, SEGMENT, "_at"]
        won = rows.groupBy(*by).agg(F.max(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("_won"))
        return won.select(*[F.col(c) for c in by], *[F.col("_won").getField(c).alias(c) for c in rest])

    return by_heat(placed, keys, ["_at"], plan, rows_per_task, winners)


def scd2_merge(
    dim: DataFrame,
    log: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    sequence: str,
    track: Sequence[str],
    delete_when: str | None = None,
    rows_per_task: int | None = None,
) -> DataFrame:
    """The dimension with a batch applied, equal to a full run over the log, in any order.

    ``log`` holds every event so far, the batch included.
    """
    kept, rebuilt = scd2_delta(dim, log, batch, keys, sequence, track, delete_when, rows_per_task)
    return kept.unionByName(rebuilt)


def scd2_delta(
    dim: DataFrame,
    log: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    sequence: str,
    track: Sequence[str],
    delete_when: str | None = None,
    rows_per_task: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rows of ``dim`` that stay, and the rows that replace the others.

    Rows that ended before a key's first new event stay. Of the others each stands in for its events: one at its start and
    its last one. That is enough wherever a new event falls, except within a row and with other tracked values, where the row
    splits; only the events of such rows are read from the log. So neither rows that an event extends, joins or follows
    nor a late event between two rows need the log. With ``delete_when`` keys with late events reread it from the first row affected,
    since rows do not tell when a key was deleted again.
    """
    dim = widen(dim, batch)  # a column added upstream is NULL in what came before
    tagged = _tagged(dim, batch, keys, sequence)
    affected = materialize(tagged.filter("_hit").drop("_hit"), "affected")
    rebuilt = _rebuilt(affected, log, batch, keys, sequence, track, delete_when, rows_per_task)
    return tagged.filter("NOT _hit").drop("_hit"), rebuilt


def scd2_changes(
    dim: DataFrame,
    log: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    sequence: str,
    track: Sequence[str],
    delete_when: str | None = None,
    rows_per_task: int | None = None,
) -> DataFrame:
    """What a batch changes in ``dim``: (was, now), structs of its columns, one of them NULL where a row comes or goes."""
    dim = widen(dim, batch)
    affected = materialize(_tagged(dim, batch, keys, sequence).filter("_hit").drop("_hit"), "affected")
    rebuilt = _rebuilt(affected, log, batch, keys, sequence, track, delete_when, rows_per_task)
    return row_changes(affected, rebuilt, [*keys, START])


def row_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(was, now): the rows that differ between two frames with the columns of ``new``, each with one row for a key."""

    def side(df: DataFrame, name: str, mark: str) -> DataFrame:
        row = F.struct(*[F.col(f"`{c}`") for c in new.columns]).alias(name)
        return df.select(*[F.col(f"`{k}`").alias(f"{mark}{i}") for i, k in enumerate(keys)], row)

    same = [F.col(f"_a{i}").eqNullSafe(F.col(f"_b{i}")) for i in range(len(keys))]
    both = side(old, "was", "_a").join(side(new, "now", "_b"), same, "full_outer").select("was", "now")
    return both.filter(~F.col("was").eqNullSafe(F.col("now")))


def _tagged(dim: DataFrame, batch: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """``dim`` with ``_hit``: the row is open or ended no earlier than the batch's first event of its key."""
    low = batch.groupBy(*keys).agg(F.min(sequence).alias("_low"))
    stays = F.col("_low").isNull() | F.coalesce(F.col(END) < F.col("_low"), F.lit(False))
    return dim.join(low, list(keys), "left").withColumn("_hit", ~stays).drop("_low").select(*dim.columns, "_hit")


def _rebuilt(
    affected: DataFrame,
    log: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    sequence: str,
    track: Sequence[str],
    delete_when: str | None,
    rows_per_task: int | None,
) -> DataFrame:
    """The rows that take the place of the affected ones."""
    log = widen(log, batch)
    columns = [c for c in affected.columns if c not in (START, END)]
    seq_type = batch.schema[sequence].dataType

    def place(df: DataFrame, at: str) -> DataFrame:
        return df.select(*columns, required(at, seq_type, sequence).alias("_at"))

    if delete_when is not None:
        placed = materialize(_reread(affected, log, batch, keys, sequence, place), "placed")
        return _runs(placed, columns, keys, track, delete_when, rows_per_task)

    placed, whole = place(batch, sequence), affected
    split = _split_rows(affected, batch, keys, sequence, track, rows_per_task)
    reach = split.agg(F.min("_from"), F.max("_upto")).first()
    if reach[0] is not None:
        # how far the split rows reach is pushed to the scan of the log
        since, upto = (F.lit(v).cast(seq_type) for v in reach)
        near = log.filter((F.col(sequence) >= since) & (F.col(sequence) <= upto))
        near = near.join(split.select(*keys).distinct(), list(keys), "left_semi")
        spans = split.withColumn("_never", F.lit(None).cast(seq_type))
        inner = as_of_join(near, spans, keys, sequence, "_from", "_never", rows_per_task)
        placed = placed.unionByName(place(inner.filter(F.col(sequence) <= F.col("_upto")), sequence))
        mine = [affected[k].eqNullSafe(split[k]) for k in keys]
        whole = affected.join(split, [*mine, affected[START] == split["_from"]], "left_anti")
    last = whole.filter(F.col(sequence) > F.col(START))
    placed = placed.unionByName(place(whole, START)).unionByName(place(last, sequence))
    return _runs(placed, columns, keys, track, delete_when, rows_per_task)


def _split_rows(
    affected: DataFrame, batch: DataFrame, keys: Sequence[str], sequence: str, track: Sequence[str], rows_per_task: int | None
) -> DataFrame:
    """(keys, _from, _upto): rows of several events, with the time of the last, into which an event with other tracked values falls."""
    events = batch.select(*keys, F.col(sequence).alias("_new"), F.struct(*track).alias("_as"))
    spans = affected.select(
        *keys, F.col(START).alias("_from"), F.col(END).alias("_until"), F.col(sequence).alias("_upto"), F.struct(*track).alias("_is")
    )
    met = as_of_join(events, spans, keys, "_new", "_from", "_until", rows_per_task)
    inside = (F.col("_from") < F.col("_upto")) & (F.col("_new") <= F.col("_upto")) & ~F.col("_as").eqNullSafe(F.col("_is"))
    return materialize(met.filter(inside).select(*keys, "_from", "_upto").distinct(), "split")


def _reread(affected: DataFrame, log: DataFrame, batch: DataFrame, keys: Sequence[str], sequence: str, place) -> DataFrame:
    """Events from which the rows of the batch's keys follow: the open row and the batch, or the log for keys with late events."""
    on = list(keys)
    low = batch.groupBy(*on).agg(F.min(sequence).alias("_low"))
    anchors = affected.groupBy(*on).agg(
        F.min(START).alias("_first"),
        F.max(sequence).alias("_seen"),
        F.bool_or(F.col(END).isNull()).alias("_open"),
    )
    reach = low.join(anchors, on, "left").select(
        *on,
        F.coalesce(F.col("_open") & (F.col("_seen") < F.col("_low")), F.lit(False)).alias("_in_order"),
        F.least(F.coalesce("_first", "_low"), F.col("_low")).alias("_from"),
    )
    reach = materialize(reach, "reach")  # one row per key of the batch
    forward = reach.filter("_in_order").select(*on)
    placed = place(affected.filter(F.col(END).isNull()).join(forward, on, "left_semi"), START).unionByName(
        place(batch.join(forward, on, "left_semi"), sequence)
    )
    late = reach.filter(~F.col("_in_order")).select(*on, "_from")
    since = late.agg(F.min("_from")).first()[0]
    if since is None:
        return placed
    # The earliest point of any late key reaches the scan of the log as a pushed filter.
    recent = log.filter(F.col(sequence) >= F.lit(since))
    return placed.unionByName(place(recent.join(late, on).filter(F.col(sequence) >= F.col("_from")), sequence))


def scd2_current(dim: DataFrame) -> DataFrame:
    """The open row of each key."""
    return dim.filter(F.col(END).isNull())


def scd2_as_of(dim: DataFrame, ts) -> DataFrame:
    """The rows valid at ``ts`` (a column or a literal)."""
    at = ts if isinstance(ts, Column) else F.lit(ts)
    return dim.filter((F.col(START) <= at) & (F.col(END).isNull() | (F.col(END) > at)))
