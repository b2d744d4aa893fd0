"""Structured Streaming flows: run to completion, keep state in tables, tolerate replays."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.merge import delete_insert, insert_if_absent, merge_full, require_unique, upsert, widen
from tidemark.operators.quality import Rule, write_checked
from tidemark.operators.scd import END, START, row_changes, scd1, scd1_merge, scd2, scd2_changes, scd2_delta
from tidemark.runtime import Files, materialize
from tidemark.sources.ledger import FileLedger, stream_id, write_names
from tidemark.sources.runs import GONE, LATEST, NEWEST, RunTable
from tidemark.sources.tables import OPEN, KeyedTable

Sink = Callable[[DataFrame, int], None]
SOURCE = "_source"  # the file a streamed row comes from


def run_available(query: StreamingQuery) -> StreamingQuery:
    """Wait for a triggered query to finish what is there; a failed batch raises here."""
    query.awaitTermination()
    return query


def foreach_batch_sink(fn: Sink, keep: bool = False) -> Sink:
    """A sink from a callback. A replay repeats a batch id, so the callback must be idempotent.

    ``keep`` holds the batch while the callback runs, for sources dearer to read than files.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        if not keep:
            fn(batch, batch_id)
            return
        batch.persist()
        try:
            fn(batch, batch_id)
        finally:
            batch.unpersist()

    return sink


def append_flow(stream: DataFrame, sink: Sink, checkpoint: str) -> StreamingQuery:
    """Feed a stream into a sink until its input is used up."""
    query = (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    return run_available(query)


def merge_sink(table: KeyedTable | RunTable, strategy: str = "merge_full") -> Sink:
    """Apply a keyed merge per micro-batch to an external table. Replaying the last batch is safe.

    ``merge_full`` treats each batch as a full snapshot. ``upsert``, ``insert_if_absent`` and ``delete_insert`` rewrite the cells of a
    ``KeyedTable`` that the batch touches, and add one run to a ``RunTable``, whose rule must be ``newest``, or
    ``group`` for ``delete_insert``; there a NULL key is a key like others.
    """
    if isinstance(table, RunTable):
        return _merge_runs(table, strategy)
    partial = {"upsert": upsert, "insert_if_absent": insert_if_absent, "delete_insert": delete_insert}

    def apply(batch: DataFrame, batch_id: int) -> None:
        if strategy == "merge_full":
            held = table.schema()
            target = table.read(schema=held) if held and set(held.names) - set(batch.columns) else batch
            table.replace(merge_full(target, batch, table.keys), table.known_cells())
            return
        cells = table.cells_of(batch)
        before = table.read(cells, table.schema() or batch.schema)
        table.replace(partial[strategy](before, batch, table.keys), cells)

    return foreach_batch_sink(apply)


def _merge_runs(table: RunTable, strategy: str) -> Sink:
    def apply(batch: DataFrame, batch_id: int) -> None:
        if strategy != "delete_insert":
            require_unique(batch, table.keys)
        if strategy == "merge_full":
            held = table.schema()
            target = table.read() if held and set(held.names) - set(batch.columns) else batch
            table.commit(merge_full(target, batch, table.keys), replace=True)
        elif strategy == "insert_if_absent":
            known = table.near(batch, batch.schema).select(*table.keys)
            table.commit(batch.join(known, table.keys, "left_anti"))
        else:
            table.commit(batch)

    return foreach_batch_sink(apply)


def stream_scd(
    stream: DataFrame,
    table: KeyedTable | RunTable,
    type: int,
    sequence: str,
    checkpoint: str,
    track: Sequence[str] = (),
    delete_when: str | None = None,
    rows_per_task: int | None = None,
    feed: str | None = None,
) -> StreamingQuery:
    """Keep a type 1 or type 2 table current. The table is the state, so nothing else grows.

    Applying a batch again changes nothing, so a replay, or a stream that starts over on a new
    checkpoint, needs no memory of batch ids. In a ``RunTable`` (see ``scd1_runs`` and ``scd2_runs``) a batch costs what it brings;
    ``feed`` then names a folder that receives, for each batch, the rows that it changed as (was, now).
    """
    if isinstance(table, RunTable):
        if type == 1:
            sink = _scd1_runs_sink(table, delete_when, feed)
        else:
            sink = _scd2_runs_sink(table, sequence, track, delete_when, rows_per_task, feed)
    elif feed:
        raise ValueError("only a table of runs has a feed")
    elif type == 1:
        sink = _scd1_sink(table, sequence)
    elif type == 2:
        sink = _scd2_sink(table, sequence, track, delete_when, rows_per_task)
    else:
        raise ValueError("type must be 1 or 2")
    return append_flow(stream, sink, checkpoint)


def scd1_runs(spark: SparkSession, path: str, keys: Sequence[str], sequence: str) -> RunTable:
    """A type 1 table whose upkeep costs what each batch brings."""
    return RunTable(spark, path, keys, LATEST, sequence)


def scd2_runs(spark: SparkSession, path: str, keys: Sequence[str]) -> RunTable:
    """A type 2 table whose upkeep costs what each batch changes; its log holds all events."""
    return RunTable(spark, path, [*keys, START], NEWEST, by=keys)


def read_feed(spark: SparkSession, feed: str, since: int = -1, upto: int | None = None) -> DataFrame | None:
    """(was, now) of the batches after ``since``, up to ``upto``; a row changed twice comes once for each batch. None without any."""
    taken = [n for n in Files(spark).list(feed) if n.startswith("batch=")]
    wanted = [n for n in taken if since < int(n.split("=")[1]) <= (upto if upto is not None else int(n.split("=")[1]))]
    if not wanted:
        return None
    frames = [spark.read.parquet(f"{feed}/{n}") for n in sorted(wanted, key=lambda n: int(n.split("=")[1]))]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _commit_changes(table: RunTable, changes: DataFrame, feed: str | None, log: dict | None = None) -> None:
    """Store (was, now) in the feed, then commit what it says: new rows, and keys whose rows went."""
    if feed:
        path = f"{feed}/batch={table.version() + 1}"
        changes.write.mode("overwrite").parquet(path)
        changes = table.spark.read.schema(changes.schema).parquet(path)
    columns = changes.schema["now"].dataType.names
    row = F.coalesce("now", "was")
    rows = changes.select(*[row.getField(c).alias(c) for c in columns], F.col("now").isNull().alias(GONE))
    table.commit(rows, log)


def _scd1_runs_sink(table: RunTable, delete_when: str | None, feed: str | None) -> Sink:
    """Each batch is reduced to its last event per key and added; ``delete_when`` marks events that remove their key."""
    gone = F.coalesce(F.expr(delete_when), F.lit(False)) if delete_when else F.lit(False)

    def apply(batch: DataFrame, batch_id: int) -> None:
        last = scd1(batch, table.keys, table.sequence).withColumn(GONE, gone)
        if not feed:
            table.commit(last)
            return
        if table.schema() is None:
            shown = F.when(~F.col(GONE), F.struct(*batch.columns))
            changes = last.select(F.lit(None).cast(batch.schema).alias("was"), shown.alias("now")).filter("now IS NOT NULL")
            changes.write.mode("overwrite").parquet(f"{feed}/batch=0")
            table.commit(last)
            return
        last = materialize(last, "batch")
        held = table.near(last, batch.schema, gone=True)
        ids = last.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(table.keys)])
        same = [held[k].eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(table.keys)]
        held = materialize(held.join(ids, same, "left_semi"), "held")
        both = held.unionByName(last, allowMissingColumns=True)
        won = scd1(both.select(*[c for c in both.columns if c != GONE], GONE), table.keys, table.sequence)
        old = held.filter(~F.col(GONE)).drop(GONE)
        changes = row_changes(widen(old, batch), won.filter(~F.col(GONE)).drop(GONE), table.keys)
        path = f"{feed}/batch={table.version() + 1}"
        changes.write.mode("overwrite").parquet(path)
        table.commit(last)

    return foreach_batch_sink(apply)


def _scd2_runs_sink(
    table: RunTable, sequence: str, track: Sequence[str], delete_when: str | None, rows_per_task: int | None, feed: str | None
) -> Sink:
    """A batch goes to the log, and what it changes in the dimension is added: new rows, and starts that are no more."""
    keys = table.by

    def apply(batch: DataFrame, batch_id: int) -> None:
        staged = table.stage_log(batch)
        batch = table.read_run(staged)  # from here on read what was written
        if table.schema() is None:
            rows = scd2(batch, keys, sequence, track, delete_when, rows_per_task)
            changes = rows.select(F.struct(*rows.columns).alias("now")).withColumn("was", F.lit(None).cast(rows.schema))
            _commit_changes(table, changes.select("was", "now"), feed, staged)
            return
        history = table.read_log(batch.schema, batch, staged)
        changes = scd2_changes(
            table.near(batch), history, batch, keys, sequence, track, delete_when, rows_per_task
        )
        _commit_changes(table, changes, feed, staged)

    return foreach_batch_sink(apply)


def _scd1_sink(table: KeyedTable, sequence: str) -> Sink:
    if table.period:
        raise ValueError("a type 1 table has one row per key and cells by bucket only")

    def apply(batch: DataFrame, batch_id: int) -> None:
        cells = table.cells_of(batch)
        before = table.read(cells, table.schema() or batch.schema)
        table.replace(scd1_merge(before, batch, table.keys, sequence), cells)

    return foreach_batch_sink(apply)


def _period_floor(cells: Sequence[str], low: Mapping[str, str]) -> list[str]:
    """Cells of the given buckets that are open or end no earlier than the bucket's period."""
    kept = []
    for cell in cells:
        bucket, _, period = cell.partition("-")
        if bucket in low and (not period or period == OPEN or period >= low[bucket]):
            kept.append(cell)
    return kept


def _scd2_sink(
    table: KeyedTable, sequence: str, track: Sequence[str], delete_when: str | None, rows_per_task: int | None
) -> Sink:
    """Rewrite only cells that hold rows a batch may change: its buckets, from its first period on."""

    def lowest(batch: DataFrame) -> dict[str, str]:
        bucket = F.pmod(F.xxhash64(*table.keys), F.lit(table.buckets)).cast("string")
        at = F.date_format(F.min(sequence), table.period_format) if table.period else F.lit("")
        return {r[0]: r[1] for r in batch.groupBy(bucket.alias("b")).agg(at).collect()}

    def apply(batch: DataFrame, batch_id: int) -> None:
        log = KeyedTable(table.spark, table.path, table.keys, table.buckets)
        version, schema = table.version() + 1, batch.schema
        log.append(batch, version)
        batch = log.read_log(schema, generation=version)  # from here on read what was written
        if version == 0:
            table.replace(scd2(batch, table.keys, sequence, track, delete_when, rows_per_task), [])
            return
        low = lowest(batch)
        touched = _period_floor(table.known_cells(), low)
        before = table.read(touched, table.schema())
        history = log.read_log(schema, sorted(low))
        kept, rebuilt = scd2_delta(
            before, history, batch, table.keys, sequence, track, delete_when, rows_per_task
        )
        # Rebuilt rows end no earlier than the batch begins, so they fall into touched or new cells.
        table.replace(kept.unionByName(rebuilt.select(*kept.columns)), touched)

    return foreach_batch_sink(apply)


def scd2_table(spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 64) -> KeyedTable:
    """A type 2 table whose closed rows lie apart by the month they ended in."""
    return KeyedTable(spark, path, keys, buckets, period=END)


def stream_expect(
    stream: DataFrame, rules: Sequence[Rule], path: str, checkpoint: str, source: str | None = None
) -> list[dict[str, int]]:
    """Append passing rows batch by batch; returns the counts of each batch committed in this run.

    A violated fail rule raises and leaves nothing of its batch behind. Batches are named after their stream, whose id
    lies in its checkpoint, and their number, so a replay adds nothing. ``source`` names a column with the file that each row
    comes from; it is not stored. With it a ledger keeps the files taken in, and a stream on a new checkpoint adds exactly
    the rows of files that are missing. Without it such a stream appends all it reads: start it on a new output (``refresh``).
    """
    counts: list[dict[str, int]] = []
    files = Files(stream.sparkSession)
    root = path.rstrip("/")
    ledger = FileLedger(stream.sparkSession, f"{root}/_ledger") if source else None
    if ledger:
        found = {}
        for name in files.list(root):
            if name.startswith("batch="):
                stream_name, _, number = name.removeprefix("batch=").rpartition("-")
                found[f"{root}/{name}"] = (stream_name, int(number))
        ledger.catch_up(found)

    def apply(batch: DataFrame, batch_id: int) -> None:
        mine = stream_id(batch.sparkSession, checkpoint)
        target = f"{root}/batch={mine}-{batch_id}"
        if files.exists(f"{target}/_SUCCESS"):
            return
        if not ledger:
            counts.append(write_checked(batch, rules, target))
            return
        fresh = materialize(ledger.missing(batch.select(F.col(source).alias("file")), mine), "new-files")
        if set(ledger.last()) - {mine}:
            batch = batch.join(fresh, F.col(source) == F.col("file"), "left_semi")
        counts.append(write_checked(batch.drop(source), rules, target, beside=lambda staged: write_names(fresh, staged)))
        ledger.add(fresh, mine, batch_id)

    append_flow(stream, apply, checkpoint)
    return counts


def refresh(
    flows: Mapping[str, Callable[[str, str], object]], root: str, spark: SparkSession, full: bool = False
) -> dict[str, object]:
    """Run flows in order, each with its own output and checkpoint directory.

    Incremental runs resume; a full run starts each flow on new directories.
    """
    files = Files(spark)
    pointer = f"{root.rstrip('/')}/_epoch"
    epoch = files.latest(pointer)
    if full or epoch is None:
        taken = [int(n.split("=", 1)[1]) for n in files.list(root) if n.startswith("epoch=")]
        fresh = max(taken, default=-1) + 1
    else:
        fresh = epoch
    base = f"{root.rstrip('/')}/epoch={fresh}"
    results = {name: flow(f"{base}/{name}", f"{base}/_checkpoints/{name}") for name, flow in flows.items()}
    if fresh != epoch:
        files.supersede(pointer, fresh)
    return results
