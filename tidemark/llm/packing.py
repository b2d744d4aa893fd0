"""Best-fit packing in rounds: local packing, nearly full bins leave, the rest merges along a tree."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, materialize, nullable
from tidemark.llm.tokens import encoder

ITEMS_PER_GROUP = 4096  # what one task packs at a time
FAN_IN = 16  # most groups that merge into one
OPENED = 25  # percent of a group's underfull bins, the emptiest, whose items are dealt with one by one in the next round
SLACK_SHARE = 64  # a bin is nearly full when less than capacity / 64 is free


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, place in it) of each item and the number of bins: largest first, each into the fullest bin it fits."""
    bin_of, at = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    with_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    some, bins = 0, 0  # some: bit f is set when a bin with f free exists
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fitting = some >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            chosen = with_free[free].pop()
            if not with_free[free]:
                some ^= 1 << free
        else:
            free, chosen, bins = capacity, bins, bins + 1
        bin_of[i], at[i] = chosen, capacity - free
        with_free[free - size].append(chosen)
        some |= 1 << (free - size)
    return bin_of, at, bins


def _pack_group(table: pa.Table, capacity: int) -> pa.Table:
    """Bins of one group's items. Items and bins alike: _group, _fill and the _members, each with its place _at."""
    fills = table.column("_fill").to_numpy()
    bin_of, at, bins = best_fit(fills, capacity)
    order = np.argsort(bin_of, kind="stable")
    members = table.column("_members").combine_chunks()
    members = members.chunk(0) if isinstance(members, pa.ChunkedArray) else members
    members = members.take(pa.array(order))
    lengths = np.diff(members.offsets.to_numpy())
    flat = members.flatten()
    fields = {f.name: column for f, column in zip(flat.type, flat.flatten())}
    fields["_at"] = pa.array(fields["_at"].to_numpy() + np.repeat(at[order], lengths), pa.int64())
    moved = pa.StructArray.from_arrays(list(fields.values()), fields=[f.with_nullable(True) for f in flat.type])
    ends = np.zeros(bins + 1, np.int64)
    np.add.at(ends, bin_of[order] + 1, lengths)
    lists = pa.ListArray.from_arrays(pa.array(np.cumsum(ends), pa.int32()), moved, type=pa.list_(pa.field("element", moved.type)))
    filled = np.bincount(bin_of, weights=fills, minlength=bins).astype(np.int64)
    group = pa.array(np.full(bins, table.column("_group")[0].as_py()), pa.int64())
    return pa.table({"_group": group, "_fill": pa.array(filled), "_members": lists})


def _opened(bins: DataFrame, size: str) -> DataFrame:
    """``bins`` with the emptiest of each group taken apart into the items they hold."""
    emptiest = F.percent_rank().over(Window.partitionBy("_group").orderBy("_fill"))
    ranked = bins.withColumn("_open", (emptiest <= OPENED / 100) & (F.size("_members") > 1))
    apart = ranked.filter("_open").select("_group", F.explode("_members").alias("_m"))
    alone = F.array(F.col("_m").withField("_at", F.lit(0).cast("long"))).alias("_members")
    apart = apart.select("_group", F.col("_m").getField(size).cast("long").alias("_fill"), alone)
    return ranked.filter("NOT _open").select("_group", "_fill", "_members").unionByName(apart)


def pack(items: DataFrame, size: str, capacity: int) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset`` (long): few bins of ``capacity``, filled without gaps from 0.

    Items of the whole capacity are bins of their own. The others are dealt into groups of about
    ITEMS_PER_GROUP; each group packs best-fit, its nearly full bins leave, and up to FAN_IN groups merge,
    their underfull bins being the items of the next round, until one group is left. Of these the OPENED emptiest are taken apart, so that
    bins more than half full, which cannot join each other, take in their items one by one.
    Sizes run from 0 to ``capacity``; a null or larger size raises. Ties and repeated rows are items like any other; an
    empty table gives no rows. Other columns pass through; ``sequence_id`` and ``offset`` are replaced.
    """
    spark = items.sparkSession
    bounded_batches(spark)
    items = items.drop("sequence_id", "offset")
    payload = items.columns
    fits = F.col(size).isNotNull() & F.col(size).between(0, capacity)
    # one table, written: every later read of it numbers the same rows alike
    items = materialize(
        items.withColumn(size, F.when(fits, F.col(size)).otherwise(F.raise_error(F.lit("an item exceeds the capacity")))),
        "pack-items",
    )
    member = F.array(F.struct(*[F.col(c) for c in payload], F.lit(0).cast("long").alias("_at"))).alias("_members")
    fill = F.col(size).cast("long")
    done = [items.filter(fill == capacity).select(member)]

    rest = items.filter(fill < capacity)
    count = rest.count()
    groups = max(1, -(-count // ITEMS_PER_GROUP))
    level = rest.select(
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).alias("_group"), fill.alias("_fill"), member
    )
    schema = nullable(level.schema)
    slack = capacity // SLACK_SHARE
    while count:
        packed = materialize(
            level.groupBy("_group").applyInArrow(lambda t: _pack_group(t, capacity), schema), "pack-round"
        )
        open_bins = packed.filter(F.col("_fill") < capacity - slack)
        left = open_bins.count()
        if groups == 1 or left == 0:  # nothing is left to merge
            done.append(packed.select("_members"))
            break
        done.append(packed.filter(F.col("_fill") >= capacity - slack).select("_members"))
        fan = int(min(FAN_IN, max(2, ITEMS_PER_GROUP * groups // left)))
        groups, count = -(-groups // fan), left
        level = _opened(open_bins, size).withColumn("_group", F.expr(f"_group div {fan}"))

    union = done[0]
    for more in done[1:]:
        union = union.unionByName(more)
    return (
        union.withColumn("sequence_id", F.monotonically_increasing_id())
        .select("sequence_id", F.inline("_members"))
        .withColumnRenamed("_at", "offset")
        .select(*payload, "sequence_id", "offset")
    )


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    length: int,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
    ranks: str | None = None,
) -> DataFrame:
    """Pieces of at most ``length`` ids: (key, piece, start, length, ids_crc32).

    A document's ids are its text's and then ``end_id``; a null text is empty and gives the end id alone.
    Documents of more than ``length`` ids are cut so that all pieces but the first are full, which leaves one
    short piece to pack. ``ids_crc32`` is over the piece's ids as little-endian unsigned 32-bit integers. Very long texts are
    encoded whole. Rows that repeat a document give its pieces again; an empty table gives none. No other column is read or returned, and
    a key named ``piece``, ``start``, ``length`` or ``ids_crc32`` is refused.
    """
    if key in ("piece", "start", "length", "ids_crc32"):
        raise ValueError(f"the key would share the name {key} with a result column")
    bounded_batches(docs.sparkSession)
    end = np.asarray([end_id], "<u4").tobytes()
    names = ["_key", "piece", "start", "length", "ids_crc32"]

    def cut(batches):
        enc = encoder(tokenizer, ranks)
        for b in batches:
            at, pieces = [], []
            for row, ids in enumerate(enc.encode(b.column("_text").to_pylist())):
                ids += end
                n, start, piece = len(ids) // 4, 0, 0
                stop = (n - 1) % length + 1
                while start < n:
                    at.append(row)
                    pieces.append((piece, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop])))
                    start, stop, piece = stop, stop + length, piece + 1
            columns = list(zip(*pieces)) or [(), (), (), ()]
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("_key").take(pa.array(at, pa.int64())), *map(pa.array, columns, kinds)], names
            )

    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    kind = docs.schema[key].dataType.simpleString()
    schema = f"_key {kind}, piece int, start long, length long, ids_crc32 long"
    return rows.mapInArrow(cut, schema).withColumnRenamed("_key", key)
