"""Near-duplicate groups by exact Jaccard similarity of word shingles, found through parity sketches.

A parity sketch has one bit for each cell of a hash table: the parity of the number of set elements in it. Two
sketches differ in at most as many bits as their sets differ in elements, so sets within a known symmetric
difference d agree on at least one of d + 1 blocks of their sketches. Blocks here are as wide as the
element hash, and stored as the XOR of one random word for each set bit.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, materialize, rows_of_bytes
from tidemark.llm.graph import components, linked_groups
from tidemark.llm.sets import mix, shingles, words

BAND_RATIO = Fraction(5, 4)  # sizes of one band differ by at most this factor
#: (elements a block must hold on average, elements up to which it is sparse and tells little, share of blocks that are
#: spare, which pays for leaving sparse ones out); the first that fits holds.
SPARSE = [(8, 2, Fraction(1, 16)), (0, 0, Fraction(1, 8))]
CHUNK_SETS = 2048  # of a crowded group, compared with as many others in one task
CHUNK_ELEMENTS = 4_000_000
BROADCAST_ROWS = 500_000  # most wanted documents whose ids go to every task; more are joined by a shuffle


def band_tops(most: int) -> list[int]:
    """The largest set size of each band, so that the last holds ``most``."""
    tops = [1]
    while tops[-1] < most:
        tops.append(max(tops[-1] + 1, int(tops[-1] * BAND_RATIO)))
    return tops


def sketch_blocks(elements: np.ndarray, top: int, threshold: Fraction) -> np.ndarray:
    """64-bit keys from the blocks of the parity sketch that serves sets of up to ``top`` elements.

    Two different sets of at most ``top`` elements with a Jaccard similarity of ``threshold`` or more differ in d elements
    or fewer, d = 2 top (1 - t) / (1 + t). Of d + 1 + g blocks they agree on g + 1. If one of them has at most g
    sparse blocks, they agree on a block that is not sparse; if both have more, both give all their blocks as keys. So they
    share a key in any case. Without room for a difference only equal sets are similar, and there are no keys.
    """
    apart = int(2 * top * (1 - threshold) / (1 + threshold))
    if apart == 0:
        return np.empty(0, np.uint64)
    few, share = next((few, share) for least, few, share in SPARSE if top >= least * (apart + 1))
    spare = int(apart * share)
    blocks = apart + 1 + spare
    cells = mix(elements ^ np.uint64(top))
    block = (cells % np.uint64(blocks)).astype(np.int64)
    order = np.argsort(block, kind="stable")
    sizes = np.bincount(block, minlength=blocks)
    some = np.flatnonzero(sizes)
    parity = np.zeros(blocks, np.uint64)
    starts = np.cumsum(sizes) - sizes
    parity[some] = np.bitwise_xor.reduceat(mix(cells)[order], starts[some])
    name = np.arange(blocks, dtype=np.uint64) + (np.uint64(top) << np.uint64(32))
    keys = mix(mix(name) + parity)
    dense = sizes > few
    return keys[dense] if blocks - dense.sum() <= spare else keys


def sketch_keys(elements: np.ndarray, threshold: Fraction) -> np.ndarray:
    """Keys in the set's own band and in each further band in which a set can be similar."""
    n = len(elements)
    tops = band_tops(max(int(n / threshold), 1) * 2)
    own = next(i for i, top in enumerate(tops) if top >= n)
    keys = [sketch_blocks(elements, tops[own], threshold)]
    for below, top in zip(tops[own:], tops[own + 1 :]):
        if n < threshold * (below + 1):
            break
        keys.append(sketch_blocks(elements, top, threshold))
    return np.concatenate(keys)


def sets_of(docs: DataFrame, size: int, threshold: Fraction, key: str, text: str) -> DataFrame:
    """(key, n_shingles, node, digest, keys): the set's size, two digests of it and its sketch keys."""

    def sketch(batches):
        for b in batches:
            n, node, digest, keys = [], [], [], []
            for t in rows_of_bytes(b.column("_text")):
                s = shingles(words(t.lower()), size)
                raw = s.tobytes()
                n.append(len(s))
                node.append(int(np.uint64(xxhash.xxh3_64_intdigest(raw)).astype(np.int64)) if len(s) else None)
                digest.append(xxhash.xxh3_128_digest(raw))
                keys.append(sketch_keys(s, threshold).astype(np.int64) if len(s) else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("_key"),
                    pa.array(n, pa.int64()),
                    pa.array(node, pa.int64()),
                    pa.array(digest, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                ["_key", "n_shingles", "node", "digest", "keys"],
            )

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    return rows.mapInArrow(sketch, f"_key {kind}, n_shingles long, node long, digest binary, keys array<long>")


def near_duplicates(
    docs: DataFrame,
    size: int = 5,
    threshold: Fraction = Fraction(8, 10),
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, n_shingles, component_id) for each row of ``docs``.

    A text's set holds its distinct ``size``-word shingles, A-Z lower-cased; fewer words make one shingle; a
    null or empty text or one without words has the empty set and is linked with nothing. Two texts link when
    their Jaccard similarity is at least ``threshold``; ``component_id`` is the smallest key reachable by links,
    the row's own for an empty set. Equal sets are one node from the start, whatever their number. Rows with
    a null key are grouped as others are and count last for the smallest; repeated rows come out repeated; an
    empty table gives no rows. Elements are 64-bit hashes.
    """
    bounded_batches(docs.sparkSession)
    sets = materialize(sets_of(docs, size, threshold, key, text), "sets")
    full = sets.filter(F.col("n_shingles") > 0)
    same = F.min("digest") == F.max("digest")
    classes = materialize(
        full.groupBy("node").agg(
            F.min("_key").alias("first"),
            F.first("n_shingles").alias("n"),
            F.when(same, F.first("digest")).otherwise(F.raise_error(F.lit("two sets share a 64-bit id"))).alias("digest"),
        ),
        "classes",
    )

    def verify(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        wanted = materialize(ends.join(classes, "node"), "wanted")
        arrays = materialize(_elements(docs, wanted, size, key, text), "elements")
        one = arrays.select(F.col("node").alias("a"), F.col("elements").alias("_one"))
        two = arrays.select(F.col("node").alias("b"), F.col("elements").alias("_two"))
        rows = pairs.join(one, "a").join(two, "b")
        return rows.mapInArrow(lambda it: _similar(it, threshold), "a long, b long")

    def dense(rows: DataFrame) -> DataFrame:
        return _crowded(rows, classes, docs, size, threshold, key, text)

    buckets = full.select(F.explode("keys").alias("bucket"), "node")
    roots = linked_groups(buckets, verify, dense)
    labels = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    firsts = labels.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = labels.join(firsts, "root").select("node", "component_id")
    out = sets.select("_key", "n_shingles", "node").join(labels, "node", "left")
    return out.select(F.col("_key").alias(key), "n_shingles", F.coalesce("component_id", "_key").alias("component_id"))


def _elements(docs: DataFrame, wanted: DataFrame, size: int, key: str, text: str) -> DataFrame:
    """(node, elements) of the wanted sets, from the text of the first document that has each."""
    few = wanted.count() <= BROADCAST_ROWS
    near = F.broadcast(wanted) if few else wanted
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(
        near, F.col("_key").eqNullSafe(F.col("first"))
    )

    def build(batches):
        for b in batches:
            nodes, arrays = [], []
            texts, digests = rows_of_bytes(b.column("_text")), b.column("digest").to_pylist()
            for node, digest, t in zip(b.column("node").to_pylist(), digests, texts):
                raw = shingles(words(t.lower()), size).tobytes()
                if xxhash.xxh3_128_digest(raw) == digest:  # a repeated key may stand for other texts
                    nodes.append(node)
                    arrays.append(raw)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(arrays, pa.binary())], ["node", "elements"])

    found = rows.select("node", "digest", "_text").mapInArrow(build, "node long, elements binary")
    return found.dropDuplicates(["node"])


def _crowded(rows: DataFrame, classes: DataFrame, docs: DataFrame, size, threshold, key, text) -> DataFrame:
    """Links (a, b) that connect all similar sets of crowded buckets (bucket, node, root).

    Such buckets overlap, so sets that share any are one crowd. A crowd is cut into chunks by hash; each pair of chunks is a
    task, which compares all sketches by Hamming distance, verifies pairs of different groups within the bound, and
    returns a link for each two groups it joins: no more links than sets.
    """
    least = rows.groupBy("bucket").agg(F.min("node").alias("_least"))
    crowds = components(rows.join(least, "bucket").select(F.col("_least").alias("a"), F.col("node").alias("b")))
    nodes = crowds.select("node", F.col("root").alias("crowd")).join(classes.select("node", "n"), "node")
    chunks = F.greatest(F.ceil(F.count("node") / CHUNK_SETS), F.ceil(F.sum("n") / CHUNK_ELEMENTS))
    many = nodes.groupBy("crowd").agg(chunks.alias("_chunks"))
    placed = nodes.join(many, "crowd").withColumn("_own", F.pmod(F.xxhash64("node"), F.col("_chunks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_chunks") - 1)).alias("_other")
    tiles = placed.select("node", "crowd", "_own", other).select(
        "node", "crowd", "_own", F.least("_own", "_other").alias("_lo"), F.greatest("_own", "_other").alias("_hi")
    )
    ends = materialize(nodes.select("node").join(classes, "node"), "wanted")
    arrays = materialize(_elements(docs, ends, size, key, text), "elements")
    held = rows.select("node", "root").distinct()
    full = tiles.join(arrays, "node").join(held, "node")

    def compare(table: pa.Table) -> pa.Table:
        return _tile_links(table, threshold)

    return full.groupBy("crowd", "_lo", "_hi").applyInArrow(compare, "a long, b long")


def _tile_links(table: pa.Table, threshold: Fraction) -> pa.Table:
    sets = [np.frombuffer(x, np.uint64) for x in table.column("elements").to_pylist()]
    node = table.column("node").to_numpy()
    _, group = np.unique(table.column("root").to_numpy(), return_inverse=True)
    own, lo, hi = (table.column(c).to_numpy() for c in ("_own", "_lo", "_hi"))
    one_chunk = lo[0] == hi[0]
    n = np.array([len(s) for s in sets], np.int64)
    width = 1 << int(np.clip(np.ceil(np.log2(n.max() / 8 + 1)), 4, 9))  # words of a sketch
    sketches = np.zeros((len(sets), width), np.uint64)
    for i, s in enumerate(sets):
        bits = np.bincount((mix(s) % np.uint64(64 * width)).astype(np.int64), minlength=64 * width) & 1
        sketches[i] = np.packbits(bits.astype(np.uint8), bitorder="little").view("<u8")
    num, den = threshold.numerator, threshold.denominator
    links = []
    for i in range(len(sets)):
        after = np.arange(i + 1, len(sets)) if one_chunk else np.flatnonzero(own != own[i]) if own[i] == lo[0] else ()
        after = np.asarray(after, np.int64)
        after = after[(group[after] != group[i]) & (den * np.minimum(n[after], n[i]) >= num * np.maximum(n[after], n[i]))]
        if not len(after):
            continue
        apart = np.bitwise_count(sketches[after] ^ sketches[i]).sum(axis=1, dtype=np.int64)
        near = apart * (den + num) <= (n[after] + n[i]) * (den - num)
        for j in after[near][np.argsort(apart[near], kind="stable")]:
            if group[j] == group[i]:
                continue
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if den * both >= num * (n[i] + n[j] - both):
                links.append((int(node[i]), int(node[j])))
                group[group == group[j]] = group[i]
    return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})


def _similar(batches, threshold: Fraction):
    for b in batches:
        a, c, keep = b.column("_one").to_pylist(), b.column("_two").to_pylist(), []
        for x, y in zip(a, c):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(threshold.denominator * both >= threshold.numerator * (len(x) + len(y) - both))
        mask = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([b.column("a").filter(mask), b.column("b").filter(mask)], ["a", "b"])
