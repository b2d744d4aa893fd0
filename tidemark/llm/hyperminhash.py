"""Near-duplicate groups through HyperMinHash: compressed registers, banded, and compared before the full sets are.

Each element goes to one of the buckets by its hash; a bucket's register holds its smallest hash value as the number of leading
zeros and the ten bits behind the first one. Registers of similar sets agree with the probability of their Jaccard
similarity, and by accident in few cases, which the estimate takes off.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, materialize, rows_of_bytes
from tidemark.llm.graph import components, linked_groups
from tidemark.llm.sets import mix, shingles, words

MANTISSA = 10  # bits of a register behind its leading zeros, of which there are up to 63
#: Sets of similarity 0.85 agree in none of so many bands of so many registers in fewer than one case in 10^10.
BANDS, BAND_REGISTERS = 32, 4
SMALL_REGISTERS = 16  # in a band of a set that has too few elements to fill BANDS of them
CLASS_RATIO = Fraction(5, 4)  # sizes of one class of small sets differ by at most this factor
SPARSE = 2  # a band of so few elements tells little
MISSED = 1e-9  # largest chance that a candidate pair at the threshold is taken for one below it
HOT_SHARE = 4096  # a set that more than this share of all rows have is joined by broadcast: there are fewer such sets
HOT_ROWS = 1000
BROADCAST_ROWS = 500_000  # most candidates, of some 40 bytes, that go to every task that reads texts
CHUNK_SETS = 1024  # of a crowd, compared with as many others in one task
CHUNK_ELEMENTS = 2_000_000

_KINDS = "_key {}, n_shingles long, digest binary, registers binary, keys array<long>"


def registers(elements: np.ndarray, buckets: int) -> np.ndarray:
    """A 16-bit register for each bucket: 1 + zeros * 2**MANTISSA + mantissa, or 0 where no element falls."""
    out = np.zeros(buckets, np.uint16)
    if not len(elements):
        return out
    bucket, value = placed(elements, buckets)
    least = np.full(buckets, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, bucket, value)
    some = np.unique(bucket)
    low = least[some]
    # a float's exponent may be rounded up, so the number of leading zeros is corrected
    zeros = np.clip(63 - np.floor(np.log2(np.maximum(low, 1).astype(np.float64))).astype(np.int64), 0, 62)
    zeros = np.clip(zeros + ((np.uint64(1) << (63 - zeros).astype(np.uint64)) > low), 0, 62)
    mantissa = (low << (zeros + 1).astype(np.uint64)) >> np.uint64(64 - MANTISSA)
    out[some] = (1 + (zeros << MANTISSA) + mantissa.astype(np.int64)).astype(np.uint16)
    return out


def placed(elements: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each element, and its hash value there."""
    hashes = mix(elements ^ np.uint64(buckets))
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64), mix(hashes)


def classes_of_sizes(threshold: Fraction) -> list[tuple[int, int, int]]:
    """(largest size, bands, spare bands) of each class of small sets, until a class needs more than BANDS.

    Two sets of a class differ in at most d elements. An element lies in one band, so of d + 1 + spare bands spare + 1 agree
    whatever the registers: no pair of small sets is left to chance.
    """
    out, top = [], 1
    while True:
        apart = int(2 * top * (1 - threshold) / (1 + threshold))
        spare = max(1, apart // 8)
        if apart + 1 + spare > BANDS:
            return out
        out.append((top, apart + 1 + spare if apart else 0, spare))
        top = max(top + 1, int(top * CLASS_RATIO))


def band_keys(elements: np.ndarray, bands: int, size: int, spare: int | None) -> np.ndarray:
    """A key for each band that has elements. With ``spare`` bands too many, sparse ones are left out if there are not more of them."""
    regs = registers(elements, bands * size)
    content = regs.reshape(bands, size).view(np.uint64)
    keys = mix(np.arange(bands, dtype=np.uint64) + (np.uint64(bands) << np.uint64(32)) + (np.uint64(size) << np.uint64(48)))
    for column in content.T:
        keys = mix(keys * np.uint64(3) + column)
    used = content.any(axis=1)
    if spare is None:
        return keys[used]
    counts = np.bincount(placed(elements, bands * size)[0] // size, minlength=bands)
    return keys[counts > SPARSE] if (counts <= SPARSE).sum() <= spare else keys[used]


def set_keys(elements: np.ndarray, threshold: Fraction, small: list[tuple[int, int, int]]) -> np.ndarray:
    """Keys in the set's own class and in each further one in which a similar set can lie.

    Of two sets that differ the smaller gives the larger's keys too. Where no difference is possible there are no keys.
    """
    n, out, below = len(elements), [np.empty(0, np.uint64)], 0
    for top, bands, spare in small:
        if n <= top and n >= threshold * (below + 1) and bands:
            out.append(band_keys(elements, bands, SMALL_REGISTERS, spare))
        below = top
    if n >= threshold * (below + 1):
        out.append(band_keys(elements, BANDS, BAND_REGISTERS, None))
    return np.concatenate(out)


def accidental(n: np.ndarray, m: np.ndarray, buckets: int) -> np.ndarray:
    """Expected number of equal registers of two disjoint sets of ``n`` and ``m`` elements.

    With x = n / buckets and y = m / buckets the smallest values are distributed with densities x e^-xv and y e^-yv. A register
    with i leading zeros covers a cell of width 2^-(i + 1 + MANTISSA) between 2^-(i + 1) and 2^-i, so the chance to share a
    cell there is its width times the integral of the product of both densities.
    """
    x, y = (np.asarray(v, np.float64)[:, None] / buckets for v in (n, m))
    i = np.arange(48)[None, :]
    rate = x + y
    inside = np.exp(-rate * 2.0 ** -(i + 1)) - np.exp(-rate * 2.0**-i)
    chance = (2.0 ** -(i + 1 + MANTISSA) * (x * y / rate) * inside).sum(axis=1)
    return buckets * chance


def estimate(one: np.ndarray, two: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(Jaccard estimates, registers that count) for rows of registers and the sizes of their sets.

    Of the U registers that are set on either side C agree; C = J U + (1 - J) A with A accidental ones.
    """
    used = ((one != 0) | (two != 0)).sum(axis=1).astype(np.float64)
    equal = ((one == two) & (one != 0)).sum(axis=1).astype(np.float64)
    chance = np.minimum(accidental(n, m, one.shape[1]), used / 2)
    return np.clip((equal - chance) / (used - chance), 0, 1), used


def possible(estimated: np.ndarray, used: np.ndarray, threshold: float) -> np.ndarray:
    """False where a pair at the threshold would be estimated so low with a chance below MISSED (Chernoff's bound)."""
    q = np.clip(estimated, 1e-12, 1 - 1e-12)
    apart = q * np.log(q / threshold) + (1 - q) * np.log((1 - q) / (1 - threshold)) if threshold < 1 else np.inf
    return (estimated >= threshold) | (used * apart <= -math.log(MISSED))


def sets_of(docs: DataFrame, size: int, threshold: Fraction, key: str, text: str) -> DataFrame:
    """(key, n_shingles, digest, registers, keys) of each row; without words the digest is null."""
    small = classes_of_sizes(threshold)

    def sketch(batches):
        for b in batches:
            n, digest, regs, keys = [], [], [], []
            for t in rows_of_bytes(b.column("_text")):
                s = shingles(words(t.lower()), size)
                n.append(len(s))
                digest.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                regs.append(registers(s, BANDS * BAND_REGISTERS).tobytes() if len(s) else None)
                keys.append(set_keys(s, threshold, small).view(np.int64) if len(s) else None)
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
            arrays = [b.column("_key"), *[pa.array(v, k) for v, k in zip((n, digest, regs, keys), kinds)]]
            yield pa.RecordBatch.from_arrays(arrays, ["_key", "n_shingles", "digest", "registers", "keys"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    return rows.mapInArrow(sketch, _KINDS.format(kind))


def near_duplicates(
    docs: DataFrame, size: int = 5, threshold: Fraction = Fraction(85, 100), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, n_shingles, component_id, kept) for each row of ``docs``, a stored table.

    A text's set holds its distinct ``size``-word shingles, A-Z lower-cased; fewer words make one shingle; a null or empty text or
    one without words has the empty set and is linked with nothing. Texts link when the Jaccard similarity of their
    full sets is at least ``threshold`` (0.85 or more, for which the bands are laid out); ``component_id`` is the smallest key
    reachable by links, ``kept`` tells whether it is the row's own. Equal sets are one class from the start, and hold
    together however many rows have them. Very long texts are read whole; their sketch is no larger. Rows with a null key are grouped as others and
    count last for the smallest; rows that repeat a key come out once each. An empty table gives no rows, and other
    columns are left out, so their names cannot clash. Elements are 64-bit hashes.
    """
    if threshold < Fraction(85, 100) or threshold > 1:
        raise ValueError("the bands are laid out for thresholds from 0.85 to 1")
    bounded_batches(docs.sparkSession)
    sets = materialize(sets_of(docs, size, threshold, key, text), "sets")
    full = sets.filter("digest IS NOT NULL")
    classes = full.groupBy("digest").agg(
        F.min("_key").alias("first"),
        F.count(F.lit(1)).alias("rows"),
        F.first("n_shingles").alias("n"),
        F.first("registers").alias("registers"),
        F.first("keys").alias("keys"),
    )
    # numbered by place, so classes never share a number
    classes = materialize(classes, "numbered").withColumn("node", F.monotonically_increasing_id())
    classes = materialize(classes, "classes")

    def elements(nodes: DataFrame) -> DataFrame:
        """(node, elements) of some classes, from the first text of each."""
        wanted = materialize(nodes.join(classes.select("node", "digest", "first"), "node"), "wanted")
        rows = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
        near = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted  # so few go to the texts, else these are shuffled
        rows = rows.join(near, F.col("_key").eqNullSafe(F.col("first"))).select("node", "digest", "_text")

        def build(batches):
            for b in batches:
                node, raw = [], []
                for i, digest, t in zip(b.column("node").to_pylist(), b.column("digest").to_pylist(), rows_of_bytes(b.column("_text"))):
                    s = shingles(words(t.lower()), size).tobytes()
                    if xxhash.xxh3_128_digest(s) == digest:  # rows that share a key may hold other texts
                        node.append(i)
                        raw.append(s)
                yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(raw, pa.binary())], ["node", "elements"])

        return materialize(rows.mapInArrow(build, "node long, elements binary").dropDuplicates(["node"]), "elements")

    def both(pairs: DataFrame, values: DataFrame, *names: str) -> DataFrame:
        one = values.select(F.col("node").alias("a"), *[F.col(c).alias(f"{c}_a") for c in names])
        two = values.select(F.col("node").alias("b"), *[F.col(c).alias(f"{c}_b") for c in names])
        return pairs.join(one, "a").join(two, "b")

    def verify(pairs: DataFrame) -> DataFrame:
        num, den = threshold.numerator, threshold.denominator
        sized = both(pairs, classes, "n", "registers").filter(den * F.least("n_a", "n_b") >= num * F.greatest("n_a", "n_b"))
        close = materialize(sized.mapInArrow(lambda it: _estimated(it, float(threshold)), "a long, b long"), "close")
        ends = close.select(F.col("a").alias("node")).unionByName(close.select(F.col("b").alias("node"))).distinct()
        return both(close, elements(ends), "elements").mapInArrow(lambda it: _similar(it, threshold), "a long, b long")

    def crowded(rows: DataFrame) -> DataFrame:
        """Links that connect all similar sets of large buckets (bucket, node, root).

        Such buckets overlap, so sets that share any are one crowd. It is cut by size into classes no wider than the threshold, of
        which neighbours are compared, and these into chunks; each two chunks are a task. It compares registers and then
        full sets of those still in different groups, and returns no more links than sets.
        """
        least = rows.groupBy("bucket").agg(F.min("node").alias("_least"))
        crowds = components(rows.join(least, "bucket").select(F.col("_least").alias("a"), F.col("node").alias("b")))
        sized = crowds.select("node", F.col("root").alias("crowd")).join(classes.select("node", "n"), "node")
        own = F.floor(F.log(F.col("n").cast("double")) / F.lit(-math.log(threshold) if threshold < 1 else 1.0)).cast("long")
        sized = sized.select("node", "crowd", "n", F.explode(F.array(own, own + 1)).alias("class"))
        chunks = F.greatest(F.ceil(F.count("node") / CHUNK_SETS), F.ceil(F.sum("n") / CHUNK_ELEMENTS))
        many = sized.groupBy("crowd", "class").agg(chunks.alias("_chunks"))
        put = sized.join(many, ["crowd", "class"]).withColumn("_own", F.pmod(F.xxhash64("node"), F.col("_chunks")))
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_chunks") - 1)).alias("_other")
        tiles = put.select("node", "crowd", "class", "n", "_own", other)
        tiles = tiles.withColumns({"_lo": F.least("_own", "_other"), "_hi": F.greatest("_own", "_other")}).drop("_other")
        held = rows.select("node", "root").distinct()
        full = tiles.join(elements(crowds.select("node")), "node").join(classes.select("node", "registers"), "node").join(held, "node")

        def compare(table: pa.Table) -> pa.Table:
            return _tile_links(table, threshold)

        return full.groupBy("crowd", "class", "_lo", "_hi").applyInArrow(compare, "a long, b long")

    members = materialize(classes.select(F.explode("keys").alias("bucket"), "node"), "members")
    roots = linked_groups(members, verify, crowded)
    labels = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = labels.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = materialize(labels.join(least, "root").select("digest", "rows", "component_id"), "labels")
    out = _labelled(sets.select("_key", "n_shingles", "digest"), labels, sets.count())
    component = F.coalesce("component_id", "_key")
    return out.select(
        F.col("_key").alias(key),
        "n_shingles",
        component.alias("component_id"),
        component.eqNullSafe(F.col("_key")).alias("kept"),
    )


def _labelled(sets: DataFrame, labels: DataFrame, total: int) -> DataFrame:
    """Each row with its class's label. Classes of very many rows, fewer than HOT_SHARE, go to every task; others are shuffled."""
    bar = max(HOT_ROWS, total // HOT_SHARE)
    large = labels.filter(F.col("rows") > bar)
    hot = F.broadcast(large.select("digest", F.col("component_id").alias("_hot")))
    marked = sets.join(hot, "digest", "left")
    rest = marked.filter("_hot IS NULL").drop("_hot").join(labels.filter(F.col("rows") <= bar).drop("rows"), "digest", "left")
    done = marked.filter("_hot IS NOT NULL").withColumnRenamed("_hot", "component_id")
    return rest.select("_key", "n_shingles", "component_id").unionByName(done.select("_key", "n_shingles", "component_id"))


def _estimated(batches, threshold: float):
    """The pairs (a, b) whose registers leave the threshold possible."""
    for b in batches:
        if not b.num_rows:
            continue
        one, two = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint16).reshape(b.num_rows, -1) for c in ("registers_a", "registers_b"))
        near = possible(*estimate(one, two, b.column("n_a").to_numpy(), b.column("n_b").to_numpy()), threshold)
        mask = pa.array(near, pa.bool_())
        yield pa.RecordBatch.from_arrays([b.column("a").filter(mask), b.column("b").filter(mask)], ["a", "b"])


def _similar(batches, threshold: Fraction):
    """The pairs (a, b) whose full sets are similar."""
    for b in batches:
        pairs = zip(b.column("elements_a").to_pylist(), b.column("elements_b").to_pylist())
        mask = pa.array([_near(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), threshold) for x, y in pairs], pa.bool_())
        yield pa.RecordBatch.from_arrays([b.column("a").filter(mask), b.column("b").filter(mask)], ["a", "b"])


def _near(x: np.ndarray, y: np.ndarray, threshold: Fraction) -> bool:
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return threshold.denominator * shared >= threshold.numerator * (len(x) + len(y) - shared)


def _tile_links(table: pa.Table, threshold: Fraction) -> pa.Table:
    """Links between two chunks of a crowd, or within one: for each two groups that similar sets join, one."""
    node, n, own = (table.column(c).to_numpy() for c in ("node", "n", "_own"))
    _, group = np.unique(table.column("root").to_numpy(), return_inverse=True)
    regs = np.frombuffer(b"".join(table.column("registers").to_pylist()), np.uint16).reshape(len(node), -1)
    sets = [np.frombuffer(x, np.uint64) for x in table.column("elements").to_pylist()]
    lo, hi = table.column("_lo")[0].as_py(), table.column("_hi")[0].as_py()
    num, den = threshold.numerator, threshold.denominator
    links = []
    for i in range(len(node)):
        if lo != hi and own[i] != lo:
            continue
        met = np.arange(len(node)) > i if lo == hi else own == hi
        met &= (group != group[i]) & (den * np.minimum(n, n[i]) >= num * np.maximum(n, n[i]))
        after = np.flatnonzero(met)
        if not len(after):
            continue
        near, used = estimate(np.broadcast_to(regs[i], (len(after), regs.shape[1])), regs[after], np.full(len(after), n[i]), n[after])
        keep = possible(near, used, float(threshold))
        for j in after[keep][np.argsort(-near[keep], kind="stable")]:
            if group[j] != group[i] and _near(sets[i], sets[j], threshold):
                links.append((int(node[i]), int(node[j])))
                group[group == group[j]] = group[i]
    return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})
