"""How far the word use of each source departs from the other sources of its language, term by term.

Every source is a segment tree over the ids of its language's terms. Nodes are hash-consed: subtrees with the same counts are
one node, within a tree and across trees. Two trees are walked together from their roots; equal pairs of
nodes met on a level are one pair with a weight, so each is opened once and each pair of counts priced once.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, materialize

LEAVES = 4096  # terms below one segment that a task holds; a language has as many segments as it needs
CHUNK = 64  # sources, about, whose trees one task holds; each pair of chunks is a task for each segment
FRONTIER = 2_000_000  # node pairs that are walked at a time
FLUSH = 200_000  # terms counted in a task before its counts go on
RANGE_ROWS = 64 * LEAVES  # terms that one task puts in order

SCALE = 1_000_000_000
PRIOR = 2

WHOLE = -1  # the number of a language's own tree
ROW = ["id", "slot", "n", "size"]  # a leaf's count, or with a null slot a tree's total and the terms of the segment

_BLANK = bytes(range(0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80))
_FOLD = bytes.maketrans(
    _BLANK + bytes(range(0x41, 0x5B)), b" " * len(_BLANK) + bytes(range(0x61, 0x7B))
)


def terms(utf8: bytes) -> list[bytes]:
    """Runs of A-Z, a-z and characters beyond 0x7F, only A-Z lower-cased."""
    return utf8.translate(_FOLD).split()


def shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + PRIOR) / total), exact for totals up to 2**53: three digits of a long division by 1000."""
    quotient, rest = np.divmod(counts + PRIOR, totals)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, totals)
        quotient = quotient * 1000 + digit
    return quotient + 1


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


class Forest:
    """Segment trees over the same leaves, with nodes shared between equal subtrees of all of them."""

    def __init__(self, counts: np.ndarray):
        """``counts``: a row for each tree, a column for each leaf, as many as a power of two."""
        self.values, ids = np.unique(counts, return_inverse=True)
        self.leaves = ids.reshape(counts.shape)
        ids, known, self.levels = self.leaves, len(self.values), []  # (left, right) child of each node, from the leaves up
        while ids.shape[1] > 1:
            pairs, up = np.unique(ids[:, 0::2].astype(np.int64) * known + ids[:, 1::2], return_inverse=True)
            self.levels.append((pairs // known, pairs % known))
            ids, known = up.reshape(len(ids), -1), len(pairs)
        self.roots = ids[:, 0]

    def distances(self, one: np.ndarray, two: np.ndarray, totals: np.ndarray) -> np.ndarray:
        """The sum of prices over all leaves for each pair of trees (one[i], two[i]), whose shares have these totals."""
        pair, a, b = np.arange(len(one)), self.roots[one], self.roots[two]
        weight = np.ones(len(one), np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            left, right = self.levels[depth]
            known = len(self.levels[depth - 1][0]) if depth else len(self.values)
            key = np.concatenate([(pair * known + left[a]) * known + left[b], (pair * known + right[a]) * known + right[b]])
            order = np.argsort(key, kind="stable")
            key, weight = key[order], np.concatenate([weight, weight])[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            weight, key = np.add.reduceat(weight, first), key[first]
            rest, b = np.divmod(key, known)
            pair, a = np.divmod(rest, known)
        p = shares(self.values[a], totals[one[pair]])
        q = shares(self.values[b], totals[two[pair]])
        first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        return np.add.reduceat(price(p, q) * weight, first)

    def highest(self, tree: int, base: int, totals: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """(leaf, price) of the ``most`` dearest leaves that ``tree`` has counts for and larger shares in than ``base``.

        Pairs of leaf nodes are priced once; of equal prices the first leaves count.
        """
        known = len(self.values)
        pairs, back = np.unique(self.leaves[tree] * known + self.leaves[base], return_inverse=True)
        own = self.values[pairs // known]
        p, q = shares(own, totals[tree]), shares(self.values[pairs % known], totals[base])
        value = np.where((own > 0) & (p > q), price(p, q), -1)[back]
        found = np.argsort(-value, kind="stable")[:most]
        found = found[value[found] >= 0]
        return found, value[found]


def term_counts(docs: DataFrame, lang: str, source: str, text: str) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents; a row with a null term for each group, terms or none."""

    def count(batches):
        n, seen, held = {}, {}, 0

        def rows():
            flat = [(*g, t, c, seen[g][t]) for g, counter in n.items() for t, c in counter.items()]
            kinds = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
            arrays = [pa.array([r[i] for r in flat], k) for i, k in enumerate(kinds)]
            arrays[2] = arrays[2].cast(pa.string())
            return pa.RecordBatch.from_arrays(arrays, ["lang", "source", "term", "n", "docs"])

        for b in batches:
            texts = b.column("text").cast(pa.binary()).to_pylist()
            for g in zip(b.column("lang").to_pylist(), b.column("source").to_pylist(), texts):
                found, g = terms(g[2]), g[:2]
                if g not in n:
                    n[g], seen[g] = Counter({None: 0}), Counter()
                before = len(n[g])
                n[g].update(found)
                seen[g].update(set(found))
                seen[g][None] += 1
                held += len(n[g]) - before
                if held > FLUSH:
                    yield rows()
                    n, seen, held = {}, {}, 0
        yield rows()

    empty = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = docs.select(empty(lang).alias("lang"), empty(source).alias("source"), empty(text).alias("text"))
    counted = rows.mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def placed_terms(kept: DataFrame) -> DataFrame:
    """``kept`` (lang, term, total, stored) with ``block`` and ``slot``: segments of at most LEAVES terms of about one frequency.

    So rare terms, which most sources lack, share segments and nodes. Within a segment slots follow the terms' bytes.
    """
    tasks = max(1, -(-kept.count() // RANGE_ROWS))
    ranged = kept.repartitionByRange(tasks, "lang", F.desc("total"), "term")
    ranged = materialize(ranged.withColumn("_part", F.spark_partition_id()), "ranged-terms")
    place = F.row_number().over(Window.partitionBy("lang", "_part").orderBy(F.desc("total"), "term")) - 1
    # a range holds RANGE_ROWS terms or so, far fewer than 2**40
    block = F.shiftleft(F.col("_part").cast("long"), 40) + F.floor(place / LEAVES).cast("long")
    slot = F.row_number().over(Window.partitionBy("lang", "block").orderBy("term")) - 1
    return ranged.withColumn("block", block).withColumn("slot", slot.cast("int")).drop("_part")


def divergence_audit(
    docs: DataFrame,
    lang: str = "lang",
    source: str = "source",
    text: str = "text",
    least_docs: int = 10,
    most: int = 10,
) -> DataFrame:
    """(lang, source, part, item, value, rank): the distance to each other source, and the terms that a source overuses most.

    A language keeps the terms that at least ``least_docs`` of its documents hold. A source's share of a term is
    1 + floor(10^9 (count + 2) / (N + 2 V)) with N occurrences of the V kept terms in it; the price of shares p and q is
    floor((p - q)^2 / (p + q)). Part ``pair``: for every other source of the language the sum of prices over all kept terms, all ranks. Part
    ``term``: the price against the whole language, for terms that occur in the source and have a larger share there, ranks up to ``most``.
    Ties go to the smaller item in bytes.

    Null texts, languages and sources count as empty strings, which are groups like others. A source without a kept term has no
    ``term`` rows but all its pairs; in a language without kept terms all pairs have value 0; the only source of a
    language has no pairs. Repeated rows count each; very long texts are counted whole, and a task's counters are passed on when they
    hold FLUSH terms; an empty table gives no rows. Other columns are not read. A task holds one segment of LEAVES terms for two chunks
    of sources.
    """
    bounded_batches(docs.sparkSession)
    counts = materialize(term_counts(docs, lang, source, text), "term-counts")
    found = counts.filter("term IS NOT NULL")
    kept = found.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
    kept = materialize(kept.filter(F.col("docs") >= least_docs).drop("docs"), "kept-terms")
    placed = materialize(placed_terms(kept), "placed-terms")

    langs = placed.groupBy("lang").agg(F.count("term").alias("v"), F.sum("total").alias("lang_n"))
    names = counts.filter("term IS NULL").select("lang", "source")
    chunks = names.groupBy("lang").agg(F.ceil(F.count("source") / CHUNK).alias("chunks"))
    used = found.drop("docs").join(placed.drop("total"), ["lang", "term"]).drop("term")
    used = materialize(used, "used-terms")
    sums = used.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = names.join(sums, ["lang", "source"], "left").join(chunks, "lang").join(langs, "lang", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    groups = groups.select(
        "lang",
        "source",
        "chunks",
        F.pmod(F.xxhash64("source"), "chunks").alias("chunk"),
        (zero("n") + PRIOR * zero("v")).alias("total"),
        (zero("lang_n") + PRIOR * zero("v")).alias("lang_total"),
    )
    groups = materialize(groups, "numbered-groups").withColumn("id", F.monotonically_increasing_id())
    groups = materialize(groups, "groups")

    # a language without kept terms has one segment without leaves, so that its pairs come out too
    sizes = placed.groupBy("lang", "block").agg(F.count("term").alias("size"))
    segments = groups.select("lang").distinct().join(sizes, "lang", "left")
    segments = materialize(segments.select("lang", F.coalesce("block", F.lit(-1).cast("long")).alias("block"), zero("size").alias("size")), "segments")
    shape = segments.groupBy("lang").count().join(chunks, "lang")
    tiles = shape.agg(F.sum(F.col("count") * F.col("chunks") * (F.col("chunks") + 1) / 2)).first()[0]
    if not tiles:
        return docs.sparkSession.createDataFrame([], "lang string, source string, part string, item string, value long, rank int")

    def tiled(rows: DataFrame) -> DataFrame:
        """Rows of a chunk once for each chunk that it meets."""
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("_other")
        rows = rows.select("lang", "block", "chunk", other, *ROW)
        return rows.select("lang", "block", F.least("chunk", "_other").alias("lo"), F.greatest("chunk", "_other").alias("hi"), "chunk", *ROW)

    no_leaf, no_size = F.lit(None).cast("int").alias("slot"), F.lit(None).cast("long").alias("size")
    heads = groups.join(segments, "lang").select("lang", "block", "chunk", "chunks", "id", no_leaf, F.col("total").alias("n"), "size")
    ids = groups.select("lang", "source", "id", "chunk", "chunks")
    leaves = used.join(ids, ["lang", "source"]).select("lang", "block", "chunk", "chunks", "id", "slot", "n", no_size)
    # the language's own tree, to which the sources of a chunk are held, goes to the tile of each chunk with itself
    home = groups.select("lang", "chunk", "lang_total").distinct()
    own = ["lang", "block", F.col("chunk").alias("lo"), F.col("chunk").alias("hi"), "chunk", F.lit(WHOLE).alias("id")]
    whole_heads = home.join(segments, "lang").select(*own, no_leaf, F.col("lang_total").alias("n"), "size")
    whole = home.join(placed, "lang").select(*own, "slot", F.col("total").alias("n"), no_size)
    rows = tiled(heads).unionByName(tiled(leaves)).unionByName(whole_heads).unionByName(whole)

    def walk(table: pa.Table) -> pa.Table:
        return _walk(table, most)

    keys = ["lang", "block", "lo", "hi"]
    priced = rows.repartition(-(-int(tiles) // 2), *keys).groupBy(*keys).applyInArrow(
        walk, "lang string, block long, a long, b long, slot int, value long"
    )
    priced = materialize(priced, "prices")

    label = groups.select(F.col("id").alias("a"), "source")
    partner = groups.select(F.col("id").alias("b"), F.col("source").alias("item"))
    pairs = priced.filter("slot IS NULL").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    pairs = pairs.unionByName(pairs.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    pairs = pairs.join(label, "a").join(partner, "b").select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    words = priced.filter("slot IS NOT NULL").join(placed, ["lang", "block", "slot"]).join(label, "a")
    words = words.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    top = words.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(top)


def _walk(table: pa.Table, most: int) -> pa.Table:
    """Prices of one segment: a row (a, b) for each pair of sources of two chunks, and the dearest leaves of each source."""
    lang, block = table.column("lang")[0].as_py(), table.column("block")[0].as_py()
    is_head = pc.is_null(table.column("slot"))
    heads, leaves = table.filter(is_head), table.filter(pc.invert(is_head))
    order = np.argsort(heads.column("id").to_numpy())
    trees, totals, chunk = (heads.column(c).to_numpy()[order] for c in ("id", "n", "chunk"))
    size = heads.column("size")[0].as_py()  # terms of the segment
    inside = table.column("lo")[0].as_py() == table.column("hi")[0].as_py()
    one, two = np.triu_indices(len(trees), 1)
    real = trees[one] != WHOLE if inside else chunk[one] != chunk[two]
    one, two = one[real], two[real]
    value, found = np.zeros(len(one), np.int64), []
    if size:
        width = 1 << (size - 1).bit_length()
        counts = np.zeros((len(trees), width), np.int64)
        counts[np.searchsorted(trees, leaves.column("id").to_numpy()), leaves.column("slot").to_numpy()] = leaves.column("n").to_numpy()
        forest = Forest(counts)
        step = max(1, FRONTIER // width)
        for s in range(0, len(one), step):
            value[s : s + step] = forest.distances(one[s : s + step], two[s : s + step], totals)
        nothing = np.zeros(1, np.int64)  # leaves beyond the last term were priced as terms that nobody uses
        value -= (width - size) * price(shares(nothing, totals[one]), shares(nothing, totals[two]))
        if inside:
            base = int(np.searchsorted(trees, WHOLE))
            for tree in np.flatnonzero(trees != WHOLE):
                leaf, cost = forest.highest(tree, base, totals, most)
                found += [(int(trees[tree]), int(i), int(v)) for i, v in zip(leaf, cost)]
    pairs, rows = len(one), len(one) + len(found)
    return pa.table(
        {
            "lang": pa.array([lang] * rows, pa.string()),
            "block": pa.array([block] * rows, pa.int64()),
            "a": pa.array(trees[one].tolist() + [f[0] for f in found], pa.int64()),
            "b": pa.array(trees[two].tolist() + [None] * len(found), pa.int64()),
            "slot": pa.array([None] * pairs + [f[1] for f in found], pa.int32()),
            "value": pa.array(value.tolist() + [f[2] for f in found], pa.int64()),
        }
    )
