"""Benchmark decontamination with DataFrame functions alone.

Windows as long as benchmark items are fingerprinted by SimHash over word shingles, joined with the items'
fingerprints through Hamming blocks, and verified by exact weighted shingle similarity. A window that shares no
shingle with an item of its length has similarity 0 to it, so only windows on such shingles are cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lean_disk, materialize
from tidemark.llm.fingerprints import block_keys, from_lanes, hamming, lane_sums

SHINGLE = 5
SIMILARITY = 80  # percent
RADIUS = 16  # bits: at the similarity, about 10 differ, and more than 16 in one pair of a hundred
BLOCKS = RADIUS + 1
BROADCAST_SHINGLES = 1_000_000  # most benchmark shingles that go to every task; more are joined by a shuffle


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def shingles_of(words: Column, size: int = SHINGLE) -> Column:
    """A hash for each run of ``size`` words; a shorter text is one run."""
    runs = F.sequence(F.lit(1), F.greatest(F.size(words) - size + 1, F.lit(1)))
    hashes = F.transform(runs, lambda i: F.xxhash64(F.slice(words, i, size)))
    return F.when(F.size(words) > 0, hashes).otherwise(F.array().cast("array<long>"))


def _items(benchmark: DataFrame, key: str, text: str) -> DataFrame:
    """(item_id, n_words, shingles) of the items that have a shingle."""
    words = benchmark.select(F.col(key).alias("item_id"), words_of(F.col(text)).alias("_words"))
    words = words.filter(F.size("_words") > 0)
    return words.select("item_id", F.size("_words").alias("n_words"), shingles_of(F.col("_words")).alias("shingles"))


def _windows(docs: DataFrame, anchors: DataFrame, few: bool, short: list[int], key: str, text: str) -> DataFrame:
    """(window, doc_id, start, n_words, shingles): the item-sized windows that share an aligned shingle with an item."""
    words = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(key).alias("doc_id"), words_of(F.col(text)).alias("_words")
    )
    rows = words.filter(F.size("_words") >= SHINGLE).select("_row", "doc_id", shingles_of(F.col("_words")).alias("_all"))
    at = F.posexplode("_all").alias("_pos", "hash")
    wide = anchors.filter(F.col("n_words") >= SHINGLE)
    if few:
        hits = rows.select("*", at).join(F.broadcast(wide), "hash")
    else:  # the hits are few beside the text, so the shingles of their rows are fetched afterwards
        hits = materialize(rows.select("_row", at).join(wide, "hash").select("_row", "_pos", "offset", "n_words").distinct(), "hits")
        hits = rows.join(hits, "_row")
    last = F.greatest(F.size("_all") - (F.col("n_words") - SHINGLE + 1), F.lit(0))
    start = F.least(F.greatest(F.col("_pos") - F.col("offset"), F.lit(0)), last)
    cut = hits.select("_row", "doc_id", start.alias("start"), "n_words", "_all").select(
        "_row", "doc_id", "start", "n_words", F.slice("_all", F.col("start") + 1, F.col("n_words") - SHINGLE + 1).alias("shingles")
    )
    found = cut.dropDuplicates(["_row", "start", "n_words"])
    for n in short:  # items of fewer words than a shingle: runs of their own length
        run = words.filter(F.size("_words") >= n).select(
            "_row", "doc_id", F.posexplode(shingles_of(F.col("_words"), n)).alias("start", "hash"), F.lit(n).alias("n_words")
        )
        own = anchors.filter(F.col("n_words") == n).select("hash")
        run = run.join(F.broadcast(own) if few else own, "hash")
        found = found.unionByName(run.select("_row", "doc_id", "start", "n_words", F.array("hash").alias("shingles")))
    found = found.drop("_row")
    return materialize(found.withColumn("window", F.monotonically_increasing_id()), "windows")


def _fingerprints(df: DataFrame, key: str) -> DataFrame:
    """(key, n_words, fingerprint): SimHash over shingles, each occurrence one vote."""
    hashed = df.select(key, "n_words", F.explode("shingles").alias("_h"))
    sums = hashed.groupBy(key, "n_words").agg(F.count("_h").alias("_n"), *lane_sums(F.col("_h")))
    return sums.select(key, "n_words", from_lanes(F.col("_n")).alias("fingerprint"))


def weighted_similarity(a: Column, b: Column) -> Column:
    """Sum of the smaller over sum of the larger weights, a shingle's weight being its number of occurrences."""
    times = lambda bag, s: F.size(F.filter(bag, lambda x: x == s))
    both = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda sum_, s: sum_ + F.least(times(a, s), times(b, s)))
    return both / (F.size(a) + F.size(b) - both)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    similarity: int = SIMILARITY,
) -> DataFrame:
    """(doc_id, item_id, start, n_words, similarity): benchmark items found in documents, at their best window.

    Words are lower-cased runs of letters and digits, ``start`` counts them from 0, and windows have an item's number of
    words (or are the whole of a shorter document). An item matches where the weighted similarity of the
    five-word shingles is at least ``similarity`` percent; ties go to the first window. An item of one to four words is one run and
    matches where a document has it word for word, by chance as well. Very long texts are searched whole. Null and empty texts match nothing; empty tables give no rows; rows that repeat a key
    are reported as one. Neither table's other columns matter. ``docs`` is read once, or twice for a very large benchmark, and once more for each length of items under five words.
    """
    lean_disk(docs.sparkSession)
    items = materialize(_items(benchmark, item_key, item_text), "items")
    anchors = items.select("n_words", F.posexplode("shingles").alias("offset", "hash")).distinct()
    anchors = materialize(anchors, "anchors")
    few = anchors.count() <= BROADCAST_SHINGLES
    short = [r.n_words for r in items.filter(F.col("n_words") < SHINGLE).select("n_words").distinct().collect()]
    windows = _windows(docs, anchors, few, sorted(short), key, text)

    prints = materialize(_fingerprints(windows, "window"), "window-prints")
    own = materialize(_fingerprints(items, "item_id"), "item-prints")
    keyed = lambda df, id_: df.select(
        id_, "n_words", F.col("fingerprint").alias(f"_{id_}"), F.explode(block_keys(F.col("fingerprint"), BLOCKS, RADIUS, F.col("n_words"))).alias("_key")
    )
    candidates = (
        keyed(prints, "window")
        .join(keyed(own, "item_id").drop("n_words"), "_key")
        .filter(hamming(F.col("_window"), F.col("_item_id")) <= RADIUS)
        .select("window", "item_id")
        .distinct()
    )
    pairs = materialize(candidates, "candidates").join(windows, "window").join(
        items.select("item_id", F.col("shingles").alias("_item")), "item_id"
    )
    scored = pairs.withColumn("similarity", weighted_similarity(F.col("shingles"), F.col("_item")))
    matched = scored.filter(100 * F.col("similarity") >= similarity)
    best = F.struct((-F.col("similarity")).alias("_s"), "start", "n_words", "similarity")
    return (
        matched.groupBy("doc_id", "item_id")
        .agg(F.min(best).alias("_best"))
        .select("doc_id", "item_id", "_best.start", "_best.n_words", "_best.similarity")
    )
