"""Token counts through a cache of digests: only texts that no earlier run has counted are encoded."""

from __future__ import annotations

import hashlib
from importlib.metadata import version

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches
from tidemark.llm.tokens import counter
from tidemark.runtime import Files

CACHE_SCHEMA = "digest string, tokenizer string, n_tokens long"


def tokenizer_version(path: str) -> str:
    """Digest of the vocabulary file and the library's version: counts are valid for both together."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + version("tokenizers").encode()).hexdigest()


def content(text: Column, blanks_matter: bool) -> Column:
    """The text up to differences that can't change its count; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    return text if blanks_matter else F.regexp_replace(text, r"[\x09-\x0D ]+", " ")


def count_tokens(
    docs: DataFrame, tokenizer: str, cache: str, text: str = "text", blanks_matter: bool = True
) -> DataFrame:
    """``docs`` with ``n_tokens`` (long), the number of ids the library gives for the whole text.

    ``cache`` is a parquet folder of (digest of the normalised content, digest of the tokenizer, count). Contents it
    lacks are encoded once each, however many rows hold them, and appended. ``blanks_matter`` says whether the vocabulary
    keeps white space; if not, contents that differ only in runs of it share an entry. A null text is
    empty and counts 0. Repeated rows each get their count; an empty table gives no rows and
    leaves the cache as it is. Other columns pass through, except one named ``n_tokens``, which is replaced.
    """
    spark, tag = docs.sparkSession, tokenizer_version(tokenizer)
    bounded_batches(spark)
    digest = F.sha2(content(F.col(text), blanks_matter), 256)

    def known() -> DataFrame:
        rows = (
            spark.read.schema(CACHE_SCHEMA).parquet(cache)
            if Files(spark).has_data(cache)
            else spark.createDataFrame([], CACHE_SCHEMA)
        )
        # a run that failed after its append may have been repeated: one row for each digest
        return rows.filter(F.col("tokenizer") == tag).groupBy("digest").agg(F.max("n_tokens").alias("_n"))

    def encode(batches):
        words = counter(tokenizer, blanks_matter)
        for b in batches:
            counts = words.encode(b.column("_text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    wanted = docs.select(digest.alias("digest"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    misses = wanted.join(known(), "digest", "left_anti").dropDuplicates(["digest"])
    misses.mapInArrow(encode, "digest string, n_tokens long").select(
        "digest", F.lit(tag).alias("tokenizer"), "n_tokens"
    ).write.mode("append").parquet(cache)

    rows = docs.drop("n_tokens").withColumn("_digest", digest)
    counted = known().select(F.col("digest").alias("_digest"), F.col("_n").alias("n_tokens"))
    return rows.join(counted, "_digest", "left").drop("_digest")
