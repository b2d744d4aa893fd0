"""The queries of this subpackage by name, each over whole tables, and SQL where it can express them."""

from __future__ import annotations

from fractions import Fraction

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, divergence, hyperminhash, infill, jaccard, lines, ngram_trie, packing, quality, sql, token_counts, token_files, urls, warc
from tidemark.llm.common import scratch_path

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
BYTE_BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")  # the same vocabulary

QUERIES: dict = {}
SQL: dict[str, str] = {
    "op2_ngram_jaccard_join": sql.OP2,
    "op3_warc": sql.OP3,
    "op7_quality_rules": sql.OP7,
    "op11_source_divergence": sql.OP11,
    "op12_fill_in_middle": sql.OP12,
    "op13_minhash_near_dedup": sql.OP13,
}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    pieces = packing.token_pieces(
        table(spark, folder, "documents"), BYTE_BPE, length=2048, end_id=0, ranks=BYTE_BPE_RANKS
    )
    packed = packing.pack(pieces, "length", 2048)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op2_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents with a Jaccard similarity of 0.9 or more on three-word shingles."""
    docs = table(spark, folder, "documents")
    return jaccard.near_duplicates(docs, size=3, threshold=Fraction(9, 10))


@query
def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of all documents, through a cache that starts empty."""
    docs = table(spark, folder, "documents").select(
        "doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    )
    counted = token_counts.count_tokens(
        docs,
        public_tokenizers.path("word_bpe_49k.json"),
        scratch_path(spark, "token-counts"),
        blanks_matter=False,
    )
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


@query
def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """All documents' ids written to token files in ascending doc_id order, and read back."""
    to = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, folder, "documents"), to, BYTE_BPE, end_id=2, ranks=BYTE_BPE_RANKS)
    return token_files.read_token_files(spark, to)


@query
def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of every document and whether line-first cleaning keeps it."""
    judged = quality.clean(table(spark, folder, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op10_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Log-probabilities of all documents under a word-triple model of those that are not held out."""
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2, F.lit(False))
    docs = table(spark, folder, "documents").select("doc_id", "text", held_out.alias("held_out"))
    model = scratch_path(spark, "ngram-model")
    ngram_trie.train(docs.filter(~F.col("held_out")), model, order=3)
    return ngram_trie.score(docs, model).drop("text")


@query
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of all documents when only the first of similar lines stays."""
    left = lines.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return left.select(
        "doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_md5")
    )


@query
def op9_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items in all documents."""
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages as WARC records, read back through the capture index by all of their URLs."""
    pages, to = table(spark, folder, "pages"), scratch_path(spark, "warc")
    warc.write_archives(pages, to)
    key = pages.schema["page_id"].dataType
    return warc.lookup(spark, to, pages).select(
        F.col("page").cast(key).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(key).alias("refers_to"),
    )


URL_RULES = [
    urls.Rule("allow", "com/"),
    urls.Rule("block", "example.com/en/"),
    urls.Rule("allow", "www.example.com/en/"),
    urls.Rule("block", "net/es/"),
    urls.Rule("block", "net/fr/"),
]


@query
def op8_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """A verdict on every page's URL.

    A page's URL ends in the number of the document it shows; it is labelled block where that document's quality is 0.
    """
    pages = table(spark, folder, "pages").select("page_id", "url")
    shown = F.regexp_extract(urls.path_of(F.col("url")), r"/(\d{1,18})(?:\.\w+)?/?$", 1)
    labels = table(spark, folder, "labels").select("doc_id", (F.col("quality") == 0).cast("int").alias("blocked"))
    labelled = pages.withColumn("doc_id", F.when(shown != "", shown.cast("long"))).join(labels, "doc_id")
    model = urls.fit(labelled.select("url", "blocked"))
    return urls.judge(pages, model, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query
def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """All documents rearranged for infilling at line ends, and put back together."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out = infill.restore(infill.fill_in_middle(docs).drop("text"))
    return out.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


@query
def op13_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents with a Jaccard similarity of 0.85 or more on five-word shingles; the smallest id of each is kept."""
    return hyperminhash.near_duplicates(table(spark, folder, "documents"), size=5, threshold=Fraction(85, 100))


@query
def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """Distances between the sources of a language, and the terms each source uses more than its language."""
    return divergence.divergence_audit(table(spark, folder, "documents"), least_docs=10, most=10)
