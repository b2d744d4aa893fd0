"""Token ids in binary files: one zstandard dictionary, a frame for each document, an index of offsets.

A folder holds ``shard-*.tok`` files and two parquet tables, ``shards`` and ``dictionary``. A shard file is

    magic (8 bytes) | SHA-256 of the dictionary (32) | frames | index | number of documents (8) | index offset (8)

with little-endian numbers. Each frame is one document's ids, serialised as unsigned 32-bit integers and compressed
alone with the shared dictionary, so that a short document is read without its neighbours. The
index has one entry for each document: frame offset (8), frame length (8), number of ids (8).
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, open_store, unique_name
from tidemark.llm.tokens import encoder

MAGIC = b"TOKIDS\x00\x01"
HEADER = len(MAGIC) + 32
DICTIONARY_BYTES = 64 * 2**10
SAMPLE_ROWS = 2_000  # documents the dictionary is trained on
SAMPLE_IDS = 2_000  # ids of each of them that serve for it
LEVEL = 3


def _ids(docs: list[str], tokenizer: str, ranks: str | None, end: bytes) -> list[bytes]:
    return [ids + end for ids in encoder(tokenizer, ranks).encode(docs)]


def train_dictionary(docs: DataFrame, tokenizer: str, ranks: str | None, end_id: int, key: str, text: str) -> bytes:
    """A dictionary from a bounded sample of serialised documents: the SAMPLE_ROWS keys of least hash.

    The sample sets how small frames get, not what they hold. With too little to learn from it is empty.
    """
    end = np.asarray([end_id], "<u4").tobytes()
    rank = F.xxhash64(F.lit("dictionary"), F.col(key))
    least = docs.select(rank.alias("_rank")).orderBy("_rank").limit(SAMPLE_ROWS)
    bar = least.agg(F.max("_rank")).first()[0]
    if bar is None:
        return b""

    def train(batches):
        samples = []
        for b in batches:
            samples += [s[: 4 * SAMPLE_IDS] for s in _ids(b.column("_text").to_pylist(), tokenizer, ranks, end)]
        try:
            trained = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
        except zstandard.ZstdError:  # too few or too short samples
            trained = b""
        yield pa.RecordBatch.from_pydict({"dictionary": pa.array([trained], pa.binary())})

    sample = docs.filter(rank <= bar).select(rank.alias("_rank"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    # a key that many rows repeat has one hash: the limit keeps the sample bounded
    sample = sample.orderBy("_rank", "_text").limit(SAMPLE_ROWS).select("_text")
    return bytes(sample.coalesce(1).mapInArrow(train, "dictionary binary").first()[0])


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
    ranks: str | None = None,
) -> None:
    """Write the ids of every text, then ``end_id``, to shard files in ascending key order.

    Keys are numbers or strings. A null text is empty and has the end id alone. Null keys come first; rows with
    equal keys follow each other by text. An empty table gives no shards. Files are named by
    attempt, and only those in the committed table ``shards`` count, so lost and repeated tasks do no harm.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    trained = train_dictionary(docs, tokenizer, ranks, end_id, key, text)
    digest = hashlib.sha256(trained).digest()
    end = np.asarray([end_id], "<u4").tobytes()
    spark.createDataFrame([(digest, trained)], "digest binary, dictionary binary").coalesce(1).write.parquet(
        f"{folder}/dictionary"
    )
    kind = docs.schema[key].dataType.simpleString()

    def write(batches):
        store, path = open_store(folder)
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(trained) if trained else None)
        name, number = unique_name("shard", ".tok"), TaskContext.get().partitionId()
        index, keys, at, out, tokens = [], [], HEADER, None, 0
        for b in batches:
            if not b.num_rows:
                continue
            if out is None:
                store.create_dir(path, recursive=True)
                out = store.open_output_stream(f"{path}/{name}")
                out.write(MAGIC + digest)
            for ids in _ids(b.column("_text").to_pylist(), tokenizer, ranks, end):
                frame = compressor.compress(ids)
                out.write(frame)
                index.append((at, len(frame), len(ids) // 4))
                at, tokens = at + len(frame), tokens + len(ids) // 4
            keys.append(b.column("_key"))
        if out is not None:
            out.write(np.asarray(index, "<u8").tobytes() + struct.pack("<QQ", len(index), at))
            out.close()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int32()),
                    pa.array([name]),
                    pa.array([len(index)], pa.int64()),
                    pa.array([tokens], pa.int64()),
                    pa.array([pa.concat_arrays(keys).to_pylist()], pa.list_(keys[0].type)),
                ],
                ["shard", "file", "n_docs", "n_tokens", "keys"],
            )

    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    ordered = rows.repartitionByRange("_key").sortWithinPartitions("_key", "_text")
    ordered.mapInArrow(write, f"shard int, file string, n_docs long, n_tokens long, keys array<{kind}>").write.parquet(
        f"{folder}/shards"
    )


def load_dictionary(spark: SparkSession, folder: str) -> tuple[bytes, bytes]:
    """(digest, dictionary); at most DICTIONARY_BYTES."""
    row = spark.read.parquet(f"{folder}/dictionary").first()
    return bytes(row.digest), bytes(row.dictionary)


class ShardReader:
    """One shard file; ``ids(i)`` reads the i-th document's frame alone."""

    def __init__(self, store, path: str, digest: bytes, dictionary: bytes):
        self._file = store.open_input_file(path)
        head = self._file.read_at(HEADER, 0)
        if head[: len(MAGIC)] != MAGIC or head[len(MAGIC) :] != digest:
            raise ValueError(f"{path} was written with another dictionary or format")
        size = self._file.size()
        n, at = struct.unpack("<QQ", self._file.read_at(16, size - 16))
        self.index = np.frombuffer(self._file.read_at(24 * n, at), "<u8").reshape(n, 3)
        self._decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)

    def ids(self, i: int) -> np.ndarray:
        at, length, n = map(int, self.index[i])
        return np.frombuffer(self._decompressor.decompress(self._file.read_at(length, at), max_output_size=4 * n), "<u4")

    def all(self):
        for i in range(len(self.index)):
            yield self.ids(i)

    def close(self):
        self._file.close()


def read_token_files(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document in the files, from its decompressed ids.

    ``start`` is the number of ids of all documents before it; running totals are over one row a shard.
    """
    bounded_batches(spark)
    digest, dictionary = load_dictionary(spark, folder)
    shards = spark.read.parquet(f"{folder}/shards")
    kind = shards.schema["keys"].dataType.elementType.simpleString()
    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    totals = shards.select("shard", "n_tokens").select("shard", F.coalesce(before, F.lit(0)).alias("_before"))

    def read(batches):
        store, path = open_store(folder)
        for b in batches:
            for shard, name, keys in zip(b.column("shard").to_pylist(), b.column("file").to_pylist(), b.column("keys")):
                reader, at = ShardReader(store, f"{path}/{name}", digest, dictionary), 0
                starts, lengths, crcs = [], [], []
                for ids in reader.all():
                    starts.append(at)
                    lengths.append(len(ids))
                    crcs.append(zlib.crc32(ids.tobytes()))
                    at += len(ids)
                reader.close()
                numbers = [pa.array(v, pa.int64()) for v in (starts, lengths, crcs)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * len(crcs), pa.int32()), keys.values, *numbers],
                    ["shard", "_key", "_start", "n_tokens", "ids_crc32"],
                )

    # by a number of tasks of its own: what a shard's row weighs says nothing about its file
    tasks = max(1, shards.count())
    rows = shards.select("shard", "file", "keys").repartition(tasks, "shard").mapInArrow(
        read, f"shard int, _key {kind}, _start long, n_tokens long, ids_crc32 long"
    )
    rows = rows.join(totals, "shard")
    return rows.select(
        F.col("_key").alias(key), (F.col("_start") + F.col("_before")).alias("start"), "n_tokens", "ids_crc32"
    )
