"""A smoothed n-gram model in compact, memory-mapped tries, built and queried by Spark jobs.

A model folder holds ``words-*`` and ``level<k>-*`` files and one small parquet table, ``files``, that names those which
count. The words are sorted by hash and cut into files by its first bits; a word's id is its place among
all. Level k holds the k-grams of the training texts, cut into shards by their context (k - 1
words); in each shard

* ``contexts`` are the sorted contexts, with a quantised back-off weight each,
* ``pointers`` rise and say where each context's followers begin,
* ``followers`` are the ids of next words, as (place of the context) * V + id, which rise through the shard,
* ``codes`` are their quantised log10 probabilities,

the first three as Elias-Fano sequences. A query finds its context, then the successor of the next word's
id among that context's followers.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import elias_fano
from tidemark.llm.common import bounded_batches, open_store, rows_of_bytes, unique_name
from tidemark.llm.elias_fano import EliasFano
from tidemark.llm.sets import mix, word_hashes, words

U = np.uint64
END = xxhash.xxh3_64_intdigest(b"")  # closes every text and stands before its first word; no word is empty
CHUNK_TOKENS = 4_000_000  # what a task counts at a time
SHARD_BYTES = 16 * 2**20  # text for each shard
PRIOR = 4.0  # weight of the lower order's probability, in occurrences of the context
STEP = 1 / 16  # width of a quantised log10 probability
MOST_WORDS = (1 << 32) - 1  # distinct words whose ids fit the halves of a packed n-gram
_32 = U(32)


def _tokens(text: bytes) -> np.ndarray:
    found = words(text.lower())
    out = np.empty(len(found) + 1, U)
    out[:-1], out[-1] = word_hashes(found), END
    return out


def _chunks(batches, column: str = "_text"):
    """Lists of token arrays, about CHUNK_TOKENS tokens each."""
    held, size = [], 0
    for b in batches:
        for text in rows_of_bytes(b.column(column)):
            held.append(_tokens(text))
            size += len(held[-1])
            if size >= CHUNK_TOKENS:
                yield held
                held, size = [], 0
    if held:
        yield held


def _order(keys: np.ndarray, below: int = 1 << 64) -> np.ndarray:
    """What puts numbers under ``below`` in order: numbers packed with their places are sorted, which is far faster than an argsort."""
    bits = U(max(1, (len(keys) - 1).bit_length()))
    if below <= 1 << (64 - int(bits)):
        packed = keys << bits
    else:  # the lowest bits give way; equal highest bits of different hashes are rare
        packed = (keys >> bits) << bits
    packed = packed | np.arange(len(keys), dtype=U)
    packed.sort()
    order = (packed & ((U(1) << bits) - U(1))).astype(np.int64)
    if below > 1 << (64 - int(bits)):
        found = keys[order]
        if (found[1:] < found[:-1]).any():
            return np.argsort(keys, kind="stable")
    return order


def _distinct(keys: np.ndarray, below: int = 1 << 64) -> tuple[np.ndarray, np.ndarray]:
    """(different keys in order, place of each key among them)."""
    order = _order(keys, below)
    found = keys[order]
    opens = np.diff(found, prepend=~found[:1]) != 0
    back = np.empty(len(keys), np.int64)
    back[order] = np.cumsum(opens) - 1
    return found[opens], back


def _squeeze(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys as differences, and counts, byte by byte, compressed."""
    if not len(keys):
        return b""
    steps = np.diff(keys, prepend=U(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T
    times = counts.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.concatenate([steps, times]).tobytes())


def _spread(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    if not blob:
        return np.empty(0, U), np.empty(0, np.int64)
    rows = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(12, -1)
    keys = np.cumsum(np.ascontiguousarray(rows[:8].T).view("<u8").ravel(), dtype=U)
    return keys, np.ascontiguousarray(rows[8:].T).view("<u4").ravel().astype(np.int64)


def _merged(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    parts = [_spread(b) for b in blobs]
    keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.diff(keys, prepend=keys[:1] ^ U(1)) != 0)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _save(folder: str, stem: str, arrays: dict[str, np.ndarray]) -> str:
    store, path = open_store(folder)
    store.create_dir(path, recursive=True)
    name, at, table = unique_name(stem, ".bin"), 0, {}
    for key, a in arrays.items():
        table[key] = [a.dtype.str, at, len(a)]
        at += -(-a.nbytes // 8) * 8
    head = json.dumps(table).encode()
    head += b" " * (-len(head) % 8)
    with store.open_output_stream(f"{path}/{name}") as out:
        out.write(len(head).to_bytes(8, "little") + head)
        for a in arrays.values():
            out.write(a.tobytes() + b"\0" * (-a.nbytes % 8))
    return name


_OPEN: dict[str, dict[str, np.ndarray]] = {}


def _load(folder: str, name: str) -> dict[str, np.ndarray]:
    """The arrays of a file: mapped where the store is mounted, else read once for each worker."""
    key = f"{folder}/{name}"
    if key not in _OPEN:
        store, path = open_store(folder)
        if isinstance(store, fs.LocalFileSystem):
            raw = pa.memory_map(f"{path}/{name}").read_buffer()
        else:
            raw = store.open_input_file(f"{path}/{name}").read_buffer()
        size = int.from_bytes(raw[:8].to_pybytes(), "little")
        table = json.loads(raw[8 : 8 + size].to_pybytes())
        _OPEN[key] = {
            k: np.frombuffer(raw, np.dtype(kind), count=n, offset=8 + size + at) for k, (kind, at, n) in table.items()
        }
    return _OPEN[key]


def _sequence(arrays: dict[str, np.ndarray], name: str) -> EliasFano:
    return EliasFano({k: arrays[f"{name}.{k}"] for k in ("size", "low", "high", "zeros")})


def _named(name: str, values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    return {f"{name}.{k}": a for k, a in elias_fano.build(values, universe).items()}


def _codes(log10: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-log10 / STEP), 0, 255).astype(np.uint8)


class Model:
    """What a task needs to look words and n-grams up. Files are opened when first used."""

    def __init__(self, folder: str, bits: int, word_files: list, levels: dict, shards: int, prior: float):
        self.folder, self.bits, self.shards, self.prior = folder, bits, shards, prior
        self.word_files = word_files  # (bucket, file, words, tokens), at most one for each bucket
        self.levels = levels  # k -> {shard: file}
        self.size = sum(n for _, _, n, _ in word_files)
        self.tokens = sum(t for _, _, _, t in word_files)

    # --- words ---

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id, count) of each word; unknown words have the id ``size`` and count 0."""
        ids, counts = np.full(len(hashes), self.size, np.int64), np.zeros(len(hashes), np.int64)
        bucket = hashes >> U(64 - self.bits) if self.bits else np.zeros(len(hashes), U)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange((1 << self.bits) + 1, dtype=U))
        base = 0
        for b, name, n, _ in self.word_files:
            own = order[edges[b] : edges[b + 1]]
            if len(own):
                arrays = _load(self.folder, name)
                place = _sequence(arrays, "hashes").find(hashes[own] - (U(b) << U(64 - self.bits) if self.bits else U(0)))
                ids[own] = np.where(place >= 0, base + place, self.size)
                counts[own] = np.where(place >= 0, arrays["counts"][np.maximum(place, 0)], 0)
            base += n
        return ids, counts

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        """log10 of the add-one probability; one share is for all unknown words."""
        return np.log10((counts + 1) / (self.tokens + self.size + 1))

    def tokens_of(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(id, count, whether it opens a text) of all tokens, in order."""
        hashes = np.concatenate(texts)
        distinct, back = _distinct(hashes)
        ids, counts = self.lookup(distinct)
        opens = np.zeros(len(hashes), bool)
        opens[np.cumsum([0, *map(len, texts[:-1])])] = True
        return ids[back], counts[back], opens

    # --- n-grams ---

    def contexts(self, ids: np.ndarray, opens: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
        """(packed ids of the order - 1 tokens before each token, whether all lie in its text and are known).

        The text's end stands before its first word; longer contexts do not reach beyond that.
        """
        before = np.empty_like(ids)
        before[1:] = ids[:-1]
        before[opens] = self.end_id()
        if order == 2:
            return before.astype(U), before < self.size
        two = np.empty_like(ids)
        two[1:] = before[:-1]
        two[opens] = self.size
        return (two.astype(U) << _32) | before.astype(U), (two < self.size) & (before < self.size)

    def end_id(self) -> int:
        if not hasattr(self, "_end"):
            self._end = int(self.lookup(np.array([END], U))[0][0])
        return self._end

    def shard(self, context: np.ndarray, ids: np.ndarray, heavy: dict, order: int) -> np.ndarray:
        """Where an n-gram lies: by its context, for heavy contexts by the next word as well."""
        keys = heavy[order][0]
        if len(keys):
            own = np.flatnonzero(keys[np.minimum(np.searchsorted(keys, context), len(keys) - 1)] == context)
            place = context[own] << _32 if order == 2 else mix(context[own])
            context = context.copy()
            context[own] = place ^ ids[own].astype(U)
        return mix(context) % U(self.shards)

    def dense(self, context: np.ndarray) -> np.ndarray:
        """Packed pairs of ids, and ids alone, as numbers below ``(size + 1) ** 2`` in the same order."""
        return (context >> _32) * U(self.size + 1) + (context & U(0xFFFFFFFF))

    def order(self, context: np.ndarray) -> np.ndarray:
        return _order(self.dense(context), (self.size + 1) ** 2)

    def by_shard(self, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in the order of their shards, where each shard begins among them)."""
        by = np.argsort(shard.astype(np.uint16) if self.shards <= 1 << 16 else shard, kind="stable")
        return by, np.concatenate([[0], np.cumsum(np.bincount(shard.astype(np.int64), minlength=self.shards))])

    def log10(self, order: int, context: np.ndarray, ids: np.ndarray, known: np.ndarray, lower: np.ndarray, heavy: dict) -> np.ndarray:
        """log10 P(id | context) at ``order``, given the lower order's; ``known`` says where a context exists."""
        out = lower.copy()
        ask = np.flatnonzero(known)
        if not len(ask):
            return out
        keys, totals = heavy[order]
        if len(keys):  # a heavy context lies in those shards only where it has followers
            place = np.minimum(np.searchsorted(keys, context[ask]), len(keys) - 1)
            split = keys[place] == context[ask]
            own, total = ask[split], totals[place[split]]
            out[own] -= STEP * _codes(np.log10(self.prior / (total + self.prior))).astype(np.float64)
        ask = ask[self.order(context[ask])]  # rising contexts are found fastest, and each but once
        shard = self.shard(context[ask], ids[ask], heavy, order)
        by, edges = self.by_shard(shard)
        for s, name in self.levels[order].items():
            own = ask[by[edges[s] : edges[s + 1]]]
            if not len(own):
                continue
            arrays = _load(self.folder, name)
            asked = context[own]
            opens = np.flatnonzero(np.diff(asked, prepend=~asked[:1]) != 0)
            place = _sequence(arrays, "contexts").find(asked[opens])
            there, each = place >= 0, np.diff(opens, append=len(own))
            own, place = own[np.repeat(there, each)], place[there]
            pointers = _sequence(arrays, "pointers")
            first, last = pointers.get(place).astype(np.int64), pointers.get(place + 1).astype(np.int64)
            place, first, last = (np.repeat(v, each[there]) for v in (place, first, last))
            wanted = place.astype(U) * U(self.size + 1) + ids[own].astype(U)
            found = _sequence(arrays, "followers").find(wanted, first, last)
            seen = -STEP * arrays["codes"][np.maximum(found, 0)].astype(np.float64)
            unseen = lower[own] - STEP * arrays["backoffs"][place].astype(np.float64)
            out[own] = np.where(found >= 0, seen, unseen)
        return out


def _text(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.col(text).alias("_text"))


def train(docs: DataFrame, folder: str, order: int = 2, text: str = "text", prior: float = PRIOR) -> None:
    """Count the words and n-grams of all texts and write a model of ``order`` 2 or 3 to ``folder``.

    Words are runs of characters other than blank and 0x09 to 0x0D, A-Z lower-cased; every text ends with
    one more token, also a null, empty or repeated one. P(w | context) = (c + prior * P(w | shorter context))
    / (total + prior), below which lies the add-one probability of single words. Tasks send counts of chunks, not tokens, so
    a word, pair or text that a third of all rows hold costs one entry a chunk. An empty table
    gives a model without words. More than MOST_WORDS distinct words raise.
    """
    if order not in (2, 3):
        raise ValueError("order is 2 or 3")
    spark = docs.sparkSession
    bounded_batches(spark)
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    bits = max(3, (-(-size // SHARD_BYTES)).bit_length())
    shards = 1 << bits

    def count_words(batches):
        for chunk in _chunks(batches):
            keys, counts = np.unique(np.concatenate(chunk), return_counts=True)
            edges = np.searchsorted(keys >> U(64 - bits), np.arange(shards + 1, dtype=U))
            yield _blobs([(b, keys[i:j], counts[i:j]) for b, (i, j) in enumerate(zip(edges, edges[1:])) if i < j])

    def merge_words(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        keys, counts = _merged(table.column("counts").to_pylist())
        own = _named("hashes", keys - (U(bucket) << U(64 - bits)), 1 << (64 - bits))
        name = _save(folder, f"words-{bucket}", {**own, "counts": counts.astype("<i8")})
        return _file_row(1, bucket, name, len(keys), int(counts.sum()))

    files_schema = "level int, bucket int, file string, n long, tokens long"
    blob_schema = "bucket int, counts binary"
    train_text = _text(docs, text)
    train_text.mapInArrow(count_words, blob_schema).groupBy("bucket").applyInArrow(merge_words, files_schema).write.parquet(
        f"{folder}/files/level=1"
    )
    word_files = _file_list(spark, folder, 1)
    model = Model(folder, bits, word_files, {}, shards, prior)
    if model.size > MOST_WORDS:
        raise ValueError(f"{model.size} distinct words are more than n-grams can be packed from")
    heavy = {2: heavy_words(spark, model)}

    for k in range(2, order + 1):

        def count_grams(batches):
            for chunk in _chunks(batches):
                ids, _, opens = model.tokens_of(chunk)
                context, known = model.contexts(ids, opens, k)
                context, ids = context[known], ids[known]
                by, edges = model.by_shard(model.shard(context, ids, heavy, k))
                parts = []
                for s, (i, j) in enumerate(zip(edges, edges[1:])):
                    if i < j:
                        own = by[i:j]
                        parts.append((s, *_count_pairs(model, context[own], ids[own])))
                yield _gram_blobs(parts)

        def build_shard(table: pa.Table) -> pa.Table:
            shard = table.column("bucket")[0].as_py()
            blobs = zip(table.column("contexts").to_pylist(), table.column("counts").to_pylist())
            context, ids, counts = _merge_pairs(list(blobs), model.size + 1)
            return _build_level(model, k, shard, context, ids, counts, heavy)

        train_text.mapInArrow(count_grams, "bucket int, contexts binary, counts binary").groupBy("bucket").applyInArrow(
            build_shard, files_schema
        ).write.parquet(f"{folder}/files/level={k}")
        levels = {**model.levels, k: {b: f for b, f, _, _ in _file_list(spark, folder, k)}}
        model = Model(folder, bits, word_files, levels, shards, prior)
        if k < order:
            heavy[k + 1] = heavy_pairs(spark, model)
    listed = [(k, [int(h) for h in keys], [int(t) for t in totals]) for k, (keys, totals) in heavy.items()]
    spark.createDataFrame(
        [(bits, shards, order, float(prior), listed)],
        "bits int, shards int, order int, prior double, heavy array<struct<level int, contexts array<long>, totals array<long>>>",
    ).coalesce(1).write.parquet(f"{folder}/model")


def _blobs(parts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([b for b, _, _ in parts], pa.int32()), pa.array([_squeeze(k, c) for _, k, c in parts], pa.binary())],
        ["bucket", "counts"],
    )


def _count_pairs(model: Model, context: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct contexts, and distinct (place of the context, id) packed with their counts."""
    order = model.order(context)
    context, ids = context[order], ids[order]
    opens = np.diff(context, prepend=~context[:1]) != 0
    distinct, place = context[opens], np.cumsum(opens) - 1
    keys, counts = np.unique((place.astype(U) << _32) | ids.astype(U), return_counts=True)
    return distinct, keys, counts


def _gram_blobs(parts) -> pa.RecordBatch:
    contexts = [_squeeze(d, np.zeros(len(d), np.int64)) for _, d, _, _ in parts]
    grams = [_squeeze(k, c) for _, _, k, c in parts]
    columns = [pa.array([s for s, *_ in parts], pa.int32()), pa.array(contexts, pa.binary()), pa.array(grams, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["bucket", "contexts", "counts"])


def _merge_pairs(blobs: list[tuple[bytes, bytes]], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    contexts = [_spread(c)[0] for c, _ in blobs]
    distinct = np.unique(np.concatenate(contexts))
    keys, counts = [], []
    for own, (_, blob) in zip(contexts, blobs):
        k, c = _spread(blob)
        place = np.searchsorted(distinct, own)[(k >> _32).astype(np.int64)]
        keys.append((place.astype(U) << _32) | (k & U(0xFFFFFFFF)))
        counts.append(c)
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    order = _order((keys >> _32) * U(size) + (keys & U(0xFFFFFFFF)), len(distinct) * size)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.diff(keys, prepend=keys[:1] ^ U(1)) != 0)
    keys, counts = keys[first], np.add.reduceat(counts, first)
    return distinct[(keys >> _32).astype(np.int64)], (keys & U(0xFFFFFFFF)).astype(np.int64), counts


def _counts_of(model: Model, ids: np.ndarray) -> np.ndarray:
    """Counts of words by id."""
    out, base = np.zeros(len(ids), np.int64), 0
    for _, name, n, _ in model.word_files:
        own = np.flatnonzero((ids >= base) & (ids < base + n))
        if len(own):
            out[own] = _load(model.folder, name)["counts"][ids[own] - base]
        base += n
    return out


def _build_level(model, k, shard, context, ids, counts, heavy) -> pa.Table:
    """Write one shard from its sorted n-grams."""
    opens = np.diff(context, prepend=~context[:1]) != 0
    start, place = np.flatnonzero(opens), np.cumsum(opens) - 1
    distinct = context[start]
    if k == 2:  # every word stands before another token as often as it occurs, a text's end before its first
        total = _counts_of(model, distinct.astype(np.int64))
    else:
        total = np.add.reduceat(counts, start)
        keys, totals = heavy[k]
        if len(keys):  # of these, other shards have followers too
            at = np.minimum(np.searchsorted(keys, distinct), len(keys) - 1)
            total = np.where(keys[at] == distinct, totals[at], total)
    lower = model.unigram(_counts_of(model, ids))
    if k == 3:
        last = context & U(0xFFFFFFFF)
        lower = model.log10(2, last, ids, np.ones(len(ids), bool), lower, heavy)
    p = (counts + model.prior * 10.0**lower) / (total[place] + model.prior)
    arrays = {
        **_named("contexts", distinct, int(distinct[-1]) + 1),
        **_named("pointers", np.append(start, len(ids)).astype(U), len(ids) + 1),
        **_named("followers", place.astype(U) * U(model.size + 1) + ids.astype(U), len(distinct) * (model.size + 1)),
        "codes": _codes(np.log10(p)),
        "backoffs": _codes(np.log10(model.prior / (total + model.prior))),
    }
    if k == 2:
        large = counts > heavy_bar(model)
        arrays["large"], arrays["times"] = (context[large] << _32) | ids[large].astype(U), counts[large]
    return _file_row(k, shard, _save(model.folder, f"level{k}-{shard}", arrays), len(ids), int(counts.sum()))


def _file_row(level: int, bucket: int, name: str, n: int, tokens: int) -> pa.Table:
    kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
    values = (level, bucket, name, n, tokens)
    return pa.table({c: pa.array([v], t) for c, v, t in zip(("level", "bucket", "file", "n", "tokens"), values, kinds)})


def _file_list(spark: SparkSession, folder: str, level: int) -> list[tuple]:
    """One entry for each bucket, so as many as there are shards."""
    rows = spark.read.parquet(f"{folder}/files/level={level}").select("bucket", "file", "n", "tokens").collect()
    return sorted((r.bucket, r.file, r.n, r.tokens) for r in rows)


def heavy_bar(model: Model) -> float:
    """A quarter of a shard's mean share of all tokens: under 4 words, and under 4 pairs, for each shard occur more often."""
    return model.tokens / (4 * model.shards)


def heavy_words(spark: SparkSession, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words above ``heavy_bar``, in order, and their counts."""
    bar = heavy_bar(model)
    bases = np.cumsum([0, *[n for _, _, n, _ in model.word_files]])

    def over(base, arrays):
        found = np.flatnonzero(arrays["counts"] > bar)
        return found + base, arrays["counts"][found]

    return _heavy(spark, model.folder, [(int(base), name) for base, (_, name, _, _) in zip(bases, model.word_files)], over)


def heavy_pairs(spark: SparkSession, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Pairs above ``heavy_bar`` as contexts of triples, in order, and their counts.

    Every text ends with a token that is no context of triples, so all other pairs stand before a token as often as they occur.
    """
    return _heavy(
        spark, model.folder, [(0, name) for name in model.levels[2].values()], lambda _, a: (a["large"].view(np.int64), a["times"])
    )


def _heavy(spark: SparkSession, folder: str, plan: list, over) -> tuple[np.ndarray, np.ndarray]:
    if not plan:
        return np.empty(0, U), np.empty(0, np.int64)

    def read(batches):
        for b in batches:
            for base, name in zip(b.column("base").to_pylist(), b.column("file").to_pylist()):
                ids, n = over(base, _load(folder, name))
                yield pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.int64()), "n": pa.array(n, pa.int64())})

    rows = spark.createDataFrame(plan, "base long, file string").repartition("file").mapInArrow(read, "id long, n long").collect()
    rows.sort(key=lambda r: r.id)
    return np.array([r.id for r in rows], np.int64).astype(U), np.array([r.n for r in rows], np.int64)


def load_model(spark: SparkSession, folder: str) -> tuple[Model, dict, int]:
    """(model, heavy contexts by level, order) as tasks need them: names and sizes of files, not their contents."""
    row = spark.read.parquet(f"{folder}/model").first()
    levels = {k: {b: f for b, f, _, _ in _file_list(spark, folder, k)} for k in range(2, row.order + 1)}
    model = Model(folder, row.bits, _file_list(spark, folder, 1), levels, row.shards, row.prior)
    heavy = {h.level: (np.array(h.contexts, np.int64).astype(U), np.array(h.totals, np.int64)) for h in row.heavy}
    return model, heavy, row.order


def score(docs: DataFrame, folder: str, text: str = "text") -> DataFrame:
    """``docs`` with the scores of each whole text under the model in ``folder``.

    Adds ``n_tokens`` (words and the end), ``n_known`` (those that training saw), ``train_tokens`` (long),
    ``base_score``, the sum of log10 add-one probabilities of single words, and ``score``, the model's log10 probability.
    Unknown words count as one unseen word; after an unknown word the model knows no context. A null text is
    empty: its end alone is scored. Repeated rows score alike; other columns pass through, the new names replace older ones.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    model, heavy, order = load_model(spark, folder)
    added = ["n_tokens", "n_known", "base_score", "score"]
    docs = docs.drop(*added, "train_tokens")
    held = [f"_c{i}" for i in range(len(docs.columns))]

    def run(batches):
        waiting, size = [], 0
        for b in batches:
            tokens = [_tokens(t) for t in rows_of_bytes(b.column("_text"))]
            waiting.append((b, tokens))
            size += sum(map(len, tokens))
            if size >= CHUNK_TOKENS // 4:
                yield from finish(waiting)
                waiting, size = [], 0
        yield from finish(waiting)

    def finish(waiting):
        texts = [t for _, own in waiting for t in own]
        if not texts:
            return
        ids, counts, opens = model.tokens_of(texts)
        base = model.unigram(counts)
        log10 = base
        for k in range(2, order + 1):
            context, known = model.contexts(ids, opens, k)
            if k == 2:
                # pairs repeat: look each up once
                pair, back = _distinct(model.dense((context << _32) | ids.astype(U)), (model.size + 1) ** 2)
                one = np.zeros(len(pair), np.int64)
                one[back] = np.arange(len(ids))
                log10 = model.log10(2, context[one], ids[one], known[one], log10[one], heavy)[back]
            else:
                log10 = model.log10(k, context, ids, known, log10, heavy)
        starts = np.flatnonzero(opens)
        sums = [np.add.reduceat(v, starts) for v in (np.ones(len(ids), np.int64), (counts > 0).astype(np.int64), base, log10)]
        at = 0
        for b, own in waiting:
            columns = [b.column(h) for h in held] + [pa.array(v[at : at + len(own)]) for v in sums]
            at += len(own)
            yield pa.RecordBatch.from_arrays(columns, [*held, *added])

    rows = docs.select(*[F.col(f"`{c}`").alias(h) for c, h in zip(docs.columns, held)], F.col(text).alias("_text"))
    kinds = dict(rows.dtypes)
    schema = ", ".join([f"{h} {kinds[h]}" for h in held] + ["n_tokens long, n_known long, base_score double, score double"])
    scored = rows.mapInArrow(run, schema)
    return scored.select(
        *[F.col(h).alias(c) for c, h in zip(docs.columns, held)],
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
