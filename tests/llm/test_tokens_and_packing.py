"""Token counts, packing and token files against the tokenizer library and plain Python."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import packing, token_counts, token_files
from tidemark.llm.tokens import counter, encoder
from tidemark.runtime import scratch_path

BYTE, RANKS, WORD = map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "word_bpe_49k.json"))
ODD = [
    "",
    " ",
    "a,b. c.",
    "x!!, y.,",
    "Foo.\nBar, <|endoftext|> <|StartOfText|><|startoftext|> don't, it's.",
    "é, É. ş, İ. ﬁ, Σας.",
    "ABC,\t\x0b next line ,́x",
    "\n\n  lead and trail  \n",
    "日本語, 漢字。 \U0001f600 emoji",
    "word " * 3000,
    "x" * 5000,
]
DOCS = [(i, t) for i, t in enumerate(ODD)] + [(50, None), (3, ODD[3]), (None, "no key"), (60, "y z " * 2047)]


def ids(text):
    return np.array(Tokenizer.from_file(BYTE).encode(text or "", add_special_tokens=False).ids, "<u4")


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame([(k, t, 7, "n") for k, t in DOCS], "doc_id long, text string, n_tokens int, extra string").write.mode(
        "overwrite"
    ).parquet(path)
    return spark.read.parquet(path)


def test_ids_and_counts_are_the_librarys():
    texts = ODD + [" ".join(ODD)]
    want = [ids(t).tobytes() for t in texts]
    assert encoder(BYTE, RANKS).encode(texts) == want
    assert encoder(BYTE).encode(texts) == want
    word = Tokenizer.from_file(WORD)
    assert counter(WORD, False).encode(texts) == [len(word.encode(t, add_special_tokens=False)) for t in texts]
    assert counter(BYTE, True).encode(texts) == [len(w) // 4 for w in want]


def test_a_wrong_rank_file_is_noticed():
    from tidemark.llm.tokens import IdEncoder

    with pytest.raises(ValueError, match="rank file"):
        IdEncoder(BYTE, public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).encode(["Ähnliche Wörter überall"] * 9)


def test_counts_and_cache(spark, docs):
    cache, word = scratch_path(spark, "cache"), Tokenizer.from_file(WORD)
    out = token_counts.count_tokens(docs, WORD, cache, blanks_matter=False)
    assert out.columns == ["doc_id", "text", "extra", "n_tokens"]
    want = sorted((k if k is not None else -1, len(word.encode(t or "", add_special_tokens=False))) for k, t in DOCS)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens) for r in out.collect()) == want
    held = spark.read.parquet(cache).count()
    assert held == spark.read.parquet(cache).select("digest").distinct().count()  # contents, not rows
    again = token_counts.count_tokens(docs.unionByName(docs), WORD, cache, blanks_matter=False)
    assert again.count() == 2 * len(DOCS) and spark.read.parquet(cache).count() == held
    assert token_counts.count_tokens(docs.limit(0), WORD, scratch_path(spark, "cache")).isEmpty()


def test_best_fit_fills_without_overlap():
    rng = np.random.default_rng(1)
    sizes = rng.integers(0, 2049, 5000)
    bins, at, n = packing.best_fit(sizes, 2048)
    for b in range(0, n, 97):
        own = np.flatnonzero(bins == b)
        own = own[np.lexsort((sizes[own], at[own]))]
        assert at[own].tolist() == np.concatenate([[0], np.cumsum(sizes[own])[:-1]]).tolist() and sizes[own].sum() <= 2048
    assert n <= sizes.sum() / 2048 * 1.02 + 1


def test_pieces_and_sequences(spark, docs):
    pieces = packing.token_pieces(docs, BYTE, 2048, 0, ranks=RANKS)
    packed = packing.pack(pieces, "length", 2048).collect()
    got, want = {}, {}
    for r in packed:
        got.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
        assert 1 <= r.length <= 2048
    for k, t in DOCS:
        all_ids = np.append(ids(t), np.uint32(0)).astype("<u4")
        cuts = list(range((len(all_ids) - 1) % 2048 + 1, len(all_ids) + 1, 2048))
        want.setdefault(k, []).extend(
            (i, a, b - a, zlib.crc32(all_ids[a:b].tobytes())) for i, (a, b) in enumerate(zip([0, *cuts], cuts))
        )
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    for s in {r.sequence_id for r in packed}:
        own = sorted((r.offset, r.length) for r in packed if r.sequence_id == s)
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
        assert sum(n for _, n in own) <= 2048
    assert packing.pack(packing.token_pieces(docs.limit(0), BYTE, 2048, 0), "length", 2048).isEmpty()


def test_rounds_merge_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "ITEMS_PER_GROUP", 8)
    rows = [(i, 1 + (i * 37) % 100, "x") for i in range(300)] + [(i, 0, "x") for i in range(5)] + [(9, 100, "x")] * 4
    out = packing.pack(spark.createDataFrame(rows, "sequence_id int, size int, offset string"), "size", 100).collect()
    assert len(out) == len(rows) and out[0].asDict().keys() == {"size", "sequence_id", "offset"}
    by = {}
    for r in out:
        by.setdefault(r.sequence_id, []).append((r.offset, r.size))
    assert all(sum(s for _, s in v) <= 100 for v in by.values())
    assert all(sorted(v)[-1][0] + sorted(v)[-1][1] == sum(s for _, s in v) for v in by.values())
    assert len(by) <= sum(s for _, s, _ in rows) / 100 * 1.1 + 2
    with pytest.raises(Exception, match="capacity"):
        packing.pack(spark.createDataFrame([(101,)], "size int"), "size", 100)


def test_token_files_round_trip(spark, docs):
    folder = scratch_path(spark, "token-files")
    token_files.write_token_files(docs, folder, BYTE, 2, ranks=RANKS)
    got = token_files.read_token_files(spark, folder).orderBy("start").collect()
    at = 0
    rows = sorted(DOCS, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or ""))
    for r, (k, t) in zip(got, rows, strict=True):
        own = np.append(ids(t), 2).astype("<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (k, at, len(own), zlib.crc32(own.tobytes()))
        at += len(own)
    digest, dictionary = token_files.load_dictionary(spark, folder)
    shard = spark.read.parquet(f"{folder}/shards").orderBy("shard").first()
    store, path = token_files.open_store(folder)
    reader = token_files.ShardReader(store, f"{path}/{shard.file}", digest, dictionary)
    assert reader.ids(len(shard["keys"]) - 1)[-1] == 2  # one document without its neighbours
    with pytest.raises(ValueError, match="another dictionary"):
        token_files.ShardReader(store, f"{path}/{shard.file}", b"x" * 32, dictionary)

    empty = scratch_path(spark, "token-files")
    token_files.write_token_files(docs.limit(0), empty, BYTE, 2)
    assert token_files.read_token_files(spark, empty).isEmpty()
    keys = docs.select(F.col("text").alias("doc_id"), "text")
    token_files.write_token_files(keys, f"{empty}-text", BYTE, 2)
    assert token_files.read_token_files(spark, f"{empty}-text").count() == len(DOCS)
