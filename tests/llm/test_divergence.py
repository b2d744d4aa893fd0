"""Source divergence against brute force over plain counts."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import divergence
from tidemark.llm.divergence import Forest, price, shares

SCHEMA = "doc_id long, text string, lang string, source string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, least, most):
    docs = [((l or ""), (s or ""), [fold(t) for t in TERM.findall(x or "")]) for _, x, l, s in rows]
    held, counts, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, found in docs:
        held[lang].update(set(found))
        counts[lang, source].update(found)
        sources[lang].add(source)
    out = []
    for lang, own in sources.items():
        kept = [t for t, n in held[lang].items() if n >= least]
        whole = Counter()
        for s in own:
            whole.update(counts[lang, s])

        def share(counter):
            total = sum(counter[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (counter[t] + 2) // total for t in kept}

        p = {s: share(counts[lang, s]) for s in own}
        q = share(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in own:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in own if o != s]
            words = [(f(p[s][t], q[t]), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, cut in (("pair", pairs, None), ("term", words, most)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, i + 1) for i, (v, item) in enumerate(items[:cut])]
    return sorted(out)


def corpus(rng):
    words = ["a", "bb", "Ccc", "é", "Éa", "ÄB", "中文", "x1y", "it's", "ſ", "K", "don_t"] + [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(9) for j in range(9)]
    rows = []
    for i in range(260):
        lang = rng.choice(["en", "en", "en", "de", None])
        source = rng.choice(["s1", "s1", "s2", "s3", "é", "", None])
        text = " ".join(rng.choice(words[: rng.choice([6, 20, len(words)])]) for _ in range(rng.randrange(40)))
        rows.append((i, rng.choice([text, text, text, None, "", "123 ..."]), lang, source))
    rows += [(1, "only here", "fr", "s1"), (2, "", "it", "s1"), (2, None, "it", "s2"), (3, None, "it", "s3")]
    rows += [(900, "same words here " * 3, "en", "s9")] * 15
    rows += [(901, "Ein sehr langer Text " * 30_000, "de", "s2"), (902, "ohneleerzeichen" * 20_000, "de", "s2")]
    return rows


@pytest.mark.parametrize("leaves,chunk,frontier,flush", [(4096, 64, 2_000_000, 200_000), (8, 2, 16, 5)])
def test_against_brute_force(spark, monkeypatch, leaves, chunk, frontier, flush):
    """The second time with many segments, pairs of chunks, batches of pairs, and counters passed on early."""
    for name, value in (("LEAVES", leaves), ("CHUNK", chunk), ("FRONTIER", frontier), ("FLUSH", flush), ("RANGE_ROWS", 6 * leaves)):
        monkeypatch.setattr(divergence, name, value)
    rows = corpus(random.Random(3))
    docs = spark.createDataFrame(rows, SCHEMA).withColumnsRenamed({"doc_id": "term"}).repartition(3)
    out = divergence.divergence_audit(docs, least_docs=4, most=5)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    want = brute(rows, 4, 5)
    assert sorted(map(tuple, out.collect())) == want
    assert {w[0] for w in want} == {"", "en", "de", "it"} and len(want) > 80


def test_empty_table_and_no_kept_terms(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "x"), (2, "c", "en", "y")], SCHEMA)
    assert divergence.divergence_audit(docs.limit(0)).collect() == []
    out = sorted(map(tuple, divergence.divergence_audit(docs).collect()))
    assert out == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]


def test_shares_are_exact_beyond_64_bits():
    rng = random.Random(1)
    for _ in range(300):
        total = rng.choice([5, 1000, 10**9, 10**13, 2**53])
        count = rng.randrange(total)
        assert int(shares(np.array([count]), np.array([total]))[0]) == 1 + 10**9 * (count + 2) // total


def test_equal_subtrees_are_one_node_and_pairs_are_opened_once():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 3, (6, 64))
    counts[:, 32:] = 0  # rare terms: one node a level for all trees
    counts[3] = counts[1]
    forest, totals = Forest(counts), counts.sum(axis=1) + 128
    assert forest.roots[3] == forest.roots[1]
    for left, right in forest.levels[:5]:
        assert len(set(zip(left.tolist(), right.tolist()))) == len(left)
    one, two = np.triu_indices(6, 1)
    p = shares(counts, totals[:, None])
    want = [int(price(p[a], p[b]).sum()) for a, b in zip(one, two)]
    assert forest.distances(one, two, totals).tolist() == want
