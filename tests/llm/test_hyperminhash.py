"""HyperMinHash: registers, estimates, and groups against brute force."""

from __future__ import annotations

import itertools
import random
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import graph, hyperminhash
from tidemark.llm.sets import mix

WORDS = [f"w{i}" for i in range(500)]
T = Fraction(85, 100)


@pytest.fixture
def stored(spark, tmp_path):
    def store(rows, schema):
        path = str(tmp_path / str(random.random()))
        spark.createDataFrame(rows, schema).write.parquet(path)
        return spark.read.parquet(path)

    return store


def test_registers_hold_zeros_and_mantissa_of_the_least_hash():
    rng = np.random.default_rng(1)
    for n, k in ((0, 128), (1, 128), (50, 80), (5000, 128), (5000, 4096)):
        s = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        least = {}
        for h, low in zip(map(int, mix(s ^ np.uint64(k))), map(int, mix(mix(s ^ np.uint64(k))))):
            b = ((h >> 32) * k) >> 32
            least[b] = min(low, least.get(b, 2**64))
        want = [0] * k
        for b, low in least.items():
            text = f"{low:064b}"
            zeros = min(len(text) - len(text.lstrip("0")), 62)
            want[b] = 1 + (zeros << 10) + int(text[zeros + 1 :].ljust(10, "0")[:10], 2)
        assert hyperminhash.registers(s, k).tolist() == want


def pair(rng, n, jaccard):
    """Two random sets of about n elements and that similarity."""
    common = int(2 * n * jaccard / (1 + jaccard))
    s = np.unique(rng.integers(0, 1 << 63, 2 * n - common, dtype=np.uint64))
    rng.shuffle(s)
    return s[:n], np.concatenate([s[:common], s[n:]])


def test_estimates_are_corrected_for_collisions():
    rng = np.random.default_rng(2)
    for n, jaccard in ((40, 0.85), (300, 0.85), (3000, 0.9), (3000, 0.3), (100_000, 0.0), (2000, 0.0)):
        errors, raw = [], []
        for _ in range(20 if n > 10_000 else 60):
            a, b = pair(rng, n, jaccard)
            one, two = (hyperminhash.registers(x, 512)[None, :] for x in (a, b))
            got, used = hyperminhash.estimate(one, two, np.array([len(a)]), np.array([len(b)]))
            errors.append(float(got[0]) - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
            raw.append(float(((one == two) & (one > 0)).sum()))
        assert abs(np.mean(errors)) < 0.012, (n, jaccard)
        if not jaccard:  # what agrees by accident is as frequent as the correction says
            assert abs(np.mean(raw) - hyperminhash.accidental(np.array([n]), np.array([n]), 512)[0]) < 0.15


def test_pairs_at_the_threshold_share_a_key_and_pass_the_estimate():
    """Small sets are covered by the pigeonhole principle, large ones but for one pair in 10^10."""
    assert (1 - 0.85**hyperminhash.BAND_REGISTERS) ** hyperminhash.BANDS < 1e-10
    rng, small, tried = np.random.default_rng(7), hyperminhash.classes_of_sizes(T), 0
    assert small[-1][0] > 100 and all(bands <= hyperminhash.BANDS for _, bands, _ in small)
    for n in (7, 8, 12, 14, 19, 25, 33, 47, 60, 100, 130, 160, 190, 240, 400, 2500):
        for _ in range(60):
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            lost = int(len(a) * 0.15 + 1e-9)
            drop = rng.integers(0, lost + 1)
            b = np.delete(a, rng.choice(len(a), drop, replace=False))
            more = int((len(b) - 0.85 * len(a)) / 0.85)
            b = np.unique(np.concatenate([b, rng.integers(0, 1 << 63, max(0, more), dtype=np.uint64)]))
            union, both = len(np.union1d(a, b)), len(np.intersect1d(a, b))
            if both == union or 100 * both < 85 * union:
                continue
            tried += 1
            keys = [hyperminhash.set_keys(x, T, small) for x in (a, b)]
            assert len(np.intersect1d(*keys)), (n, len(a), len(b))
            one, two = (hyperminhash.registers(x, 128)[None] for x in (a, b))
            near, used = hyperminhash.estimate(one, two, np.array([len(a)]), np.array([len(b)]))
            assert hyperminhash.possible(near, used, 0.85)[0]
    assert tried > 700


def shingle_set(text, size):
    w = (text or "").encode().lower().split()
    return frozenset([tuple(w)] if 0 < len(w) < size else [tuple(w[i : i + size]) for i in range(len(w) - size + 1)])


def classes_of(sets, threshold):
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = 0
    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and len(x & y) >= threshold * len(x | y):
            links += 1
            root[max(find(a), find(b))] = min(find(a), find(b))
    return {k: find(k) for k in sets}, links


@pytest.mark.parametrize("small,hot", [(32, 1000), (1, 2)])
def test_groups_against_brute_force(spark, stored, monkeypatch, small, hot):
    """With buckets of two already crowded all pairs meet in tiles; with two rows hot every join back is tried."""
    monkeypatch.setattr(hyperminhash, "CHUNK_SETS", 5 if small == 1 else 1024)
    monkeypatch.setattr(hyperminhash, "BROADCAST_ROWS", 0 if small == 1 else 500_000)
    monkeypatch.setattr(graph, "SMALL", small)
    monkeypatch.setattr(hyperminhash, "HOT_ROWS", hot)
    rng, rows = random.Random(4), []
    passage = [rng.choice(WORDS) for _ in range(60)]
    for g in range(30):
        base = [rng.choice(WORDS) for _ in range(rng.choice([1, 2, 4, 9, 14, 30, 60, 200, 900]))]
        base += passage if g % 5 == 0 else []
        for _ in range(rng.randint(1, 8)):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
                own[rng.randrange(len(own))] = rng.choice(WORDS)
            rows.append((len(rows) * 3, " ".join(own)))
    rows += [(1, None), (4, ""), (7, " \t\n"), (10, "ÄB c d"), (13, "äb C d"), (16, "Same Words Here now"), (19, "same\twords here NOW")]
    rows += [(1000 + i, "one text in many rows of the table") for i in range(12)]
    rows += [rows[5], rows[5]]
    long = [rng.choice(WORDS) for _ in range(60_000)]
    rows += [(5001, " ".join(long)), (5002, " ".join(long[:-2000]))]
    docs = stored([(k, t, "x", 1, True) for k, t in rows], "doc_id long, text string, digest string, n_shingles int, kept boolean")
    out = hyperminhash.near_duplicates(docs)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    sets = {k: shingle_set(t, 5) for k, t in rows}
    want, links = classes_of(sets, T)
    got = sorted(map(tuple, out.collect()))
    assert got == sorted((k, len(sets[k]), want[k], want[k] == k) for k, _ in rows)
    assert links > 60 and want[5002] == 5001


def test_a_crowd_below_the_threshold_stays_apart(spark, stored, monkeypatch):
    """Many texts that share most of their words, and pairs that share nearly all, compared in tiles."""
    monkeypatch.setattr(graph, "SMALL", 4)
    monkeypatch.setattr(hyperminhash, "CHUNK_SETS", 30)
    rng = random.Random(9)
    passage, rows = [rng.choice(WORDS) for _ in range(150)], []
    for i in range(60):
        own = [rng.choice(WORDS) for _ in range(40)]
        rows += [(2 * i, " ".join(passage + own)), (2 * i + 1, " ".join(passage + own[:-1]))]
    out = {r.doc_id: r.component_id for r in hyperminhash.near_duplicates(stored(rows, "doc_id long, text string")).collect()}
    sets = {k: shingle_set(t, 5) for k, t in rows}
    assert out == classes_of(sets, T)[0] and len(set(out.values())) == 60


def test_null_keys_empty_tables_and_thresholds(spark, stored):
    docs = stored([(None, "a b c d e f"), (5, "a b c d e f"), (None, "only here once more now"), (None, None)], "doc_id long, text string")
    out = [tuple(r) for r in hyperminhash.near_duplicates(docs).collect()]
    assert sorted(out, key=str) == sorted([(5, 2, 5, True), (None, 2, 5, False), (None, 1, None, True), (None, 0, None, True)], key=str)
    assert hyperminhash.near_duplicates(docs.limit(0)).isEmpty()
    with pytest.raises(ValueError):
        hyperminhash.near_duplicates(docs, threshold=Fraction(1, 2))
