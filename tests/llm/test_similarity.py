"""Near duplicates, line dedup, decontamination and groups against brute force."""

from __future__ import annotations

import itertools
import random
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, graph, jaccard, lines
from tidemark.llm.fingerprints import block_keys, from_lanes, hamming, lane_sums

WORDS = [f"w{i}" for i in range(400)]


@pytest.fixture
def stored(spark, tmp_path):
    """A stored table, as operators that read their input twice ask for."""

    def store(rows, schema):
        path = str(tmp_path / str(random.random()))
        spark.createDataFrame(rows, schema).write.parquet(path)
        return spark.read.parquet(path)

    return store


def groups_of(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(40)] + [(200, 200), (None, 5)]
    edges += [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(60)]
    found = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    want = groups_of({x for e in real for x in e}, real)
    assert found.keys() == want.keys()
    assert all((found[a] == found[b]) == (want[a] == want[b]) for a, b in itertools.combinations(want, 2))
    assert graph.components(spark.createDataFrame([], "a long, b long")).isEmpty()


@pytest.mark.parametrize("small,most", [(2, 3), (32, 32)])
def test_linked_groups_lose_no_link_of_a_bucket(spark, monkeypatch, small, most):
    """One bucket for all nodes, which are linked in short chains: pivots alone see few of the links."""
    monkeypatch.setattr(graph, "SMALL", small)
    monkeypatch.setattr(graph, "MOST_PIVOTS", most)
    n, linked = 40, {(i, i + 1) for i in range(40) if i % 4 != 3}
    members = spark.createDataFrame([(0, i) for i in range(n)] + [(1, 5), (1, 5)], "bucket long, node long")
    near = F.array(*[F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b")) for a, b in linked])
    roots = graph.linked_groups(members, lambda pairs: pairs.filter(F.array_contains(near, F.struct("a", "b"))))
    found, want = {r.node: r.root for r in roots.collect()}, groups_of(range(n), [p for p in linked if p[1] < n])
    assert all((found.get(a, a) == found.get(b, b)) == (want[a] == want[b]) for a, b in itertools.combinations(range(n), 2))


def shingle_set(text, size):
    w = (text or "").encode().lower().split()
    return frozenset([tuple(w)] if 0 < len(w) < size else [tuple(w[i : i + size]) for i in range(len(w) - size + 1)])


@pytest.mark.parametrize("small,chunk", [(32, 2048), (1, 2048), (1, 3)])
@pytest.mark.parametrize("size,threshold", [(3, Fraction(9, 10)), (5, Fraction(8, 10))])
def test_near_duplicates(spark, stored, monkeypatch, size, threshold, small, chunk):
    monkeypatch.setattr(graph, "SMALL", small)
    monkeypatch.setattr(jaccard, "CHUNK_SETS", chunk)
    rng, rows = random.Random(size), []
    for g in range(25):
        base = [rng.choice(WORDS) for _ in range(rng.choice([1, 2, 4, 9, 12, 30, 60, 200, 900]))]
        for _ in range(rng.randint(1, 8)):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
                own[rng.randrange(len(own))] = rng.choice(WORDS)
            rows.append((len(rows) * 3, " ".join(own)))
    rows += [(1, None), (4, ""), (7, " \t\n"), (10, "ÄB c d"), (13, "äb C d"), (16, "Same Words Here now"), (19, "same\twords here NOW")]
    rows += [rows[5], rows[5]]
    docs = stored([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, node string, n_shingles int")
    out = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs, size, threshold).collect()]
    sets = {k: shingle_set(t, size) for k, t in rows}
    links = [
        (a, b)
        for a, b in itertools.combinations(sets, 2)
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])
    ]
    root = groups_of(sets, links)
    least = {}
    for k in sorted(sets):
        least.setdefault(root[k], k)
    assert sorted(out) == sorted((k, len(sets[k]), least[root[k]]) for k, _ in rows)
    assert len(links) > 20
    assert jaccard.near_duplicates(docs.limit(0), size, threshold).isEmpty()


def test_rows_with_null_keys_are_grouped(spark, stored):
    docs = stored([(None, "a b c d e f"), (5, "a b c d e f"), (None, "only here once more now")], "doc_id long, text string")
    out = [(r.doc_id, r.component_id) for r in jaccard.near_duplicates(docs).collect()]
    assert sorted(out, key=str) == [(5, 5), (None, 5), (None, None)]


@pytest.mark.parametrize("percent", [80, 90])
def test_sketches_within_the_distance_share_a_key(percent):
    import numpy as np

    t = percent / 100

    rng = np.random.default_rng(5)
    for n in (10, 15, 40, 150, 700, 3000):
        for _ in range(60):
            a = np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64))
            most = int(len(a) * (1 - t) + 1e-9)
            drop = rng.choice(len(a), rng.integers(0, most + 1), replace=False)
            b = np.delete(a, drop)
            spare = int((len(b) - t * len(a)) / t)
            b = np.unique(np.concatenate([b, rng.integers(0, 1 << 62, rng.integers(0, spare + 1), dtype=np.uint64)]))
            if len(np.intersect1d(a, b)) * 100 < percent * len(np.union1d(a, b)) or len(a) == len(b) == len(np.intersect1d(a, b)):
                continue
            keys = [jaccard.sketch_keys(x, Fraction(percent, 100)) for x in (a, b)]
            assert len(np.intersect1d(*keys)), (n, len(a), len(b))


def test_low_thresholds_reach_bands_beyond_the_next():
    import numpy as np

    rng = np.random.default_rng(6)
    for percent, n, m in ((50, 10, 20), (50, 40, 80), (60, 30, 50), (50, 300, 600)):
        for _ in range(20):
            b = np.unique(rng.integers(0, 1 << 62, m, dtype=np.uint64))
            a = np.sort(rng.choice(b, n, replace=False))
            assert len(np.intersect1d(*[jaccard.sketch_keys(x, Fraction(percent, 100)) for x in (a, b)])), (n, m)


def test_fingerprints_are_majorities_and_blocks_hold_the_radius(spark):
    rng = random.Random(9)
    hashes = {i: [rng.getrandbits(64) - 2**63 for _ in range(rng.choice([1, 2, 7, 40]))] for i in range(30)}
    df = spark.createDataFrame([(i, h) for i, v in hashes.items() for h in v], "i int, h long")
    sums = df.groupBy("i").agg(F.count("h").alias("n"), *lane_sums(F.col("h")))
    for r in sums.select("i", from_lanes(F.col("n")).alias("f")).collect():
        own = hashes[r.i]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in own) > len(own))
        assert r.f % 2**64 == want
    pairs = []
    for _ in range(300):
        a, flips = rng.getrandbits(64), rng.sample(range(64), 3)
        b = a ^ sum(1 << f for f in flips)
        pairs.append((a - 2**63, (a ^ b ^ a) - 2**63))
    df = spark.createDataFrame(pairs, "a long, b long")
    share = F.arrays_overlap(block_keys(F.col("a"), 5, 3), block_keys(F.col("b"), 5, 3))
    assert df.filter(hamming(F.col("a"), F.col("b")) == 3).count() == 300
    assert df.filter(~share).isEmpty()


LETTERS = ["".join(random.Random(i).choices("abcdefghijklmnop", k=6)) for i in range(400)]
LONG = " ".join(LETTERS)
LINE_ROWS = [
    (1, f"First line here.\n{LONG}\n\nFirst  line, here!"),
    (2, f"first line HERE\n...\nRoom 12 is open today\n{LONG.replace(LETTERS[200], 'other')}"),
    (3, None),
    (4, ""),
    (5, "Room 97 is open today\nOwn line of the fifth"),
    (5, "Room 97 is open today\nOwn line of the fifth"),
]


def test_lines(spark, stored):
    docs = stored([(k, t, 1) for k, t in LINE_ROWS], "doc_id long, text string, n_lines int")
    out = [(r.doc_id, r.text, r.n_lines, r.n_removed) for r in lines.dedup_lines(docs).collect()]
    by = {}
    for k, t, n, m in out:
        by.setdefault(k, []).append((t, n, m))
    assert sum(n for _, _, n, _ in out) == 10 and sum(m for *_, m in out) == 6
    kept = [line for t in (t for _, t, _, _ in out if t) for line in t.split("\n")]
    assert sum("irst" in x and "ine" in x for x in kept) == 1  # case, blanks and punctuation do not matter
    assert sum(x.startswith("Room") for x in kept) == 1  # nor do digits
    assert sum(x.startswith(LETTERS[0]) for x in kept) == 1  # one word of 400 changed
    assert sum(x.startswith("Own") for x in kept) == 1  # of repeated rows one keeps its lines
    assert "..." in kept and by[3] == [(None, 0, 0)] and by[4] == [("", 0, 0)]
    assert lines.dedup_lines(docs.limit(0)).isEmpty()
    assert lines.dedup_lines(docs).columns == ["doc_id", "text", "n_lines", "n_removed"]


def test_distant_lines_stay(spark, stored):
    docs = stored([(i, f"{' '.join(LETTERS[9 * i : 9 * i + 9])}") for i in range(40)] + [(99, "a " * 300), (98, "a " * 100)], "doc_id long, text string")
    assert lines.dedup_lines(docs).agg(F.sum("n_removed")).first()[0] == 0


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return row[-1]


def test_similar_lines_of_10_to_100_words_against_brute_force(spark, stored):
    """One word changed, words changed up to the bound, and scattered letters changed: the share that is found."""
    rng, pairs = random.Random(11), {}
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8)))
    for kind in ("one word", "words", "letters 5 %", "letters 9 %"):
        for n in [10, 12, 15, 20, 20, 30, 40, 60, 80, 100] * 3:
            words = [word() for _ in range(n)]
            a, own = " ".join(words), list(words)
            if kind == "one word":
                own[rng.randrange(n)] = word()
            elif kind == "words":
                left = len(a) // 10
                for i in rng.sample(range(n), n):
                    new = word()
                    if max(len(new), len(own[i])) <= left:
                        left -= max(len(new), len(own[i]))
                        own[i] = new
            else:
                letters = list(a)
                for i in rng.sample(range(len(a)), len(a) * int(kind.split()[1]) // 100):
                    letters[i] = rng.choice("abcdefghijklmnop")
                own = "".join(letters).split(" ")
            b = " ".join(own)
            if a != b and edits(a, b) * 10 <= max(len(a), len(b)):
                pairs.setdefault(kind, []).append((a, b))
    rows = [(i, line) for i, line in enumerate(line for both in pairs.values() for pair in both for line in pair)]
    docs = stored(rows, "doc_id long, text string")
    gone = {r.doc_id: r.n_removed for r in lines.dedup_lines(docs).select("doc_id", "n_removed").collect()}
    at, found = 0, {}
    for kind, both in pairs.items():
        found[kind] = sum(gone[at + 2 * i] + gone[at + 2 * i + 1] for i in range(len(both))) / len(both)
        at += 2 * len(both)
        assert len(both) > 15
    print(found)
    assert found["one word"] >= 0.98 and found["words"] >= 0.95 and found["letters 5 %"] >= 0.95 and found["letters 9 %"] >= 0.6


def test_crowds_of_unlike_lines_are_compared_in_two_rounds(spark, stored, monkeypatch):
    """Lines that share a block, and so keys, but are unlike; a few are near copies."""
    rng, calls, similar = random.Random(12), [], lines.similar
    letters = lambda n: "".join(rng.choices("abcdefghijklmnop", k=n))
    block = letters(90)
    own = [f"{block} {letters(110)}" for _ in range(120)]
    copies = [x[:150] + "xyz" + x[153:] for x in own[:9]]
    monkeypatch.setattr(lines, "similar", lambda *a: calls.append(1) or similar(*a))
    monkeypatch.setattr(lines, "TILE", 16, raising=False)
    docs = stored(list(enumerate(own + copies)), "doc_id long, text string")
    gone = {r.doc_id: r.n_removed for r in lines.dedup_lines(docs).select("doc_id", "n_removed").collect()}
    assert sum(gone.values()) == 9 and all(gone[i] + gone[120 + i] == 1 for i in range(9))
    assert len(calls) == 2


def test_members_of_a_bucket_in_different_groups_meet(spark, stored, monkeypatch):
    monkeypatch.setattr(lines, "TILE", 16)
    rng = random.Random(13)
    rows = []
    for node in range(260):
        root = 7 if node % 2 else 9 if node % 5 == 0 else 1000 + node
        rows += [(b, node, root, rng.randint(90, 140), *[0] * 5) for b in (1, 2) if node < 200 or b == 1]
    rows += [(3, 500 + i, 500 + i, 100 + i, *[0] * 5) for i in range(5)] + [(4, 600, 1, 99, *[0] * 5), (4, 601, 1, 99, *[0] * 5)]
    of = {}
    for b, node, root, length, *_ in rows:
        of.setdefault(b, []).append((node, root, length))
    want = {
        (x[0], y[0]) for own in of.values() for x in own for y in own
        if x[0] < y[0] and x[1] != y[1] and 10 * abs(x[2] - y[2]) <= max(x[2], y[2]) // 10 * 10
    }
    members = stored(rows, "bucket long, node long, root long, length int, " + ", ".join(f"{f} long" for f in lines.FEW))
    out = [(r.a, r.b) for r in lines._met_apart(members.select("node", "bucket", "length", *lines.FEW, "root")).collect()]
    assert len(out) == len(set(out)) and set(out) == want


def test_no_pair_within_the_edit_distance_is_refused_before_it(spark, stored):
    rng, rows = random.Random(14), []
    for n in (10, 11, 40, 90, 300, 700):
        for k in (n // 10, n // 10, n // 20):
            a = list("".join(rng.choices("abcdeé ü", k=n)))
            b, at = list(a), sorted(rng.sample(range(n), k), reverse=True)
            for i in at:
                kind = rng.randrange(3)
                b[i : i + 1] = [] if kind == 0 else ["x"] if kind == 1 else [b[i], "y"]
            rows.append(("".join(a), "".join(b)))
    texts = stored([(i, t) for i, t in enumerate(t for both in rows for t in both)], "node long, norm string")
    near = stored([(2 * i, 2 * i + 1) for i in range(len(rows))], "a long, b long")
    want = {2 * i for i, (a, b) in enumerate(rows) if edits(a, b) <= max(len(a), len(b)) // 10}
    assert len(want) > 12 and {r.a for r in lines.similar(near, texts).collect()} == want


def test_edits_by_pieces_are_never_fewer_than_needed(spark):
    rng, rows = random.Random(15), []
    words = lambda n: " ".join(rng.choice(LETTERS[:60]) for _ in range(n))
    for n in (2, 10, 40, 90):
        a = words(n)
        at = rng.randrange(len(a))
        letters = "".join(rng.choice("xé ") if rng.random() < 0.05 else c for c in a)
        rows += [(a, a), (a, a[:at] + "é" + a[at + 1 :]), (a, a[: at // 2] + a[at:]), (a, letters), (a, words(n)), (a, a[len(a) // 9 :]), ((a + " ") * 3, (a + " ") * 2)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string")
    bound = F.greatest(F.length("a"), F.length("b")).cast("int")
    tight = F.floor(bound / 10).cast("int")
    own = [lines.edits_by_pieces(F.col("a"), F.col("b"), x) for x in (bound, tight)]
    for r in df.select("i", own[0].alias("loose"), own[1].alias("tight"), tight.alias("most")).collect():
        a, b = rows[r.i]
        need = edits(a, b)
        assert need <= r.loose
        assert need <= r.tight or r.tight > r.most
        if r.i % 7 < 2:
            assert r.loose == need


def test_texts_of_lines_are_not_stored_again(spark, stored, monkeypatch):
    rng, sizes, store = random.Random(16), {}, lines.materialize

    def kept(df, purpose):
        out = store(df, purpose)
        sizes.setdefault(purpose, []).append((lines.Files(spark).size(out.inputFiles()[0].rsplit("/", 1)[0]), out.columns))
        return out

    monkeypatch.setattr(lines, "materialize", kept)
    monkeypatch.setattr(lines, "BROADCAST_ROWS", 0)
    own = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=3000)) for _ in range(300)]
    own += [x[:1500] + "0" + x[1501:] for x in own[:9]]
    docs = stored(list(enumerate(own)), "doc_id long, text string")
    gone = lines.dedup_lines(docs).agg(F.sum("n_removed")).first()[0]
    assert gone == 9
    assert sum(size for size, _ in sizes["line-entries"]) < sum(map(len, own)) / 4
    assert {c for _, columns in sizes["line-members"] for c in columns} == {"bucket", "node", "head"}


def test_many_pairs_of_few_texts_are_read_in_slices(spark, stored, monkeypatch):
    rng, calls, within = random.Random(17), [], lines._within
    base = "".join(rng.choices("abcdefghijklmnop", k=400))
    texts = []
    for i in range(16):
        own = list(base)
        for j in rng.sample(range(400), 4 + 3 * (i % 8)):
            own[j] = "x"
        texts.append("".join(own))
    monkeypatch.setattr(lines, "_within", lambda *a: calls.append(1) or within(*a))
    pairs = list(itertools.combinations(range(16), 2))
    near = stored(pairs, "a long, b long")
    found = {(r.a, r.b) for r in lines.similar(near, stored(list(enumerate(texts)), "node long, norm string")).collect()}
    assert found == {(a, b) for a, b in pairs if edits(texts[a], texts[b]) <= 40}
    assert 0 < len(found) and len(calls) > 3


def item(n, seed):
    rng = random.Random(seed)
    return [rng.choice(WORDS) for _ in range(n)]


def test_short_items_are_found_word_for_word(spark, stored):
    items = {1: "who wrote hamlet", 2: "Paris", 3: "two plus two is", 4: "what is two plus two", 5: "never there"}
    docs = stored(
        [(1, "Tell me: who wrote Hamlet? Who wrote, hamlet"), (2, "paris"), (3, "Two plus two is four; what is two plus two."), (4, "who wrote it"), (5, None)],
        "doc_id long, text string",
    )
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    for bound in (decontaminate.BROADCAST_SHINGLES, 0):
        decontaminate.BROADCAST_SHINGLES, kept = bound, decontaminate.BROADCAST_SHINGLES
        out = sorted((r.doc_id, r.item_id, r.start, r.n_words, r.similarity) for r in decontaminate.contamination(docs, bench).collect())
        decontaminate.BROADCAST_SHINGLES = kept
        assert out == [(1, 1, 2, 3, 1.0), (2, 2, 0, 1, 1.0), (3, 3, 0, 4, 1.0), (3, 4, 5, 5, 1.0)]


def test_contamination_against_brute_force(spark, stored):
    items = {i: item(n, i) for i, n in enumerate([5, 6, 15, 30, 30, 59, 80])}
    items[7] = items[3][:15] * 2
    rng, docs = random.Random(4), {}
    for k in [*range(60), *range(100, 220)]:
        words = item(rng.choice([3, 20, 100, 400]), 1000 + k)
        if k % 2:
            own = list(items[k % 8])
            for _ in range(rng.choice([0, 0, 1, 2])):
                own[rng.randrange(len(own))] = "other"
            at = rng.randrange(len(words) + 1)
            words[at:at] = own
        docs[k] = " ".join(words)
    docs[60] = " ".join(items[6][2:])  # shorter than the item
    docs[61] = "; ".join(w.upper() for w in items[5])
    rows = [(k, t, 1) for k, t in docs.items()] + [(62, None, 1), (63, "", 1), (61, docs[61], 1)]
    table = stored(rows, "doc_id long, text string, similarity int")
    bench = spark.createDataFrame(
        [(i, " ".join(w), "x") for i, w in items.items()] + [(20, None, "x"), (21, "", "x"), (22, "too short", "x")],
        "item_id long, text string, window string",
    )

    def bag(words):
        return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]

    want = {}
    for k, t in docs.items():
        s = bag(t.lower().replace(";", "").split())
        for i, w in items.items():
            b = bag(w)
            for p in range(max(len(s) - len(b), 0) + 1):
                cut = s[p : p + len(b)]
                both = sum((Counter(cut) & Counter(b)).values())
                if cut and both >= 0.8 * (len(cut) + len(b) - both):
                    want[k, i] = max(want.get((k, i), 0), both / (len(cut) + len(b) - both))
    for bound in (decontaminate.BROADCAST_SHINGLES, 0):
        decontaminate.BROADCAST_SHINGLES, kept = bound, decontaminate.BROADCAST_SHINGLES
        out = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contamination(table, bench).collect()}
        decontaminate.BROADCAST_SHINGLES = kept
        assert out.keys() <= want.keys() and all(abs(out[x] - want[x]) < 1e-9 for x in out)
        exact = {x for x, s in want.items() if s == 1}
        assert exact <= out.keys() and len(want.keys() - out.keys()) <= 1 and len(want) > 20
    assert decontaminate.contamination(table.limit(0), bench).isEmpty()
    assert decontaminate.contamination(table, bench.limit(0)).isEmpty()
