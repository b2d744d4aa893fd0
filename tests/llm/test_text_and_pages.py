"""Quality rules, language model, WARC archives and URL filters."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ngram_trie, quality, urls, warc
from tidemark.llm.elias_fano import EliasFano, build
from tidemark.runtime import scratch_path

OTHER = "Some quite different words follow here and none of them come from the line above."
PROSE = "The quick brown fox jumps over the lazy dog near the old river bank today."


# --- quality ---


def test_counts_of_one_text():
    text = "a b c d e f\na b c d e g\n\n \na b c d e f\nTwo #x* | <y>\x0b99%"
    counts, _ = quality.judge(text)
    got = dict(zip(quality.COUNTS, counts))
    assert got["n_words"] == 18 + 5 and got["n_symbols"] == 6 and got["n_dup_lines"] == 1
    assert got["word_chars"] == sum(len(w) for w in text.encode().split())
    assert got["n_repeat_words"] == 5 * 3 + 2  # a to e three times, then "e f" once more through b to f
    assert quality.judge("\u00e9 \u20ac\U0001f600 x")[0][1] == 4


def repeated(text, size=5):
    w = text.encode().split()
    grams = [tuple(w[i : i + size]) for i in range(len(w) - size + 1)]
    times, hit = Counter(grams), set()
    for i, g in enumerate(grams):
        if times[g] > 1:
            hit |= set(range(i, i + size))
    return len(hit)


def test_repeated_words_match_brute_force():
    rng = random.Random(1)
    for n in (0, 4, 5, 6, 30, 300):
        for vocabulary in (1, 2, 5, 50):
            text = " ".join(str(rng.randrange(vocabulary)) for _ in range(n))
            assert quality.repeated_words(text.encode().split()) == repeated(text)


def test_lines_go_before_documents(spark):
    rows = [
        (1, f"{PROSE}\nHome | About | Shop | Login\nAll rights reserved.\nMenu\n\n{OTHER}"),
        (2, f"{PROSE}\n" + "\n".join(f"BUY!! NOW!! CHEAP!! No{i}!!" for i in range(20))),
        (3, "Licensed under the Apache License, Version 2.0."),
        (4, f"{PROSE}\nThis work is licensed under the GNU General Public License and so on and so forth for ever.\n{OTHER}"),
        (5, " ".join(["again and again and again"] * 30)),
        (6, "few words"),
        (7, None),
        (8, ""),
        (9, " \n\t\n"),
        (1, f"{PROSE}\nHome | About | Shop | Login\nAll rights reserved.\nMenu\n\n{OTHER}"),
        (10, " ".join(f"w{i}" for i in range(200_000))),
        (11, f"{PROSE}\n" + "\n".join(f"Click here a{i} b{i} c{i} d{i} e{i} f{i}." for i in range(40))),
    ]
    docs = spark.createDataFrame(rows, "doc_id int, text string").withColumn("kept", F.lit("old")).withColumn("a.b", F.lit(1))
    out = quality.clean(docs, cleaned="text").collect()
    kept = [(r.doc_id, r.text) for r in out if r.kept]
    assert sorted(k for k, _ in kept) == [1, 1, 4, 10]
    assert dict(kept)[1] == f"{PROSE}\n\n{OTHER}" and dict(kept)[4] == f"{PROSE}\n{OTHER}"
    by = {r.doc_id: r for r in out}
    assert by[5].base_failed and by[6].base_failed and by[7].text is None and by[7].n_words == 0 and by[8].text == ""
    assert not by[2].base_failed and not by[2].kept and not by[3].kept
    assert quality.clean(docs.limit(0)).isEmpty() and "a.b" in quality.clean(docs).columns
    other = quality.clean(docs, cleaned="cleaned").filter("doc_id = 4").first()
    assert other.cleaned == f"{PROSE}\n{OTHER}" and other.text == rows[3][1]
    assert not by[11].base_failed and not by[11].kept  # boilerplate is text lost like any other


# --- language model ---


def test_elias_fano_reads_and_finds():
    rng = np.random.default_rng(2)
    for n, top in ((0, 10), (1, 1), (5, 5), (1000, 1 << 20), (3000, 3001), (2000, 1 << 61)):
        values = np.sort(rng.integers(0, top, n, dtype=np.uint64))
        ef = EliasFano(build(values, top))
        if n:
            assert (ef.get(np.arange(n)) == values).all()
        ask = np.concatenate([values, rng.integers(0, top, 500, dtype=np.uint64)])
        want = np.searchsorted(values, ask)
        assert (ef.successor(ask) == want).all()
        found = ef.find(ask)
        has = np.isin(ask, values)
        assert (found[~has] == -1).all() and (values[found[has]] == ask[has]).all()


WORDS = [f"w{i}" for i in range(60)]


def brute_scores(train, texts, order, mu):
    tok = lambda t: (t or "").encode().lower().split() + [b""]
    c1, c2, c3 = Counter(), Counter(), Counter()
    for t in train:
        w = tok(t)
        c1.update(w)
        c2.update(zip([b"", *w[:-1]], w))
        c3.update(zip([b"", *w[:-2]], w[:-1], w[1:]))
    n, v = sum(c1.values()), len(c1)
    seen3 = Counter()
    for (a, b, _), k in c3.items():
        seen3[a, b] += k
    out = []
    for t in texts:
        w, score, base = tok(t), 0.0, 0.0
        for i, x in enumerate(w):
            p = (c1[x] + 1) / (n + v + 1)
            base += math.log10(p)
            a = w[i - 1] if i else b""
            if a in c1:
                p = (c2[a, x] + mu * p) / (c1[a] + mu)
            if order == 3 and i:
                aa = w[i - 2] if i > 1 else b""
                if (aa, a) in seen3:
                    p = (c3[aa, a, x] + mu * p) / (seen3[aa, a] + mu)
            score += math.log10(p)
        out.append((len(w), sum(c1[x] > 0 for x in w), n, base, score))
    return out


@pytest.mark.parametrize("order", [2, 3])
def test_scores_match_brute_force(spark, order):
    rng = random.Random(order)
    texts = [" ".join(rng.choice("aA b c dd e f g.h É".split()) for _ in range(rng.choice([1, 3, 20, 400]))) for _ in range(80)]
    texts += [None, "", "  \n ", "unseen zzz words", texts[0], "the the " * 3000]
    train = texts[:60] + [None, "", texts[0], "the the " * 3000]
    folder = scratch_path(spark, "lm")
    ngram_trie.train(spark.createDataFrame([(t,) for t in train], "text string"), folder, order=order)
    rows = [(i, t, 5) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "id int, text string, score int")
    got = ngram_trie.score(docs, folder).orderBy("id").collect()
    for r, (n, known, total, base, score) in zip(got, brute_scores(train, texts, order, ngram_trie.PRIOR), strict=True):
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert abs(r.base_score - base) < 1e-6
        assert abs(r.score - score) <= n * order * ngram_trie.STEP / 2 + 1e-9  # each quantised step is off by half a width
    assert ngram_trie.score(docs.limit(0), folder).isEmpty()
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_followers_of_a_heavy_pair_lie_in_several_shards(spark):
    rng = random.Random(8)
    train = ["of the " + rng.choice(WORDS) for _ in range(400)] + ["in in " * 300 + "x"] + [" ".join(rng.sample(WORDS, 9)) for _ in range(20)]
    texts = train[:3] + ["of the x", "in in w3 w4", "in in of the in x", "in in x", "w1 w2 unseen w3", None]
    folder = scratch_path(spark, "lm")
    ngram_trie.train(spark.createDataFrame([(t,) for t in train], "text string"), folder, order=3)
    model, heavy, order = ngram_trie.load_model(spark, folder)
    of, the = (int(i) for i in model.lookup(np.concatenate([ngram_trie._tokens(w)[:1] for w in (b"of", b"the")]))[0])
    pair = np.uint64(of << 32 | the)
    assert order == 3 and pair in heavy[3][0]
    assert len(np.unique(model.shard(np.full(60, pair), np.arange(60), heavy, 3))) > 2
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for r, (n, *_, score) in zip(ngram_trie.score(docs, folder).orderBy("id").collect(), brute_scores(train, texts, 3, ngram_trie.PRIOR), strict=True):
        assert abs(r.score - score) <= n * 3 * ngram_trie.STEP / 2 + 1e-9, r.text


def test_the_query_scores_with_triples(spark, monkeypatch):
    from tidemark.llm import queries

    used, train = [], ngram_trie.train
    monkeypatch.setattr(ngram_trie, "train", lambda *a, **k: used.append(k.get("order")) or train(*a, **k))
    docs = spark.createDataFrame([(i, "a b c a b c") for i in range(20)], "doc_id long, text string")
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    assert queries.op10_lm_scoring(spark, "").count() == 20 and used == [3]


def test_too_many_words_for_packed_ids_raise(spark, monkeypatch):
    monkeypatch.setattr(ngram_trie, "MOST_WORDS", 3)
    few, many = (spark.createDataFrame([(t,)], "text string") for t in ("a b", "a b c"))  # the end is a word too
    ngram_trie.train(few, scratch_path(spark, "few"))
    with pytest.raises(ValueError, match="4 distinct words"):
        ngram_trie.train(many, scratch_path(spark, "many"))


def test_a_model_of_nothing(spark):
    folder = scratch_path(spark, "lm")
    ngram_trie.train(spark.createDataFrame([], "text string"), folder)
    r = ngram_trie.score(spark.createDataFrame([("a b",)], "text string"), folder).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.score) == (3, 0, 0, 0.0)


# --- WARC ---


def test_archives_round_trip(spark):
    big = "<p>" + "x" * 200
    rows = [
        (5, "http://B.example.org:80/a?q=1#f", big),
        (3, "https://www.example.com/a b\tc", big),
        (9, "https://www.example.com/a b\tc", big),
        (4, None, "short"),
        (2, "no scheme", "short"),
        (7, "https://www.example.com/é", None),
        (8, "https://www.example.com/", ""),
        (6, "https://www.example.com/", "ß€" * 100),
        (9, "https://www.example.com/a b\tc", big),
        (None, "https://n.example", big + "!"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    folder = scratch_path(spark, "warc")
    warc.write_archives(pages, folder)
    got = warc.lookup(spark, folder, pages, payload=True).collect()
    want = []
    for k, _, h in rows:
        raw = (h or "").encode()
        first = min((p for p, _, x in rows if x == h and p is not None), default=None)
        revisit = len(raw) >= 100 and first is not None and first != k
        want.append((k, "revisit" if revisit else "response", first if revisit else None, len(raw), hashlib.sha256(raw).hexdigest(), b"" if revisit else raw))
    seen = [(r.page and int(r.page), r.record_type, r.refers_to and int(r.refers_to), r.payload_bytes, r.payload_digest, bytes(r.payload)) for r in got]
    assert sorted(seen, key=str) == sorted(want, key=str)
    one = spark.createDataFrame([("https://www.example.com/",), ("https://nowhere.example/",)], "url string")
    assert sorted(r.page for r in warc.lookup(spark, folder, one).collect()) == ["6", "8"]
    empty = scratch_path(spark, "warc")
    warc.write_archives(pages.limit(0), empty)
    assert warc.lookup(spark, empty, one).isEmpty()


def test_a_key_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 4)
    pages = spark.range(50).selectExpr("id AS page_id", "IF(id % 5 = 0, concat('http://a.b/', id), 'http://a.b/same') AS url", "concat('page ', id) AS html")
    folder = scratch_path(spark, "warc")
    warc.write_archives(pages, folder)
    same = spark.createDataFrame([("http://a.b/same",), ("http://a.b/15",)], "url string")
    assert sorted(int(r.page) for r in warc.lookup(spark, folder, same).collect()) == [i for i in range(50) if i % 5 or i == 15]


def test_url_keys():
    assert warc.url_key("https://Blog.Example.COM/x/?a=1#top") == "com,example,blog)/x/?a=1"
    assert warc.url_key("http://a.b") == "b,a)/" and warc.url_key(None) == "" and warc.url_key("plain") == "plain"


# --- URLs ---

RULES = [
    urls.Rule("allow", "com/"),
    urls.Rule("block", "example.com/en/"),
    urls.Rule("allow", "www.example.com/en/"),
    urls.Rule("block", "net/es/"),
]


def test_rules(spark):
    rows = [
        ("http://X.Example.com/en/1?u=http://y.net/es/", "x.example.com", "/en/1", "example.com/en/", "block"),
        ("http://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("http://myexample.com/en/", "myexample.com", "/en/", "com/", "allow"),
        ("http://example.com", "example.com", "", None, None),
        ("http://a.net/es/x#y", "a.net", "/es/x", "net/es/", "block"),
        ("http://a.net?x=/es/", "a.net", "", None, None),
        ("no scheme /en/", "", "", None, None),
        (None, "", "", None, None),
        ("", "", "", None, None),
        ("://com/ä", "com", "/ä", "com/", "allow"),
        ("http://ÄB.com/\nx", "Äb.com", "/\nx", "com/", "allow"),
    ]
    df = spark.createDataFrame([(u, 1) for u, *_ in rows], "url string, host int")
    model = urls.fit(spark.createDataFrame([], "url string, blocked int"))
    out = urls.judge(df, model, RULES).collect()
    assert [(r.url, r.host, r.path, r.rule) for r in out] == [r[:4] for r in rows]
    assert [r.verdict for r in out] == [r[4] or "allow" for r in rows]
    assert urls.judge(df.limit(0), model, RULES).isEmpty()


def test_trees_learn_what_urls_tell(spark):
    rng = random.Random(6)

    def url(bad):
        host = f"{rng.choice(['win', 'bet', 'pills'])}-{rng.randrange(10**6)}.biz" if bad else f"{rng.choice(['news', 'blog', 'docs'])}.example.org"
        return f"http://{host}/{rng.randrange(100)}" + ("?a=1&b=2&c=3" if bad and rng.random() < 0.7 else "")

    rows = [(url(i % 3 == 0), int(i % 3 == 0)) for i in range(900)] + [(None, 0), ("http://x", None)]
    train, test = rows[:600] + rows[900:], rows[600:900]
    model = urls.fit(spark.createDataFrame(train, "url string, blocked int"))
    out = urls.judge(spark.createDataFrame(test, "url string, blocked int"), model, [])
    right = out.filter(F.col("verdict") == F.when(F.col("blocked") == 1, "block").otherwise("allow")).count()
    assert right >= 0.95 * len(test)
    one = urls.fit(spark.createDataFrame([("http://x", 1), ("http://y", 1)], "url string, blocked int"))
    assert urls.judge(spark.createDataFrame([("http://z",)], "url string"), one, []).first().verdict == "block"


@pytest.mark.parametrize("bound", [urls.BROADCAST_SUFFIXES, 0])
def test_suffixes_count_all_labels_and_a_hot_url_does_not_fill_the_sample(spark, monkeypatch, bound):
    monkeypatch.setattr(urls, "TRAINING_ROWS", 200)
    monkeypatch.setattr(urls, "LEAST_ROWS", 40)
    monkeypatch.setattr(urls, "BROADCAST_SUFFIXES", bound)
    hot = [("http://hot.example.org/", 0)] * 3000
    rows = hot + [(f"http://h{i}.example.org/{i}", 0) for i in range(500)] + [(f"http://win{i}.biz/?a=1&b={i}", 1) for i in range(300)]
    rows += [(f"http://x{i}.rare{i % 5}/", 1) for i in range(50)]
    model = urls.fit(spark.createDataFrame(rows, "url string, blocked int"))
    seen = {r._suffix: (r.f_suffix_seen, r.f_suffix_rate) for r in model.suffixes.collect()}
    rate = 350 / len(rows)
    assert {k: v[0] for k, v in seen.items()} == {"org": 3500, "biz": 300, **{f"rare{i}": 10 for i in range(5)}}
    assert abs(seen["rare3"][1] - (10 + 10 * rate) / 20) < 1e-12 and model.rate == rate and model.few == (bound > 0)
    asked = spark.createDataFrame([("http://win999.biz/?a=1&b=5",), ("http://h7.example.org/9",)], "url string")
    assert {r.url[7]: r.verdict for r in urls.judge(asked, model, []).collect()} == {"w": "block", "h": "allow"}
    counted = spark.createDataFrame(rows, "_url string, label int").groupBy("_url", "label").agg(F.count("label").alias("_n"))
    drawn = {r.label: r["count"] for r in urls._sample(counted, len(rows), 350).groupBy("label").count().collect()}
    assert 150 < drawn[0] < 220 and 20 < drawn[1] < 60


def test_sequences_and_orders_against_numpy():
    rng = np.random.default_rng(8)
    for n, below in ((1, 1), (5, 100), (1000, 1001), (3000, 1 << 40), (70000, 1 << 62), (2, 1 << 63)):
        values = np.sort(rng.integers(0, below, n, dtype=np.uint64))
        own = EliasFano(build(values, below))
        asked = np.concatenate([values[:500], rng.integers(0, below, 500, dtype=np.uint64), np.array([below, 2 * below - 1], np.uint64)])
        at = np.searchsorted(values, asked)
        there = (at < n) & (values[np.minimum(at, n - 1)] == asked)
        assert (own.find(asked) == np.where(there, at, -1)).all() and (own.successor(asked) == at).all()
        assert (own.get(np.arange(n)) == values).all()
        for limit in (below, 1 << 64):
            keys = rng.permutation(values)
            assert (keys[ngram_trie._order(keys, limit)] == values).all()
            found, back = ngram_trie._distinct(keys, limit)
            assert (found == np.unique(keys)).all() and (found[back] == keys).all()


def test_a_context_is_looked_up_once_for_all_its_followers(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([("the cat sat on the mat and the cat lay on the mat",)] * 3, "text string")
    ngram_trie.train(docs, str(tmp_path / "model"), order=3)
    model, heavy, _ = ngram_trie.load_model(spark, str(tmp_path / "model"))
    ids, counts, opens = model.tokens_of([ngram_trie._tokens(b"the cat sat on the mat")] * 50)
    context, known = model.contexts(ids, opens, 2)
    asked, find = [], EliasFano.find
    monkeypatch.setattr(EliasFano, "find", lambda self, x, first=None, last=None: asked.append(len(x) * (first is None)) or find(self, x, first, last))
    model.log10(2, context, ids, known, model.unigram(counts), heavy)
    assert sum(asked) <= len(ids) // 10
