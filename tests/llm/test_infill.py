"""Fill-in-the-middle against plain string cuts, and the way back."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import infill

MARKS = [m.encode() for m in infill.MARKERS]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab\n é€😀́中"), max_size=60))
def test_index_converts_every_cut(text):
    utf8 = text.encode()
    index = infill.ExceptionIndex(utf8)
    chars = np.arange(len(text) + 1)
    at = [len(text[:c].encode()) for c in chars]
    assert index.chars == len(text)
    assert index.to_bytes(chars).tolist() == at and index.to_chars(at).tolist() == chars.tolist()
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    assert np.diff(np.concatenate([[0], infill.line_ends(utf8)])).tolist() == [len(u.encode()) for u in units]


def brute(key, text, unit, rate=100, spm=50, seed="7"):
    """The same from code points only."""
    h = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)
    n = len(units)
    if not text or any(m in text for m in infill.MARKERS) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    form = "spm" if h4 % 100 < spm else "psm"
    return n, form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


TRICKY = ["", None, "\n", "\n\n", "a", "é", "one\ntwo", "one\ntwo\n", "<P", "S>x<", "a<P>b", "<M", "\r\n\x0b", "x<S>", "😀\n€"]


@pytest.mark.parametrize("unit", ["line", "char"])
def test_against_code_points(spark, unit):
    rng = random.Random(5)
    texts = TRICKY + ["".join(rng.choice("ab é€😀\n<PSM>") for _ in range(rng.randrange(200))) for _ in range(150)]
    texts += ["wörter und mehr\n" * 40_000, "é" * 300_000]  # very long texts and a very long line
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, "no key\nat all")]
    out = infill.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"), unit=unit)
    got = infill.restore(out).collect()
    assert len(got) == len(rows)
    want = {(k, t or ""): brute("" if k is None else k, t or "", unit) for k, t in rows}
    for r in got:
        t = r.text or ""
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == want[r.doc_id, t]
        assert r.restored == t
        if r.form != "plain":
            assert (r.prefix_bytes, r.middle_bytes) == (
                len(t[: r.prefix_chars].encode()),
                len(t[r.prefix_chars : r.prefix_chars + r.middle_chars].encode()),
            )
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_rates_names_and_empty_tables(spark):
    schema = "n string, text string, form int, output string, doc_id long, `a b` int"
    docs = spark.createDataFrame([("x", "one\ntwo\n" * 3, 1, "y", i, i) for i in range(60)], schema)
    out = infill.fill_in_middle(docs, rate=50, suffix_first=0)
    assert out.columns == ["text", "doc_id", "a b", *[p.split()[0] for p in infill.PARTS.split(", ")]]
    rows = out.collect()
    assert {r.form for r in rows} == {"plain", "psm"} and all(r["a b"] == r.doc_id for r in rows)
    assert all((r.form, r.output) == brute(r.doc_id, r.text, "line", 50, 0)[1::3] for r in rows)
    assert infill.restore(infill.fill_in_middle(docs.limit(0))).count() == 0
    with pytest.raises(ValueError):
        infill.fill_in_middle(docs, unit="word")
