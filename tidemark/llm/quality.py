"""Quality rules, lines first: failing lines go, then documents that lost too much text."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches
from tidemark.llm.sets import windows, word_hashes

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
SEPARATORS = (b"|", b">", b"/", "·".encode(), "•".encode(), "»".encode(), "›".encode())
BOILERPLATE = (
    "all rights reserved", "licensed under", "released under", "cookie policy", "use of cookies", "privacy policy",
    "terms of use", "terms of service", "enable javascript", "click here", "subscribe to our",
)
ENDS = ".!?:;,\"')]”’»…"  # how a sentence or a part of one ends

LEAST_WORDS = 10
MOST_REPEATED = 20  # percent of the words
MOST_MARKED = 20  # percent of a line's words that carry a symbol or two exclamation marks
NAVIGATION_WORDS = 3  # a line of at most so many words that ends like no sentence is a menu entry
LEAST_LEFT = 50  # percent of the words that must be left

_MARKED = re.compile(rb"[#*$%&|<>]|!!")
_BOILERPLATE = re.compile("|".join(map(re.escape, BOILERPLATE)), re.IGNORECASE | re.ASCII)

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_words_left", "n_words_failed"]


def line_fails(line: str, tokens: list[bytes]) -> bool:
    """Whether a line with words breaks the punctuation or the navigation rule."""
    n = len(tokens)
    marked = sum(_MARKED.search(t) is not None for t in tokens) if _MARKED.search(line.encode()) else 0
    if 100 * marked > MOST_MARKED * n:
        return True
    if n <= NAVIGATION_WORDS and line.rstrip(BLANKS)[-1] not in ENDS:
        return True
    return 100 * sum(t in SEPARATORS for t in tokens) > MOST_MARKED * n


def line_is_boilerplate(line: str) -> bool:
    """Licence, consent and subscription lines."""
    return _BOILERPLATE.search(line) is not None


def repeated_words(tokens: list[bytes], size: int = 5) -> int:
    """Words that lie in a ``size``-word window which the text holds twice or more."""
    if len(tokens) <= size:
        return 0
    found = windows(word_hashes(tokens), size)
    _, back, times = np.unique(found, return_inverse=True, return_counts=True)
    if len(times) == len(found):
        return 0
    twice = times[back] > 1
    covered = np.zeros(len(tokens), bool)
    for k in range(size):
        covered[k : k + len(twice)] |= twice
    return int(covered.sum())


def judge(text: str) -> tuple[list[int], str]:
    """The counts of a text in the order of COUNTS, and the text without its failing lines."""
    tokens = text.encode().split()
    lines = text.split("\n")
    left, failed, kept, seen, with_words = 0, 0, [], set(), 0
    for line in lines:
        own = line.encode().split()
        if own:
            with_words += 1
            seen.add(line)
            if line_is_boilerplate(line) or line_fails(line, own):
                failed += len(own)
                continue
            left += len(own)
        kept.append(line)
    counts = [
        len(tokens),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        with_words - len(seen),
        repeated_words(tokens),
        left,
        failed,
    ]
    return counts, "\n".join(kept)


def clean(docs: DataFrame, text: str = "text", cleaned: str | None = None) -> DataFrame:
    """``docs`` with COUNTS (long), ``base_failed`` and ``kept``; ``cleaned`` names a column for the text left.

    A null text has no words, and null stays null when cleaned. Words are runs of characters other than blank and 0x09 to
    0x0D, lines end at line feeds, lines without a word are kept and counted nowhere. ``base_failed`` is true
    under LEAST_WORDS words or above MOST_REPEATED percent repeated ones; ``kept`` is false then, where no word is
    left, and where under LEAST_LEFT percent of all words are left. Repeated rows are judged alike; an empty table gives no
    rows. Other columns pass through, the new names replace older ones.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.drop(*COUNTS, "base_failed", "kept", *([cleaned] if cleaned and cleaned != text else []))
    held = [f"_c{i}" for i in range(len(docs.columns))]  # own names, whatever the input's are

    def run(batches):
        for b in batches:
            judged = [judge(t or "") for t in b.column("_text").to_pylist()]
            columns = [b.column(h) for h in held]
            columns += [pa.array([c[i] for c, _ in judged], pa.int64()) for i in range(len(COUNTS))]
            if cleaned:
                columns.append(pa.array([t for _, t in judged], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, [*held, *COUNTS, *(["_cleaned"] if cleaned else [])])

    rows = docs.select(
        *[F.col(f"`{c}`").alias(h) if c != text or not cleaned == text else F.col(f"`{c}`").isNull().alias(h) for c, h in zip(docs.columns, held)],
        F.col(text).alias("_text"),
    )
    kinds = dict(rows.dtypes)
    schema = ", ".join(
        [f"{h} {kinds[h]}" for h in held] + [f"{c} long" for c in COUNTS] + (["_cleaned string"] if cleaned else [])
    )
    judged = rows.mapInArrow(run, schema)
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    left = F.col("n_words_left")
    enough = (left > 0) & (100 * left >= LEAST_LEFT * (left + F.col("n_words_failed")))
    back = []
    for c, h in zip(docs.columns, held):
        if c == cleaned:
            back.append(F.when(~F.col(h), F.col("_cleaned")).alias(c))
        else:
            back.append(F.col(h).alias(c))
    if cleaned and cleaned not in docs.columns:
        null = F.col(held[docs.columns.index(text)]).isNull()
        back.append(F.when(~null, F.col("_cleaned")).alias(cleaned))
    return judged.select(*back, *COUNTS, base.alias("base_failed"), (~base & enough).alias("kept"))
