"""Fill-in-the-middle: texts cut into prefix, middle and suffix, and put together in another order.

Cuts are chosen in lines or in code points and made in UTF-8 bytes. The two are converted through an index of the
characters that take more than one byte; between those a code point is a byte, and positions differ by a constant.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches

MARKERS = ("<P>", "<S>", "<M>")  # before the prefix, the suffix and the middle
PARTS = "n long, form string, prefix_chars long, middle_chars long, prefix_bytes long, middle_bytes long, output string"


class ExceptionIndex:
    """Where a UTF-8 text has characters of several bytes, and by how much they exceed one."""

    def __init__(self, utf8: bytes):
        raw = np.frombuffer(utf8, np.uint8)
        lead = np.flatnonzero(raw >= 0xC0)
        first = raw[lead]
        self.excess = np.concatenate([[0], np.cumsum(1 + (first >= 0xE0) + (first >= 0xF0), dtype=np.int64)])
        self.byte_at = lead.astype(np.int64)
        self.char_at = self.byte_at - self.excess[:-1]
        self.chars = len(raw) - int(self.excess[-1])

    def to_bytes(self, cuts) -> np.ndarray:
        """Byte offsets of cuts given in code points."""
        cuts = np.asarray(cuts, np.int64)
        return cuts + self.excess[np.searchsorted(self.char_at, cuts)]

    def to_chars(self, cuts) -> np.ndarray:
        """Code points before cuts given in bytes, none of them inside a character."""
        cuts = np.asarray(cuts, np.int64)
        return cuts - self.excess[np.searchsorted(self.byte_at, cuts)]


def line_ends(utf8: bytes) -> np.ndarray:
    """The byte offset behind each line; a line keeps its line feed, and one without any may end the text."""
    ends = np.flatnonzero(np.frombuffer(utf8, np.uint8) == 10) + 1
    return ends if not utf8 or utf8.endswith(b"\n") else np.append(ends, len(utf8))


def draws(seed: str, key: str) -> tuple[int, int, int, int]:
    """The first four groups of eight hex digits of the digest of ``seed:key``."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4))


def rearrange(utf8: bytes, key: str, seed: str, unit: str, rate: int, suffix_first: int, markers: Sequence[bytes]):
    """(n, form, prefix_chars, middle_chars, prefix_bytes, middle_bytes, output) of one text."""
    index = ExceptionIndex(utf8)
    ends = line_ends(utf8) if unit == "line" else None
    n = index.chars if ends is None else len(ends)
    h = draws(seed, key)
    if not utf8 or any(m in utf8 for m in markers) or h[2] % 100 >= rate:
        return n, "plain", None, None, None, None, utf8
    units = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if ends is None:
        chars = np.array(units, np.int64)
        at = index.to_bytes(chars)
    else:
        at = np.concatenate([[0], ends])[units]
        chars = index.to_chars(at)
    a, b = int(at[0]), int(at[1])
    prefix, middle, suffix = utf8[:a], utf8[a:b], utf8[b:]
    p, s, m = markers
    if h[3] % 100 < suffix_first:
        form, output = "spm", b"".join((s, suffix, p, prefix, m, middle))
    else:
        form, output = "psm", b"".join((p, prefix, s, suffix, m, middle))
    return n, form, int(chars[0]), int(chars[1] - chars[0]), a, b - a, output


def original(output: bytes, form: str | None, markers: Sequence[bytes]) -> bytes:
    """The text behind an output. No text that was rearranged holds a marker, so each is found where it was put."""
    if form not in ("psm", "spm"):
        return output
    p, s, m = markers
    first, second = (p, s) if form == "psm" else (s, p)
    head, middle = output[len(first) :].split(m, 1)
    one, two = head.split(second, 1)
    return one + middle + two if form == "psm" else two + middle + one


def _with_columns(docs: DataFrame, inputs: dict, added: str, run) -> DataFrame:
    """``docs`` and the columns that ``run(batch)`` adds, whatever the names of the others."""
    names = [part.split()[0] for part in added.split(", ")]
    kept = [c for c in docs.columns if c not in names]
    held = [f"_c{i}" for i in range(len(kept))]
    rows = docs.select(
        *[F.col(f"`{c}`").alias(h) for c, h in zip(kept, held)], *[c.alias(f"_in_{k}") for k, c in inputs.items()]
    )
    kinds = dict(rows.dtypes)

    def whole(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(h) for h in held] + run(b), held + names)

    schema = ", ".join([f"{h} {kinds[h]}" for h in held] + [added])
    return rows.mapInArrow(whole, schema).select(*[F.col(h).alias(c) for c, h in zip(kept, held)], *names)


def fill_in_middle(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    seed: str = "7",
    unit: str = "line",
    rate: int = 100,
    suffix_first: int = 50,
    markers: Sequence[str] = MARKERS,
) -> DataFrame:
    """``docs`` with ``n`` (units), ``form``, the lengths of prefix and middle in code points and bytes, and ``output``.

    A text is cut at two units (``line`` or ``char``) drawn from the digest of ``seed`` and its key, so a repeated row comes out
    the same and a lost task changes nothing. ``rate`` percent are rearranged, ``suffix_first`` percent of
    these as spm (suffix, prefix, middle), the others as psm; drawn cuts may coincide, and parts may be empty. Other texts are plain: the
    output is the text, the lengths are null. Empty and null texts (n = 0, output empty) and those that hold a marker are always plain. A
    null key counts as an empty one. Texts are cut whole whatever their length; one is held at a time beside its Arrow batch. An empty table
    gives no rows. Other columns pass through, the new names replace older ones.
    """
    if unit not in ("line", "char"):
        raise ValueError("unit must be line or char")
    bounded_batches(docs.sparkSession)
    marks = [m.encode() for m in markers]

    def run(b):
        keys, texts = b.column("_in_key").to_pylist(), b.column("_in_text").cast(pa.binary()).to_pylist()
        rows = [rearrange(t, k, seed, unit, rate, suffix_first, marks) for k, t in zip(keys, texts)]
        kinds = [pa.int64(), pa.string(), *[pa.int64()] * 4]
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        return [*columns, pa.array([r[6] for r in rows], pa.binary()).cast(pa.string())]

    inputs = {
        "key": F.coalesce(F.col(key).cast("string"), F.lit("")),
        "text": F.coalesce(F.col(text), F.lit("")),
    }
    return _with_columns(docs, inputs, PARTS, run)


def restore(
    rows: DataFrame, output: str = "output", form: str = "form", markers: Sequence[str] = MARKERS, name: str = "restored"
) -> DataFrame:
    """``rows`` with the text that each output was made of. A null output counts as empty, a null form as plain."""
    bounded_batches(rows.sparkSession)
    marks = [m.encode() for m in markers]

    def run(b):
        outputs, forms = b.column("_in_output").cast(pa.binary()).to_pylist(), b.column("_in_form").to_pylist()
        texts = [original(o, f, marks) for o, f in zip(outputs, forms)]
        return [pa.array(texts, pa.binary()).cast(pa.string())]

    inputs = {"output": F.coalesce(F.col(output), F.lit("")), "form": F.col(form)}
    return _with_columns(rows, inputs, f"{name} string", run)
