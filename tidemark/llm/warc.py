"""WARC archives of pages, and a two-level index of their captures.

Archives hold one gzip member for each record, so that a record is read by its range alone. The index
sorts captures by reversed-host URL key. Each index file holds compressed blocks of BLOCK_LINES captures, then a sparse
directory with the first key of each block; a table of one row a file names their first and last keys.
A lookup searches the files' keys, then a file's directory, then one block, and reads the record's range.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import BATCH_BYTES, BATCH_ROWS, bounded_batches, open_store, unique_name

LEAST_REVISIT = 100  # bytes; equal payloads under it are all stored
FILE_BYTES = 256 * 2**20  # an archive is closed beyond it
READ_BYTES = 32 * 2**20  # compressed records that one task reads
BLOCK_LINES = 1024
DATE = "1970-01-01T00:00:00Z"  # pages carry no time of capture
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:page:"

_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def url_key(url: str | None) -> str:
    """Host labels reversed, then path and query: ``com,example,www)/path?x=1``; a text without ``://`` as it is."""
    head, mark, rest = (url or "").partition("://")
    if not mark:
        return head
    host = re.match(r"[^/?#]*", rest)[0]
    tail = rest[len(host) :].partition("#")[0]
    return ",".join(reversed(host.lower().split("."))) + ")" + (tail or "/")


def _gzip(raw: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def record(page: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC record: a response with its payload, or a revisit with the response's headers alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    target = _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url or "")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{URN}{page}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head[2:2] = [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{URN}{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(raw: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in raw.decode().split("\r\n")[1:])


def parse(member: bytes) -> tuple[str, str, str | None, int, str, bytes]:
    """(record type, page, refers to, full payload's bytes, its digest, stored payload) of a compressed record."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    h = _headers(head)
    block = rest[: int(h["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size, digest = int(_headers(http)["Content-Length"]), h["WARC-Payload-Digest"].removeprefix("sha256:")
    page = h["WARC-Record-ID"][1:-1].removeprefix(URN)
    refers = h.get("WARC-Refers-To")
    if h["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"the record of page {page} is damaged")
    return h["WARC-Type"], page, refers and refers[1:-1].removeprefix(URN), size, digest, payload


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", body: str = "html") -> None:
    """Write a record for every page below ``folder``, and the index of all captures.

    Payloads are the body in UTF-8, empty for a null. Of pages with equal payloads of LEAST_REVISIT bytes or more, those of the
    smallest key are responses and the others revisit it; smaller payloads, and pages of which only null keys share the
    payload, are responses. Rows that repeat a key and payload get the same verdict. An empty table gives an
    empty index. Only files named in committed tables count.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    rows = pages.select(
        F.col(key).alias("_key"),
        F.col(url).alias("_url"),
        F.coalesce(F.col(body), F.lit("")).alias("_body"),
    ).withColumn("_digest", F.sha2(F.col("_body"), 256))
    large = F.octet_length("_body") >= LEAST_REVISIT
    shared = rows.filter(large).groupBy("_digest").agg(F.min("_key").alias("_first"), F.count(F.lit(1)).alias("_n"))
    shared = shared.filter(F.col("_n") > 1).select(F.col("_digest").alias("_shared"), "_first")
    refers = F.when(~F.col("_key").eqNullSafe(F.col("_first")), F.col("_first")).cast("string")
    placed = rows.join(shared, large & (F.col("_digest") == F.col("_shared")), "left").select(
        F.col("_key").cast("string").alias("_key"), "_url", "_body", "_digest", refers.alias("_refers")
    )

    def write(batches):
        store, path = open_store(f"{folder}/archives")
        store.create_dir(path, recursive=True)
        out, name, at = None, None, 0
        for b in batches:
            columns = [[], [], [], [], []]
            for page, target, text, digest, refers_to in zip(*(c.to_pylist() for c in b.columns)):
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = unique_name("pages", ".warc.gz"), 0
                    out = store.open_output_stream(f"{path}/{name}", compression=None)
                member = _gzip(record(page or "", target, text.encode(), digest, refers_to))
                out.write(member)
                for column, value in zip(columns, (url_key(target), page, name, at, len(member))):
                    column.append(value)
                at += len(member)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.string()) for c in columns[:3]), *(pa.array(c, pa.int64()) for c in columns[3:])],
                ["url_key", "page", "file", "at", "length"],
            )
        if out is not None:
            out.close()

    captures = "url_key string, page string, file string, at long, length long"
    placed.mapInArrow(write, captures).write.parquet(f"{folder}/captures")
    build_index(spark.read.schema(captures).parquet(f"{folder}/captures"), folder)


def build_index(captures: DataFrame, folder: str) -> None:
    """Sort captures by URL key into files of compressed blocks with a directory at the end of each."""

    def write(batches):
        store, path = open_store(f"{folder}/index")
        out, name, at, directory, lines, last = None, None, 0, [], [], None

        def flush():
            nonlocal at, lines
            block = _gzip("\n".join(lines).encode())
            directory.append((json.loads(lines[0])[0], at, len(block), len(lines)))
            out.write(block)
            at, lines = at + len(block), []

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    store.create_dir(path, recursive=True)
                    name = unique_name("captures", ".idx")
                    out = store.open_output_stream(f"{path}/{name}", compression=None)
                lines.append(json.dumps(row))
                last = row[0]
                if len(lines) == BLOCK_LINES:
                    flush()
        if out is None:
            return
        if lines:
            flush()
        tail = _gzip(json.dumps(directory).encode())
        out.write(tail + len(tail).to_bytes(8, "little"))
        out.close()
        yield pa.RecordBatch.from_pydict({"file": [name], "first": [directory[0][0]], "last": [last]})

    ordered = captures.repartitionByRange("url_key", "page", "file", "at").sortWithinPartitions("url_key", "page", "file", "at")
    ordered.mapInArrow(write, "file string, first string, last string").write.parquet(f"{folder}/files")


class IndexFile:
    """One file of the index: its directory is read at once, blocks when a key needs them."""

    def __init__(self, store, path: str):
        self._file = store.open_input_file(path)
        size = self._file.size()
        length = int.from_bytes(self._file.read_at(8, size - 8), "little")
        self._directory = json.loads(zlib.decompress(self._file.read_at(length, size - 8 - length), 31))
        self._firsts = [d[0] for d in self._directory]
        self._block = (None, [])

    def captures(self, key: str):
        """The captures of a key; equal keys may run over several blocks."""
        i = max(0, bisect_left(self._firsts, key) - 1)
        while i < len(self._firsts) and self._firsts[i] <= key:
            if self._block[0] != i:
                _, at, length, _ = self._directory[i]
                rows = zlib.decompress(self._file.read_at(length, at), 31).decode().split("\n")
                self._block = (i, [json.loads(r) for r in rows])
            rows = self._block[1]
            start = bisect_left(rows, key, key=lambda r: r[0])
            while start < len(rows) and rows[start][0] == key:
                yield rows[start]
                start += 1
            i += 1


def lookup(spark: SparkSession, folder: str, urls: DataFrame, url: str = "url", payload: bool = False) -> DataFrame:
    """The captures of each distinct URL of ``urls``, read from the archives through the index.

    (page, record_type, refers_to, payload_bytes, payload_digest[, payload]); page and refers_to are text, null for a
    page without a key. URLs with the same key (see ``url_key``) have the same captures. URLs that were not
    archived give no row. A key with very many captures is read by all the index files that hold it.
    """
    bounded_batches(spark)
    # one row for each index file
    files = sorted((r.first, r.last, r.file) for r in spark.read.parquet(f"{folder}/files").collect())
    firsts, lasts = [f[0] for f in files], [f[1] for f in files]

    def route(batches):
        for b in batches:
            keys, numbers = [], []
            for u in b.column("_url").to_pylist():
                k = url_key(u)
                for i in range(bisect_left(lasts, k), bisect_right(firsts, k)):
                    keys.append(k)
                    numbers.append(i)
            yield pa.RecordBatch.from_pydict({"number": pa.array(numbers, pa.int32()), "url_key": pa.array(keys, pa.string())})

    names = ["page", "record_type", "refers_to", "payload_bytes", "payload_digest"] + ["payload"] * payload
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def find(batches):
        store, path = open_store(f"{folder}/index")
        number, index = None, None
        for b in batches:
            found = []
            for n, k in zip(b.column("number").to_pylist(), b.column("url_key").to_pylist()):
                if n != number:
                    number, index = n, IndexFile(store, f"{path}/{files[n][2]}")
                for _, _, file, at, length in index.captures(k):
                    found.append((file, at, length))
                    if len(found) == BATCH_ROWS:
                        yield _locations(found)
                        found = []
            yield _locations(found)

    def read(batches):
        store, path = open_store(f"{folder}/archives")
        name, archive = None, None
        for b in batches:
            rows, held = [], 0
            for file, at, length in zip(*(b.column(c).to_pylist() for c in ("file", "at", "length"))):
                if file != name:
                    name, archive = file, store.open_input_file(f"{path}/{file}")
                kind, page, refers, size, digest, body = parse(archive.read_at(length, at))
                rows.append((page or None, kind, refers, size, digest) + ((body,) if payload else ()))
                held += len(body) if payload else 0
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    keys = urls.select(F.col(url).alias("_url")).distinct()
    routed = keys.mapInArrow(route, "number int, url_key string").distinct()
    ordered = routed.repartition(max(1, len(files)), "number").sortWithinPartitions("number", "url_key")
    places = ordered.mapInArrow(find, "file string, at long, length long")
    # tasks follow the bytes of the archives, which the places of their records say nothing about
    size = spark.read.parquet(f"{folder}/captures").agg(F.sum("length")).first()[0] or 0
    part = F.floor(F.col("at") / READ_BYTES)
    places = places.repartition(-(-size // READ_BYTES) or 1, "file", part).sortWithinPartitions("file", "at")
    schema = "page string, record_type string, refers_to string, payload_bytes long, payload_digest string"
    return places.mapInArrow(read, schema + (", payload binary" if payload else ""))


def _locations(found: list) -> pa.RecordBatch:
    files, at, length = ([f[i] for f in found] for i in range(3))
    return pa.RecordBatch.from_arrays(
        [pa.array(files, pa.string()), pa.array(at, pa.int64()), pa.array(length, pa.int64())], ["file", "at", "length"]
    )
