"""Session settings, the shared scratch folder, and small file-system calls.

All file access goes through Hadoop's FileSystem, so any path Spark can read works.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


SHUFFLE_BYTES = 128 * 2**20  # what one shuffle task should take in


def shuffle_tasks(input_bytes: int) -> int:
    """Shuffle partitions to start from; adaptive execution merges those that turn out small."""
    return max(200, -(-input_bytes // SHUFFLE_BYTES))


def build_session(
    app: str = "tidemark", master: str | None = None, input_bytes: int | None = None, **conf
) -> SparkSession:
    """A session with the settings the library assumes (UTC, adaptive execution).

    ``input_bytes`` sizes shuffles for the largest input of the job.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    if input_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_tasks(input_bytes))
    for name, value in {**settings, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> None:
    """Casts between zoned and zoneless timestamps are only stable in a fixed zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    named = named or sc.getCheckpointDir()
    if named:
        return named
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    local = tempfile.mkdtemp(prefix="tidemark-")
    sc.setCheckpointDir(local)
    return local


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/tidemark/{spark.sparkContext.applicationId}"


_WATCHERS: list[Callable[[str], None]] = []


@contextmanager
def watch_scratch(told: Callable[[str], None]):
    """Tell ``told`` each scratch path that is taken in the meantime, so that its folders can go once they have served."""
    _WATCHERS.append(told)
    try:
        yield
    finally:
        _WATCHERS.remove(told)


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    path = f"{_scratch_root(spark)}/{purpose}-{uuid.uuid4().hex}"
    for told in _WATCHERS:
        told(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application wrote below the shared folder, once its results are stored."""
    Files(spark).delete(_scratch_root(spark))


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: lineage ends here."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def estimated_bytes(df: DataFrame) -> int:
    """The planner's estimate of a result's size, from file sizes; it may be far too large, as behind a join."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


class Files:
    """The few file-system calls that a staged, all-or-nothing publish needs."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _open(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._open(path)
        return fs.exists(p)

    def list(self, path: str) -> list[str]:
        """Names directly below ``path``; empty when it does not exist."""
        fs, p = self._open(path)
        if not fs.exists(p):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(p))

    def has_data(self, path: str) -> bool:
        """Whether a directory holds anything but hidden and marker files."""
        return any("=" in n or not n.startswith(("_", ".")) for n in self.list(path))

    def tree(self, path: str) -> list[str]:
        """All files below ``path``."""
        fs, p = self._open(path)
        found, names = fs.listFiles(p, True), []
        while found.hasNext():
            names.append(found.next().getPath().toString())
        return sorted(names)

    def size(self, path: str) -> int:
        """Bytes of all files below ``path``."""
        fs, p = self._open(path)
        return fs.getContentSummary(p).getLength()

    def set_modified(self, path: str, milliseconds: int) -> None:
        fs, p = self._open(path)
        fs.setTimes(p, milliseconds, -1)

    def delete(self, path: str) -> None:
        fs, p = self._open(path)
        fs.delete(p, True)

    def rename(self, src: str, dst: str) -> None:
        fs, s = self._open(src)
        d = self._jvm.org.apache.hadoop.fs.Path(dst)
        fs.mkdirs(d.getParent())
        if not fs.rename(s, d):
            raise IOError(f"could not move {src} to {dst}")

    def read_json(self, path: str):
        fs, p = self._open(path)
        stream = fs.open(p)
        try:
            raw = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(raw)

    def write_json(self, path: str, value) -> None:
        """Write beside the target, then move into place."""
        staged = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
        fs, p = self._open(staged)
        stream = fs.create(p, True)
        try:
            stream.write(bytearray(json.dumps(value), "utf-8"))
        finally:
            stream.close()
        self.rename(staged, path)

    # --- small values that change: a new numbered file each time, the highest counts ---

    def latest(self, folder: str):
        """The newest value written by ``supersede``, or None."""
        names = [n for n in self.list(folder) if n.endswith(".json") and not n.startswith(".")]
        return self.read_json(f"{folder}/{names[-1]}") if names else None

    def supersede(self, folder: str, value) -> None:
        """Write a value that takes the place of the previous one, which stays until then."""
        names = [n for n in self.list(folder) if n.endswith(".json") and not n.startswith(".")]
        number = int(names[-1].removesuffix(".json")) + 1 if names else 0
        self.write_json(f"{folder}/{number:012d}.json", value)
