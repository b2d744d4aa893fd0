"""Incremental parquet ingest with additive schema evolution and rescued values."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.merge import widen_schema
from tidemark.runtime import Files, materialize
from tidemark.sources.ledger import FileLedger, stream_id, write_names

RESCUED = "_rescued_data"
INGEST_COLUMNS = ("_ingest_file_path", "_ingest_file_mtime", "_ingest_ts")
_LISTING = "path string, modificationTime timestamp, length long, content binary"
_BATCH = "ingest_batch"
_BY = "_by.json"  # inside a committed batch: the stream that brought it and that stream's number for it
EVERY_AGE = "36500d"  # a file is new when it was not seen, however old its time stamp is


def stream_files(reader, path: str, source: str = "parquet", **options) -> DataFrame:
    """Open a file stream that leaves no file out for its age."""
    return reader.format(source).option("maxFileAge", EVERY_AGE).options(**options).load(path)


def with_ingest_metadata(df: DataFrame) -> DataFrame:
    """Add where and when each row was read; call it on a frame read straight from files."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_ingest_file_path"),
        F.col("_metadata.file_modification_time").alias("_ingest_file_mtime"),
        F.current_timestamp().alias("_ingest_ts"),
    )


def _footers(paths: DataFrame) -> DataFrame:
    """The schema text of each file's footer, read where the tasks run."""

    # Defined here so that it travels to the tasks by value: workers need no copy of this package.
    def read(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        import pandas
        import pyarrow.parquet as pq
        from pyarrow import fs

        same = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss", "wasb": "abfs"}
        for batch in batches:
            texts = []
            for path in batch["path"]:
                # names are plain here: a URI parser would stop at blanks and decode percent signs
                scheme, _, rest = path.partition(":")
                if scheme == "file":
                    store, name = fs.LocalFileSystem(), "/" + rest.lstrip("/")
                else:
                    host, _, key = rest.lstrip("/").partition("/")
                    store, root = fs.FileSystem.from_uri(f"{same.get(scheme, scheme)}://{host}/")
                    name = f"{root.rstrip('/')}/{key}"
                with store.open_input_file(name) as f:
                    texts.append(pq.read_schema(f).remove_metadata().to_string())
            yield pandas.DataFrame({"path": batch["path"], "footer": texts})

    return paths.select("path").mapInPandas(read, "path string, footer string")


def files_by_schema(paths: DataFrame) -> list[list[str]]:
    """Group the files of one batch (column ``path``) by equal footer schema.

    Only names reach the driver, and a batch holds at most ``max_files`` of them.
    """
    groups = _footers(paths).groupBy("footer").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    return [r.paths for r in groups.orderBy(F.element_at("paths", 1)).collect()]


def discover_schema(spark: SparkSession, src: str, known: T.StructType | None = None) -> T.StructType:
    """Schema of every parquet file below ``src``, added to the known one and never narrowing it."""
    listing = spark.read.format("binaryFile").schema(_LISTING).option("pathGlobFilter", "*.parquet")
    footers = _footers(listing.option("recursiveFileLookup", "true").load(src))
    samples = footers.groupBy("footer").agg(F.min("path").alias("path")).orderBy("path").collect()
    return widen_schema(known, [spark.read.parquet(r.path).schema for r in samples])


def rescue_misfits(df: DataFrame, target: T.StructType) -> DataFrame:
    """Columns in the target's types; values that do not fit are kept as JSON in ``_rescued_data``."""
    have = {f.name.lower(): f for f in df.schema.fields}
    cells, misfits = [], []
    for f in target.fields:
        held = have.get(f.name.lower())
        if held is None:
            cells.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        raw = F.col(f"`{held.name}`")
        if held.dataType == f.dataType:
            cells.append(raw.alias(f.name))
            continue
        cast = _exact_cast(raw, held.dataType, f.dataType)
        cells.append(cast.alias(f.name))
        misfits.append(F.when(cast.isNull() & raw.isNotNull(), raw).alias(f.name))
    if not misfits:
        return df.select(*cells, F.lit(None).cast("string").alias(RESCUED))
    kept = F.to_json(F.struct(*misfits))
    return df.select(*cells, F.when(kept != "{}", kept).alias(RESCUED))


def _exact_cast(raw: Column, source: T.DataType, target: T.DataType) -> Column:
    """``try_cast`` that also refuses whatever does not come back as it was; text may be written in other ways."""
    cast = raw.try_cast(target)
    if isinstance(source, T.StringType):
        return F.when(_text_kept(raw, cast, target), cast)
    if isinstance(source, (T.ArrayType, T.MapType, T.StructType)):
        return cast
    return F.when(cast.try_cast(source).eqNullSafe(raw), cast)


def _text_kept(raw: Column, cast: Column, target: T.DataType) -> Column:
    """Whether a cast of text lost nothing: no digits of a fraction, no time of a day, no zone. Signs and outer zeros are free."""
    text = F.trim(raw)
    fraction = F.length(F.regexp_extract(text, r"\.(\d*?)0*$", 1))
    if isinstance(target, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return text.rlike(r"^[+-]?\d+$")
    if isinstance(target, T.DecimalType):
        return text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)$") & (fraction <= target.scale)
    if isinstance(target, T.DateType):
        return cast.cast("timestamp_ntz").eqNullSafe(text.try_cast("timestamp_ntz"))
    if isinstance(target, T.TimestampNTZType):
        seconds = F.length(F.regexp_extract(text, r"\.(\d*?)0*$", 1))
        return ~text.rlike(r"\d\s*(Z|UTC|GMT|[A-Za-z]+/[A-Za-z_]+)$|:\d+(\.\d+)?\s*[+-]\d") & (seconds <= 6)
    if isinstance(target, T.TimestampType):
        return F.length(F.regexp_extract(text, r"\.(\d*?)0*(\D|$)", 1)) <= 6
    return F.lit(True)


def read_widened(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Old and new files under one wider schema (int to bigint and the like); no file is rewritten."""
    return spark.read.schema(schema).parquet(path)


# --- incremental ingest -------------------------------------------------------------------------


class BronzeTable:
    """Append-only directory of committed batches with the last known schema beside it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.files = spark, path.rstrip("/"), Files(spark)

    def schema(self) -> T.StructType | None:
        known = self.files.latest(f"{self.path}/_schema")
        return T.StructType.fromJson(known) if known else None

    def save_schema(self, schema: T.StructType) -> None:
        if schema != self.schema():
            self.files.supersede(f"{self.path}/_schema", schema.jsonValue())

    def batch_path(self, batch_id: int) -> str:
        return f"{self.path}/{_BATCH}={batch_id}"

    def full_schema(self) -> T.StructType:
        extra = [
            T.StructField(RESCUED, T.StringType()),
            T.StructField("_ingest_file_path", T.StringType()),
            T.StructField("_ingest_file_mtime", T.TimestampType()),
            T.StructField("_ingest_ts", T.TimestampType()),
        ]
        return T.StructType([*(self.schema() or T.StructType()).fields, *extra])

    def read(self) -> DataFrame:
        schema = self.full_schema()
        if not self.files.has_data(self.path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path).drop(_BATCH)

    def stream(self, **options) -> DataFrame:
        return stream_files(
            self.spark.readStream.schema(self.full_schema()), f"{self.path}/{_BATCH}=*", **options
        )

    def batches(self) -> list[int]:
        names = [n for n in self.files.list(self.path) if n.startswith(f"{_BATCH}=")]
        return sorted(int(n.split("=", 1)[1]) for n in names)

    def ledger(self) -> FileLedger:
        return FileLedger(self.spark, f"{self.path}/_ledger")

    def _catch_up(self, ledger: FileLedger) -> None:
        """Batches are numbered; the ledger says how many it has taken in."""
        known = ledger.table.version() + 1
        fresh = [self.batch_path(b) for b in self.batches()[known:]]
        ledger.catch_up({p: tuple(self.files.read_json(f"{p}/{_BY}")) for p in fresh})

    def append(self, paths: DataFrame, batch_id: int, stream: str = "") -> None:
        """Commit the files of one batch that are not held yet: written aside, then moved into place as a whole.

        The names of its files are part of a batch, and go to a ledger. So a replay adds nothing, and a stream on a new
        checkpoint, which counts its batches from 0 again, adds exactly the files that are missing.
        """
        ledger = self.ledger()
        self._catch_up(ledger)
        if ledger.has(stream, batch_id):
            return
        paths = materialize(ledger.missing(paths.select(F.col("path").alias("file")), stream), "new-files")
        groups = files_by_schema(paths.withColumnRenamed("file", "path"))
        if not groups:
            return
        taken = self.batches()
        done = self.batch_path(taken[-1] + 1 if taken else 0)
        frames = [self.spark.read.parquet(*g) for g in groups]
        target = widen_schema(self.schema(), [f.schema for f in frames])
        rows = None
        for frame in frames:
            part = _read_into(frame, target)
            rows = part if rows is None else rows.unionByName(part)
        staged = f"{self.path}/_staged/{_BATCH}={batch_id}"
        rows.write.mode("overwrite").parquet(staged)
        write_names(paths, staged)
        self.files.write_json(f"{staged}/{_BY}", [stream, batch_id])
        self.save_schema(target)
        self.files.rename(staged, done)
        ledger.add(paths, stream, batch_id)


def _read_into(frame: DataFrame, target: T.StructType) -> DataFrame:
    """Rescue to the target schema while keeping file metadata of the scan."""
    tagged = with_ingest_metadata(frame)
    fitted = rescue_misfits(
        tagged,
        T.StructType(
            [
                *target.fields,
                *[tagged.schema[c] for c in INGEST_COLUMNS],
            ]
        ),
    )
    return fitted.select(*[f"`{f.name}`" for f in target.fields], RESCUED, *INGEST_COLUMNS)


def ingest_files(
    spark: SparkSession,
    src: str,
    dst: str,
    checkpoint: str,
    max_files: int = 1000,
    seed: T.StructType | None = None,
) -> BronzeTable:
    """Read every new parquet file below ``src`` exactly once into the bronze table at ``dst``.

    The stream carries file names only, so its own schema never changes and one checkpoint
    outlives every evolution. ``seed`` fixes types before the first file is seen.
    """
    bronze = BronzeTable(spark, dst)
    if seed is not None and bronze.schema() is None:
        bronze.save_schema(seed)
    names = stream_files(
        spark.readStream.schema(_LISTING),
        src,
        "binaryFile",
        pathGlobFilter="*.parquet",
        recursiveFileLookup="true",
        maxFilesPerTrigger=max_files,
    ).select("path")
    def append(paths: DataFrame, batch_id: int) -> None:
        bronze.append(paths, batch_id, stream_id(spark, checkpoint))

    query = (
        names.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return bronze


def stream_table(spark: SparkSession, path: str, schema: T.StructType | None = None, **options) -> DataFrame:
    """Stream of an append-only parquet directory."""
    known = schema or spark.read.parquet(path).schema
    return stream_files(spark.readStream.schema(known), path, **options)


def read_jdbc_snapshot(
    spark: SparkSession,
    url: str,
    table: str,
    pk: str,
    bounds: tuple[int, int],
    partitions: int = 8,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A relational table read in parallel by ranges of its key."""
    return spark.read.jdbc(
        url,
        table,
        column=pk,
        lowerBound=bounds[0],
        upperBound=bounds[1],
        numPartitions=partitions,
        properties=properties or {},
    )


def write_chunked(df: DataFrame, path: str, rows: int, mode: str = "errorifexists") -> None:
    """Parquet files of at most ``rows`` rows each; every task splits its own output."""
    df.write.mode(mode).option("maxRecordsPerFile", rows).option("compression", "snappy").parquet(path)
