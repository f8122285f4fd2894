"""Layered parquet tables under year=/month=/day=/hour= folders: writers, tolerant readers, time-window scans."""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from airmill import constants as K
from airmill.session import file_system, stored
from airmill.sources import commits


class EmptySource(ValueError):
    """Raised by the ``fail`` policy."""


# --- partition columns ---------------------------------------------------------------------------------------------


def partition_time(message_time: Column, processed_at: Column, by_message_time: bool = True) -> Column:
    """Time that decides the partition: message time when it can be read, processing time otherwise."""
    if not by_message_time:
        return processed_at.cast("timestamp_ntz")
    return F.coalesce(message_time.try_cast("timestamp_ntz"), processed_at.cast("timestamp_ntz"))


def with_partitions(df: DataFrame, when: Column) -> DataFrame:
    """Zero-padded text columns year, month, day, hour."""
    formats = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    return df.withColumns({name: F.date_format(when, pattern) for name, pattern in formats.items()})


def padded(df: DataFrame) -> DataFrame:
    """Partition columns as zero-padded text again: reading a layer turns them into numbers."""
    widths = {"year": 4, "month": 2, "day": 2, "hour": 2}
    return df.withColumns({name: F.lpad(F.col(name).cast("string"), width, "0") for name, width in widths.items()})


def partition_key(when: Column) -> Column:
    """The folder path of a time."""
    return F.date_format(when, "'year='yyyy'/month='MM'/day='dd'/hour='HH")


# --- windows --------------------------------------------------------------------------------------------------------


def partition_hour() -> Column:
    """Start of the partition hour, from partition columns only, so that filters on it prune folders."""
    y, m, d, h = (F.col(c).cast("int") for c in K.PARTITION_COLUMNS)
    return F.make_timestamp_ntz(y, m, d, h, F.lit(0), F.lit(0))


def hours_back(now: datetime, hours: int = K.DEFAULT_LOOKBACK_HOURS) -> tuple[datetime, datetime]:
    """First and last hour start of the window that ends with the hour of ``now``."""
    last = now.replace(minute=0, second=0, microsecond=0)
    return last - timedelta(hours=hours - 1), last


def lookback(
    now: datetime, hours: int = K.DEFAULT_LOOKBACK_HOURS, backfill_from: str = "", wall_clock: datetime | None = None
) -> tuple[datetime, datetime]:
    """Window bounds with the backfill override.

    ``backfill_from`` ('YYYY-MM-DD HH:MM') counts whole hours up to the wall clock, plus one, and ends there; a
    malformed text gives a warning and the plain window. The hour limit applies to the parameter, not to a backfill.
    """
    if not 1 <= hours <= K.MAX_LOOKBACK_HOURS:
        raise ValueError(f"look-back must be 1..{K.MAX_LOOKBACK_HOURS} hours")
    text = backfill_from.strip()
    if text:
        clock = wall_clock or now
        try:
            start = datetime.strptime(text, "%Y-%m-%d %H:%M")
        except ValueError:
            warnings.warn(f"backfill start {text!r} is not 'YYYY-MM-DD HH:MM'; using {hours} hours", stacklevel=2)
        else:
            return hours_back(clock, int((clock - start).total_seconds() / 3600) + 1)
    return hours_back(now, hours)


def _ntz(value: datetime) -> Column:
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def in_hours(bounds: tuple[datetime, datetime], at: Column | None = None) -> Column:
    """Rows whose hour lies in the bounds; ``at`` defaults to the partition hour."""
    first, last = bounds
    inside = (at if at is not None else partition_hour()).between(_ntz(first), _ntz(last))
    if at is None:
        inside = inside & F.col("year").cast("int").between(first.year, last.year)
    return inside


def days_back(now: datetime, days: tuple[int, int]) -> tuple[datetime, datetime]:
    """First and last hour start of the whole calendar days ``now - days[1]`` .. ``now - days[0]``."""
    midnight = now.replace(hour=0, minute=0, second=0, microsecond=0)
    first = midnight - timedelta(days=days[1])
    last = midnight - timedelta(days=days[0]) + timedelta(hours=23)
    return first, last


def in_days(now: datetime, days: tuple[int, int], at: Column | None = None) -> Column:
    """Rows of the whole calendar days ``now - days[1]`` .. ``now - days[0]``."""
    return in_hours(days_back(now, days), at)


# --- readers --------------------------------------------------------------------------------------------------------


def _plain(spark: SparkSession, tolerant: bool, merge: bool) -> DataFrameReader:
    reader = spark.read.option("mergeSchema", str(merge).lower())
    if tolerant:
        reader = reader.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
    return reader


def read_layer(spark: SparkSession, path: str, tolerant: bool = False, schema: str | None = None) -> DataFrame:
    """A whole layer with its partition columns as numbers; ``tolerant`` skips unreadable and vanished files."""
    state = commits.live(spark, path)
    plain = None
    if state.schema is None or _has_folders(spark, path):
        reader = _plain(spark, tolerant, schema is None)
        plain = (reader.schema(schema) if schema else reader).parquet(path)
        for hour in state.replaced:
            y, m, d, h = (int(part.split("=")[1]) for part in hour.split("/"))
            plain = plain.where(~((F.col("year") == y) & (F.col("month") == m) & (F.col("day") == d) & (F.col("hour") == h)))
    if state.schema is None:
        return plain
    committed = commits.read(spark, path, state, tolerant)
    return committed if plain is None else union_layers([plain, committed])


def _has_folders(spark: SparkSession, path: str) -> bool:
    files, of = file_system(spark, path)
    return bool(files.globStatus(of(f"{path}/year=*")))


def read_hours(spark: SparkSession, path: str, bounds: tuple[datetime, datetime], tolerant: bool = False) -> DataFrame:
    """A window of a layer: the live runs of its hours by commit, and its plain hour folders that no commit replaces.

    Nothing outside the window is listed or read. An hour without a folder is an empty hour; a window without any is an empty frame, for
    which a layer without commits has to show the columns of one file.
    """
    names = commits.hour_folders(bounds)
    state = commits.live(spark, path, names)
    files, of = file_system(spark, path)
    there = [f"{path}/{n}" for n in names if n not in state.replaced and files.exists(of(f"{path}/{n}"))]
    frames = [_plain(spark, tolerant, True).option("basePath", path).parquet(*there)] if there else []
    if state.parts:
        frames.append(commits.read(spark, path, state, tolerant))
    if frames:
        return union_layers(frames).where(in_hours(bounds))
    if state.schema is not None:
        return commits.read(spark, path, state).withColumns({c: F.lit(None).cast("int") for c in K.PARTITION_COLUMNS})
    return _plain(spark, tolerant, False).parquet(path).limit(0)


def _footer_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, content) to (file, rows, error) as the footer tells."""
    for b in batches:
        rows, errors = [], []
        for content in b.column(1):
            try:
                rows.append(pq.read_metadata(pa.BufferReader(content.as_buffer())).num_rows)
                errors.append(None)
            except (pa.ArrowException, OSError) as error:
                rows.append(None)
                errors.append(str(error))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.int64()), pa.array(errors, pa.string())], names=["file", "rows", "error"])


def scan_report(spark: SparkSession, path: str, schema: StructType, columns: Sequence[str] | None = None) -> DataFrame:
    """(file, promised, rows, status, error) of every parquet file under ``path``: what a tolerant read gets from it, and why not all.

    ``promised`` are the rows of the footer, ``rows`` those that could be read with ``columns`` (all by default). ``status`` is 'whole',
    'cut' (unreadable from some row on), 'empty' or 'unreadable'. Both counts are one scan each, combined on the map side. Only files
    without any row are opened once more, in tasks, for their error; a folder without files gives no rows.
    """
    file = F.col("_metadata.file_path").alias("file")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select(file)
    rows = _plain(spark, True, False).schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(path)
    promised = rows.select(file).groupBy("file").agg(F.count(F.lit(1)).alias("promised"))
    # counting by the sign of a hash makes the scan read every value
    value = F.xxhash64(*(columns or schema.fieldNames())).alias("_value")
    read = rows.select(file, value).groupBy("file").agg((F.count_if(F.col("_value") < 0) + F.count_if(F.col("_value") >= 0)).alias("rows"))
    report = stored(listed.join(promised, "file", "left").join(read, "file", "left").na.fill(0, ["rows"]))
    silent = [r["file"] for r in report.where("promised IS NULL").collect()]  # file names, as any listing holds them
    if silent:
        opened = spark.read.format("binaryFile").load([unquote(f) for f in silent]).select(file, "content")
        told = opened.mapInArrow(_footer_rows, "file string, rows long, error string").withColumnRenamed("rows", "_footer")
    else:
        told = spark.createDataFrame([], "file string, _footer long, error string")
    out = report.join(told, "file", "left").withColumn("promised", F.coalesce("promised", "_footer"))
    status = F.when(F.col("promised").isNull(), "unreadable").when(F.col("promised") == 0, "empty")
    status = status.when(F.col("rows") < F.col("promised"), "cut").otherwise("whole")
    return out.select("file", "promised", "rows", status.alias("status"), "error")


def union_layers(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames, columns by name, absent columns null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def latest_hour(df: DataFrame, now: datetime, at: Column | None = None) -> DataFrame:
    """Rows of the newest non-empty hour among the current and the previous one.

    The newest hour is a scalar subquery over the two candidate hours.
    """
    hour = at if at is not None else partition_hour()
    near = df.where(in_hours(hours_back(now, 2), at))
    newest = near.agg(F.max(hour).alias("newest"))
    return near.where(hour == newest.scalar())


def require_rows(df: DataFrame, policy: str = "fail") -> DataFrame | None:
    """``fail`` raises on an empty source, ``skip`` returns None; one row is enough to decide."""
    if not df.isEmpty():
        return df
    if policy == "skip":
        return None
    raise EmptySource("no rows in the source window")


# --- writers --------------------------------------------------------------------------------------------------------


def write_layer(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    extra: Sequence[str] = (),
    rows_per_file: int = 5_000_000,
) -> None:
    """Write by year/month/day/hour (and ``extra``), a few files per folder.

    ``overwrite`` replaces only the folders present in ``df``, so that re-running a window is idempotent; ``append``
    keeps what is there. Rows of one hour are spread over several tasks with ``rebalance``, which splits big partitions
    and merges small ones at run time, and ``maxRecordsPerFile`` bounds the file size.
    """
    columns = [*K.PARTITION_COLUMNS, *extra]
    writer = padded(df).hint("rebalance", *columns).write.mode(mode).option("maxRecordsPerFile", rows_per_file)
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)


def stage_layer(df: DataFrame, path: str, extra: Sequence[str] = (), rows_per_file: int = 5_000_000) -> tuple[str, list[str], StructType]:
    """Write rows as a run that nobody sees yet: its id, the hours it holds, and its columns."""
    spark, run = df.sparkSession, uuid.uuid4().hex
    target = commits.run_folder(path, run)
    write_layer(df, target, "overwrite", extra, rows_per_file)
    files, of = file_system(spark, path)
    found = files.globStatus(of(f"{target}/year=*/month=*/day=*/hour=*")) or []
    hours = ["/".join(str(s.getPath().toUri().getPath()).split("/")[-4:]) for s in found]
    columns = [*K.PARTITION_COLUMNS, *extra]
    return run, hours, StructType([f for f in df.schema.fields if f.name not in columns])


def commit_layer(df: DataFrame, path: str, replaces: Sequence[str] | None = (), files: Sequence[str] = (), rows_per_file: int = 5_000_000) -> int:
    """Write rows and make them visible at once; see ``commits``.

    ``replaces`` are hour folders whose earlier rows go, None for the hours of ``df``; ``files`` are landed files that this write consumes.
    """
    run, hours, schema = stage_layer(df, path, rows_per_file=rows_per_file)
    return commits.commit(df.sparkSession, path, run, hours, schema, hours if replaces is None else replaces, files)


def write_report(document: DataFrame, path: str, run_ts: datetime) -> list[str]:
    """One JSON report under its date and a copy under ``latest``; returns both folders."""
    stamp = run_ts.strftime("%Y%m%d_%H%M%S")
    dated = f"{path}/year={run_ts:%Y}/month={run_ts:%m}/day={run_ts:%d}/report_{stamp}"
    latest = f"{path}/latest"
    for target in (dated, latest):
        document.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(target)
    return [dated, latest]


def read_latest_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The ``latest`` report; an empty frame when none was written yet."""
    reader = spark.read.schema(schema).option("ignoreMissingFiles", "true")
    try:
        return reader.json(f"{path}/latest")
    except Exception as error:  # the folder does not exist before the first run
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)
