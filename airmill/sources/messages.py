"""Message landing folders: one JSON message per line, read in batch or as a bounded stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airmill.sources import commits

# Files per micro-batch: normal polling, and draining a backlog.
POLL_FILES = 100
DRAIN_FILES = 5000


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """(body, received_at) of everything in the folder."""
    return spark.read.text(path).select(F.col("value").alias("body"), F.current_timestamp().alias("received_at"))


def unread_files(spark: SparkSession, landing: str, layer: str, most: int = DRAIN_FILES) -> list[tuple[str, str]]:
    """(path, name in the ledger) of the oldest landed files that no commit of ``layer`` has consumed, ``most`` at most.

    A file is known by path, size and time, so a file that was landed anew is read again. Sizes and times come from the listing; the
    contents are not read.
    """
    landed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing).select("path", "length", "modificationTime")
    named = landed.withColumn("file", F.concat_ws("|", "path", "length", F.unix_millis("modificationTime")))
    new = named.join(commits.consumed(spark, layer), "file", "left_anti").orderBy("modificationTime", "path").limit(most)
    return [(r["path"], r["file"]) for r in new.select("path", "file").collect()]


def read_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(body, received_at) of some files."""
    return spark.read.text(paths).select(F.col("value").alias("body"), F.current_timestamp().alias("received_at"))


def stream_messages(spark: SparkSession, path: str, drain: bool = False, max_files: int | None = None) -> DataFrame:
    """The same as a stream; a micro-batch takes a bounded number of files."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files or (DRAIN_FILES if drain else POLL_FILES))
    return reader.text(path).select(F.col("value").alias("body"), F.current_timestamp().alias("received_at"))
