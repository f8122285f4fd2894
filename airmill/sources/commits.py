"""Layers that change by commits: a write is a folder of its own that never changes, and one small file makes it visible.

    <layer>/_runs/run=<id>/year=/month=/day=/hour=/part-*    rows of one write
    <layer>/_commits/<number>.json                           the run, the hours it holds, the hours it replaces, its schema,
                                                             and the landed files it consumed

Of an hour, a reader takes the last replacing write and all writes after it. A commit appears by one rename, so a reader sees the layer
before or after a write, never in between; a write that dies before its commit leaves rows that nobody reads, and its landed files are still
unread. Hour folders that lie in the layer itself (written by streams) count as its first write.

The commits of a window are read as a table and only those that touch it come to the driver: a row per write and hour of the window.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airmill.session import file_system

FIELDS = "number bigint, run string, hours array<string>, replaces array<string>, schema string, files array<string>"


def hour_folder(at: datetime) -> str:
    return f"year={at:%Y}/month={at:%m}/day={at:%d}/hour={at:%H}"


def hour_folders(bounds: tuple[datetime, datetime]) -> list[str]:
    """Folders of all hours of a window."""
    first, last = bounds
    return [hour_folder(first + timedelta(hours=k)) for k in range(int((last - first).total_seconds() // 3600) + 1)]


def run_folder(path: str, run: str) -> str:
    return f"{path}/_runs/run={run}"


def log(spark: SparkSession, path: str) -> DataFrame | None:
    """The commits of a layer as a table, or None if it has none."""
    files, of = file_system(spark, path)
    found = files.globStatus(of(f"{path}/_commits/[0-9]*.json"))
    return spark.read.schema(FIELDS).json(f"{path}/_commits/[0-9]*.json") if found else None


def consumed(spark: SparkSession, path: str) -> DataFrame:
    """(file) of all landed files that a commit of the layer has consumed."""
    entries = log(spark, path)
    if entries is None:
        return spark.createDataFrame([], "file string")
    return entries.select(F.explode("files").alias("file"))


def commit(spark: SparkSession, path: str, run: str, hours: Iterable[str], schema: T.StructType, replaces: Sequence[str] = (), files: Sequence[str] = ()) -> int:
    """Make a written run visible; returns its number. Two writers get different numbers, in the order of their claims."""
    system, of = file_system(spark, path)
    taken = [s.getPath().getName() for s in system.globStatus(of(f"{path}/_commits/.*claim")) or []]
    number = max([int(n.split(".")[1]) for n in taken], default=0) + 1
    while True:
        try:
            system.create(of(f"{path}/_commits/.{number:012d}.claim"), False).close()
            break
        except Exception as error:
            if "exist" not in str(error).lower():
                raise
            number += 1
    entry = {"number": number, "run": run, "hours": sorted(hours), "replaces": sorted(replaces), "schema": schema.json(), "files": sorted(files)}
    hidden = of(f"{path}/_commits/.{uuid.uuid4().hex}.tmp")
    out = system.create(hidden, False)
    out.write(bytearray((json.dumps(entry) + "\n").encode()))
    out.close()
    if not system.rename(hidden, of(f"{path}/_commits/{number:012d}.json")):
        raise OSError(f"commit {number} of {path} could not be made")
    return number


@dataclass
class Live:
    """What a window holds: (run, hour) pairs to read, hours whose plain folders are replaced, and the columns of all live runs."""

    parts: list[tuple[str, str]]
    replaced: set[str]
    schema: T.StructType | None


def live(spark: SparkSession, path: str, hours: Sequence[str] | None = None) -> Live:
    """The state of some hours of a layer, or of all."""
    entries = log(spark, path)
    if entries is None:
        return Live([], set(), None)
    touched = F.array_distinct(F.concat("hours", "replaces"))
    if hours is not None:
        touched = F.array_intersect(touched, F.array(*[F.lit(h) for h in hours]))
    rows = entries.select("number", "run", F.explode(touched).alias("hour"), "hours", "replaces")
    rows = rows.select("number", "run", "hour", F.array_contains("hours", F.col("hour")).alias("holds"), F.array_contains("replaces", F.col("hour")).alias("replaces"))
    held: dict[str, list[str]] = {}
    replaced = set()
    for r in rows.orderBy("number").collect():
        if r["replaces"]:
            held[r["hour"]] = []
            replaced.add(r["hour"])
        if r["holds"]:
            held.setdefault(r["hour"], []).append(r["run"])
    parts = [(run, hour) for hour, runs in held.items() for run in runs]
    newest = entries.groupBy("schema").agg(F.max("number").alias("number"), F.collect_set("run").alias("runs")).orderBy("number").collect()
    used, columns = {run for run, _ in parts}, {}
    for r in newest:  # a row per schema the layer ever had
        if not used or used & set(r["runs"]):
            columns.update({f.name: f for f in T.StructType.fromJson(json.loads(r["schema"]))})
    return Live(parts, replaced, T.StructType(list(columns.values())))


def read(spark: SparkSession, path: str, state: Live, tolerant: bool = False) -> DataFrame:
    """The rows of the live runs: their hour folders only, with the columns the commits name, so no footer is read for the schema."""
    if not state.parts:
        return spark.createDataFrame([], state.schema)
    reader = spark.read.schema(state.schema).option("basePath", f"{path}/_runs")
    if tolerant:
        reader = reader.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
    return reader.parquet(*[f"{run_folder(path, run)}/{hour}" for run, hour in state.parts]).drop("run")
