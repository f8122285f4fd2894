"""Token totals by source, language and tokenizer version, maintained by deltas.

Changes are signed rows: +1 puts a document's count in, -1 takes out what was put in, a revised count is one of each. A batch of
changes is summed per group, map-side first, and written as one small table under its batch id; a marker written last commits
it. Committing a batch again does nothing, and a batch without marker (a lost driver) is overwritten by the next attempt and
never read. Totals are the sum of the committed deltas and of the last snapshot; ``compact`` folds deltas into a snapshot.

Cases: null source, language or tokenizer are groups of their own; null counts and null or zero signs add nothing to tokens
and documents; groups whose documents and tokens are all taken out disappear; repeated rows count each; extra columns are
ignored; empty batches commit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airmill.llm import packing

GROUP = ("source", "lang", "tokenizer")
SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long, batch string"


class Rollup:
    """Totals in a shared folder: ``deltas/<batch>``, ``commits/<batch>`` (markers) and ``snapshots/<batches>``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        jvm = spark.sparkContext._jvm
        self.path = jvm.org.apache.hadoop.fs.Path
        self.files = self.path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, kind: str) -> set[str]:
        at = self.path(f"{self.folder}/{kind}")
        return {s.getPath().getName() for s in self.files.listStatus(at)} if self.files.exists(at) else set()

    def _snapshot(self) -> tuple[str | None, set[str]]:
        """Newest snapshot and the batches in it; a snapshot is valid if Spark finished it."""
        done = [s for s in self._names("snapshots") if self.files.exists(self.path(f"{self.folder}/snapshots/{s}/totals/_SUCCESS"))]
        if not done:
            return None, set()
        newest = max(done, key=lambda s: int(s))
        return newest, {r[0] for r in self.spark.read.parquet(f"{self.folder}/snapshots/{newest}/batches").collect()}  # a name a batch

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Adds (source, lang, tokenizer, n_tokens, sign) rows once; False if the batch was committed before."""
        if batch in self._names("commits") or batch in self._snapshot()[1]:
            return False
        sign = F.coalesce(F.signum("sign"), F.lit(0)).cast("long")
        delta = changes.groupBy(*GROUP).agg(F.sum(sign).alias("n_docs"), F.sum(sign * F.coalesce("n_tokens", F.lit(0))).cast("long").alias("n_tokens"))
        delta.withColumn("batch", F.lit(batch)).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/deltas/{batch}")
        self.files.create(self.path(f"{self.folder}/commits/{batch}"), True).close()
        return True

    def totals(self) -> DataFrame:
        newest, inside = self._snapshot()
        paths = [f"{self.folder}/deltas/{b}" for b in sorted(self._names("commits") - inside)]
        if newest is not None:
            paths.append(f"{self.folder}/snapshots/{newest}/totals")
        rows = self.spark.read.schema(SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], SCHEMA)
        summed = rows.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return summed.where("n_docs <> 0 OR n_tokens <> 0")

    def compact(self) -> None:
        """Folds all committed deltas into a new snapshot; a failure leaves the old one in force."""
        newest, inside = self._snapshot()
        batches = inside | self._names("commits")
        at = f"{self.folder}/snapshots/{0 if newest is None else int(newest) + 1}"
        self.spark.createDataFrame([(b,) for b in sorted(batches)], "batch string").coalesce(1).write.mode("overwrite").parquet(f"{at}/batches")
        self.totals().withColumn("batch", F.lit("snapshot")).coalesce(1).write.mode("overwrite").parquet(f"{at}/totals")


def with_counts(docs: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """All columns but the text, and its number of ids; null texts have none."""
    rest = [c for c in docs.columns if c not in (text, out)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts = pa.array(np.fromiter((len(x) for x in packing.encode(b.column(len(rest)), path)), np.int64, b.num_rows))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(rest)], counts], names=[*rest, out])

    return docs.select(*rest, F.col(text)).mapInArrow(run, docs.select(*rest, F.lit(0).cast("long").alias(out)).schema)
