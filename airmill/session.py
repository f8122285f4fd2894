"""Session construction, the shared checkpoint folder and tables stored in it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a repeated key in a message is no error, its last value counts
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.ui.enabled": "false",
}


def get_session(app: str = "airmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own: on a cluster a machine-local folder would be
    lost together with its executor, so there the missing setting is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not named:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a shared folder")
            named = tempfile.mkdtemp(prefix="airmill-checkpoint-")
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def stored(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the checkpoint folder and read it back; ``compression`` is a Parquet codec, else the session's.

    Cuts the lineage like a checkpoint and survives lost executors, but is columnar: later reads are compressed and fetch
    only the columns they use. ``discard`` removes the table when all that reads it is done.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/airmill-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def file_system(spark: SparkSession, path: str) -> tuple:
    """Spark's own file system of ``path`` and a function that makes paths for it."""
    of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return of(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), of


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` returned. Nothing that still has to read them may be left."""
    for df in tables:
        files, of = file_system(df.sparkSession, df._stored_at)
        files.delete(of(df._stored_at), True)
