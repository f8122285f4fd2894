"""The scheduled jobs, one function per job, on layer paths and the registry table.

Each function plans Spark jobs and returns decisions as DataFrames or small rows; when to run them is up to any scheduler.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airmill import constants as K
from airmill.operators import compare, drift, forest, labels, metrics, quality, registry
from airmill.plans import medallion
from airmill.session import discard, stored
from airmill.sources import commits, lake, messages


def ingest(
    spark: SparkSession, landing: str, bronze: str, processed_at: datetime, by_message_time: bool = True, most: int = messages.DRAIN_FILES
) -> DataFrame:
    """Landed files to bronze, each once; returns (reason, messages) of what this call read.

    Files are taken in rounds of ``most``. A round's rows and the names of its files become visible by the same commit, so a run that dies
    before it leaves no rows behind and its files unread.
    """
    told = spark.createDataFrame([], "reason string, messages bigint")
    while files := messages.unread_files(spark, landing, bronze, most):
        parsed = stored(medallion.parse_messages(messages.read_files(spark, [path for path, _ in files])))
        rows = medallion.bronze_rows(parsed, F.lit(processed_at), by_message_time)
        counts = medallion.ingest_quality(parsed).collect()  # a row per reason
        lake.commit_layer(rows, bronze, files=[name for _, name in files])
        told = told.unionByName(spark.createDataFrame(counts, told.schema))
        discard(parsed)
    return told.groupBy("reason").agg(F.sum("messages").alias("messages"))


def lead_in(spark: SparkSession, bronze: str, rows: DataFrame, first: datetime, needed: int = K.ROLLING_ROWS - 1) -> DataFrame:
    """Whole bronze hours before ``first`` that hold at least ``needed`` clean rows of every device of ``rows``.

    Goes back one hour, then four times as far until no device lacks rows, ``MAX_LOOKBACK_HOURS`` at most: a device that was silent for
    longer begins anew.
    """
    hours = 1
    while True:
        lead = lake.read_hours(spark, bronze, (first - timedelta(hours=hours), first - timedelta(hours=1)))
        if hours == K.MAX_LOOKBACK_HOURS:
            return lead
        clean = quality.keep_valid(lead, ["timestamp"]).select("timestamp", "device_id").distinct()
        held = clean.groupBy("device_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= needed)
        if rows.select("device_id").distinct().join(held, "device_id", "left_anti").isEmpty():
            return lead
        hours = min(4 * hours, K.MAX_LOOKBACK_HOURS)


def build_silver(
    spark: SparkSession, bronze: str, silver: str, now: datetime, hours: int = K.DEFAULT_LOOKBACK_HOURS, backfill_from: str = ""
) -> DataFrame | None:
    """Look-back window of bronze to silver; returns the quality row, or None when there is nothing to do.

    All hours of the window are replaced by one commit, also those that have no rows any more. Baselines belong to the hour and rolling
    values reach back before the window, so overlapping runs write the same rows.
    """
    window = lake.lookback(now, hours, backfill_from)
    rows = lake.require_rows(lake.read_hours(spark, bronze, window), "skip")
    if rows is None:
        return None
    lead = lead_in(spark, bronze, rows, window[0])
    lake.commit_layer(medallion.to_silver(rows, lead=lead), silver, replaces=commits.hour_folders(window))
    return quality.quality_metrics(rows, medallion.SILVER_KEYS, ["timestamp"])


def _labelled_window(spark: SparkSession, silver: str, now: datetime, days: tuple[int, int], tolerant: bool = False) -> DataFrame:
    rows = lake.require_rows(lake.read_hours(spark, silver, lake.days_back(now, days), tolerant))
    keyed = labels.with_label(quality.require_columns(rows, K.SENSOR_COLUMNS))
    return keyed.withColumn("row_key", F.xxhash64("timestamp", "device_id"))


def _scored(rows: DataFrame, models: dict[str, forest.ForestModel]) -> DataFrame:
    """(..., side, is_anomaly, predicted, outlierness) of labelled rows; all models score a row in the same pass."""
    kept = [c for c in ("is_anomaly", "split") if c in rows.columns]
    wide = rows.select(*kept, *[forest.score_column(rows, model).alias(side) for side, model in models.items()])
    offset = F.create_map(*[F.lit(v) for side, model in models.items() for v in (side, model.offset)])
    long = wide.unpivot(kept, list(models), "side", "_score")
    flagged = (F.col("_score") < offset[F.col("side")]).cast("int").alias("predicted")
    return long.select(*kept, "side", flagged, (-F.col("_score")).alias("outlierness"))


def train_model(
    spark: SparkSession, silver: str, models: str, versions: DataFrame, model_name: str, now: datetime, run_id: str
) -> tuple[DataFrame, DataFrame]:
    """Seven days of silver to a stored model; returns (metrics row with gate, version table after registration)."""
    rows = labels.require_anomalies(_labelled_window(spark, silver, now, K.TRAINING_DAYS))
    rows = stored(rows.select("row_key", "is_anomaly", *K.SENSOR_COLUMNS))
    parts = stored(labels.stratified_split(rows, "row_key"))
    rate = rows.agg(F.avg("is_anomaly")).first()[0]
    nodes, params = forest.train_tables(parts.where(F.col("split") == "train"), "row_key", rate=rate)
    forest.write_model(nodes, params, f"{models}/{run_id}")
    model = forest.read_model(spark, f"{models}/{run_id}")
    scored = _scored(quality.drop_nulls(parts, K.SENSOR_COLUMNS), {"candidate": model})
    report = stored(registry.registration_gate(metrics.evaluate(scored, ["split"], digits=12)))
    test = report.where(F.col("split") == "test")
    newest = F.coalesce(versions.where(F.col("model_name") == model_name).agg(F.max("version")).scalar(), F.lit(0)) + 1
    candidate = test.where(F.col("registered")).select(
        F.lit(model_name).alias("model_name"), newest.cast("bigint").alias("version"), F.lit(run_id).alias("run_id")
    )
    return report, registry.register(candidate, versions)


def run_inference(spark: SparkSession, silver: str, gold: str, model: forest.ForestModel, now: datetime) -> DataFrame | None:
    """The whole newest silver hour to gold; returns the anomaly extract, or None without input.

    A folder of gold belongs to one hour of silver, so scoring it again replaces it.
    """
    near = lake.read_hours(spark, silver, lake.hours_back(now, 2))
    recent = lake.latest_hour(quality.require_columns(near, K.SILVER_FEATURES), now)
    if recent.isEmpty():
        return None
    scored = stored(medallion.to_gold(recent, model))
    lake.commit_layer(scored, gold, replaces=None)
    return medallion.anomaly_extract(scored, "event_ts")


def check_drift(
    spark: SparkSession, silver: str, gold: str, reports: str, versions: DataFrame, now: datetime
) -> tuple[DataFrame, DataFrame]:
    """30 days of silver against 7 days of gold; writes the report, returns (feature report, retrain decision)."""
    reference = lake.require_rows(lake.read_hours(spark, silver, lake.days_back(now, K.REFERENCE_DAYS), tolerant=True))
    production = lake.require_rows(lake.read_hours(spark, gold, lake.days_back(now, K.PRODUCTION_DAYS), tolerant=True))
    report = stored(drift.drift_features(reference, drift.require_production_rows(production), exact_rows=K.KS_EXACT_ROWS))
    summary = drift.drift_summary(report)
    document = drift.drift_document(report, summary, F.lit(now.isoformat(sep=" ")))
    lake.write_report(document, reports, now)
    return report, drift.retrain_decision(summary, versions, ["model_name"])


def compare_models(
    spark: SparkSession, silver: str, champion: forest.ForestModel, challenger: forest.ForestModel, now: datetime
) -> dict[str, DataFrame]:
    """Both models on the same labelled week: metrics, deltas, recommendation and report tables."""
    window = _labelled_window(spark, silver, now, K.EVALUATION_DAYS, tolerant=True)
    rows = stored(quality.drop_nulls(window.select("row_key", "is_anomaly", *K.SENSOR_COLUMNS), K.SENSOR_COLUMNS))
    models = {"champion": champion, "challenger": challenger}
    result = stored(metrics.evaluate(stored(_scored(rows, models)), ["side"]))
    importance = lake.union_layers(
        [forest.permutation_importance(rows, model, "row_key").withColumn("side", F.lit(side)) for side, model in models.items()]
    )
    deltas = compare.metric_deltas(result)
    return {
        "metrics": result,
        "deltas": deltas,
        "recommendation": compare.recommendation(deltas),
        "report": compare.report_tables(result, stored(importance)),
    }
