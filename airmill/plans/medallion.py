"""Layer plans: messages -> bronze -> silver -> gold, as lazy DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airmill import constants as K
from airmill.functions import air_quality, rules
from airmill.functions.parsing import parse_aliases, parse_messages
from airmill.operators import features, forest, quality
from airmill.session import stored
from airmill.sources import lake

BRONZE_COLUMNS = ["timestamp", "device_id", "version", *K.SENSOR_COLUMNS, "processed_at"]
SILVER_KEYS = ("timestamp", "device_id")


# --- bronze --------------------------------------------------------------------------------------------------------


def ingest_quality(parsed: DataFrame) -> DataFrame:
    """(reason, messages): 'valid' or the reason of rejection."""
    reason = F.coalesce(F.col("invalid_reason"), F.lit("valid")).alias("reason")
    return parsed.groupBy(reason).agg(F.count(F.lit(1)).alias("messages"))


def split_valid(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted rows and quarantined rows."""
    return parsed.where(F.col("invalid_reason").isNull()), parsed.where(F.col("invalid_reason").isNotNull())


def bronze_rows(
    parsed: DataFrame, processed_at: Column, by_message_time: bool = True
) -> DataFrame:
    """Accepted rows of parsed messages with baseline, score and partition columns; reads ``parsed`` twice."""
    rows = split_valid(parsed.withColumn("processed_at", processed_at))[0].select(*BRONZE_COLUMNS)
    base = features.gas_baseline(rows, min_rows=K.GAS_BASELINE_MIN_ROWS)
    rows = features.with_iaq(rows.withColumn("gas_resistance_raw", F.col("gas_resistance")), base)
    when = lake.partition_time(F.col("timestamp"), F.col("processed_at"), by_message_time)
    return lake.with_partitions(rows, when)


def to_bronze(
    messages: DataFrame, processed_at: Column, by_message_time: bool = True
) -> DataFrame:
    """Messages to bronze rows. The parsed rows are stored, because parsing costs more than reading them back."""
    return bronze_rows(stored(parse_messages(messages)), processed_at, by_message_time)


# --- silver --------------------------------------------------------------------------------------------------------


def clean(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """Null drop, range filter, newest row per key."""
    return quality.keep_latest(quality.keep_valid(df, [keys[0]]), keys, newest)


def silver_features(
    cleaned: DataFrame,
    ts: str,
    order: Sequence[str],
    groups: Sequence[str] = ("device_id",),
    hour: Sequence[str] = (),
) -> DataFrame:
    """Baseline, score, time parts, ratios and rolling statistics over cleaned rows; the baseline is that of all rows, or of each row's
    ``hour``.

    Baseline and features both read the cleaned rows, so these are stored instead of being cleaned again.
    """
    cleaned = stored(cleaned)
    if hour:
        rows = features.with_hourly_iaq(cleaned, features.hourly_baseline(cleaned, hour), hour)
    else:
        rows = features.with_iaq(cleaned, features.gas_baseline(cleaned))
    rows = features.ratios(features.time_parts(rows, ts))
    return features.rolling(rows, order, groups=groups)


def to_silver(bronze: DataFrame, groups: Sequence[str] = ("device_id",), at: Column | None = None, lead: DataFrame | None = None) -> DataFrame:
    """Silver rows of a bronze window, with partition columns.

    With ``lead``, whole bronze hours before the window, the rolling values of the window's first rows are complete and every hour has a
    baseline of its own, so a row does not depend on the window that it was computed in. Rows of ``lead`` are not returned.

    A row stays in the folder hour it has in bronze. A window reads whole bronze folders, so re-running overlapping
    windows replaces whole silver folders instead of repeating rows. Pass a processing time in ``at`` for the append-only
    layout. A time that cannot be read falls back to the processing time, as it does for the bronze folder.
    """
    folder = {c: F.col(c) for c in K.PARTITION_COLUMNS}
    hour = [f"_{c}" for c in folder] if lead is not None else []
    rows = bronze.select(*BRONZE_COLUMNS, F.struct(*folder.values()).alias("_folder"), F.lit(False).alias("_lead"))
    if lead is not None:
        before = lead.select(*BRONZE_COLUMNS, F.struct(*folder.values()).alias("_folder"), F.lit(True).alias("_lead"))
        rows = rows.unionByName(before).withColumns({f"_{c}": F.col(f"_folder.{c}") for c in folder})
    cleaned = clean(rows, SILVER_KEYS, ["processed_at", "gas_resistance", "temperature", "humidity", "pressure"])
    event_time = lake.partition_time(F.col("timestamp"), F.col("processed_at"))
    cleaned = cleaned.withColumn("event_ts", event_time)
    silver = silver_features(cleaned, "event_ts", ["event_ts", "timestamp"], groups, hour)
    silver = silver.where(~F.col("_lead")).drop("_lead", *hour)
    # the hour feature and the hour folder share a name; the feature keeps its own column in the files
    silver = silver.withColumnRenamed("hour", "hour_of_day")
    if at is not None:
        return lake.with_partitions(silver, at).drop("_folder")
    return silver.withColumns({c: F.col(f"_folder.{c}") for c in folder}).drop("_folder")


# --- gold ----------------------------------------------------------------------------------------------------------


def to_gold(silver: DataFrame, model: forest.ForestModel) -> DataFrame:
    """Silver with anomaly_score, decision_score, prediction, is_anomaly and outlierness."""
    return forest.with_prediction(forest.score(silver, model), model.offset)


def gold_rate(gold: DataFrame) -> DataFrame:
    """One row: total_records, anomaly_count, anomaly_rate."""
    one = gold.agg(F.count(F.lit(1)).alias("total_records"), F.coalesce(F.sum("is_anomaly"), F.lit(0)).alias("anomaly_count"))
    rate = F.coalesce(F.try_divide(F.col("anomaly_count").cast("double"), F.col("total_records")), F.lit(0.0))
    return one.withColumn("anomaly_rate", rate)


def anomaly_extract(gold: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Flagged rows, the alert columns that exist, second-resolution ISO time."""
    stamped = gold.where(F.col("is_anomaly") == 1).withColumn("timestamp", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
    return stamped.select(*[c for c in K.ALERT_COLUMNS if c in stamped.columns])


def first_alerts(gold: DataFrame, order: Sequence[str], limit: int = K.ALERT_LIMIT) -> DataFrame:
    """The first anomalies in row order (a top-k, not a sort)."""
    return gold.where(F.col("is_anomaly") == 1).orderBy(*order).limit(limit)


def hourly_rate(gold: DataFrame, ts: str = "ts") -> DataFrame:
    """(hour_start, total, anomalies, rate) per hour of event time."""
    hour = F.date_trunc("hour", F.col(ts)).cast("timestamp_ntz").alias("hour_start")
    out = gold.groupBy(hour).agg(F.count(F.lit(1)).alias("total"), F.sum("is_anomaly").alias("anomalies"))
    return out.withColumn("rate", F.col("anomalies") / F.col("total"))


# --- per-reading scorer ----------------------------------------------------------------------------------------------


def score_readings(df: DataFrame, anomaly_score: Column, offset: Column | float) -> DataFrame:
    """The scorer's record for every reading: model decision, index, labels, rule match and override.

    A stateless projection: the same function serves batch tables and streams.
    """
    t, h, p, g = (F.col(c) for c in K.SENSOR_COLUMNS)
    cut = offset if isinstance(offset, Column) else F.lit(float(offset))
    ready = df.withColumn("_decision", anomaly_score - cut).withColumn("_iaq", air_quality.iaq_v2(g, h))
    ready = ready.withColumn("_rule", rules.correlation_rule(t, h, p, g))
    final = rules.apply_override(F.col("_rule"), F.col("_decision") < 0)
    ready = ready.withColumn("_final", final)
    return ready.select(
        *df.columns,
        F.col("_final.is_anomaly").alias("is_anomaly"),
        F.col("_final.anomaly_type").alias("anomaly_type"),
        F.col("_final.severity").alias("severity"),
        F.col("_iaq").alias("iaq_v2"),
        air_quality.air_label(F.col("_iaq")).alias("air_quality"),
        rules.contributing_factors(t, h, g).alias("contributing_factors"),
        F.round("_decision", 4).alias("decision_score"),
        air_quality.score_band(F.col("_decision")).alias("score_meaning"),
    )


def response_json(scored: DataFrame) -> DataFrame:
    """Add ``response``: the scored record as JSON with its status code.

    A row whose ``status`` (if there is one) is not 200 gets an error record that names the first unusable field.
    """
    fields = [
        "is_anomaly",
        "anomaly_type",
        "severity",
        F.col("iaq_v2").alias("iaq_score"),
        "air_quality",
        "contributing_factors",
        "decision_score",
        "score_meaning",
    ]
    record = F.to_json(F.struct(F.lit(200).alias("statusCode"), F.struct(*fields).alias("body")))
    if "status" not in scored.columns:
        return scored.withColumn("response", record)
    unusable = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(c)) for c in K.SENSOR_COLUMNS])
    error = F.struct(F.concat(F.lit("unusable_field:"), unusable).alias("error"))
    failed = F.to_json(F.struct(F.col("status").alias("statusCode"), error.alias("body")))
    return scored.withColumn("response", F.when(F.col("status") == 200, record).otherwise(failed))


def respond(events: DataFrame, anomaly_score: Column, offset: Column | float, body: str = "body") -> DataFrame:
    """The scorer's whole path: raw event, field aliases, score, response record."""
    return response_json(score_readings(parse_aliases(events, body), anomaly_score, offset))
