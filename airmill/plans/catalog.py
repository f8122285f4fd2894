"""The registered queries: one callable (spark, folder) -> DataFrame per operator.

Doubles are rounded for output so that engines with another summation order print the same value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airmill import constants as K
from airmill.functions import air_quality, parsing, rules
from airmill.operators import compare, drift, features, forest, labels, metrics, ordered, quality, quantiles, registry
from airmill.plans import medallion, workflows
from airmill.session import ensure_checkpoint_dir, file_system, stored
from airmill.sources import commits, fixtures, lake, messages
from airmill.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

# "Now" of the look-back queries, inside the range of the events table.
NOW = datetime(2024, 1, 30, 12, 34)
#: The hour whose files are spoiled.
SPOILED = "year=2024/month=01/day=17/hour=05"
KEYS, NEWEST, ORDER = ("ts", "device_id"), ["copy_no", "event_id"], ["ts", "event_id"]
CHAMPION_SHARE, CHALLENGER_SHARE = 0.03, 0.06


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = {f.name: F.round(f.name, digits) for f in df.schema.fields if f.dataType.typeName() == "double"}
    return df.withColumns(doubles) if doubles else df


# --- shared inputs -----------------------------------------------------------------------------------------------


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    """Stored, as the baseline and the rows are both read from it."""
    return stored(medallion.clean(fixtures.bronze(spark, folder), KEYS, NEWEST))


def scored_silver(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned rows with baseline and score (no windows)."""
    rows = cleaned(spark, folder)
    return features.with_iaq(rows, features.gas_baseline(rows))


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    return labels.with_label(scored_silver(spark, folder))


def model_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Evaluation rows scored by both literal forests, long by ``model``.

    Each model's cut-off is a quantile of its own scores at its contamination, held in a scalar subquery. Metrics read the rows more than
    once, so they are stored.
    """
    rows = labelled(spark, folder).select("event_id", "ts", "is_anomaly", *K.SENSOR_COLUMNS)
    scored = rows.select(
        "event_id",
        "ts",
        "is_anomaly",
        forest.box_score(fixtures.CHAMPION_BOXES).alias("champion"),
        forest.box_score(fixtures.CHALLENGER_BOXES).alias("challenger"),
    )
    long = scored.unpivot(["event_id", "ts", "is_anomaly"], ["champion", "challenger"], "model", "score")
    plain = fixtures.readings(spark, folder).select(
        forest.box_score(fixtures.CHAMPION_BOXES).alias("champion"),
        forest.box_score(fixtures.CHALLENGER_BOXES).alias("challenger"),
    )
    cuts = quantiles.summarise(
        quantiles.melt(plain, ["champion", "challenger"]), [], [CHAMPION_SHARE, CHALLENGER_SHARE], ["feature"]
    )
    own = F.when(F.col("feature") == "champion", F.col("q")[0]).otherwise(F.col("q")[1])
    cut_map = cuts.agg(F.map_from_entries(F.collect_list(F.struct("feature", own)))).scalar()
    flagged = (F.col("score") < F.col("_cuts")[F.col("model")]).cast("int")
    return stored(
        long.withColumn("_cuts", cut_map).select(
            "event_id", "ts", "model", "is_anomaly", flagged.alias("predicted"), (-F.col("score")).alias("outlierness")
        )
    )


def model_metrics(spark: SparkSession, folder: str) -> DataFrame:
    out = metrics.evaluate(model_rows(spark, folder), ["model"])
    return out.withColumnRenamed("model", "side")


def gold(spark: SparkSession, folder: str) -> DataFrame:
    """Scored rows with the champion forest, columns of the gold layer."""
    rows = scored_silver(spark, folder)
    scored = rows.withColumn("anomaly_score", forest.box_score(fixtures.CHAMPION_BOXES))
    # cut-off between the paths of smoky and hot rows
    return forest.with_prediction(scored, -(2.0 ** (-2.0 / forest.average_path_length(K.SUBSAMPLE))))


def sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = fixtures.readings(spark, folder)
    start = F.lit(fixtures.DRIFT_START).cast("timestamp_ntz")
    return rows.where(F.col("ts") < start), rows.where(F.col("ts") >= start)


def day_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Metric rows by (day, matchup, side): the pair in both directions and the champion against itself."""
    rows = model_rows(spark, folder).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    by_day = metrics.evaluate(rows, ["day", "model"])
    roles = {"forward": ("champion", "challenger"), "reverse": ("challenger", "champion"), "self": ("champion", "champion")}
    seats = []
    for matchup, (champion, challenger) in roles.items():
        for side, model in (("champion", champion), ("challenger", challenger)):
            seat = F.struct(F.lit(matchup).alias("matchup"), F.lit(side).alias("side"))
            seats.append(F.when(F.col("model") == model, seat))
    seated = by_day.withColumn("_seat", F.explode(F.array_compact(F.array(*seats))))
    return seated.select("*", "_seat.matchup", "_seat.side").drop("_seat", "model")


# --- sources and windows -------------------------------------------------------------------------------------------


def _hour_of(ts: str = "ts"):
    return F.date_trunc("hour", F.col(ts)).cast("timestamp_ntz")


def scan_lookback_hours(spark, folder):
    return fixtures.readings(spark, folder).where(lake.in_hours(lake.lookback(NOW, 2), _hour_of())).select("event_id", "ts")


def scan_backfill(spark, folder):
    bounds = lake.lookback(NOW, 2, "2024-01-28 06:15", wall_clock=NOW)
    return fixtures.readings(spark, folder).where(lake.in_hours(bounds, _hour_of())).select("event_id", "ts")


def scan_day_windows(spark, folder):
    windows = {
        "training": K.TRAINING_DAYS,
        "reference": K.REFERENCE_DAYS,
        "production": K.PRODUCTION_DAYS,
        "evaluation": K.EVALUATION_DAYS,
    }
    one = fixtures.readings(spark, folder).agg(
        *[F.count_if(lake.in_days(NOW, days, _hour_of())).alias(name) for name, days in windows.items()]
    )
    return one.unpivot([], list(windows), "window", "rows")


def scan_latest_hour(spark, folder):
    return lake.latest_hour(fixtures.readings(spark, folder), NOW, _hour_of()).select("event_id", "ts")


def _parsed(spark, folder):
    return parsing.parse_messages(fixtures.messages(spark, folder))


def _valid(spark, folder):
    return medallion.split_valid(_parsed(spark, folder))[0]


def bronze_partition_counts(spark, folder):
    key = lake.partition_key(lake.partition_time(F.col("ts").cast("string"), F.col("ts")))
    return _valid(spark, folder).groupBy(key.alias("partition_key")).agg(F.count(F.lit(1)).alias("rows"))


def _hour_counts(rows: DataFrame) -> DataFrame:
    """(partition_key, rows, sum_temperature) of a layer read back."""
    key = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.col(c)) for c in K.PARTITION_COLUMNS]).alias("partition_key")
    return lake.padded(rows).groupBy(key).agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("temperature"), 3).alias("sum_temperature"))


def bronze_layer(spark, folder):
    """Messages landed in three parts and ingested: a run dies between writing and committing, another finds nothing new."""
    base = f"{ensure_checkpoint_dir(spark)}/landed-{uuid.uuid4().hex}"
    rows, processed = fixtures.readings(spark, folder), datetime(2024, 2, 1, 3)
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp")
    whole = F.to_json(F.struct(stamp, "device_id", F.struct(*K.SENSOR_COLUMNS).alias("sensors")))
    body = F.when(F.col("event_id") % 10 == 8, F.lit("no json")).otherwise(whole).alias("value")
    for part in range(3):
        rows.where(F.col("event_id") % 3 == part).select(body).write.mode("append").text(f"{base}/in")
        if part == 1:
            unread = [path for path, _ in messages.unread_files(spark, f"{base}/in", f"{base}/bronze")]
            lake.stage_layer(medallion.to_bronze(messages.read_files(spark, unread), F.lit(processed)), f"{base}/bronze")
        workflows.ingest(spark, f"{base}/in", f"{base}/bronze", processed)
    workflows.ingest(spark, f"{base}/in", f"{base}/bronze", processed)
    return _hour_counts(lake.read_layer(spark, f"{base}/bronze"))


def _landed(spark, folder, base: str, part: Column) -> None:
    """Readings with their defects as message files: a null leaves its field out, every seventh row is no message at all."""
    rows = fixtures.bronze(spark, folder).where(part)
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp")
    whole = F.to_json(F.struct(stamp, "device_id", F.struct(*K.SENSOR_COLUMNS).alias("sensors")))
    rows.select(F.when(F.col("event_id") % 7 == 6, F.lit("no json")).otherwise(whole).alias("value")).write.mode("append").text(f"{base}/in")


def _bronze_stream(spark, base: str) -> None:
    stream = messages.stream_messages(spark, f"{base}/in", drain=True)
    jobs.start_bronze(stream, f"{base}/bronze", f"{base}/quarantine", f"{base}/bronze-mark").awaitTermination()


def stream_bronze(spark, folder):
    """Landed messages through the bronze stream, which stops half-way, goes on from its checkpoint, and finds nothing new at last."""
    base = f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    for part in range(2):
        _landed(spark, folder, base, F.col("event_id") % 2 == part)
        _bronze_stream(spark, base)
    _bronze_stream(spark, base)
    kept = _hour_counts(lake.read_layer(spark, f"{base}/bronze")).withColumn("reason", F.lit("valid"))
    away = spark.read.parquet(f"{base}/quarantine").groupBy(F.col("invalid_reason").alias("reason")).agg(F.count(F.lit(1)).alias("rows"))
    return kept.unionByName(away, allowMissingColumns=True)


def stream_silver(spark, folder):
    """Bronze and silver streams in turns, stopped and restarted; copies of a reading lie in one half or in both."""
    base = f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    for part in range(2):
        _landed(spark, folder, base, (F.col("event_id") + F.col("copy_no")) % 2 == part)
        _bronze_stream(spark, base)
        # the columns of the layer, folder columns included, as its first batch wrote them
        schema = lake.read_layer(spark, f"{base}/bronze").schema
        bronze = spark.readStream.schema(schema).parquet(f"{base}/bronze")
        jobs.start_silver(bronze, f"{base}/silver", f"{base}/silver-mark").awaitTermination()
    return _hour_counts(lake.read_layer(spark, f"{base}/silver")).select("partition_key", "rows")


def stream_hourly_rate(spark, folder):
    """Hours that the watermark has closed, from a stream that stops before the newest week and goes on from its checkpoint."""
    base = f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    rows = stored(gold(spark, folder).select("ts", "is_anomaly"))
    start = F.lit(fixtures.DRIFT_START).cast("timestamp_ntz")
    for part, inside in enumerate((F.col("ts") < start, F.col("ts") >= start)):
        rows.where(inside).write.parquet(f"{base}/in/{part}")
        stream = spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).parquet(f"{base}/in")
        jobs.start_append(jobs.hourly_anomaly_rate(stream, "ts"), f"{base}/rate", f"{base}/mark").awaitTermination()
    closed = spark.read.parquet(f"{base}/rate")
    return _rounded(closed.withColumn("hour_start", F.col("hour_start").cast("timestamp_ntz")))


def tolerant_scan(spark, folder):
    """A layer in which the files of one hour are spoiled: rows per hour of a tolerant read, and how much of the hour was skipped."""
    path = f"{ensure_checkpoint_dir(spark)}/spoiled-{uuid.uuid4().hex}"
    rows = fixtures.readings(spark, folder)
    lake.write_layer(lake.with_partitions(rows, F.col("ts")), path)
    files, of = file_system(spark, path)
    for status in files.globStatus(of(f"{path}/{SPOILED}/*.parquet")):
        out = files.create(status.getPath(), True)
        out.write(bytearray(b"PAR1, but no footer PAR1"))
        out.close()
    report = lake.scan_report(spark, path, rows.schema)
    hour = F.regexp_extract("file", "year=[^/]+/month=[^/]+/day=[^/]+/hour=[^/]+", 0).alias("partition_key")
    told = F.max(F.when(F.col("status") != "whole", F.col("status")))
    return report.groupBy(hour).agg(F.sum("rows").alias("rows"), F.coalesce(told, F.lit("whole")).alias("status"))


def layer_lookback(spark, folder):
    """A day of a layer whose every hour was written wrong, replaced, and half replaced again by a run that died."""
    path = f"{ensure_checkpoint_dir(spark)}/layer-{uuid.uuid4().hex}"
    window = lake.lookback(NOW, 24)
    rows = stored(lake.with_partitions(fixtures.readings(spark, folder).where(lake.in_hours(lake.lookback(NOW, 48), _hour_of())), F.col("ts")))
    wrong = rows.withColumn("temperature", F.lit(-1.0))
    lake.commit_layer(wrong.unionByName(wrong), path)
    lake.commit_layer(rows, path, replaces=commits.hour_folders(lake.lookback(NOW, 48)))
    lake.stage_layer(wrong, path)
    return _hour_counts(lake.read_hours(spark, path, window))


def silver_two_runs(spark, folder):
    """Silver of the whole table from overlapping windows, the last one short: the same rows as in one run."""
    base = f"{ensure_checkpoint_dir(spark)}/runs-{uuid.uuid4().hex}"
    rows = fixtures.readings(spark, folder).select(
        F.col("ts").cast("string").alias("timestamp"), "device_id", F.lit("1").alias("version"), *K.SENSOR_COLUMNS,
        F.lit(datetime(2024, 2, 1)).cast("timestamp_ntz").alias("processed_at"), "ts",
    )
    lake.commit_layer(lake.with_partitions(rows, F.col("ts")).drop("ts"), f"{base}/bronze")
    for now, hours in ((datetime(2024, 1, 16, 0, 30), 400), (datetime(2024, 1, 31, 0, 30), 400), (datetime(2024, 1, 20, 5, 30), 3)):
        workflows.build_silver(spark, f"{base}/bronze", f"{base}/silver", now, hours)
    names = ["gas_baseline", "iaq_score", *[f"{c}_rolling_{k}" for c in ("temperature", "iaq_score") for k in ("mean", "std")]]
    return _rounded(lake.read_layer(spark, f"{base}/silver").select("timestamp", "device_id", "temperature", *names))


def partition_key_modes(spark, folder):
    rows = fixtures.readings(spark, folder)
    text = F.when(F.col("event_id") % 5 == 0, F.lit("soon")).when(F.col("event_id") % 7 != 0, F.col("ts").cast("string"))
    processed = F.lit("2024-02-01 03:04:05").cast("timestamp_ntz")
    return rows.select(
        "event_id",
        lake.partition_key(lake.partition_time(text, processed)).alias("by_message_time"),
        lake.partition_key(lake.partition_time(text, processed, False)).alias("by_processing_time"),
    )


def union_by_name(spark, folder):
    rows = fixtures.readings(spark, folder)
    old = rows.where(F.col("ts") < F.lit(fixtures.DRIFT_START).cast("timestamp_ntz")).select("event_id", "temperature")
    new = rows.where(F.col("ts") >= F.lit(fixtures.DRIFT_START).cast("timestamp_ntz")).select("humidity", "event_id")
    return _rounded(lake.union_layers([old, new]))


# --- parsing -------------------------------------------------------------------------------------------------------


def parse_envelopes(spark, folder):
    read = parsing.unwrap_envelope(fixtures.messages(spark, folder))
    return read.select("event_id", "envelope", F.try_variant_get("doc", "$.pressure", "double").alias("pressure"))


def parse_flat_nested(spark, folder):
    return _parsed(spark, folder).select("event_id", "layout", "device_id", "version", "gas_resistance")


def missing_fields(spark, folder):
    return _parsed(spark, folder).select("event_id", F.concat_ws(",", "missing").alias("missing"))


def bronze_parse(spark, folder):
    return _rounded(_valid(spark, folder).select("event_id", *K.SENSOR_COLUMNS))


def ingest_quality(spark, folder):
    return medallion.ingest_quality(_parsed(spark, folder))


def alias_fields(spark, folder):
    return _rounded(parsing.parse_aliases(fixtures.scorer_events(spark, folder)).drop("body"))


# --- quality -------------------------------------------------------------------------------------------------------


def silver_nulls(spark, folder):
    kept = quality.drop_nulls(fixtures.bronze(spark, folder), [*K.SENSOR_COLUMNS, "ts"])
    return _rounded(kept.select("event_id", "copy_no", "humidity"))


def null_profile(spark, folder):
    return quality.null_profile(fixtures.bronze(spark, folder), [*K.SENSOR_COLUMNS, "ts"])


def silver_valid(spark, folder):
    return _rounded(quality.keep_valid(fixtures.bronze(spark, folder), ["ts"]).select("event_id", "copy_no", "pressure"))


def range_violations(spark, folder):
    return quality.range_violations(fixtures.bronze(spark, folder), required=["ts"])


def silver_dedup(spark, folder):
    return _rounded(cleaned(spark, folder))


def quality_metrics(spark, folder):
    return _rounded(quality.quality_metrics(fixtures.bronze(spark, folder), KEYS, ["ts"]))


# --- scalar functions ------------------------------------------------------------------------------------------------


def iaq_v1(spark, folder):
    rows = fixtures.readings(spark, folder)
    score = air_quality.iaq_score(F.col("gas_resistance"), F.col("humidity"), F.lit(55000.0))
    return rows.select("event_id", score.alias("iaq_score"))


def iaq_v2(spark, folder):
    rows = fixtures.readings(spark, folder)
    return rows.select("event_id", air_quality.iaq_v2(F.col("gas_resistance"), F.col("humidity")).alias("iaq_v2"))


def air_label(spark, folder):
    rows = fixtures.readings(spark, folder).withColumn("index", (F.col("event_id") % 351).cast("int"))
    label = air_quality.air_label(F.col("index")).alias("label")
    return rows.groupBy(label).agg(F.count(F.lit(1)).alias("rows"), F.min("index").alias("low"), F.max("index").alias("high"))


def score_band(spark, folder):
    rows = fixtures.readings(spark, folder).withColumn("decision", (F.col("event_id") % 61 - 50) / F.lit(200.0))
    band = air_quality.score_band(F.col("decision")).alias("band")
    return _rounded(rows.groupBy(band).agg(F.count(F.lit(1)).alias("rows"), F.min("decision").alias("low")))


def _spread_readings(spark, folder):
    """Readings stretched over the whole range of the rules."""
    return fixtures.readings(spark, folder).selectExpr(
        "event_id",
        "15.0e0 + event_id % 23 AS temperature",
        "20.0e0 + event_id % 61 AS humidity",
        "995.0e0 + event_id % 21 AS pressure",
        "CASE WHEN event_id % 3 = 0 THEN 160000.0e0 ELSE 10000.0e0 + (event_id * 7919) % 150000 END AS gas_resistance",
    )


def factor_arrays(spark, folder):
    rows = _spread_readings(spark, folder)
    found = rules.contributing_factors(F.col("temperature"), F.col("humidity"), F.col("gas_resistance"))
    return rows.select("event_id", F.concat_ws(",", found).alias("factors"))


def _rule():
    return rules.correlation_rule(*[F.col(c) for c in K.SENSOR_COLUMNS])


def correlation_rules(spark, folder):
    return _spread_readings(spark, folder).withColumn("r", _rule()).select("event_id", "r.anomaly_type", "r.severity")


def rule_override(spark, folder):
    rows = _spread_readings(spark, folder).withColumn("r", _rule())
    return rows.withColumn("o", rules.apply_override(F.col("r"), F.col("event_id") % 2 == 0)).select("event_id", "o.*")


def score_readings(spark, folder):
    rows = fixtures.readings(spark, folder).select("event_id", *K.SENSOR_COLUMNS)
    scored = medallion.score_readings(rows, forest.box_score(fixtures.CHALLENGER_BOXES), -0.75)
    scored = scored.withColumn("contributing_factors", F.concat_ws(",", "contributing_factors"))
    return scored.drop(*K.SENSOR_COLUMNS)


def scorer_responses(spark, folder):
    """Raw scorer events to response records with status 200, 400 or 500, whose JSON is read back whole.

    ``is_anomaly`` and ``iaq_score`` are text, because a missing boolean or number has no common client-side type.
    """
    told = medallion.respond(fixtures.scorer_events(spark, folder), forest.box_score(fixtures.CHALLENGER_BOXES), -0.75)
    kinds = {
        "is_anomaly": "string", "anomaly_type": "string", "severity": "string", "iaq_score": "string", "air_quality": "string",
        "contributing_factors": "array<string>", "decision_score": "double", "score_meaning": "string", "error": "string",
    }
    body = "struct<" + ", ".join(f"{name}: {kind}" for name, kind in kinds.items()) + ">"
    read = told.select("event_id", F.from_json("response", f"statusCode int, body {body}").alias("r"))
    factors = F.when(F.col("contributing_factors").isNotNull(), F.concat_ws(",", "contributing_factors"))
    return read.select("event_id", F.col("r.statusCode").alias("status"), "r.body.*").withColumn("contributing_factors", factors)


def ratio_features(spark, folder):
    rows = features.ratios(fixtures.readings(spark, folder))
    return _rounded(rows.select("event_id", "temp_humidity_ratio", "gas_pressure_ratio"))


def time_features(spark, folder):
    return features.time_parts(fixtures.readings(spark, folder)).select("event_id", "hour", "day_of_week", "is_weekend")


def parse_ts(spark, folder):
    rows = fixtures.readings(spark, folder)
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = F.when(F.col("event_id") % 4 == 0, F.lit("yesterday")).when(F.col("event_id") % 2 == 0, iso)
    text = text.otherwise(F.col("ts").cast("string"))
    return rows.select("event_id", text.try_cast("timestamp_ntz").alias("event_ts"))


def clip_values(spark, folder):
    rows = fixtures.readings(spark, folder)
    return _rounded(rows.select("event_id", air_quality.clip(F.col("temperature"), 28.0, 33.0).alias("temperature")))


def domain_label(spark, folder):
    return labelled(spark, folder).select("event_id", "is_anomaly")


def label_rate_preview(spark, folder):
    rows = fixtures.readings(spark, folder)
    score = air_quality.iaq_score(F.col("gas_resistance"), F.col("humidity"), F.lit(55000.0))
    rows = labels.with_label(rows.withColumn("iaq_score", score), K.PREVIEW_LABEL_LIMITS)
    return _rounded(labels.label_rate(rows))


def scale_features(spark, folder):
    rows = fixtures.readings(spark, folder)
    scaled = forest.scale_features(rows, forest.fit_scaler(rows))
    return _rounded(scaled.select("event_id", *[f"{c}_scaled" for c in K.SENSOR_COLUMNS]))


# --- aggregates ----------------------------------------------------------------------------------------------------


def gas_baseline(spark, folder):
    return _rounded(features.gas_baseline(fixtures.readings(spark, folder), min_rows=K.GAS_BASELINE_MIN_ROWS))


def silver_iaq(spark, folder):
    return _rounded(scored_silver(spark, folder).select("event_id", "copy_no", "gas_baseline", "iaq_score"))


def gas_summary(spark, folder):
    return _rounded(features.gas_summary(fixtures.readings(spark, folder)))


def sensor_profile(spark, folder):
    return _rounded(features.sensor_profile(scored_silver(spark, folder)))


def anomaly_rate(spark, folder):
    return _rounded(labels.label_rate(labelled(spark, folder)))


def rule_breakdown(spark, folder):
    return labels.rule_breakdown(scored_silver(spark, folder))


def silver_anomaly_rate(spark, folder):
    """Flagship: defects -> clean -> baseline and score -> label -> rate per device."""
    rated = labelled(spark, folder).groupBy("device_id").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("is_anomaly").alias("anomalies"), F.avg("iaq_score").alias("mean_iaq")
    )
    return _rounded(rated.withColumn("rate", F.col("anomalies") / F.col("rows")))


def silver_features(spark, folder):
    return _rounded(medallion.silver_features(cleaned(spark, folder), "ts", ORDER))


# --- rolling -------------------------------------------------------------------------------------------------------


def _with_score(spark, folder):
    score = air_quality.iaq_score(F.col("gas_resistance"), F.col("humidity"), F.lit(55000.0))
    return fixtures.readings(spark, folder).withColumn("iaq_score", score)


def _rolled(df, suffix):
    return _rounded(df.select("event_id", *[f"{c}_rolling_{suffix}" for c in K.ROLLING_COLUMNS]))


def rolling_mean(spark, folder):
    return _rolled(features.rolling(_with_score(spark, folder), ORDER), "mean")


def rolling_std(spark, folder):
    return _rolled(features.rolling(_with_score(spark, folder), ORDER), "std")


def rolling_global(spark, folder):
    rows = features.rolling(_with_score(spark, folder), ORDER, groups=())
    return _rounded(rows.select("event_id", *[f"{c}_rolling_{s}" for c in K.ROLLING_COLUMNS for s in ("mean", "std")]))


def rolling_device_blocks(spark, folder):
    """Per device through numbered blocks, the plan for devices that are too large for one task."""
    rows = features.rolling(_with_score(spark, folder), ORDER, block_rows=5000)
    return _rolled(rows, "mean")


# --- drift ---------------------------------------------------------------------------------------------------------


def _drift_run(spark, folder):
    long = drift.both_sides(*sides(spark, folder))
    return drift.running_counts(drift.value_counts(long)), long


def describe_offset_channel(spark, folder):
    """A channel with a high level and a small spread, where sums of squares lose the deviation."""
    value = F.lit(1e5) + (F.col("event_id") * 7919 % 41 - 20) / 2000.0
    frames = [df.select("event_id", value.alias("gas_resistance")) for df in sides(spark, folder)]
    long = drift.both_sides(*frames, features=["gas_resistance"])
    out = drift.describe(drift.running_counts(drift.value_counts(long)), long)
    return _rounded(out.select("side", "count", "mean", "std", "min", "max"))


def _drift_counts(spark, folder):
    return drift.value_counts(drift.both_sides(*sides(spark, folder)))


def describe_distribution(spark, folder):
    return _rounded(drift.describe(*_drift_run(spark, folder)))


def feature_summary(spark, folder):
    return _rounded(drift.feature_summary(drift.both_sides(*sides(spark, folder))))


def _drift_histogram(spark, folder):
    return drift.histogram(drift.as_counts(drift.both_sides(*sides(spark, folder))))


def feature_histogram(spark, folder):
    hist = _drift_histogram(spark, folder)
    return hist.select("feature", "bin", F.col("e").alias("reference"), F.col("a").alias("production"))


def psi(spark, folder):
    return _rounded(drift.divergences(_drift_histogram(spark, folder)).select("feature", "psi"))


def kl_divergence(spark, folder):
    return _rounded(drift.divergences(_drift_histogram(spark, folder)).select("feature", "kl_divergence"))


def ks_statistic(spark, folder):
    return _rounded(drift.ks_test(_drift_run(spark, folder)[0]).select("feature", "ks_statistic"))


def ks_statistic_ranges(spark, folder):
    """KS with cumulative counts over value ranges, the plan for many distinct values."""
    run = drift.running_counts(_drift_counts(spark, folder))
    return _rounded(drift.ks_test(run).select("feature", "ks_statistic"))


def ks_pvalue(spark, folder):
    return _rounded(drift.ks_test(_drift_run(spark, folder)[0]).select("feature", "ks_pvalue"))


def ks_pvalue_exact(spark, folder):
    """Reference against production per device and sensor, with the exact law up to ``KS_EXACT_ROWS`` rows a side."""
    start = F.lit(fixtures.DRIFT_START).cast("timestamp_ntz")
    side = F.when(F.col("ts") < start, "reference").otherwise("production")
    long = quantiles.melt(fixtures.readings(spark, folder).withColumn("side", side), K.SENSOR_COLUMNS, ["device_id", "side"])
    named = long.select(F.concat_ws(".", "device_id", "feature").alias("feature"), "side", "x")
    tested = drift.ks_test(drift.running_counts(drift.value_counts(named)), K.KS_EXACT_ROWS)
    return _rounded(tested.select("feature", "n_e", "n_a", "ks_statistic", "ks_pvalue"))


def _report(spark, folder):
    return drift.drift_features(*sides(spark, folder))


def mean_std_shift(spark, folder):
    return _report(spark, folder).select("feature", "mean_shift", "std_shift")


def drift_features(spark, folder):
    return _report(spark, folder).drop("reference", "production")


def drift_summary(spark, folder):
    out = drift.drift_summary(_report(spark, folder))
    return out.withColumns({c: F.concat_ws(",", c) for c in ("psi_violations", "ks_violations")})


def retrain_decision(spark, folder):
    summary = drift.drift_summary(_report(spark, folder))
    return drift.retrain_decision(summary, fixtures.versions(spark, folder), ["model_name"])


# --- training and evaluation -------------------------------------------------------------------------------------------


def fit_scaler(spark, folder):
    return _rounded(forest.fit_scaler(fixtures.readings(spark, folder)), 8)


def _split(spark, folder):
    """The split reads its input three times, so the labelled rows are stored once."""
    hashed = (F.col("event_id") * 7919 + 42) % 100003
    rows = stored(labelled(spark, folder).select("event_id", "is_anomaly"))
    return labels.stratified_split(rows, "event_id", hashed=hashed, modulus=100003)


def stratified_split(spark, folder):
    return _split(spark, folder).select("event_id", "is_anomaly", "split")


def split_balance(spark, folder):
    return _rounded(labels.split_balance(_split(spark, folder)))


def training_set(spark, folder):
    return _rounded(labels.training_set(labelled(spark, folder)))


def label_thresholds(spark, folder):
    return _rounded(labels.label_thresholds(labelled(spark, folder)))


def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(model_rows(spark, folder), ["model"])


def confusion_share(spark, folder):
    return _rounded(metrics.confusion_share(metrics.confusion_matrix(model_rows(spark, folder), ["model"]), ["model"]))


def classification_metrics(spark, folder):
    return _rounded(metrics.classification_metrics(model_rows(spark, folder), ["model"]))


def roc_auc(spark, folder):
    return _rounded(metrics.roc_auc(_auc_rows(spark, folder), []))


def _auc_rows(spark, folder):
    """Label against a continuous score with many distinct values."""
    rows = labels.with_label(_with_score(spark, folder))
    score = F.col("iaq_score") + F.abs(F.col("temperature") - 31.0)
    return rows.select("is_anomaly", F.lit(0).alias("predicted"), score.alias("outlierness"))


def roc_auc_ranges(spark, folder):
    """AUC with cumulative counts over score ranges, the plan for many distinct scores."""
    return _rounded(metrics.roc_auc(_auc_rows(spark, folder), []))


def score_stats(spark, folder):
    return model_metrics(spark, folder).select("side", *metrics.STAT_COLUMNS)


def eval_rates(spark, folder):
    return model_metrics(spark, folder).select("side", "anomaly_rate_predicted", "anomaly_rate_true")


def evaluate_models(spark, folder):
    return model_metrics(spark, folder)


def train_test_metrics(spark, folder):
    parts = _split(spark, folder).select("event_id", "split")
    rows = model_rows(spark, folder).where(F.col("model") == "champion").join(parts, "event_id")
    rates = metrics.classification_metrics(rows, ["split"]).drop("few_anomalies")
    return _rounded(rates.join(metrics.roc_auc(rows, ["split"]), "split"))


def eval_set(spark, folder):
    window = lake.in_days(NOW, K.EVALUATION_DAYS, _hour_of())
    rows = quality.drop_nulls(labelled(spark, folder).where(window), K.SENSOR_COLUMNS)
    return _rounded(rows.select("event_id", *K.SENSOR_COLUMNS, "is_anomaly"))


def forest_score_boxes(spark, folder):
    rows = fixtures.readings(spark, folder)
    return _rounded(rows.select("event_id", forest.box_score(fixtures.CHALLENGER_BOXES).alias("anomaly_score")))


def anomaly_cutoff(spark, folder):
    rows = fixtures.readings(spark, folder).withColumn("anomaly_score", forest.box_score(fixtures.CHALLENGER_BOXES))
    return _rounded(forest.cutoff(rows, CHALLENGER_SHARE).withColumnRenamed("q", "offset"))


def gold_rows(spark, folder):
    columns = ["event_id", "copy_no", "anomaly_score", "decision_score", "prediction", "is_anomaly"]
    return _rounded(gold(spark, folder).select(*columns))


def gold_rate(spark, folder):
    return _rounded(medallion.gold_rate(gold(spark, folder)))


def anomaly_extract(spark, folder):
    return _rounded(medallion.anomaly_extract(gold(spark, folder), "ts"))


def alert_top5(spark, folder):
    top = medallion.first_alerts(gold(spark, folder), ORDER)
    return _rounded(top.select("event_id", "ts", "device_id", "temperature", "iaq_score", "anomaly_score"))


def hourly_anomaly_rate(spark, folder):
    return _rounded(medallion.hourly_rate(gold(spark, folder)))


def _trained(spark, folder):
    return forest.train(labelled(spark, folder).select("event_id", "is_anomaly", *K.SENSOR_COLUMNS), "event_id")


def fit_forest(spark, folder):
    rows = fixtures.readings(spark, folder)
    return _rounded(forest.fit_forest(rows, stored(forest.fit_scaler(rows)), "event_id"))


def forest_score(spark, folder):
    rows = fixtures.readings(spark, folder)
    return _rounded(medallion.to_gold(rows, _trained(spark, folder)).select("event_id", "anomaly_score", "prediction", "is_anomaly"))


def permutation_importance(spark, folder):
    return forest.permutation_importance(fixtures.readings(spark, folder), _trained(spark, folder), "event_id")


# --- registry ------------------------------------------------------------------------------------------------------


def _text_versions(df: DataFrame) -> DataFrame:
    """Optional version numbers as text: a missing number has no common client-side type."""
    return df.withColumns({c: F.col(c).cast("string") for c in df.columns if c.endswith("version")})


def latest_by_stage(spark, folder):
    return registry.latest_by_stage(fixtures.versions(spark, folder))


def champion_fallback(spark, folder):
    return registry.champion_fallback(fixtures.versions(spark, folder))


def champion_challenger(spark, folder):
    return _text_versions(registry.champion_challenger(fixtures.versions(spark, folder)))


def usable_model(spark, folder):
    return _text_versions(registry.usable_model(fixtures.versions(spark, folder), fixtures.artifacts(spark, folder)))


def report_metadata(spark, folder):
    versions, runs = fixtures.versions(spark, folder), fixtures.runs(spark, folder)
    pairs = registry.champion_challenger(versions)
    return compare.metadata_table(pairs, registry.version_metrics(versions, runs)).drop("run_id")


def registration_gate(spark, folder):
    gated = registry.registration_gate(fixtures.runs(spark, folder))
    return gated.select("run_id", F.concat_ws(",", "failed").alias("failed"), "registered", "branch")


def stage_assignment(spark, folder):
    candidates = fixtures.versions(spark, folder).where("version % 2 = 1").select("model_name", "version", "run_id")
    older = fixtures.versions(spark, folder).where("version % 2 = 0")
    return registry.stage_assignment(candidates, older)


def version_metrics(spark, folder):
    return _rounded(registry.version_metrics(fixtures.versions(spark, folder), fixtures.runs(spark, folder)))


# --- comparison ------------------------------------------------------------------------------------------------------


def metric_deltas(spark, folder):
    return _rounded(compare.metric_deltas(model_metrics(spark, folder)))


def weighted_score(spark, folder):
    deltas = compare.metric_deltas(day_metrics(spark, folder), ["day", "matchup"])
    out = compare.weighted_scores(deltas, ["day", "matchup"])
    return out.select("day", "matchup", "champion_score", "challenger_score", "score_delta")


def _advice(spark, folder):
    deltas = compare.metric_deltas(day_metrics(spark, folder), ["day", "matchup"])
    return compare.recommendation(deltas, ["day", "matchup"])


def risk_points(spark, folder):
    lists = {c: F.concat_ws(",", c) for c in ("analysis_points", "risk_points")}
    return _advice(spark, folder).withColumns(lists).select("day", "matchup", *lists)


def verdict(spark, folder):
    return _advice(spark, folder).select("day", "matchup", "verdict", "confidence", "reason")


def recommendation(spark, folder):
    lists = {c: F.concat_ws(",", c) for c in ("analysis_points", "risk_points")}
    weights = F.concat_ws(",", F.transform(F.map_entries("weights_used"), lambda e: F.concat_ws("=", e["key"], F.format_number(e["value"], 2))))
    out = _advice(spark, folder).withColumns(lists).withColumn("weights_used", weights)
    return out.drop("d_recall", "d_roc_auc", "d_precision")


def importance_compare(spark, folder):
    """Spread of each feature as a stand-in importance: four features on one side, two of them on the other."""
    long = drift.feature_summary(drift.both_sides(*sides(spark, folder)))
    side = F.when(F.col("side") == "reference", "champion").otherwise("challenger")
    rows = long.select(side.alias("side"), "feature", F.col("std").alias("importance"))
    kept = rows.where((F.col("side") == "champion") | F.col("feature").isin("temperature", "humidity"))
    return _rounded(compare.importance_compare(kept))


def latest_drift_context(spark, folder):
    """Daily summaries as stored reports; the newest one joins the comparison row."""
    daily = fixtures.readings(spark, folder).groupBy(F.date_format("ts", "yyyy-MM-dd").alias("run_ts")).agg(
        F.count(F.lit(1)).alias("production_count"), (F.avg("temperature") > 31.4).alias("overall_drift")
    )
    out = compare.latest_drift_context(model_metrics(spark, folder).select("side", "recall"), daily)
    return out.select("side", "recall", "drift_context.*")


def comparison_summary(spark, folder):
    made = compare.comparison_summary(model_metrics(spark, folder), F.lit("2024-01-31 00:00 UTC"))
    paths = {
        "generated_at": "$.generated_at",
        "champion_recall": "$.champion.recall",
        "challenger_recall": "$.challenger.recall",
        "recall_delta": "$.deltas.recall",
        "verdict": "$.recommendation.verdict",
        "confidence": "$.recommendation.confidence",
    }
    numbers = ("champion_recall", "challenger_recall", "recall_delta")
    read = {n: F.get_json_object("summary", p) for n, p in paths.items()}
    return made.select(*[c.cast("double").alias(n) if n in numbers else c.alias(n) for n, c in read.items()])


def report_tables(spark, folder):
    importance = forest_free_importance(spark, folder)
    return _rounded(compare.report_tables(model_metrics(spark, folder), importance, _report(spark, folder)))


def forest_free_importance(spark, folder):
    long = drift.feature_summary(drift.both_sides(*sides(spark, folder)))
    side = F.when(F.col("side") == "reference", "champion").otherwise("challenger")
    return long.select(side.alias("side"), "feature", F.round("std", 4).alias("importance"))


def drift_report_json(spark, folder):
    report = _report(spark, folder)
    made = drift.drift_document(report, drift.drift_summary(report), F.lit("2024-01-31 01:00:00"))
    text = made.select(F.to_json(F.struct("*")).alias("j"))
    picks = {"overall_drift": "$.overall_drift", "temperature_psi": "$.features.temperature.psi", "psi_limit": "$.thresholds.psi"}
    kinds = {"overall_drift": "boolean", "temperature_psi": "double", "psi_limit": "double"}
    return text.select(*[F.get_json_object("j", p).cast(kinds[n]).alias(n) for n, p in picks.items()])


NAMES = [
    "silver_anomaly_rate", "silver_features",
    "scan_lookback_hours", "scan_backfill", "scan_day_windows", "scan_latest_hour", "bronze_partition_counts", "bronze_layer", "layer_lookback", "silver_two_runs",
    "tolerant_scan", "stream_bronze", "stream_silver", "stream_hourly_rate",
    "partition_key_modes", "union_by_name",
    "parse_envelopes", "parse_flat_nested", "missing_fields", "bronze_parse", "ingest_quality", "alias_fields",
    "silver_nulls", "null_profile", "silver_valid", "range_violations", "silver_dedup", "quality_metrics",
    "iaq_v1", "iaq_v2", "air_label", "score_band", "factor_arrays", "correlation_rules", "rule_override",
    "score_readings", "scorer_responses", "ratio_features", "time_features", "parse_ts", "clip_values", "domain_label",
    "label_rate_preview", "scale_features",
    "gas_baseline", "silver_iaq", "gas_summary", "sensor_profile", "anomaly_rate", "rule_breakdown",
    "rolling_mean", "rolling_std", "rolling_global", "rolling_device_blocks",
    "describe_distribution", "feature_summary", "feature_histogram", "psi", "kl_divergence", "ks_statistic",
    "ks_statistic_ranges", "describe_offset_channel", "ks_pvalue", "ks_pvalue_exact", "mean_std_shift", "drift_features", "drift_summary", "retrain_decision",
    "drift_report_json",
    "fit_scaler", "stratified_split", "split_balance", "training_set", "label_thresholds", "confusion_matrix",
    "confusion_share", "classification_metrics", "roc_auc", "roc_auc_ranges", "score_stats", "eval_rates",
    "evaluate_models", "train_test_metrics", "eval_set", "forest_score_boxes", "anomaly_cutoff", "gold_rate",
    "anomaly_extract", "alert_top5", "hourly_anomaly_rate", "fit_forest", "forest_score", "permutation_importance",
    "latest_by_stage", "champion_fallback", "champion_challenger", "usable_model", "registration_gate",
    "stage_assignment", "version_metrics",
    "metric_deltas", "weighted_score", "risk_points", "verdict", "recommendation", "importance_compare",
    "latest_drift_context", "comparison_summary", "report_tables", "report_metadata",
]


def registered() -> dict[str, Query]:
    """Name -> callable."""
    found = {name: globals()[name] for name in NAMES}
    found["gold"] = gold_rows
    return found
