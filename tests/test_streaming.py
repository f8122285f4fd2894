"""Streams give what the batch plans give, also across restarts."""

import json
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from airmill import constants as K
from airmill.operators import forest
from airmill.plans import medallion
from airmill.sources import fixtures, lake, messages
from airmill.streaming import jobs


def message(i, **extra):
    minute = i % 60
    reading = {"temperature": 31 + i % 3, "humidity": 65, "pressure": 1004, "gas_resistance": 50000 + i}
    return json.dumps({"timestamp": f"2024-01-03T05:{minute:02d}:00", "device_id": f"d{i % 2}", "sensors": {**reading, **extra}})


def land(spark, path, lines, name):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{path}/{name}")


def drain(query):
    query.awaitTermination(120)
    assert query.exception() is None


def test_bronze_stream_and_restart(spark, tmp_path):
    landing, out, bad, mark = (f"{tmp_path}/{x}" for x in ("in", "bronze", "bad", "mark"))

    def run():
        stream = messages.stream_messages(spark, f"{landing}/*", drain=True)
        drain(jobs.start_bronze(stream, out, bad, mark))

    land(spark, landing, [message(i) for i in range(12)] + ["broken"], "a")
    run()
    run()  # nothing new: nothing happens
    assert lake.read_layer(spark, out).count() == 12
    land(spark, landing, ["also broken", "[1]"], "b")
    run()  # a batch without valid messages is consumed too
    land(spark, landing, [message(i) for i in range(12, 20)], "c")
    run()
    stored = lake.read_layer(spark, out)
    lines = messages.read_messages(spark, f"{landing}/*")
    batch = medallion.to_bronze(lines, F.current_timestamp())
    columns = ["timestamp", "device_id", *K.SENSOR_COLUMNS]
    assert sorted(stored.select(*columns).collect()) == sorted(batch.select(*columns).collect())
    assert sorted(r.invalid_reason for r in spark.read.parquet(bad).collect()) == ["bad_json", "bad_json", "not_object"]
    # the baseline belongs to the batch: 12 rows give a quantile, 8 rows the fallback
    baselines = {r.gas_baseline for r in stored.select("gas_baseline").distinct().collect()}
    assert baselines == {80000.0, float(np.quantile([50000 + i for i in range(12)], 0.75))}


def test_replayed_batch_overwrites_itself(spark, tmp_path):
    rows = spark.createDataFrame([(message(i),) for i in range(5)], "body string")
    received = F.lit("2024-01-03 06:00:00").cast("timestamp")
    for _ in range(2):
        bronze = medallion.to_bronze(rows, received).withColumn("batch_id", F.lit(3))
        lake.write_layer(bronze, str(tmp_path), extra=["batch_id"])
    assert lake.read_layer(spark, str(tmp_path)).count() == 5


def test_deduplication_keeps_one(spark, tmp_path):
    rows = [("2024-01-03 05:00:00", "d", 1.0), ("2024-01-03 05:00:00", "d", 2.0), ("2024-01-03 05:01:00", "d", 3.0)]
    df = spark.createDataFrame(rows, "timestamp string, device_id string, temperature double")
    df.withColumn("processed_at", F.current_timestamp()).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(spark.read.parquet(f"{tmp_path}/in").schema).parquet(f"{tmp_path}/in")
    drain(jobs.start_append(jobs.deduplicated(stream), f"{tmp_path}/out", f"{tmp_path}/mark"))
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2


def test_silver_stream_keeps_one_copy_over_batches(spark, tmp_path):
    old = message(7).replace("2024-01-03T05", "2024-01-02T01")
    batches = [[message(1, temperature=9999), message(2), message(9)], [message(1), message(2), message(3)], [message(1), message(2), old]]
    for k, lines in enumerate(batches):
        landing = spark.createDataFrame([(x,) for x in lines], "body string")
        rows = medallion.to_bronze(landing, F.lit(f"2024-01-03 0{6 + k}:00:00").cast("timestamp"))
        rows.coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
        time.sleep(0.1)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    drain(jobs.start_silver(stream, f"{tmp_path}/silver", f"{tmp_path}/mark"))
    got = lake.read_layer(spark, f"{tmp_path}/silver").select(F.col("timestamp").cast("string")).collect()
    # an invalid copy does not hide a valid one, and a late reading is not lost
    assert sorted(r[0][:16].replace("T", " ") for r in got) == ["2024-01-02 01:07", *(f"2024-01-03 05:0{k}" for k in (1, 2, 3, 9))]


def test_rolling_continues_over_batches(spark, tmp_path):
    rng = np.random.default_rng(5)
    n = 90
    frame = pd.DataFrame(
        {
            "device_id": np.where(np.arange(n) % 3 == 0, "a", "b"),
            "event_ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(n), unit="min"),
            "event_id": np.arange(n),
            **{c: rng.normal(size=n) for c in K.ROLLING_COLUMNS},
        }
    )
    for i in range(3):
        spark.createDataFrame(frame.iloc[i * 30 : (i + 1) * 30]).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
        schema = spark.read.parquet(f"{tmp_path}/in/0").schema
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in/*")
        drain(jobs.start_append(jobs.rolling_across_batches(stream), f"{tmp_path}/out", f"{tmp_path}/mark"))
    got = spark.read.parquet(f"{tmp_path}/out").toPandas().set_index("event_id").sort_index()
    assert len(got) == n
    for c in K.ROLLING_COLUMNS:
        window = frame.set_index("event_id").groupby("device_id")[c].rolling(10, min_periods=1)
        assert np.allclose(got[f"{c}_rolling_mean"], window.mean().droplevel(0).sort_index())
        assert np.allclose(got[f"{c}_rolling_std"], window.std().fillna(0).droplevel(0).sort_index())


def test_silver_and_gold_streams(spark, tmp_path):
    landing = spark.createDataFrame([(message(i),) for i in range(20)], "body string")
    bronze = medallion.to_bronze(landing, F.lit("2024-01-03 06:00:00").cast("timestamp"))
    lake.write_layer(bronze, f"{tmp_path}/bronze")
    schema = lake.read_layer(spark, f"{tmp_path}/bronze").schema
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/bronze")
    drain(jobs.start_silver(stream, f"{tmp_path}/silver", f"{tmp_path}/mark1"))
    silver = lake.read_layer(spark, f"{tmp_path}/silver")
    batch = medallion.to_silver(lake.read_layer(spark, f"{tmp_path}/bronze"))
    columns = ["timestamp", "device_id", "iaq_score", "temperature_rolling_mean"]
    assert sorted(silver.select(*columns).collect()) == sorted(batch.select(*columns).collect())

    labelled = silver.withColumn("is_anomaly", F.lit(0)).withColumn("key", F.xxhash64("timestamp", "device_id"))
    model = forest.train(labelled, "key", n_trees=5)
    stream = spark.readStream.schema(silver.schema).parquet(f"{tmp_path}/silver")
    drain(jobs.start_gold(stream, model, f"{tmp_path}/gold", f"{tmp_path}/mark2"))
    gold = lake.read_layer(spark, f"{tmp_path}/gold")
    columns = ["timestamp", "device_id", "anomaly_score", "prediction"]
    want = medallion.to_gold(silver, model)
    assert sorted(gold.select(*columns).collect()) == sorted(want.select(*columns).collect())


def test_hourly_rate_and_scorer(spark, folder, tmp_path):
    rows = fixtures.readings(spark, folder).withColumn("is_anomaly", (F.col("event_id") % 7 == 0).cast("int"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    drain(jobs.start_append(jobs.hourly_anomaly_rate(stream, "ts"), f"{tmp_path}/rate", f"{tmp_path}/m1"))
    got = {r.hour_start.isoformat(): (r.total, r.anomalies) for r in spark.read.parquet(f"{tmp_path}/rate").collect()}
    want = {r.hour_start.isoformat(): (r.total, r.anomalies) for r in medallion.hourly_rate(rows).collect()}
    closed = {k: v for k, v in want.items() if k <= max(got)}
    assert got == closed and len(want) - len(got) <= 3

    score = forest.box_score(fixtures.CHALLENGER_BOXES)
    plain = stream.select("event_id", *K.SENSOR_COLUMNS)
    drain(jobs.start_append(jobs.scored_readings(plain, score, -0.75), f"{tmp_path}/scored", f"{tmp_path}/m2"))
    batch = medallion.score_readings(rows.select("event_id", *K.SENSOR_COLUMNS), score, -0.75)
    key = lambda r: r.event_id
    assert sorted(spark.read.parquet(f"{tmp_path}/scored").collect(), key=key) == sorted(batch.collect(), key=key)


@pytest.mark.parametrize("drain_mode, files", [(True, messages.DRAIN_FILES), (False, messages.POLL_FILES)])
def test_drain_mode(drain_mode, files):
    assert files == (5000 if drain_mode else 100)
