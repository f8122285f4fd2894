import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from airmill.plans import medallion
from airmill.sources import fixtures, lake, messages

NOW = datetime(2024, 1, 3, 5, 20)


@pytest.fixture(scope="module")
def layer(spark, folder, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("layer"))
    lake.write_layer(lake.with_partitions(fixtures.readings(spark, folder), F.col("ts")), path)
    return path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_layout_and_roundtrip(spark, folder, layer):
    assert os.path.isdir(f"{layer}/year=2024/month=01/day=03/hour=05") or os.path.isdir(f"{layer}/year=2024/month=01/day=03")
    files = [f for _, _, names in os.walk(layer) for f in names if f.endswith(".parquet")]
    assert all(f.endswith(".snappy.parquet") for f in files)
    assert lake.read_layer(spark, layer).count() == fixtures.readings(spark, folder).count()


def test_windows_prune_folders(spark, folder, layer):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    df = lake.read_layer(spark, layer)
    for window, lo, hi in (
        (lake.in_hours(lake.lookback(NOW, 6)), "2024-01-03 00:00", "2024-01-03 06:00"),
        (lake.in_days(NOW, (1, 2)), "2024-01-01", "2024-01-03"),
    ):
        got = df.where(window)
        assert "make_ti" in plan(got).split("PartitionFilters")[1].split("PushedFilters")[0]
        want = fixtures.readings(spark, folder).where(f"ts >= timestamp_ntz '{lo}' and ts < timestamp_ntz '{hi}'")
        assert got.count() == want.count() > 0


def test_columns_are_pruned(spark, layer):
    text = plan(lake.read_layer(spark, layer).agg(F.max("temperature")))
    assert "ReadSchema: struct<temperature:double>" in text


def test_lookback_parameters():
    assert lake.lookback(NOW, 2) == (datetime(2024, 1, 3, 4), datetime(2024, 1, 3, 5))
    assert lake.lookback(NOW, 2, "2024-01-03 02:50") == (datetime(2024, 1, 3, 3), datetime(2024, 1, 3, 5))
    assert lake.lookback(NOW, 2, " 2024-01-03 02:20 ") == (datetime(2024, 1, 3, 2), datetime(2024, 1, 3, 5))
    with pytest.warns(UserWarning):
        assert lake.lookback(NOW, 2, "03.01.2024") == lake.lookback(NOW, 2)
    with pytest.raises(ValueError):
        lake.lookback(NOW, 721)


def test_rerun_replaces_only_its_folders(spark, tmp_path):
    path = str(tmp_path)
    rows = spark.createDataFrame([(1, "2024-01-01 00:10:00"), (2, "2024-01-01 01:10:00")], "id int, t string")
    parts = lake.with_partitions(rows, F.col("t").cast("timestamp_ntz"))
    lake.write_layer(parts, path)
    lake.write_layer(parts.where("id = 2").withColumn("id", F.lit(7)), path)
    assert sorted(r.id for r in lake.read_layer(spark, path).collect()) == [1, 7]
    lake.write_layer(parts.where("id = 1"), path, mode="append")
    assert sorted(r.id for r in lake.read_layer(spark, path).collect()) == [1, 1, 7]


def test_folders_stay_padded(spark, layer, tmp_path):
    lake.write_layer(lake.read_layer(spark, layer).where(lake.in_hours(lake.lookback(NOW, 6))), str(tmp_path))
    assert os.listdir(f"{tmp_path}/year=2024") == ["month=01"]


def test_partition_fallback(spark):
    df = spark.createDataFrame([("2024-05-06T07:08:09",), ("2024-05-06 07:08:09.5",), ("soon",), (None,)], "t string")
    at = lake.partition_time(F.col("t"), F.lit("2024-02-01 03:04:05").cast("timestamp_ntz"))
    got = [r.k for r in df.select(lake.partition_key(at).alias("k")).collect()]
    assert got == ["year=2024/month=05/day=06/hour=07"] * 2 + ["year=2024/month=02/day=01/hour=03"] * 2


def test_latest_hour_and_files(spark, tmp_path):
    path = str(tmp_path)
    for i, hour in enumerate([3, 4, 4, 4, 4]):
        rows = spark.createDataFrame([(i, f"2024-01-03 0{hour}:30:00")], "id int, t string")
        lake.write_layer(lake.with_partitions(rows, F.col("t").cast("timestamp_ntz")), path, mode="append")
    df = lake.read_layer(spark, path)
    assert sorted(r.id for r in lake.latest_hour(df, NOW).collect()) == [1, 2, 3, 4]
    assert lake.latest_hour(df, datetime(2024, 1, 3, 7)).isEmpty()
    near = lake.read_hours(spark, path, lake.hours_back(NOW, 2))
    assert sorted(r.id for r in lake.latest_hour(near, NOW).collect()) == [1, 2, 3, 4]  # all files of the hour
    os.makedirs(f"{path}/year=2020/month=01/day=01/hour=00")
    with open(f"{path}/year=2020/month=01/day=01/hour=00/x.parquet", "wb") as f:
        f.write(b"not opened")
    assert lake.read_hours(spark, path, lake.hours_back(NOW, 2)).count() == 4


def test_tolerant_read(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/a")
    os.makedirs(f"{tmp_path}/b")
    with open(f"{tmp_path}/b/broken.parquet", "wb") as f:
        f.write(b"this is no parquet file at all")
    df = lake.read_layer(spark, f"{tmp_path}/*", tolerant=True, schema="id bigint")
    assert df.count() == 5
    with pytest.raises(Exception):
        lake.read_layer(spark, f"{tmp_path}/*", schema="id bigint").count()


def test_old_files_without_a_column(spark, tmp_path):
    spark.range(2).write.parquet(f"{tmp_path}/year=2024")
    spark.range(2).withColumn("x", F.lit(1)).write.parquet(f"{tmp_path}/year=2025")
    assert sorted(r.x or 0 for r in lake.read_layer(spark, str(tmp_path)).collect()) == [0, 0, 1, 1]


def test_empty_source_policy(spark):
    empty = spark.range(0)
    assert lake.require_rows(empty, "skip") is None
    with pytest.raises(lake.EmptySource):
        lake.require_rows(empty)
    assert lake.require_rows(spark.range(1)).count() == 1


def test_bronze_to_silver(spark, tmp_path):
    """Parse, score, write, read a window, clean, write twice: re-running changes nothing."""
    body = '{{"timestamp":"2024-01-03T05:{:02d}:00","device_id":"d{}","sensors":{{"temperature":31,"humidity":65,"pressure":1004,"gas_resistance":{}}}}}'
    lines = [body.format(i, i % 2, 50000 + 100 * i) for i in range(12)] + ["broken", body.format(0, 0, 90000)]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{tmp_path}/in")
    bronze = medallion.to_bronze(messages.read_messages(spark, f"{tmp_path}/in"), F.lit("2024-01-03 06:00:00").cast("timestamp"))
    lake.write_layer(bronze, f"{tmp_path}/bronze", mode="append")
    stored = lake.read_layer(spark, f"{tmp_path}/bronze")
    assert stored.count() == 13
    q75 = stored.select(F.percentile("gas_resistance", F.lit(0.75))).first()[0]
    assert {r.gas_baseline for r in stored.collect()} == {q75}
    for _ in range(2):
        lake.write_layer(medallion.to_silver(stored.where(lake.in_hours(lake.lookback(NOW, 2)))), f"{tmp_path}/silver")
    silver = lake.read_layer(spark, f"{tmp_path}/silver").toPandas()
    assert len(silver) == 12 and set(silver["hour_of_day"]) == {5}
    first = silver.sort_values(["device_id", "event_ts"]).iloc[0]
    assert first["gas_resistance"] == 90000 and first["temperature_rolling_std"] == 0


def test_scan_report_names_what_a_tolerant_read_skips(spark, tmp_path):
    path = f"{tmp_path}/layer"
    rows = spark.range(400_000).withColumn("x", F.rand(3))
    for k in range(4):
        rows.limit(0 if k == 3 else 400_000).coalesce(1).write.parquet(f"{path}/hour=0{k}")
    (whole,), (cut,), (broken,), _ = ([*(tmp_path / "layer" / f"hour=0{k}").glob("*.parquet")] for k in range(4))
    raw = bytearray(cut.read_bytes())
    middle = len(raw) // 2
    raw[middle : middle + 2_000_000] = b"\xff" * len(raw[middle : middle + 2_000_000])
    cut.write_bytes(raw)  # the footer is as it was
    broken.write_bytes(broken.read_bytes()[:-10])
    for crc in (tmp_path / "layer").rglob("*.crc"):
        crc.unlink()
    got = {r["file"].split("hour=0")[1][0]: r for r in lake.scan_report(spark, path, rows.schema).collect()}
    assert got["0"]["status"] == "whole" and got["0"]["rows"] == got["0"]["promised"] == 400_000
    assert got["1"]["status"] == "cut" and got["1"]["rows"] < got["1"]["promised"] == 400_000
    assert got["2"]["status"] == "unreadable" and got["2"]["rows"] == 0 and got["2"]["promised"] is None and got["2"]["error"]
    assert got["3"]["status"] == "empty" and got["3"]["error"] is None
    assert lake.scan_report(spark, f"{path}/hour=03", rows.schema).count() == 1
