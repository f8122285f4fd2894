"""Layers by commits: visibility, replacement, once-only ingest."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from airmill.plans import workflows
from airmill.session import file_system
from airmill.sources import commits, lake, messages

NOW = datetime(2024, 5, 1, 12, 30)


def rows(spark, values):
    """(hour of the first of May, value) as a layer's rows."""
    frame = spark.createDataFrame([(f"2024-05-01 {h:02}:10:00", v) for h, v in values], "at string, v int")
    return lake.with_partitions(frame, F.col("at").cast("timestamp_ntz"))


def seen(spark, path, hours=24):
    return sorted((r["hour"], r["v"]) for r in lake.read_hours(spark, path, lake.lookback(NOW, hours)).collect())


def test_a_reader_sees_the_layer_before_or_after_a_write(spark, tmp_path):
    path = f"{tmp_path}/layer"
    lake.commit_layer(rows(spark, [(10, 1), (11, 2), (12, 3)]), path)
    before = seen(spark, path)
    run, hours, schema = lake.stage_layer(rows(spark, [(11, 20), (12, 30)]), path)
    assert seen(spark, path) == before == [(10, 1), (11, 2), (12, 3)]
    early = lake.read_hours(spark, path, lake.lookback(NOW, 24))
    commits.commit(spark, path, run, hours, schema, hours)
    assert seen(spark, path) == [(10, 1), (11, 20), (12, 30)]
    assert sorted((r["hour"], r["v"]) for r in early.collect()) == before  # its files are still there
    assert seen(spark, path, 2) == [(11, 20), (12, 30)]
    assert sorted((r["hour"], r["v"]) for r in lake.read_layer(spark, path).collect()) == [(10, 1), (11, 20), (12, 30)]


def test_replaced_hours_without_rows_are_empty_and_appends_add(spark, tmp_path):
    path = f"{tmp_path}/layer"
    lake.commit_layer(rows(spark, [(10, 1), (11, 2), (12, 3)]), path)
    lake.commit_layer(rows(spark, [(12, 9)]), path, replaces=commits.hour_folders(lake.lookback(NOW, 2)))
    assert seen(spark, path) == [(10, 1), (12, 9)]
    lake.commit_layer(rows(spark, [(12, 9), (12, 9)]).withColumn("w", F.lit("new column")), path)
    assert seen(spark, path) == [(10, 1), (12, 9), (12, 9), (12, 9)]
    assert {r["w"] for r in lake.read_hours(spark, path, lake.lookback(NOW, 1)).collect()} == {None, "new column"}
    far = lake.read_hours(spark, path, lake.lookback(datetime(2020, 1, 1), 2))
    assert far.count() == 0 and {"at", "v", "w", "hour"} <= set(far.columns)


def test_plain_folders_count_as_the_first_write(spark, tmp_path):
    path = f"{tmp_path}/layer"
    lake.write_layer(rows(spark, [(10, 1), (11, 2)]), path)
    lake.commit_layer(rows(spark, [(11, 7), (12, 8)]), path, replaces=None)
    assert seen(spark, path) == [(10, 1), (11, 7), (12, 8)]
    assert sorted((r["hour"], r["v"]) for r in lake.read_layer(spark, path).collect()) == [(10, 1), (11, 7), (12, 8)]


def test_two_writers_get_different_numbers(spark, tmp_path):
    path = f"{tmp_path}/layer"
    assert lake.commit_layer(rows(spark, [(10, 1)]), path) == 1
    files, of = file_system(spark, path)
    files.create(of(f"{path}/_commits/.{2:012d}.claim"), False).close()  # a writer that died after its claim
    assert lake.commit_layer(rows(spark, [(11, 2)]), path) == 3
    assert seen(spark, path) == [(10, 1), (11, 2)]


def message(k, hour):
    return json.dumps({"timestamp": f"2024-05-01T{hour:02}:00:{k:02}", "device_id": "d", "temperature": 30, "humidity": 60, "pressure": 1000, "gas_resistance": 50_000})


def test_ingest_reads_every_landed_file_once(spark, tmp_path):
    landing, bronze = f"{tmp_path}/landing", f"{tmp_path}/bronze"

    def land(lines):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(landing)

    def told():
        return {r["reason"]: r["messages"] for r in workflows.ingest(spark, landing, bronze, NOW, most=1).collect()}

    land([message(k, 10) for k in range(3)] + ["junk"])
    land([message(k, 11) for k in range(2)])
    assert told() == {"valid": 5, "bad_json": 1}
    assert told() == {}
    land(["only junk"])
    land([message(7, 11)])
    unread = messages.unread_files(spark, landing, bronze)
    assert len(unread) == 2
    parsed = messages.read_files(spark, [p for p, _ in unread])
    from airmill.plans import medallion

    lake.stage_layer(medallion.to_bronze(parsed, F.lit(NOW)), bronze)  # dies before its commit
    assert lake.read_layer(spark, bronze).count() == 5
    assert told() == {"valid": 1, "bad_json": 1}
    assert lake.read_layer(spark, bronze).count() == 6
    assert commits.consumed(spark, bronze).distinct().count() == 4 and messages.unread_files(spark, landing, bronze) == []


@pytest.mark.parametrize("hours", [1, 24])
def test_a_window_reads_its_own_folders_only(spark, tmp_path, hours):
    path = f"{tmp_path}/layer"
    lake.commit_layer(rows(spark, [(h, h) for h in range(13)]), path)
    found = lake.read_hours(spark, path, lake.lookback(NOW, hours)).inputFiles()
    assert len({f.split("hour=")[1][:2] for f in found}) == min(hours, 13)
