"""Sensor tables derived from the ``events`` table, the input of the registered queries.

Every view is a projection of the whole table, so its size follows the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Literal forests: (tree, leaf, t_lo, t_hi, g_lo, g_hi, path); the leaves of one tree tile the plane.
BOXES = [
    (1, 1, -1e9, 33.0, -1e9, 20000.0, 2.0),
    (1, 2, -1e9, 33.0, 20000.0, 1e9, 6.0),
    (1, 3, 33.0, 1e9, -1e9, 1e9, 1.0),
    (2, 1, -1e9, 1e9, -1e9, 16000.0, 1.0),
    (2, 2, -1e9, 1e9, 16000.0, 1e9, 5.0),
    (3, 1, -1e9, 32.5, -1e9, 1e9, 6.0),
    (3, 2, 32.5, 1e9, -1e9, 1e9, 1.0),
]
CHAMPION_BOXES = [b for b in BOXES if b[0] <= 2]
CHALLENGER_BOXES = BOXES
DRIFT_START = "2024-01-24 00:00:00"


def events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def readings(spark: SparkSession, folder: str) -> DataFrame:
    """Clean readings: every 41st is hot, every 37th smoky, every 101st has an impossible pressure; warmer at the end."""
    return events(spark, folder).selectExpr(
        "event_id",
        "ts",
        "'dev-' || CAST(user_id % 8 AS STRING) AS device_id",
        f"""31.0e0 + ((event_id*7919) % 401 - 200)/200.0e0
            + CASE WHEN event_id % 41 = 0 THEN 4.0e0 ELSE 0e0 END
            + CASE WHEN ts >= TIMESTAMP_NTZ '{DRIFT_START}' THEN 0.5e0 ELSE 0e0 END AS temperature""",
        "65.0e0 + ((event_id*104729) % 601 - 300)/100.0e0 AS humidity",
        """CASE WHEN event_id % 101 = 0 THEN 1500.0e0
            ELSE 1004.0e0 + ((event_id*1299709) % 401 - 200)/100.0e0 END AS pressure""",
        """CASE WHEN event_id % 37 = 0 THEN 3000.0e0 + (event_id*31) % 12000
            ELSE 45000.0e0 + (event_id*15485863) % 20001 END AS gas_resistance""",
    )


def bronze(spark: SparkSession, folder: str) -> DataFrame:
    """Readings with defects: null humidity on every 97th row, a corrected copy of every 53rd (``copy_no`` 1).

    One scan: the copy is made by exploding the row in place.
    """
    copies = F.when(F.col("event_id") % 53 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    df = readings(spark, folder).withColumn("copy_no", F.explode(copies))
    first = F.col("copy_no") == 0
    return df.withColumns(
        {
            "temperature": F.col("temperature") + F.when(first, 0.0).otherwise(0.25),
            "humidity": F.when(~(first & (F.col("event_id") % 97 == 0)), F.col("humidity")),
        }
    ).select("event_id", "copy_no", "ts", "device_id", "temperature", "humidity", "pressure", "gas_resistance")


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """JSON bodies in every envelope form, chosen by event_id % 10."""
    parts = events(spark, folder).selectExpr(
        "event_id",
        "ts",
        """'{"temperature":' || CAST(3100 + (event_id*7919) % 201 - 100 AS STRING) || 'e-2,"humidity":'
            || CAST(6500 + (event_id*104729) % 601 - 300 AS STRING) || 'e-2,"pressure":1004' AS head""",
        "CAST(45000 + (event_id*15485863) % 20001 AS STRING) AS g",
    )
    flat = parts.selectExpr("*", """head || ',"gas_resistance":' || g || '}' AS flat""")
    escaped = """replace(flat, '"', chr(92) || '"')"""
    return flat.selectExpr(
        "event_id",
        "ts",
        f"""CASE event_id % 10
            WHEN 0 THEN '{{"device_id":"dev-0","version":"1","sensors":' || flat || '}}'
            WHEN 1 THEN flat
            WHEN 2 THEN '{{"Type":"Notification","Message":"' || {escaped} || '"}}'
            WHEN 3 THEN '{{"Message":"' || {escaped} || '"}}'
            WHEN 4 THEN '"' || {escaped} || '"'
            WHEN 5 THEN head || ',"gas_resistance":null}}'
            WHEN 6 THEN head || '}}'
            WHEN 7 THEN head || ',"gas_resistance":"' || g || '"}}'
            WHEN 8 THEN 'not json'
            ELSE '[1,2]' END AS body""",
    )


def scorer_events(spark: SparkSession, folder: str) -> DataFrame:
    """Scorer inputs: full names, one-letter names, both, wrapped in ``body``, missing, null, text and broken values."""
    return readings(spark, folder).selectExpr(
        "event_id",
        "CAST(CAST(round(temperature*100) AS BIGINT) AS STRING) || 'e-2' AS t",
        "CAST(CAST(round(humidity*100) AS BIGINT) AS STRING) || 'e-2' AS h",
        "CAST(CAST(gas_resistance AS BIGINT) AS STRING) AS g",
    ).selectExpr(
        "event_id",
        """CASE event_id % 8
            WHEN 0 THEN '{"temperature":' || t || ',"humidity":' || h || ',"pressure":1004,"gas_resistance":' || g || '}'
            WHEN 1 THEN '{"T":' || t || ',"H":' || h || ',"P":1004,"G":' || g || '}'
            WHEN 2 THEN '{"T":0,"temperature":' || t || ',"H":' || h || ',"P":1004,"G":' || g || '}'
            WHEN 3 THEN '{"body":{"T":' || t || ',"H":' || h || ',"P":1004,"G":' || g || '}}'
            WHEN 4 THEN '{"T":' || t || ',"H":' || h || ',"G":' || g || '}'
            WHEN 5 THEN '{"T":' || t || ',"H":null,"P":1004,"G":' || g || '}'
            WHEN 6 THEN '{"T":' || t || ',"H":"damp","P":1004,"G":' || g || '}'
            ELSE '{"T":"' || t || '","H":' || h || ',"P":1004,"G":' || g || '}' END AS body""",
    )


def versions(spark: SparkSession, folder: str) -> DataFrame:
    """A registry with many models: event_id is the version, models share out the events unevenly.

    A third of all versions belongs to one model; the others have few, so missing Production, missing Staging, older
    challengers and single versions all occur.
    """
    return events(spark, folder).selectExpr(
        "CASE WHEN event_id % 3 = 0 THEN 'model-hot' ELSE 'model-' || CAST(event_id % 2503 AS STRING) END AS model_name",
        "event_id AS version",
        """CASE event_type WHEN 'purchase' THEN 'Production' WHEN 'signup' THEN 'Staging'
            WHEN 'view' THEN 'None' ELSE 'Archived' END AS stage""",
        "'r' || CAST(event_id AS STRING) AS run_id",
    )


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """Run metrics by run_id; every 11th run is lost."""
    return events(spark, folder).where("event_id % 11 <> 0").selectExpr(
        "'r' || CAST(event_id AS STRING) AS run_id",
        "CAST(ts AS DATE) AS training_date",
        "0.5e0 + ((event_id*7919) % 501)/1000.0e0 AS roc_auc",
        "0.3e0 + ((event_id*104729) % 701)/1000.0e0 AS precision",
        "0.2e0 + ((event_id*1299709) % 801)/1000.0e0 AS recall",
        "0.2e0 + ((event_id*15485863) % 801)/1000.0e0 AS f1",
    )


def artifacts(spark: SparkSession, folder: str) -> DataFrame:
    """Stored artifact per model: its newest version that is no multiple of 7."""
    kept = versions(spark, folder).where("version % 7 <> 0")
    return kept.groupBy("model_name").agg(
        F.max("version").alias("artifact_version"), F.max_by("run_id", "version").alias("artifact_run_id")
    )
