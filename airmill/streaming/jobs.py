"""Streaming twins of the layer plans.

Offsets live in the checkpoint. Sinks are either Spark's file sink (exactly once through its commit log) or
``foreachBatch`` with a folder per batch that a replay overwrites, so input counts as consumed only after it was written.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from airmill import constants as K
from airmill.functions.parsing import parse_messages
from airmill.operators import forest, quality
from airmill.plans import medallion
from airmill.session import discard, stored
from airmill.sources import lake

ROLLING_SCHEMA = (
    "device_id string, event_ts timestamp, event_id bigint, "
    + ", ".join(f"{c} double" for c in K.ROLLING_COLUMNS)
    + ", "
    + ", ".join(f"{c}_rolling_mean double, {c}_rolling_std double" for c in K.ROLLING_COLUMNS)
)


def _start(writer, checkpoint: str, every: str | None) -> StreamingQuery:
    """Drain what is there, or poll with the given interval."""
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def start_bronze(
    messages: DataFrame,
    bronze_path: str,
    quarantine_path: str,
    checkpoint: str,
    by_message_time: bool = True,
    every: str | None = None,
) -> StreamingQuery:
    """Messages (body, received_at) to bronze; rejected messages with their reason to quarantine.

    ``received_at`` is the logged time of the batch, so a replayed batch writes the same folders again. The gas baseline
    is the one of the batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        number = F.lit(batch_id)
        parsed = stored(parse_messages(batch))
        rows = medallion.bronze_rows(parsed, F.col("received_at"), by_message_time).withColumn("batch_id", number)
        lake.write_layer(rows, bronze_path, extra=["batch_id"])
        _, rejected = medallion.split_valid(parsed)
        out = rejected.select("body", "invalid_reason", "missing", "received_at", number.alias("batch_id"))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(quarantine_path)
        discard(parsed)

    return _start(messages.writeStream.foreachBatch(write), checkpoint, every)


def deduplicated(bronze: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Bronze stream without repeated (timestamp, device_id) inside the watermark; keeps the first copy.

    The batch plan keeps the newest copy; a stream that has already emitted a row cannot take it back.
    """
    timed = bronze.withColumn("event_ts", F.coalesce(F.col("timestamp").try_cast("timestamp"), F.col("processed_at")))
    return timed.withWatermark("event_ts", delay).dropDuplicatesWithinWatermark(["timestamp", "device_id"])


def start_silver(
    bronze: DataFrame, silver_path: str, checkpoint: str, every: str | None = None, delay: str | None = None
) -> StreamingQuery:
    """Bronze stream to silver, batch by batch: baseline and row windows are the ones of the batch.

    Of a reading's valid copies the first one stays, in whatever batch the others come. Without ``delay`` the state keeps the key of
    every reading and no late reading is lost; with it, ``deduplicated`` bounds the state and drops readings that come later.
    """
    valid = quality.keep_valid(bronze, [medallion.SILVER_KEYS[0]])
    first = valid.dropDuplicates(medallion.SILVER_KEYS) if delay is None else deduplicated(valid, delay)

    def write(batch: DataFrame, batch_id: int) -> None:
        # the batch is read more than once, the state is to advance once
        held = stored(batch)
        rows = medallion.to_silver(held).withColumn("batch_id", F.lit(batch_id))
        lake.write_layer(rows, silver_path, extra=["batch_id"])
        discard(held)

    return _start(first.writeStream.foreachBatch(write), checkpoint, every)


def rolling_across_batches(readings: DataFrame, rows: int = K.ROLLING_ROWS) -> DataFrame:
    """Rolling statistics per device that continue over batch borders; the last rows are the state.

    Input columns: device_id, event_ts, event_id and the rolled columns. A task holds the rows of one device in one
    micro-batch, which the source's file limit bounds.
    """
    columns = list(K.ROLLING_COLUMNS)
    state_schema = ", ".join(f"{c} array<double>" for c in columns)

    def advance(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        fresh = pd.concat(list(parts)).sort_values(["event_ts", "event_id"], ignore_index=True)
        held = dict(zip(columns, state.get)) if state.exists else {c: [] for c in columns}
        kept = []
        for c in columns:
            series = pd.Series(np.concatenate([np.asarray(held[c], dtype=float), fresh[c].to_numpy(dtype=float)]))
            window = series.rolling(rows, min_periods=1)
            skip = len(held[c])
            fresh[f"{c}_rolling_mean"] = window.mean().to_numpy()[skip:]
            fresh[f"{c}_rolling_std"] = window.std().fillna(0.0).to_numpy()[skip:]
            kept.append(series.tail(rows - 1).tolist())
        state.update(tuple(kept))
        names = [part.split()[0] for part in ROLLING_SCHEMA.split(", ")]
        yield fresh[names]

    narrow = readings.select("device_id", F.col("event_ts").cast("timestamp"), "event_id", *columns)
    return narrow.groupBy("device_id").applyInPandasWithState(
        advance, ROLLING_SCHEMA, state_schema, "append", GroupStateTimeout.NoTimeout
    )


def start_gold(
    silver: DataFrame, model: forest.ForestModel, gold_path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Score silver rows as they arrive; stateless, written by the exactly-once file sink in silver's folders."""
    gold = lake.padded(medallion.to_gold(silver, model))
    writer = gold.writeStream.format("parquet").option("path", gold_path).partitionBy(*K.PARTITION_COLUMNS)
    return _start(writer.outputMode("append"), checkpoint, every)


def scored_readings(readings: DataFrame, anomaly_score: Column, offset: Column | float) -> DataFrame:
    """Per-reading scorer on a stream: the batch projection as it is."""
    return medallion.score_readings(readings, anomaly_score, offset)


def hourly_anomaly_rate(gold: DataFrame, ts: str = "event_ts", delay: str = "2 hours") -> DataFrame:
    """(hour_start, total, anomalies, rate) of closed hours; late rows are accepted up to the watermark."""
    timed = gold.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    hours = timed.groupBy(F.window("_ts", "1 hour")).agg(
        F.count(F.lit(1)).alias("total"), F.sum("is_anomaly").alias("anomalies")
    )
    return hours.select(
        F.col("window.start").alias("hour_start"), "total", "anomalies", (F.col("anomalies") / F.col("total")).alias("rate")
    )


def start_append(df: DataFrame, path: str, checkpoint: str, by: Sequence[str] = (), every: str | None = None) -> StreamingQuery:
    """Any append-mode stream to parquet."""
    return _start(df.writeStream.format("parquet").option("path", path).partitionBy(*by).outputMode("append"), checkpoint, every)
