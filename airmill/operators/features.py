"""Silver features: baseline and score, time parts, ratios, rolling statistics, profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airmill import constants as K
from airmill.functions.air_quality import iaq_score
from airmill.operators import ordered, quantiles


def gas_baseline(
    df: DataFrame,
    column: str = "gas_resistance",
    min_rows: int = 0,
    chunks: int | None = None,
) -> DataFrame:
    """One row ``gas_baseline``: the 75th percentile, or the fixed fallback below ``min_rows`` rows."""
    long = quantiles.melt(df, [column])
    count = F.count(F.lit(1)).alias("rows")
    probs = [K.GAS_BASELINE_QUANTILE]
    one = quantiles.summarise(long, [count], probs, ["feature"], chunks)
    # a global aggregate on top gives a row also for an empty input
    value = F.when(F.coalesce(F.max("rows"), F.lit(0)) >= max(min_rows, 1), F.max(F.col("q")[0]))
    fallback = F.lit(K.GAS_BASELINE_FALLBACK) if min_rows else F.lit(None).cast("double")
    return one.agg(F.coalesce(value, fallback).alias("gas_baseline"))


def hourly_baseline(df: DataFrame, hour: Sequence[str], column: str = "gas_resistance", chunks: int | None = None) -> DataFrame:
    """(hour..., gas_baseline): the 75th percentile of every hour, named by columns that are not null."""
    picked = quantiles.summarise(quantiles.melt(df, [column], hour), [], [K.GAS_BASELINE_QUANTILE], [*hour, "feature"], chunks)
    return picked.select(*hour, F.col("q")[0].alias("gas_baseline"))


def with_hourly_iaq(df: DataFrame, baselines: DataFrame, hour: Sequence[str]) -> DataFrame:
    """Score against the baseline of the row's hour. A window has at most ``MAX_LOOKBACK_HOURS`` hours before it and in it, so the
    baselines are broadcast."""
    scored = df.join(F.broadcast(baselines), list(hour), "left")
    return scored.withColumn("iaq_score", iaq_score(F.col("gas_resistance"), F.col("humidity"), F.col("gas_baseline")))


def with_iaq(df: DataFrame, baseline: DataFrame) -> DataFrame:
    """Attach the baseline to every row as a scalar subquery and score against it."""
    scored = df.withColumn("gas_baseline", baseline.scalar())
    return scored.withColumn("iaq_score", iaq_score(F.col("gas_resistance"), F.col("humidity"), F.col("gas_baseline")))


def time_parts(df: DataFrame, ts: str = "ts") -> DataFrame:
    """hour, day_of_week (Monday = 0) and is_weekend."""
    weekday = F.weekday(F.col(ts))
    return df.withColumns({"hour": F.hour(ts), "day_of_week": weekday, "is_weekend": (weekday >= 5).cast("int")})


def ratios(df: DataFrame) -> DataFrame:
    eps = F.lit(K.RATIO_EPSILON)
    return df.withColumns(
        {
            "temp_humidity_ratio": F.try_divide(F.col("temperature"), F.col("humidity") + eps),
            "gas_pressure_ratio": F.try_divide(F.col("gas_resistance"), F.col("pressure") + eps),
        }
    )


def _rolling_columns(columns: Sequence[str]) -> dict:
    """name -> function of a window."""

    def mean(c: str):
        return lambda w: F.avg(c).over(w)

    def deviation(c: str):
        return lambda w: F.coalesce(F.stddev_samp(c).over(w), F.lit(0.0))

    made = {}
    for c in columns:
        made[f"{c}_rolling_mean"] = mean(c)
        made[f"{c}_rolling_std"] = deviation(c)
    return made


def rolling(
    df: DataFrame,
    order: Sequence[str],
    columns: Sequence[str] = K.ROLLING_COLUMNS,
    groups: Sequence[str] = ("device_id",),
    rows: int = K.ROLLING_ROWS,
    block_rows: int = ordered.BLOCK_ROWS,
    chunks: int | None = None,
) -> DataFrame:
    """Mean and sample deviation of the last ``rows`` rows; a single row has deviation 0.

    ``groups=("device_id",)`` keeps devices apart; ``groups=()`` is the reading order of the whole table. Windows
    work on equal blocks of numbered rows, so a hot device is spread over many tasks.
    """
    groups = list(groups)
    return ordered.trailing_rows(df, order, _rolling_columns(columns), rows, groups, block_rows, chunks)


def gas_summary(df: DataFrame) -> DataFrame:
    """min, max and mean of the gas channel."""
    g = "gas_resistance"
    return df.agg(F.min(g).alias("gas_min"), F.max(g).alias("gas_max"), F.avg(g).alias("gas_mean"))


def sensor_profile(
    df: DataFrame,
    columns: Sequence[str] = K.PROFILE_COLUMNS,
    chunks: int | None = None,
) -> DataFrame:
    """One row per column: min, mean, max and the 2 % and 98 % quantiles."""
    long = quantiles.melt(df, columns)
    aggs: list[Column] = [F.min("x").alias("min"), F.avg("x").alias("mean"), F.max("x").alias("max")]
    out = quantiles.summarise(long, aggs, K.PROFILE_PROBS, ["feature"], chunks)
    return out.select("feature", "min", "mean", "max", F.col("q")[0].alias("p02"), F.col("q")[1].alias("p98"))
