"""Exact linear-interpolated quantiles that do not depend on one task holding all distinct values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airmill.operators.ordered import running_totals


def melt(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Long form (by..., feature, x) without null and NaN values."""
    wide = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    long = wide.unpivot(list(by), list(columns), "feature", "x")
    return long.where(F.col("x").isNotNull() & ~F.isnan("x"))


def _literal_array(probs: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(p)) for p in probs])


def summarise(
    long: DataFrame,
    aggs: Sequence[Column],
    probs: Sequence[float],
    by: Sequence[str] = ("feature",),
    chunks: int | None = None,
) -> DataFrame:
    """Aggregates per group of ``long`` plus ``q``, the array of exact quantiles of ``x`` at ``probs``.

    The built-in ``percentile`` keeps every distinct value of a group in one reducer, so equal values are counted first,
    running counts are added over ranges of the values, and the two neighbours of each rank are picked.
    """
    by = list(by)
    counts = long.groupBy(*by, "x").agg(F.count(F.lit(1)).alias("n"))
    picked = ranked_quantiles(running_totals(counts, ["x"], ["n"], by, chunks=chunks), probs, by)
    return long.groupBy(*by).agg(*aggs).join(picked, by) if aggs else picked


def ranked_quantiles(run: DataFrame, probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    """(by..., q) from value counts with running counts, columns (by..., x, n, n_run)."""
    by = list(by)
    totals = run.groupBy(*by).agg(F.max("n_run").alias("total"))
    spots = F.posexplode(_literal_array(probs)).alias("i", "p")
    at = (F.col("total") - 1) * F.col("p")
    wanted = totals.select(*by, "total", spots).select(*by, "i", at.alias("at"))
    wanted = wanted.withColumn("rank", F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at")))))
    hit = run.join(wanted, by).where((F.col("n_run") > F.col("rank")) & (F.col("n_run") - F.col("n") <= F.col("rank")))
    low = F.min(F.when(F.col("rank") == F.floor("at"), F.col("x")))
    high = F.max(F.when(F.col("rank") == F.ceil("at"), F.col("x")))
    share = F.max("at") - F.floor(F.max("at"))
    value = hit.groupBy(*by, "i").agg((low + (high - low) * share).alias("q"))
    ordered = F.array_sort(F.collect_list(F.struct("i", "q")))
    return value.groupBy(*by).agg(F.transform(ordered, lambda s: s["q"]).alias("q"))


def quantile(
    df: DataFrame, column: str, prob: float, chunks: int | None = None
) -> DataFrame:
    """One-row frame ``q`` for one column."""
    return summarise(melt(df, [column]), [], [prob], ["feature"], chunks).select(F.col("q")[0].alias("q"))
