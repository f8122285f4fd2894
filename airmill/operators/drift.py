"""Distribution drift between a reference side and a production side.

All measures are read from one table of value counts (feature, x, e, a): ``e`` reference rows and ``a`` production rows
with that value. It is built with one partially combined aggregate; histogram, PSI, KL, KS and the summaries never touch
the rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airmill import constants as K
from airmill.functions.stats import kolmogorov_sf, ks_exact_sf, ratio
from airmill.operators.ordered import running_totals
from airmill.operators.quality import drop_nulls, shared_columns
from airmill.operators.quantiles import melt, ranked_quantiles
from airmill.session import stored

SUMMARY_NAMES = ["p05", "p25", "median", "p75", "p95"]


def require_production_rows(df: DataFrame, minimum: int = K.MIN_PRODUCTION_ROWS) -> DataFrame:
    """Fail when production, before the null drop, has too few rows. Only ``minimum`` rows are looked at."""
    if df.limit(minimum).count() < minimum:
        raise ValueError(f"drift needs at least {minimum} production rows")
    return df


def both_sides(reference: DataFrame, production: DataFrame, features: Sequence[str] = K.SENSOR_COLUMNS) -> DataFrame:
    """(side, feature, x) with a joint null drop per side over the shared features."""
    used = shared_columns(reference, production, features)
    sides = [
        drop_nulls(df.select(*used), used).withColumn("side", F.lit(name))
        for name, df in (("reference", reference), ("production", production))
    ]
    return melt(sides[0].unionByName(sides[1]), used, ["side"])


def value_counts(long: DataFrame) -> DataFrame:
    """(feature, x, e, a); partial counts are combined before the shuffle."""
    side = F.col("side")
    e, a = F.count_if(side == "reference"), F.count_if(side == "production")
    return long.groupBy("feature", "x").agg(e.alias("e"), a.alias("a"))


def as_counts(long: DataFrame) -> DataFrame:
    """(feature, x, e, a) row by row, for aggregates that need no equal values merged before."""
    return long.select("feature", "x", *[(F.col("side") == side).cast("long").alias(c) for c, side in (("e", "reference"), ("a", "production"))])


def running_counts(counts: DataFrame, chunks: int | None = None) -> DataFrame:
    """Adds e_run and a_run, the two cumulative counts in value order."""
    return running_totals(counts, ["x"], ["e", "a"], ["feature"], chunks)


def _bounds(counts: DataFrame) -> DataFrame:
    """One row per feature: joint min and max, and the two row counts."""
    return counts.groupBy("feature").agg(
        F.min("x").alias("lo"), F.max("x").alias("hi"), F.sum("e").alias("n_e"), F.sum("a").alias("n_a")
    )


def _bin(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """1-based bin between the edges lo + i * ((hi - lo) / bins); edges belong to the bin above, hi to the last bin.

    Arithmetic finds the bin up to rounding, then the neighbouring edges decide.
    """
    step = (hi - lo) / bins
    guess = F.floor(F.coalesce(F.try_divide(x - lo, step), F.lit(0.0)))
    edge = guess.cast("double")
    fixed = F.when(x < lo + edge * step, guess - 1).when(x >= lo + (edge + 1) * step, guess + 1).otherwise(guess)
    return (F.least(F.greatest(fixed, F.lit(0)), F.lit(bins - 1)) + 1).cast("int")


def histogram(counts: DataFrame, bins: int = K.DRIFT_BINS) -> DataFrame:
    """(feature, bin, e, a, n_e, n_a, constant) over equal-width bins of the joint range; empty bins are present.

    ``counts`` may come row by row (``as_counts``): two aggregates, one for the bounds and one for the bins, combine on the map side, so
    values are not shuffled. The bounds table has one row per feature, a fixed list of column names, so it is broadcast.
    """
    bounds = _bounds(counts)
    placed = counts.join(F.broadcast(bounds), "feature")
    placed = placed.withColumn("bin", _bin(F.col("x"), F.col("lo"), F.col("hi"), bins))
    filled = placed.groupBy("feature", "bin").agg(F.sum("e").alias("e"), F.sum("a").alias("a"))
    grid = bounds.select(
        "feature", "n_e", "n_a", (F.col("lo") == F.col("hi")).alias("constant"), F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin")
    )
    out = grid.join(filled, ["feature", "bin"], "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("e", "a")})


def divergences(hist: DataFrame) -> DataFrame:
    """(feature, psi, kl_divergence) from one histogram; a constant feature has no divergence."""

    def shares(eps: float) -> tuple[Column, Column]:
        whole = Window.partitionBy("feature")
        raw = [ratio(F.col(c), F.col(n)) + F.lit(eps) for c, n in (("e", "n_e"), ("a", "n_a"))]
        return raw[0] / F.sum(raw[0]).over(whole), raw[1] / F.sum(raw[1]).over(whole)

    (e1, a1), (e2, a2) = shares(K.PSI_EPSILON), shares(K.KL_EPSILON)
    terms = hist.select(
        "feature", "constant", ((a1 - e1) * F.ln(a1 / e1)).alias("psi"), (a2 * F.ln(a2 / e2)).alias("kl")
    )
    out = terms.groupBy("feature").agg(F.max("constant").alias("constant"), F.sum("psi").alias("psi"), F.sum("kl").alias("kl"))
    flat = F.col("constant")
    return out.select(
        "feature",
        F.when(flat, 0.0).otherwise(F.col("psi")).alias("psi"),
        F.when(flat, 0.0).otherwise(F.greatest(F.col("kl"), F.lit(0.0))).alias("kl_divergence"),
    )


def ks_test(run: DataFrame, exact_rows: int = 0) -> DataFrame:
    """(feature, n_e, n_a, ks_statistic, ks_pvalue) from cumulative counts.

    The p-value is exact (``stats.ks_exact``) where both sides have at most ``exact_rows`` rows, and that of the limit law otherwise. Only
    the table of one row per feature reaches Python, and none does with the default.
    """
    sizes = run.groupBy("feature").agg(F.sum("e").alias("n_e"), F.sum("a").alias("n_a"))
    gap = F.abs(F.col("e_run") / F.col("n_e") - F.col("a_run") / F.col("n_a"))
    whole = F.max(F.when(F.greatest("n_e", "n_a") <= exact_rows, F.abs(F.col("e_run") * F.col("n_a") - F.col("a_run") * F.col("n_e"))))
    by = run.join(F.broadcast(sizes), "feature").groupBy("feature", "n_e", "n_a")
    d = by.agg(F.max(gap).alias("ks_statistic"), *([whole.alias("_gap")] if exact_rows else []))
    effective = F.col("n_e").cast("double") * F.col("n_a") / (F.col("n_e") + F.col("n_a"))
    limit = kolmogorov_sf(F.sqrt(effective) * F.col("ks_statistic"))
    if not exact_rows:
        return d.withColumn("ks_pvalue", limit)
    return d.withColumn("ks_pvalue", F.coalesce(ks_exact_sf(F.col("n_e"), F.col("n_a"), F.col("_gap")), limit)).drop("_gap")


def _side_counts(run: DataFrame, side: str) -> DataFrame:
    c = "e" if side == "reference" else "a"
    columns = ["feature", "x", F.col(c).alias("n")]
    if f"{c}_run" in run.columns:
        columns.append(F.col(f"{c}_run").alias("n_run"))
    return run.select(*columns).where(F.col("n") > 0).withColumn("side", F.lit(side))


def describe(run: DataFrame, long: DataFrame) -> DataFrame:
    """(side, feature, count, mean, std, min, p05, p25, median, p75, p95, max); std is the population value.

    Counts and quantiles come from the cumulative counts, mean and deviation from the rows: their aggregate is combined
    map-side and, unlike sums of squares, exact for a small spread on a high level.
    """
    both = _side_counts(run, "reference").unionByName(_side_counts(run, "production"))
    by = ["side", "feature"]
    x, n = F.col("x"), F.col("n")
    aggs = [F.sum(n).alias("count"), F.min(x).alias("min"), F.max(x).alias("max")]
    moments = long.groupBy(*by).agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"))
    out = both.groupBy(*by).agg(*aggs).join(moments, by).join(ranked_quantiles(both, K.SUMMARY_PROBS, by), by)
    quantiles = [F.col("q")[i].alias(name) for i, name in enumerate(SUMMARY_NAMES)]
    return out.select(*by, "count", "mean", "std", "min", *quantiles, "max")


def feature_summary(long: DataFrame) -> DataFrame:
    """(side, feature, mean, std, min, max) with the sample deviation."""
    x = F.col("x")
    return long.groupBy("side", "feature").agg(
        F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max")
    )


def drift_features(
    reference: DataFrame,
    production: DataFrame,
    features: Sequence[str] = K.SENSOR_COLUMNS,
    chunks: int | None = None,
    exact_rows: int = 0,
) -> DataFrame:
    """One row per feature with all measures, flags and both summaries; a side with too few rows drops the feature.

    Every join is between tables of one row per feature. The cumulative counts feed six aggregates, so they are
    stored once.
    """
    long = both_sides(reference, production, features)
    run = stored(running_counts(value_counts(long), chunks))
    ks = ks_test(run, exact_rows).where((F.col("n_e") >= K.MIN_FEATURE_ROWS) & (F.col("n_a") >= K.MIN_FEATURE_ROWS))
    diverged = divergences(histogram(run.select("feature", "x", "e", "a")))
    stats = describe(run, long)
    parts = ["count", "mean", "std", "min", *SUMMARY_NAMES, "max"]

    def side(name: str) -> Column:
        return F.max(F.when(F.col("side") == name, F.struct(*parts))).alias(name)

    stats = stats.groupBy("feature").agg(side("reference"), side("production"))
    whole = ks.join(diverged, "feature").join(stats, "feature")
    return whole.select(
        "feature",
        F.round("psi", 6).alias("psi"),
        F.round("kl_divergence", 6).alias("kl_divergence"),
        F.round("ks_statistic", 6).alias("ks_statistic"),
        F.round("ks_pvalue", 6).alias("ks_pvalue"),
        (F.col("psi") > K.PSI_LIMIT).alias("psi_flag"),
        (F.col("ks_pvalue") < K.KS_PVALUE_LIMIT).alias("ks_flag"),
        "reference",
        "production",
        F.round(F.col("production.mean") - F.col("reference.mean"), 4).alias("mean_shift"),
        F.round(F.col("production.std") - F.col("reference.std"), 4).alias("std_shift"),
    )


def drift_summary(report: DataFrame, features: Sequence[str] = K.SENSOR_COLUMNS) -> DataFrame:
    """One row: the three reasons, the overall decision, the violation lists and the row counts."""
    place = F.array_position(F.array(*[F.lit(f) for f in features]), F.col("feature"))

    def names(flag: str, name: str) -> Column:
        listed = F.array_sort(F.collect_list(F.when(F.col(flag), F.struct(place.alias("i"), F.col("feature").alias("f")))))
        return F.transform(listed, lambda s: s["f"]).alias(name)

    mean_kl = F.avg("kl_divergence")
    by_psi = F.count_if("psi_flag") > 0
    by_ks = F.count_if("ks_flag") >= K.KS_VIOLATION_LIMIT
    by_kl = F.coalesce(mean_kl > K.KL_LIMIT, F.lit(False))
    return report.agg(
        (by_psi | by_ks | by_kl).alias("overall_drift"),
        by_psi.alias("drift_by_psi"),
        by_ks.alias("drift_by_ks"),
        by_kl.alias("drift_by_kl"),
        names("psi_flag", "psi_violations"),
        names("ks_flag", "ks_violations"),
        F.round(mean_kl, 6).alias("kl_mean"),
        F.max("reference.count").alias("reference_count"),
        F.max("production.count").alias("production_count"),
    )


def drift_document(report: DataFrame, summary: DataFrame, run_ts: Column, window_days: int = 7) -> DataFrame:
    """One row with the nested report: summary fields, thresholds and a feature map (as many entries as features)."""
    fields = [c for c in report.columns if c != "feature"]
    by_feature = report.agg(F.map_from_entries(F.collect_list(F.struct("feature", F.struct(*fields)))).alias("features"))
    limits = F.struct(
        F.lit(K.PSI_LIMIT).alias("psi"),
        F.lit(K.KL_LIMIT).alias("kl"),
        F.lit(K.KS_PVALUE_LIMIT).alias("ks_pvalue"),
        F.lit(K.KS_VIOLATION_LIMIT).alias("ks_violations"),
    )
    return summary.select(
        run_ts.alias("execution_date"),
        "*",
        F.lit(window_days).alias("production_window_days"),
        limits.alias("thresholds"),
        by_feature.scalar().alias("features"),
    )


def retrain_decision(summary: DataFrame, versions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per model: retrain when drift was found and no Staging version waits for review."""
    waiting = versions.groupBy(*by).agg((F.count_if(F.col("stage") == "Staging") > 0).alias("staging_waiting"))
    drift = summary.select("overall_drift").scalar()
    out = waiting.withColumn("overall_drift", drift)
    action = F.when(~F.col("overall_drift"), "no_drift").when(F.col("staging_waiting"), "wait_for_review")
    return out.select(*by, "overall_drift", "staging_waiting", action.otherwise("retrain").alias("action"))
