"""Champion/challenger comparison over metric rows (one row per model)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airmill import constants as K
from airmill.functions.lists import code_list
from airmill.operators.metrics import STAT_COLUMNS

SIDES = ("champion", "challenger")


def side_by_side(metrics: DataFrame, by: Sequence[str] = (), columns: Sequence[str] = K.COMPARED_METRICS) -> DataFrame:
    """(by..., metric, champion, challenger) from rows with a ``side`` column, in one grouped pass."""
    long = metrics.unpivot([*by, "side"], list(columns), "metric", "value")
    picks = [F.max(F.when(F.col("side") == s, F.col("value"))).alias(s) for s in SIDES]
    return long.groupBy(*by, "metric").agg(*picks)


def metric_deltas(metrics: DataFrame, by: Sequence[str] = (), columns: Sequence[str] = K.COMPARED_METRICS) -> DataFrame:
    """Adds ``delta`` (challenger - champion, 4 decimals) and who is ``better``."""
    out = side_by_side(metrics, by, columns)
    out = out.withColumn("delta", F.round(F.col("challenger") - F.col("champion"), 4))
    better = F.when(F.col("delta") > 0, "challenger").when(F.col("delta") == 0, "equal").otherwise("champion")
    return out.withColumn("better", better)


def _delta(metric: str) -> Column:
    return F.max(F.when(F.col("metric") == metric, F.col("delta"))).alias(f"d_{metric}")


def _weighted(side: str) -> Column:
    parts = [F.coalesce(F.max(F.when(F.col("metric") == m, F.col(side))), F.lit(0.0)) * w for m, w in K.SCORE_WEIGHTS.items()]
    return sum(parts[1:], parts[0])


def weighted_scores(deltas: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """champion_score, challenger_score and score_delta (4 decimals) plus the metric deltas, one row per group.

    The metrics have 4 decimals and the weights 2, so sums are cleaned to 10 decimals before exact halves are rounded up.
    """
    out = deltas.groupBy(*by).agg(
        _weighted("champion").alias("champion_score"),
        _weighted("challenger").alias("challenger_score"),
        *[_delta(m) for m in ("recall", "roc_auc", "precision")],
    )
    difference = F.round(F.round(F.col("challenger_score") - F.col("champion_score"), 10), 4)
    rounded = {s: F.round(F.round(s, 10), 4) for s in ("champion_score", "challenger_score")}
    return out.withColumn("score_delta", difference).withColumns(rounded)


def with_points(scores: DataFrame) -> DataFrame:
    """Adds the code lists ``analysis_points`` and ``risk_points``."""
    recall, auc, precision = F.col("d_recall"), F.col("d_roc_auc"), F.col("d_precision")
    analysis = code_list(
        F.when(recall > 0.02, "recall_up").when(recall >= -0.02, "recall_stable"),
        F.when(auc > 0.01, "roc_auc_up"),
        F.when(precision > 0.02, "precision_up"),
    )
    risks = code_list(
        F.when(recall < -0.02, "recall_down"),
        F.when(auc < -0.01, "roc_auc_down"),
        F.when(precision < -0.05, "precision_down"),
    )
    return scores.withColumns({"analysis_points": analysis, "risk_points": risks})


def with_verdict(points: DataFrame) -> DataFrame:
    """Adds verdict (KEEP, PROMOTE, REVIEW), confidence and reason; the first rule that holds decides."""
    delta, risks = F.col("score_delta"), F.size("risk_points")

    def ruling(verdict: str, confidence: str, reason: str) -> Column:
        return F.struct(F.lit(verdict).alias("verdict"), F.lit(confidence).alias("confidence"), F.lit(reason).alias("reason"))

    decision = (
        F.when(F.col("d_recall") < -0.03, ruling("KEEP", "HIGH", "recall_drop"))
        .when((delta > 0.01) & (risks == 0), ruling("PROMOTE", "HIGH", "clear_gain"))
        .when((delta > 0) & (risks <= 1), ruling("PROMOTE", "MEDIUM", "small_gain"))
        .when(delta < -0.005, ruling("KEEP", "HIGH", "champion_better"))
        .otherwise(ruling("REVIEW", "LOW", "near_equal"))
    )
    return points.withColumn("_d", decision).select("*", "_d.verdict", "_d.confidence", "_d.reason").drop("_d")


def recommendation(deltas: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Verdict, confidence, reason, both weighted scores, their delta, point lists and the weights in use."""
    out = with_verdict(with_points(weighted_scores(deltas, by)))
    weights = F.create_map(*[F.lit(v) for pair in K.SCORE_WEIGHTS.items() for v in pair])
    return out.withColumn("weights_used", weights)


def importance_compare(importance: DataFrame) -> DataFrame:
    """(feature, champion, challenger) over the union of both feature lists; an absent feature counts 0."""
    picks = [F.coalesce(F.max(F.when(F.col("side") == s, F.col("importance"))), F.lit(0.0)).alias(s) for s in SIDES]
    return importance.groupBy("feature").agg(*picks)


def latest_drift_context(summary: DataFrame, reports: DataFrame) -> DataFrame:
    """Every row of ``summary`` with the newest drift report, null when no report exists."""
    fields = [c for c in reports.columns if c != "run_ts"]
    newest = reports.agg(F.max_by(F.struct("run_ts", *fields), "run_ts").alias("drift_context"))
    return summary.withColumn("drift_context", newest.scalar())


def report_tables(metrics: DataFrame, importance: DataFrame | None = None, drift: DataFrame | None = None) -> DataFrame:
    """All report sections in one long table (section, item, champion, challenger, delta)."""

    def section(name: str, columns: Sequence[str]) -> DataFrame:
        wide = metrics.select("side", *[F.col(c).cast("double").alias(c) for c in columns])
        rows = side_by_side(wide, (), columns)
        return rows.select(
            F.lit(name).alias("section"),
            F.col("metric").alias("item"),
            "champion",
            "challenger",
            F.round(F.col("challenger") - F.col("champion"), 4).alias("delta"),
        )

    out = section("metrics", [*K.COMPARED_METRICS, "anomaly_rate_predicted"])
    out = out.unionByName(section("confusion", ["tn", "fp", "fn", "tp"])).unionByName(section("score_stats", STAT_COLUMNS))
    if importance is not None:
        table = importance_compare(importance)
        change = F.round(F.col("challenger") - F.col("champion"), 4).alias("delta")
        out = out.unionByName(table.select(F.lit("importance").alias("section"), F.col("feature").alias("item"), *SIDES, change))
    if drift is not None:
        long = drift.unpivot(["feature"], ["psi", "kl_divergence", "ks_pvalue", "mean_shift"], "measure", "value")
        empty = F.lit(None).cast("double")
        out = out.unionByName(
            long.select(
                F.lit("drift").alias("section"),
                F.concat_ws(".", "feature", "measure").alias("item"),
                empty.alias("champion"),
                F.col("value").alias("challenger"),
                empty.alias("delta"),
            )
        )
    return out


def metadata_table(pairs: DataFrame, versions: DataFrame) -> DataFrame:
    """(model_name, side, version, ...) of every valid champion/challenger pair, run metrics with 6 decimals."""
    valid = pairs.where(F.col("status") == "ok")
    long = valid.unpivot(["model_name"], ["champion_version", "challenger_version"], "side", "version")
    named = long.withColumn("side", F.regexp_replace("side", "_version$", ""))
    out = named.join(versions, ["model_name", "version"])
    doubles = [f.name for f in out.schema.fields if f.dataType.typeName() == "double"]
    return out.withColumns({c: F.round(c, 6) for c in doubles})


def comparison_summary(metrics: DataFrame, generated_at: Column, versions: Column | None = None) -> DataFrame:
    """One JSON document: metrics of both sides, deltas and recommendation.

    ``versions`` (a struct of champion and challenger), if given, comes with it: the metrics do not name versions.
    """
    deltas = metric_deltas(metrics)
    names = K.COMPARED_METRICS

    def side(name: str) -> Column:
        picked = F.struct(*[F.max(F.when(F.col("metric") == m, F.col(name))).alias(m) for m in names])
        return picked.alias(name)

    body = deltas.agg(side("champion"), side("challenger"), side("delta"))
    advice = recommendation(deltas)
    fields = F.struct("verdict", "confidence", "reason", "champion_score", "challenger_score", "score_delta", "risk_points")
    body = body.withColumn("recommendation", advice.select(fields.alias("r")).scalar())
    document = F.struct(
        generated_at.alias("generated_at"), *([] if versions is None else [versions.alias("versions")]), "champion", "challenger", F.col("delta").alias("deltas"), "recommendation"
    )
    return body.select(F.to_json(document).alias("summary"))
