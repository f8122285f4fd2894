"""Classification metrics as aggregates.

Inputs are long: optional group columns, ``is_anomaly`` (label 0/1), ``predicted`` (0/1) and ``outlierness`` (higher =
more anomalous). Groups are models, splits, days or nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airmill import constants as K
from airmill.functions.stats import ratio
from airmill.operators.ordered import running_totals
from airmill.operators.quantiles import ranked_quantiles

METRIC_COLUMNS = [*K.COMPARED_METRICS, "anomaly_rate_predicted", "anomaly_rate_true"]
STAT_COLUMNS = ["mean", "std", "p50", "p95", "p99"]


def _cells() -> list[Column]:
    y, p = F.col("is_anomaly") == 1, F.col("predicted") == 1
    cells = {"tn": ~y & ~p, "fp": ~y & p, "fn": y & ~p, "tp": y & p}
    return [F.count_if(test).alias(name) for name, test in cells.items()]


def confusion_matrix(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """tn, fp, fn, tp per group."""
    return df.groupBy(*by).agg(*_cells())


def confusion_share(matrix: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., cell, rows, share of the total)."""
    cells = ["tn", "fp", "fn", "tp"]
    total = sum((F.col(c) for c in cells), F.lit(0))
    long = matrix.withColumn("total", total).unpivot([*by, "total"], cells, "cell", "rows")
    return long.select(*by, "cell", "rows", ratio(F.col("rows"), F.col("total")).alias("share"))


def rates_from_cells() -> dict[str, Column]:
    """Metric expressions over tn, fp, fn, tp; an undefined ratio is 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    total = tn + fp + fn + tp
    return {
        "accuracy": ratio(tp + tn, total),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(tp * 2, tp * 2 + fp + fn),
        "anomaly_rate_predicted": ratio(tp + fp, total),
        "anomaly_rate_true": ratio(tp + fn, total),
    }


def classification_metrics(df: DataFrame, by: Sequence[str] = (), digits: int | None = None) -> DataFrame:
    """Confusion cells and accuracy, precision, recall, f1 and the two anomaly rates per group."""
    rates = rates_from_cells()
    if digits is not None:
        rates = {name: F.round(value, digits) for name, value in rates.items()}
    few = (F.col("tp") + F.col("fn")) < K.MIN_EVAL_ANOMALIES
    return confusion_matrix(df, by).withColumns(rates).withColumn("few_anomalies", few)


def score_counts(
    df: DataFrame, by: Sequence[str] = (), chunks: int | None = None
) -> DataFrame:
    """(by..., x, n, neg, cells..., n_run, neg_run): equal scores are merged before anything is ordered."""
    y = F.col("is_anomaly")
    counts = df.withColumn("x", F.col("outlierness")).groupBy(*by, "x")
    counts = counts.agg(F.count(F.lit(1)).alias("n"), F.count_if(y == 0).alias("neg"), *_cells())
    return running_totals(counts, ["x"], ["n", "neg"], by, chunks)


def _auc() -> Column:
    positive = F.col("n") - F.col("neg")
    beaten = F.col("neg_run") - F.col("neg") + F.col("neg") / F.lit(2.0)
    pairs = F.sum(positive).cast("double") * F.sum("neg").cast("double")
    return ratio(F.sum(positive.cast("double") * beaten), pairs)


def roc_auc(
    df: DataFrame, by: Sequence[str] = (), chunks: int | None = None
) -> DataFrame:
    """Area under the ROC curve by rank sums, ties count half; 0 when only one class is present."""
    return score_counts(df, by, chunks).groupBy(*by).agg(_auc().alias("roc_auc"))


def evaluate(
    df: DataFrame,
    by: Sequence[str] = ("model",),
    digits: int = 4,
    chunks: int | None = None,
) -> DataFrame:
    """All metrics of every group of ``by`` (not empty): roc_auc, rates, cells, score mean/std/p50/p95/p99 and row count."""
    by = list(by)
    run = score_counts(df, by, chunks)
    cells = [F.sum(c).alias(c) for c in ("tn", "fp", "fn", "tp")]
    aggs = [*cells, _auc().alias("roc_auc"), F.sum("n").alias("n_eval")]
    x = F.col("outlierness")
    moments = df.groupBy(*by).agg(F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"))
    out = run.groupBy(*by).agg(*aggs).join(moments, by).join(ranked_quantiles(run, K.SCORE_PROBS, by), by)
    for i, name in enumerate(["p50", "p95", "p99"]):
        out = out.withColumn(name, F.col("q")[i])
    out = out.withColumns(rates_from_cells())
    rounded = {c: F.round(c, digits) for c in [*METRIC_COLUMNS, *STAT_COLUMNS]}
    few = (F.col("tp") + F.col("fn")) < K.MIN_EVAL_ANOMALIES
    out = out.withColumns(rounded).withColumn("few_anomalies", few)
    return out.select(*by, *METRIC_COLUMNS, "tn", "fp", "fn", "tp", *STAT_COLUMNS, "n_eval", "few_anomalies")
