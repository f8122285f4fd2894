import pytest
from pyspark.sql import functions as F

from airmill.operators import compare, registry

SCHEMA = "model_name string, version bigint, stage string, run_id string"


def versions(spark, *stages):
    return spark.createDataFrame([("m", i + 1, s, f"r{i + 1}") for i, s in enumerate(stages)], SCHEMA)


@pytest.mark.parametrize(
    "stages, champion, challenger, fallback, status",
    [
        (["Archived", "Production", "Staging"], 2, 3, False, "ok"),
        (["Archived", "Staging"], 1, 2, True, "ok"),
        (["Staging", "Staging"], 1, 2, True, "ok"),
        (["Staging"], None, 1, False, "single_version"),
        (["Production"], 1, None, False, "no_staging"),
        (["Staging", "Production"], 2, 1, False, "challenger_not_newer"),
        (["Staging", "None"], 2, 1, True, "challenger_not_newer"),
    ],
)
def test_champion_challenger(spark, stages, champion, challenger, fallback, status):
    row = registry.champion_challenger(versions(spark, *stages)).first()
    assert (row.champion_version, row.challenger_version, row.used_fallback, row.status) == (champion, challenger, fallback, status)


@pytest.mark.parametrize(
    "stages, artifact, expected",
    [
        (["Production", "Staging"], (1, "r1"), (1, "Production", "r1", "ok")),
        (["Archived", "Staging"], (2, "r2"), (2, "Staging", "r2", "ok")),
        (["Production", "Staging"], (2, "r2"), (1, "Production", "r2", "artifact_mismatch")),
        (["Production"], None, (1, "Production", None, "no_artifact")),
        (["Archived"], (1, "r1"), (None, None, None, "no_model")),
    ],
)
def test_usable_model(spark, stages, artifact, expected):
    stored = spark.createDataFrame([("m", *artifact)] if artifact else [], "model_name string, artifact_version bigint, artifact_run_id string")
    row = registry.usable_model(versions(spark, *stages), stored).first()
    assert (row.version, row.stage, row.run_id, row.status) == expected


@pytest.mark.parametrize("stages, stage", [(["Production"], "Staging"), (["Archived", "Staging"], "Production"), ([], "Production")])
def test_stage_of_a_new_version(spark, stages, stage):
    new = spark.createDataFrame([("m", 9, "r9")], "model_name string, version bigint, run_id string")
    after = registry.register(new, versions(spark, *stages) if stages else spark.createDataFrame([], SCHEMA)).collect()
    assert {r.version: r.stage for r in after}[9] == stage and len(after) == len(stages) + 1


@pytest.mark.parametrize(
    "metrics, failed",
    [((0.75, 0.60, 0.50), []), ((0.7499, 0.6, 0.5), ["roc_auc"]), ((0.9, 0.5, 0.4), ["precision", "recall"])],
)
def test_gate(spark, metrics, failed):
    row = registry.registration_gate(spark.createDataFrame([metrics], "roc_auc double, precision double, recall double")).first()
    assert (row.failed, row.registered, row.branch) == (failed, not failed, "skip_registration" if failed else "register_model")


def test_version_without_run(spark):
    runs = spark.createDataFrame([("r1", "2024-01-01", 0.9)], "run_id string, training_date string, roc_auc double")
    got = {r.version: (r.training_date, r.roc_auc) for r in registry.version_metrics(versions(spark, "Archived", "Staging"), runs).collect()}
    assert got == {1: ("2024-01-01", 0.9), 2: ("unknown", None)}


def pair(spark, champion, challenger):
    """(recall, roc_auc, precision, f1) per side."""
    rows = [(side, *m, 0.9) for side, m in (("champion", champion), ("challenger", challenger))]
    return spark.createDataFrame(rows, "side string, recall double, roc_auc double, precision double, f1 double, accuracy double")


BASE = (0.80, 0.80, 0.80, 0.80)


@pytest.mark.parametrize(
    "challenger, verdict, confidence, reason, risks",
    [
        ((0.769, 0.99, 0.99, 0.99), "KEEP", "HIGH", "recall_drop", ["recall_down"]),
        ((0.77, 0.90, 0.90, 0.90), "PROMOTE", "MEDIUM", "small_gain", ["recall_down"]),
        ((0.83, 0.80, 0.80, 0.80), "PROMOTE", "HIGH", "clear_gain", []),
        ((0.81, 0.80, 0.80, 0.80), "PROMOTE", "MEDIUM", "small_gain", []),
        ((0.80, 0.80, 0.80, 0.80), "REVIEW", "LOW", "near_equal", []),
        ((0.80, 0.79, 0.79, 0.80), "REVIEW", "LOW", "near_equal", []),
        ((0.80, 0.78, 0.80, 0.80), "KEEP", "HIGH", "champion_better", ["roc_auc_down"]),
        ((0.90, 0.78, 0.74, 0.80), "REVIEW", "LOW", "near_equal", ["roc_auc_down", "precision_down"]),
    ],
)
def test_verdicts(spark, challenger, verdict, confidence, reason, risks):
    row = compare.recommendation(compare.metric_deltas(pair(spark, BASE, challenger))).first()
    assert (row.verdict, row.confidence, row.reason, row.risk_points) == (verdict, confidence, reason, risks)


def test_deltas_and_scores(spark):
    deltas = compare.metric_deltas(pair(spark, BASE, (0.85, 0.75, 0.80, 0.80)))
    got = {r.metric: (r.delta, r.better) for r in deltas.collect()}
    assert got == {"recall": (0.05, "challenger"), "roc_auc": (-0.05, "champion"), "precision": (0.0, "equal"), "f1": (0.0, "equal"), "accuracy": (0.0, "equal")}
    row = compare.weighted_scores(deltas).first()
    assert (row.champion_score, row.challenger_score, row.score_delta) == (0.8, 0.8025, 0.0025)


def test_drift_context_may_be_absent(spark):
    reports = spark.createDataFrame([("2024-01-01", True), ("2024-01-03", False)], "run_ts string, overall_drift boolean")
    row = compare.latest_drift_context(spark.range(1), reports).first()
    assert (row.drift_context.run_ts, row.drift_context.overall_drift) == ("2024-01-03", False)
    assert compare.latest_drift_context(spark.range(1), reports.where(F.lit(False))).first().drift_context is None
