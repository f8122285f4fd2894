"""The scheduled jobs end to end: landing -> bronze -> silver -> model -> gold -> drift -> comparison."""

import json
from datetime import datetime, timedelta

import numpy as np
import pytest

from airmill.operators import forest
from airmill.plans import workflows
from airmill.sources import lake

START, NOW = datetime(2024, 3, 1), datetime(2024, 3, 4, 21, 30)


@pytest.fixture(scope="module")
def paths(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("lake"))
    rng = np.random.default_rng(21)
    lines = []
    for i in range(4000):
        smoky = i % 20 == 0
        reading = {
            "temperature": float(np.clip(rng.normal(31, 0.4), 28, 33)),
            "humidity": float(np.clip(rng.normal(65.4, 1.2), 60, 70)),
            "pressure": float(rng.normal(1004, 0.8)),
            "gas_resistance": float(rng.uniform(3000, 9000) if smoky else rng.normal(55000, 2000)),
        }
        at = START + timedelta(minutes=1.4 * i)
        lines.append(json.dumps({"timestamp": at.isoformat(), "device_id": f"d{i % 3}", "version": "3.2", "sensors": reading}))
    spark.createDataFrame([(x,) for x in lines + ["junk"] * 5], "value string").write.text(f"{base}/landing")
    return {name: f"{base}/{name}" for name in ("landing", "bronze", "silver", "gold", "models", "drift")}


def test_jobs(spark, paths):
    counts = {r.reason: r.messages for r in workflows.ingest(spark, paths["landing"], paths["bronze"], NOW).collect()}
    assert counts == {"valid": 4000, "bad_json": 5}

    assert workflows.build_silver(spark, paths["bronze"], paths["silver"], datetime(2025, 1, 1)) is None
    quality = workflows.build_silver(spark, paths["bronze"], paths["silver"], NOW, hours=720)
    row = quality.first()
    assert (row.total_in, row.clean_out, row.quality_score) == (4000, 4000, 1.0)
    workflows.build_silver(spark, paths["bronze"], paths["silver"], NOW, hours=24)
    assert lake.read_layer(spark, paths["silver"]).count() == 4000

    versions = spark.createDataFrame([], "model_name string, version bigint, stage string, run_id string")
    for run, stage in (("run-1", "Production"), ("run-2", "Staging")):
        report, versions = workflows.train_model(spark, paths["silver"], paths["models"], versions, "m", NOW, run)
        by_split = {r.split: r for r in report.collect()}
        assert by_split["test"].registered and by_split["test"].roc_auc > 0.9
        assert by_split["test"].n_eval == 800 and by_split["train"].n_eval == 3200
        versions = spark.createDataFrame(versions.collect(), versions.schema)
        assert {r.run_id: r.stage for r in versions.collect()}[run] == stage
    assert sorted(r.version for r in versions.collect()) == [1, 2]

    model = forest.read_model(spark, f"{paths['models']}/run-1")
    for hours in range(16):
        extract = workflows.run_inference(spark, paths["silver"], paths["gold"], model, NOW - timedelta(hours=hours))
    assert set(extract.columns) == {"timestamp", "device_id", "temperature", "humidity", "iaq_score", "anomaly_score"}
    gold = lake.read_layer(spark, paths["gold"])
    assert gold.count() > 500 and gold.where("is_anomaly = 1").count() > 0
    assert workflows.run_inference(spark, paths["silver"], paths["gold"], model, datetime(2025, 1, 1)) is None

    report, decision = workflows.check_drift(spark, paths["silver"], paths["gold"], paths["drift"], versions, NOW)
    assert report.count() == 4
    drifted = decision.first()
    assert drifted.action == ("wait_for_review" if drifted.overall_drift else "no_drift")
    assert lake.read_latest_report(spark, paths["drift"], "overall_drift boolean").count() == 1

    out = workflows.compare_models(spark, paths["silver"], model, forest.read_model(spark, f"{paths['models']}/run-2"), NOW)
    assert out["recommendation"].first().verdict == "REVIEW"  # the same data and seed give the same model
    assert {r.section for r in out["report"].collect()} == {"metrics", "confusion", "score_stats", "importance"}
    assert all(r.delta == 0 for r in out["deltas"].collect())


def test_failing_policies(spark, paths):
    with pytest.raises(lake.EmptySource):
        workflows.check_drift(spark, paths["silver"], paths["gold"], paths["drift"], None, datetime(2030, 1, 1))
