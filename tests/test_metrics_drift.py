import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from airmill.functions.stats import ks_exact
from airmill.operators import drift, metrics


def scored(spark, y, s, predicted=None):
    p = predicted if predicted is not None else [0] * len(y)
    frame = pd.DataFrame({"is_anomaly": y, "outlierness": np.asarray(s, dtype=float), "predicted": p})
    return spark.createDataFrame(frame).withColumn("model", F.lit("m"))


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean()) if len(pos) and len(neg) else 0.0


def test_auc(spark):
    rng = np.random.default_rng(3)
    y = (rng.random(800) < 0.1).astype(int)
    s = np.round(rng.normal(size=800) + y, 1)
    df = scored(spark, y, s)
    auc = metrics.roc_auc(df, [], chunks=4).first()[0]
    assert auc == pytest.approx(brute_auc(y, s))
    flipped = metrics.roc_auc(df.withColumn("outlierness", -F.col("outlierness")), [], chunks=4).first()[0]
    assert flipped == pytest.approx(1 - auc)


def test_auc_of_one_class(spark):
    assert metrics.roc_auc(scored(spark, [0, 0], [1, 2]), []).first()[0] == 0.0


def test_undefined_rates_are_zero(spark):
    row = metrics.classification_metrics(scored(spark, [0, 0, 1], [1, 2, 3])).first()
    assert (row.precision, row.recall, row.f1, row.accuracy) == (0.0, 0.0, 0.0, pytest.approx(2 / 3))
    assert (row.tn, row.fp, row.fn, row.tp, row.few_anomalies) == (2, 0, 1, 0, True)


def test_evaluate_paths_agree(spark):
    rng = np.random.default_rng(4)
    y = (rng.random(500) < 0.2).astype(int)
    s = rng.normal(size=500) + y
    df = scored(spark, y, s, (s > 1).astype(int))
    plain = metrics.evaluate(df, ["model"]).first()
    ranges = metrics.evaluate(df, ["model"], chunks=4).first()
    assert plain == ranges
    assert plain.std == round(s.std(), 4) and plain.p95 == round(np.percentile(s, 95), 4)


FEATURES = ["temperature", "humidity", "pressure", "gas_resistance"]


def sensors(spark, n, shift, seed):
    rng = np.random.default_rng(seed)
    return pd.DataFrame(
        {
            "temperature": rng.normal(31 + shift, 1, n).round(2),
            "humidity": rng.normal(65, 2, n),
            "pressure": np.full(n, 1000.0),
            "gas_resistance": rng.choice([5e4, 6e4, 7e4], n),
        }
    )


def brute(e, a):
    lo, hi = min(e.min(), a.min()), max(e.max(), a.max())
    if lo == hi:
        psi = kl = 0.0
    else:
        edges = np.linspace(lo, hi, 21)
        edges[0], edges[-1] = edges[0] - 1e-6, edges[-1] + 1e-6
        counts = [np.histogram(v, bins=edges)[0] / len(v) for v in (e, a)]
        p, q = [(c + 1e-6) / (c + 1e-6).sum() for c in counts]
        psi = float(((q - p) * np.log(q / p)).sum())
        p, q = [(c + 1e-8) / (c + 1e-8).sum() for c in counts]
        kl = max(float((q * np.log(q / p)).sum()), 0.0)
    grid = np.unique(np.concatenate([e, a]))
    d = np.abs(np.searchsorted(np.sort(e), grid, "right") / len(e) - np.searchsorted(np.sort(a), grid, "right") / len(a)).max()
    return psi, kl, d


def test_drift_report(spark):
    ref, prod = sensors(spark, 900, 0, 5), sensors(spark, 600, 1, 6)
    ref.loc[3, "humidity"] = np.nan  # joint null drop takes the whole row
    frames = [spark.createDataFrame(f) for f in (ref, prod)]
    report = {r.feature: r for r in drift.drift_features(*frames, chunks=4).collect()}
    ref = ref.dropna()
    for f in FEATURES:
        psi, kl, d = brute(ref[f].to_numpy(), prod[f].to_numpy())
        r = report[f]
        assert (r.psi, r.kl_divergence, r.ks_statistic) == (
            pytest.approx(psi, abs=1e-6), pytest.approx(kl, abs=1e-6), pytest.approx(d, abs=1e-6))
        lam = math.sqrt(900 * 600 / 1500) * d
        assert r.ks_pvalue == pytest.approx(drift_p(lam), abs=1e-3)
        assert r.reference["count"] == 899 and r.production["count"] == 600
        assert r.reference.median == pytest.approx(ref[f].median())
        assert r.production.p95 == pytest.approx(np.percentile(prod[f], 95))
        assert r.production.std == pytest.approx(prod[f].std(ddof=0), abs=1e-4)
        assert r.mean_shift == pytest.approx(prod[f].mean() - ref[f].mean(), abs=1e-4)
    assert report["temperature"].psi_flag and report["temperature"].ks_flag and not report["pressure"].psi_flag
    summary = drift.drift_summary(spark.createDataFrame(list(report.values()))).first()
    assert summary.overall_drift and summary.drift_by_psi and summary.psi_violations[0] == "temperature"
    assert (summary.reference_count, summary.production_count) == (899, 600)


def drift_p(lam):
    return min(1.0, max(0.0, 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 400)))) if lam > 0.05 else 1.0


def test_same_data_has_no_drift(spark):
    df = spark.createDataFrame(sensors(spark, 700, 0, 7))
    for r in drift.drift_features(df, df).collect():
        assert (r.psi, r.kl_divergence, r.ks_statistic, r.ks_pvalue, r.mean_shift) == (0, 0, 0, 1, 0)


def test_minimum_rows(spark):
    drift.require_production_rows(spark.range(500))
    with pytest.raises(ValueError):
        drift.require_production_rows(spark.range(499))
    small, big = sensors(spark, 9, 0, 8), sensors(spark, 50, 0, 9)
    out = drift.drift_features(spark.createDataFrame(small), spark.createDataFrame(big))
    assert out.count() == 0
    assert not drift.drift_summary(out).first().overall_drift


def test_histogram_keeps_empty_bins_and_edges(spark):
    e = pd.DataFrame({"temperature": [0.0, 20.0] * 6})
    a = pd.DataFrame({"temperature": [1.0, 19.999, 20.0] * 4})
    long = drift.both_sides(spark.createDataFrame(e), spark.createDataFrame(a), ["temperature"])
    hist = {r.bin: (r.e, r.a) for r in drift.histogram(drift.value_counts(long)).collect()}
    assert len(hist) == 20
    assert {b: c for b, c in hist.items() if c != (0, 0)} == {1: (6, 0), 2: (0, 4), 20: (6, 8)}


def test_features_of_both_sides(spark):
    left, right = spark.createDataFrame([(1.0, 2.0)], "temperature double, humidity double"), spark.createDataFrame([(1.0,)], "temperature double")
    assert [r.feature for r in drift.both_sides(left, right).select("feature").distinct().collect()] == ["temperature"]
    with pytest.raises(ValueError):
        drift.both_sides(left, spark.range(1))


@pytest.mark.parametrize("drifted, stages, action", [(True, ["Production"], "retrain"), (True, ["Staging"], "wait_for_review"), (False, ["Production"], "no_drift")])
def test_retrain(spark, drifted, stages, action):
    summary = spark.createDataFrame([(drifted,)], "overall_drift boolean")
    versions = spark.createDataFrame([(s,) for s in stages], "stage string")
    assert drift.retrain_decision(summary, versions).first().action == action


def test_report_document(spark, tmp_path):
    from datetime import datetime

    from airmill.sources import lake

    df = spark.createDataFrame(sensors(spark, 600, 0, 7))
    report = drift.drift_features(df, df)
    document = drift.drift_document(report, drift.drift_summary(report), F.lit("2024-01-31"))
    schema = "execution_date string, overall_drift boolean, features map<string, struct<psi: double, ks_flag: boolean>>"
    assert lake.read_latest_report(spark, str(tmp_path / "none"), schema).isEmpty()
    folders = lake.write_report(document, str(tmp_path), datetime(2024, 1, 31, 1, 0))
    assert folders[0].endswith("year=2024/month=01/day=31/report_20240131_010000")
    row = lake.read_latest_report(spark, str(tmp_path), schema).first()
    assert row.execution_date == "2024-01-31" and set(row.features) == set(FEATURES) and row.features["humidity"].psi == 0


def order_gaps(n, m):
    """The largest gap of every order of two samples; all are equally likely."""
    for chosen in itertools.combinations(range(n + m), n):
        i = worst = 0
        for spot in range(n + m):
            i += spot in chosen
            worst = max(worst, abs(i * m - (spot + 1 - i) * n))
        yield worst


@pytest.mark.parametrize("n,m", [(1, 1), (2, 3), (4, 4), (5, 3), (6, 2)])
def test_exact_ks_against_all_orders(n, m):
    gaps = list(order_gaps(n, m))
    for gap in range(n * m + 2):
        want = sum(g >= gap for g in gaps) / len(gaps)
        assert ks_exact(n, m, gap) == pytest.approx(want, abs=1e-12)
        assert ks_exact(m, n, gap) == pytest.approx(want, abs=1e-12)


def test_exact_ks_meets_the_limit_law():
    n, m = 3000, 2000
    for lam in (0.6, 1.0, 1.6):
        gap = round(lam * math.sqrt((n + m) / (n * m)) * n * m)
        assert ks_exact(n, m, gap) == pytest.approx(drift_p(lam), abs=0.02)
    assert ks_exact(10_000, 10_000, 10_000 * 10_000) == pytest.approx(0, abs=1e-9)


def test_ks_test_takes_the_exact_law_for_small_samples(spark):
    rows = [("reference", "x", float(v)) for v in (1, 2, 3, 9)] + [("production", "x", float(v)) for v in (4, 5, 6, 7, 8)]
    run = drift.running_counts(drift.value_counts(spark.createDataFrame(rows, "side string, feature string, x double")))
    small, limit = drift.ks_test(run, 100).first(), drift.ks_test(run, 4).first()
    assert small.ks_statistic == limit.ks_statistic == pytest.approx(0.75)
    gaps = list(order_gaps(4, 5))
    assert small.ks_pvalue == pytest.approx(sum(g >= 15 for g in gaps) / len(gaps)) and limit.ks_pvalue == drift.ks_test(run).first().ks_pvalue != small.ks_pvalue
