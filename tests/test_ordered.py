"""Order-dependent operators against pandas and numpy, with a device that holds a third of the rows and many ties."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from airmill.operators import features, labels, ordered, quality, quantiles


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(1)
    n = 3000
    device = np.where(rng.random(n) < 0.34, "hot", np.char.add("d", rng.integers(0, 40, n).astype(str)))
    return pd.DataFrame(
        {
            "id": np.arange(n),
            "device_id": device,
            "t": rng.integers(0, 900, n),
            "temperature": rng.normal(30, 2, n).round(2),
            "humidity": rng.normal(60, 5, n),
            "iaq_score": rng.integers(0, 5, n).astype(float),
        }
    ).sample(frac=1, random_state=2)


@pytest.fixture(scope="module")
def df(spark, frame):
    return spark.createDataFrame(frame).repartition(5).checkpoint()


def test_row_numbers(df, frame):
    got = ordered.number_rows(df, ["t", "id"], chunks=7).select("id", "rn").toPandas().sort_values("rn")
    assert got["rn"].tolist() == list(range(len(frame)))
    assert got["id"].tolist() == frame.sort_values(["t", "id"])["id"].tolist()


def test_running_totals(df, frame):
    out = ordered.running_totals(df, ["t", "id"], ["iaq_score"], ["device_id"], chunks=6)
    got = out.select("id", "iaq_score_run").toPandas().set_index("id")["iaq_score_run"]
    want = frame.sort_values(["t", "id"]).set_index("id").groupby("device_id")["iaq_score"].cumsum()
    assert (got.sort_index() == want.sort_index()).all()


@pytest.mark.parametrize("groups", [[], ["device_id"]])
def test_rolling(df, frame, groups):
    out = features.rolling(df, ["t", "id"], groups=groups, block_rows=64, chunks=5)
    got = out.toPandas().set_index("id").sort_index()
    assert len(got) == len(frame)
    line = frame.sort_values([*groups, "t", "id"]).set_index("id")
    for c in ("temperature", "humidity", "iaq_score"):
        series = line.groupby("device_id")[c] if groups else line[c]
        window = series.rolling(10, min_periods=1)
        mean, std = window.mean(), window.std().fillna(0)
        if groups:
            mean, std = mean.droplevel(0), std.droplevel(0)
        assert np.allclose(got[f"{c}_rolling_mean"], mean.sort_index(), atol=1e-9)
        assert np.allclose(got[f"{c}_rolling_std"], std.sort_index(), atol=1e-6)


def test_blocks_do_not_use_one_partition(df):
    plan = ordered.trailing_rows(df, ["t", "id"], {"m": lambda w: F.avg("temperature").over(w)}, 10)
    text = plan._jdf.queryExecution().executedPlan().toString()
    big = [part for part in text.split("Exchange SinglePartition")[1:] if "_size" not in part[:2000]]
    assert not big


def test_quantiles(df, frame):
    probs = [0.0, 0.02, 0.25, 0.5, 0.75, 0.98, 1.0]
    long = quantiles.melt(df, ["temperature", "humidity", "iaq_score"])
    got = {r.feature: r.q for r in quantiles.summarise(long, [], probs, ["feature"], chunks=5).collect()}
    for c, q in got.items():
        assert np.allclose(q, np.quantile(frame[c], probs), atol=1e-9)
    assert len(got) == 3


@pytest.mark.parametrize("rows, expected", [(0, 80000.0), (9, 80000.0), (10, 7.75)])
def test_baseline_minimum(spark, rows, expected):
    df = spark.range(rows).select((F.col("id") + 1).cast("double").alias("gas_resistance"))
    got = features.gas_baseline(df, min_rows=10, chunks=3).collect()
    assert [r.gas_baseline for r in got] == [expected]


def test_keep_latest_with_a_hot_key(spark):
    rows = [(None if i % 3 == 0 else f"k{i % 50}", i % 7, i, float(i)) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, z int, i int, v double").repartition(6)
    got = quality.keep_latest(df, ["k"], ["z", "i"]).toPandas()
    want = pd.DataFrame(rows, columns=["k", "z", "i", "v"]).sort_values(["z", "i"]).groupby("k", dropna=False).tail(1)
    assert sorted(got["i"]) == sorted(want["i"])
    plan = quality.keep_latest(df, ["k"], ["z", "i"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_max_by" in plan


def test_quality_of_nothing(spark):
    df = spark.createDataFrame([], "ts string, device_id string, temperature double, humidity double, pressure double, gas_resistance double")
    row = quality.quality_metrics(df, ["ts", "device_id"], ["ts"]).first()
    assert (row.total_in, row.clean_out, row.quality_score, row.low_quality) == (0, 0, 0.0, True)


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"), 1.0, 1.0, 1.0), (1.0, 1.0, 1000.0, 100.0)], "temperature double, humidity double, pressure double, gas_resistance double")
    assert quality.keep_valid(df).count() == 1
    assert {r.column_name: r.null_count for r in quality.null_profile(df, df.columns).collect()}["temperature"] == 1


@pytest.mark.parametrize("n, anomalies", [(10, 3), (13, 3), (2500, 37), (1000, 0)])
@pytest.mark.parametrize("slots", [65536, 4])
def test_split_is_exact_and_stable(spark, n, anomalies, slots):
    df = spark.range(n).withColumn("is_anomaly", (F.col("id") < anomalies).cast("int"))
    out = labels.stratified_split(df, "id", slots=slots).toPandas()
    assert len(out) == n and out["id"].is_unique
    total = int(np.ceil(0.2 * n))
    exact = {c: total * k / n for c, k in ((0, n - anomalies), (1, anomalies))}
    quotas = {c: int(v) for c, v in exact.items()}
    for c in sorted(exact, key=lambda c: (quotas[c] - exact[c], c))[: total - sum(quotas.values())]:
        quotas[c] += 1
    test = out[out["split"] == "test"].groupby("is_anomaly").size().to_dict()
    assert {c: test.get(c, 0) for c in quotas} == quotas
    again = labels.stratified_split(df.repartition(3), "id", slots=slots).toPandas()
    assert set(again[again["split"] == "test"]["id"]) == set(out[out["split"] == "test"]["id"])
