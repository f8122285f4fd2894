import itertools

import pytest
from pyspark.sql import functions as F

from airmill import constants as K
from airmill.functions import air_quality, rules, stats
from airmill.functions.lists import code_list
from airmill.operators import labels


def rows(spark, data, schema, **columns):
    return spark.createDataFrame(data, schema).select(*[c.alias(n) for n, c in columns.items()]).collect()


def test_iaq_borders(spark):
    data = [(80.0, 45.0), (100.0, 30.0), (50.0, 60.0), (100.0, 61.5), (100.0, 20.0), (0.0, 100.0), (1e9, 29.99), (None, 50.0)]
    got = rows(spark, data, "g double, h double", s=air_quality.iaq_score(F.col("g"), F.col("h"), F.lit(100.0)))
    assert [r.s for r in got] == [60.0, 0.0, 150.0, 7.5, 50.0, 500.0, 0.05, None]


def test_labels_and_bands(spark):
    values = [0, 50, 51, 100, 101, 150, 151, 200, 201, 300, 301, None]
    got = [r.s for r in rows(spark, [(v,) for v in values], "i int", s=air_quality.air_label(F.col("i")))]
    names = [name for _, name in K.AIR_LABELS]
    assert got == [names[0]] * 2 + [n for n in names[1:] for _ in range(2)] + [K.AIR_LABEL_WORST, None]
    scores = [0.1, 0.0, -0.05, -0.1, -0.2]
    got = [r.s for r in rows(spark, [(v,) for v in scores], "d double", s=air_quality.score_band(F.col("d")))]
    assert got == ["deep_normal", "near_boundary", "anomalous", "severe", "extreme"]


def test_iaq_v2_range(spark):
    data = [(g, h) for g in (0.0, 1e4, 5e4, 1.3e5, 2.5e5, 1e6) for h in range(0, 101, 5)]
    got = [r.s for r in rows(spark, data, "g double, h int", s=air_quality.iaq_v2(F.col("g"), F.col("h").cast("double")))]

    def plain(g, h):
        part = (0.25 if h > 40 else 0.75) / 100 * (h - 40) * -1
        gas = (min(max(g, 1e4), 2.5e5) - 1e4) / 2.4e5 * 0.75
        return int(max(0, min(500, (1 - (part + gas) * 100) * 500 / 100)))

    assert got == [plain(g, h) for g, h in data]


def test_rules_over_a_grid(spark):
    grid = list(itertools.product((19.0, 20.0, 25.0, 33.0, 35.0), (30.0, 50.0, 75.0), (1004.0, 1005.0), (2e4, 5e4, 1e5, 1.5e5)))
    found = rules.correlation_rule(*[F.col(c) for c in "thpg"])
    got = rows(
        spark, grid, "t double, h double, p double, g double",
        r=found, f=rules.contributing_factors(F.col("t"), F.col("h"), F.col("g")),
    )
    by_input = {row: (r.r.anomaly_type, r.r.severity) for row, r in zip(grid, got)}
    assert by_input[(35.0, 50.0, 1004.0, 2e4)] == ("FIRE_RISK", "CRITICAL")
    assert by_input[(33.0, 50.0, 1004.0, 2e4)] == ("HEAT_SOURCE", "HIGH")
    assert by_input[(25.0, 75.0, 1004.0, 2e4)] == ("CHEMICAL_VOC", "CRITICAL")
    assert by_input[(25.0, 75.0, 1004.0, 5e4)] == ("AIR_POLLUTION", "MEDIUM")
    assert by_input[(25.0, 75.0, 1004.0, 1e5)] == ("WEATHER_CHANGE", "LOW")
    assert by_input[(25.0, 75.0, 1005.0, 1e5)] == ("GENERAL_ANOMALY", "MEDIUM")
    assert by_input[(20.0, 30.0, 1005.0, 1e5)] == ("DRY_COLD", "LOW")
    assert by_input[(25.0, 50.0, 1005.0, 1.5e5)] == ("NORMAL", "NONE")
    assert "MOLD_RISK" not in {kind for kind, _ in by_input.values()}
    factors = {row: r.f for row, r in zip(grid, got)}
    assert factors[(35.0, 75.0, 1004.0, 2e4)] == ["temperature_critical", "humidity_high", "gas_very_low"]
    assert factors[(19.0, 30.0, 1004.0, 1.5e5)] == ["temperature_low", "humidity_low", "gas_clean"]
    assert factors[(25.0, 50.0, 1004.0, 1e5)] == []


def test_override(spark):
    data = [("NORMAL", "NONE", True), ("NORMAL", "NONE", False), ("FIRE_RISK", "CRITICAL", False), ("DRY_COLD", "LOW", False)]
    df = spark.createDataFrame(data, "anomaly_type string, severity string, m boolean")
    got = df.select(rules.apply_override(F.struct("anomaly_type", "severity"), F.col("m")).alias("o")).collect()
    assert [tuple(r.o) for r in got] == [
        (True, "STATISTICAL_ANOMALY", "MEDIUM"), (False, "NORMAL", "NONE"), (True, "FIRE_RISK", "CRITICAL"), (False, "DRY_COLD", "LOW"),
    ]


def test_domain_label_borders(spark):
    base = dict(iaq_score=150.0, temperature=33.0, humidity=70.0)
    cases = [base, {**base, "iaq_score": 150.1}, {**base, "temperature": 28.0}, {**base, "temperature": 27.9},
             {**base, "humidity": 60.0}, {**base, "humidity": 59.9}, {**base, "humidity": None}]
    df = spark.createDataFrame([tuple(c.values()) for c in cases], "iaq_score double, temperature double, humidity double")
    assert [r.is_anomaly for r in labels.with_label(df).collect()] == [0, 1, 0, 1, 0, 1, 0]


def test_kolmogorov(spark):
    values = [0.0, 0.05, 0.3, 0.8, 1.17, 1.19, 1.36, 2.5]
    got = [r.p for r in rows(spark, [(v,) for v in values], "l double", p=stats.kolmogorov_sf(F.col("l")))]
    assert got[:2] == [1.0, 1.0]
    import math

    for lam, p in list(zip(values, got))[2:]:
        series = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 200))
        assert p == pytest.approx(series, abs=1e-12)


def test_code_list(spark):
    df = spark.range(3).select(code_list(F.when(F.col("id") > 0, "a"), F.when(F.col("id") > 1, "b")).alias("c"))
    assert [r.c for r in df.collect()] == [[], ["a"], ["a", "b"]]
