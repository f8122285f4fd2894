import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from airmill import constants as K
from airmill.operators import forest, shuffles
from airmill.plans import medallion
from airmill.sources import fixtures


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(11)
    n = 4000
    frame = pd.DataFrame(
        {
            "id": np.arange(n),
            "temperature": rng.normal(31, 0.4, n),
            "humidity": rng.normal(65, 1.2, n),
            "pressure": np.full(n, 1004.0),
            "gas_resistance": rng.normal(55000, 4000, n),
        }
    )
    frame["is_anomaly"] = (frame["id"] % 25 == 0).astype(int)
    odd = frame["is_anomaly"] == 1
    frame.loc[odd, "gas_resistance"] = rng.uniform(3000, 15000, odd.sum())
    frame.loc[odd, "temperature"] = rng.uniform(34, 36, odd.sum())
    return spark.createDataFrame(frame).repartition(4).checkpoint()


@pytest.fixture(scope="module")
def model(data):
    return forest.train(data, "id")


def test_scaler(data):
    got = {r.feature: (r.position, r["mean"], r.scale) for r in forest.fit_scaler(data).collect()}
    frame = data.toPandas()
    for i, f in enumerate(K.SENSOR_COLUMNS):
        scale = frame[f].std(ddof=0)
        assert got[f] == (i, pytest.approx(frame[f].mean()), pytest.approx(scale if scale > 1e-9 else 1.0))
    scaled = forest.scale_features(data, forest.fit_scaler(data)).toPandas()
    assert scaled["pressure_scaled"].abs().max() == 0 and scaled["temperature_scaled"].std(ddof=0) == pytest.approx(1)


def test_samples_have_the_full_size(spark):
    df = spark.range(50_000)
    for rows, trees in ((50_000, 20), (50_000, 3)):
        sizes = forest.tree_samples(df, "id", rows, n_trees=trees).groupBy("tree").agg(F.countDistinct("id").alias("n")).collect()
        assert [r.n for r in sizes] == [256] * trees
    few = forest.tree_samples(spark.range(40), "id", 40, n_trees=3).groupBy("tree").count().collect()
    assert [r["count"] for r in few] == [40] * 3


def test_samples_are_known_before_the_scan(spark):
    """The rows of a tree are the first places of its permutation, in key order, however the table is laid out."""
    df = spark.range(1000, 1700).repartition(5)
    drawn = forest.tree_samples(df, "id", 700, n_trees=2, subsample=30, seed=9).collect()
    for tree in range(2):
        assert {r["id"] - 1000 for r in drawn if r["tree"] == tree} == set(shuffles.places(np.arange(30), 700, 9, tree))
    assert forest.tree_samples(df.limit(0), "id", 0).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 4096, 70_001])
def test_places_are_a_permutation(spark, n):
    x = np.arange(n)
    sent = shuffles.places(x, n, 3, 7)
    assert sorted(sent) == list(range(n))
    assert n < 97 or (np.abs(np.corrcoef(x, sent)[0, 1]) < 0.25 and (sent != x).mean() > 0.9 and not (sent == shuffles.places(x, n, 3, 8)).all())
    got = spark.range(0, n, 1, 3).select("id", shuffles.place(F.col("id"), n, 3, 7).alias("to")).collect()
    assert all(sent[r["id"]] == r["to"] for r in got)


def test_places_of_large_tables():
    n = 3_000_000_000_000
    x = np.random.default_rng(1).integers(0, n, 2000)
    sent = shuffles.places(x, n, 5)
    assert len(set(sent)) == len(set(x)) and sent.min() >= 0 and sent.max() < n
    assert 0.4 < (sent < n // 2).mean() < 0.6


def test_empty_table_has_no_permutation(data):
    assert forest.permuted_features(data.limit(0), ["humidity"], "id").count() == 0


def test_trees_draw_from_the_whole_table(spark):
    drawn = forest.tree_samples(spark.range(50_000), "id", 50_000, n_trees=3).groupBy("id").count()
    assert drawn.count() > 3 * 256 - 20  # about four rows are expected twice; a shared pool of 1,536 rows has over 100


def test_forest_shape(data):
    nodes = forest.fit_forest(data, forest.fit_scaler(data).checkpoint(), "id", n_trees=10).toPandas()
    assert nodes["tree"].nunique() == 10 and (nodes.groupby("tree").size() <= 511).all()
    inner = nodes[nodes["feature"] >= 0]
    assert (inner["left"] > 0).all() and (inner["right"] > 0).all() and not (inner["feature"] == 2).any()
    again = forest.fit_forest(data.repartition(7), forest.fit_scaler(data).checkpoint(), "id", n_trees=10).toPandas()
    key = ["tree", "node"]
    pd.testing.assert_frame_equal(
        nodes.sort_values(key, ignore_index=True), again.sort_values(key, ignore_index=True), atol=1e-6, rtol=1e-6
    )


def test_scores_follow_the_nodes(data):
    scaler = forest.fit_scaler(data).checkpoint()
    nodes = forest.fit_forest(data, scaler, "id", n_trees=5).checkpoint()
    model = forest.load_model(nodes, scaler)
    sample = data.orderBy("id").limit(30).toPandas()
    table = nodes.toPandas().set_index(["tree", "node"])
    x = (sample[K.SENSOR_COLUMNS].to_numpy() - model.mean) / model.scale
    for row, got in zip(x, model.score_array(sample[K.SENSOR_COLUMNS].to_numpy())):
        paths = []
        for tree in range(5):
            at = table.loc[(tree, 0)]
            while at["feature"] >= 0:
                at = table.loc[(tree, int(at["left"] if row[int(at["feature"])] <= at["threshold"] else at["right"]))]
            paths.append(at["path"])
        assert got == pytest.approx(-(2 ** (-np.mean(paths) / forest.average_path_length(256))))


def test_outliers_score_lower(data, model):
    gold = medallion.to_gold(data.drop("is_anomaly").withColumn("truth", F.col("id") % 25 == 0), model)
    frame = gold.toPandas()
    assert frame["anomaly_score"].between(-1, 0).all()
    assert frame.loc[frame["truth"], "anomaly_score"].max() < frame.loc[~frame["truth"], "anomaly_score"].median()
    assert frame["is_anomaly"].mean() == pytest.approx(0.04, abs=0.003)
    assert frame.loc[frame["is_anomaly"] == 1, "truth"].mean() > 0.9
    assert ((frame["prediction"] == -1) == (frame["decision_score"] < 0)).all()
    assert (frame["outlierness"] == -frame["anomaly_score"]).all()


def test_strict_features(data, model):
    with pytest.raises(ValueError):
        forest.score(data.drop("humidity"), model)


def test_permutation_importance(data, model):
    got = {r.feature: r.importance for r in forest.permutation_importance(data, model, "id").collect()}
    assert got["pressure"] == 0 and min(got["temperature"], got["gas_resistance"], got["humidity"]) > 0


@pytest.mark.parametrize("seed", [4000, 40_000])
def test_permuted_column_keeps_its_values(data, seed):
    frame = forest.permuted_features(data, ["humidity"], "id", seed).toPandas()
    assert len(frame) == 4000
    assert sorted(frame["humidity"]) == sorted(frame["humidity_permuted"])
    assert (frame["humidity"] != frame["humidity_permuted"]).mean() > 0.99


def test_cutoff_is_the_quantile(spark):
    df = spark.range(101).select((-F.col("id") / 100.0).alias("anomaly_score"))
    assert forest.cutoff(df, 0.05).first()[0] == pytest.approx(-0.95)
    assert [r.c for r in spark.createDataFrame([(0.0,), (0.2,), (0.9,)], "r double").select(forest.contamination(F.col("r")).alias("c")).collect()] == [0.01, 0.2, 0.5]


def test_box_score_borders(spark):
    df = spark.createDataFrame([(33.0, 20000.0), (33.1, 20000.0), (33.0, 20000.1)], "temperature double, gas_resistance double")
    got = [r.s for r in df.select(forest.box_score(fixtures.CHAMPION_BOXES).alias("s")).collect()]
    c = forest.average_path_length(256)
    assert got == [pytest.approx(-(2 ** (-m / c))) for m in ((2 + 5) / 2, (1 + 5) / 2, (6 + 5) / 2)]


def test_response_document(spark):
    df = spark.createDataFrame([(36.0, 50.0, 1004.0, 15000.0)], "temperature double, humidity double, pressure double, gas_resistance double")
    out = medallion.response_json(medallion.score_readings(df, F.lit(-0.4), -0.5))
    body = json.loads(out.first().response)
    assert body["statusCode"] == 200 and body["body"]["is_anomaly"] is True and body["body"]["anomaly_type"] == "FIRE_RISK"
    assert body["body"]["decision_score"] == 0.1 and body["body"]["score_meaning"] == "deep_normal"
    assert body["body"]["contributing_factors"] == ["temperature_critical", "gas_very_low"]


def test_respond_gives_error_records(spark):
    """Readable events get status 200; a missing field, a text and a null get error records that name the field."""
    whole = '{"T":25,"H":50,"P":1010,"G":60000}'
    bodies = [whole, '{"T":25,"H":50,"G":60000}', '{"T":25,"H":"damp","P":1010,"G":60000}', '{"T":null,"H":50,"P":1010,"G":60000}', "no json"]
    events = spark.createDataFrame(list(enumerate(bodies)), "id int, body string")
    told = [json.loads(r.response) for r in medallion.respond(events, F.lit(-0.4), -0.5).orderBy("id").collect()]
    assert [t["statusCode"] for t in told] == [200, 400, 400, 500, 400]
    assert told[0]["body"]["anomaly_type"] == "NORMAL" and told[0]["body"]["decision_score"] == 0.1
    assert [t["body"]["error"] for t in told[1:]] == [f"unusable_field:{c}" for c in ("pressure", "humidity", "temperature", "temperature")]
