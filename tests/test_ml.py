"""Isolation forest cases carried over from the reference's model tests
(FIXTURES §5), plus the paper's c(n) and reload equality."""

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from roadlens.ml.iforest import IsolationForest, IsolationForestModel, c_factor
from roadlens.ml.maintenance import FEATURE_COLS as MAINTENANCE_COLS
from roadlens.operators.features import align_imu
from roadlens.plans import q_ml, tables
from roadlens.plans.forest_sql import forest_ctes, with_forest


def normal_rows(spark, n=500, seed=42):
    rng = np.random.default_rng(seed)
    rows = [
        (f"n{i}", float(rng.uniform(0, 20)), float(rng.uniform(9.5, 10.5)), float(rng.uniform(-30, 30)),
         float(rng.uniform(0, 30)), float(rng.uniform(80, 95)))
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "event_id string, speed_ms double, accel_magnitude double, "
                                       "steering_angle_deg double, brake_pressure_pct double, engine_temp_celsius double")


@pytest.fixture(scope="module")
def model(spark):
    return IsolationForest().fit(normal_rows(spark))


def test_c_factor():
    assert c_factor([2])[0] == 1.0
    assert abs(c_factor([256])[0] - (2 * (np.log(255) + np.euler_gamma) - 2 * 255 / 256)) < 1e-12


def test_labels_and_share(spark, model):
    pred = model.predict(normal_rows(spark)).select("prediction").toPandas()["prediction"]
    assert set(pred.unique()) <= {-1, 1}
    assert (pred == 1).mean() > 0.9


def test_outlier_scores_below_mean(spark, model):
    normal = model.score_samples(normal_rows(spark)).agg(F.avg("anomaly_score")).first()[0]
    out = spark.createDataFrame([("o1", 100.0, 50.0, 400.0, 99.0, 200.0)],
                                "event_id string, speed_ms double, accel_magnitude double, "
                                "steering_angle_deg double, brake_pressure_pct double, engine_temp_celsius double")
    s = model.score_samples(out).first()["anomaly_score"]
    assert s < normal
    assert -1.0 <= s < 0.0


def test_reload_identical(spark, model, tmp_path):
    path = str(tmp_path / "forest")
    model.save(spark, path)
    again = IsolationForestModel.load(spark, path)
    a = model.score_samples(normal_rows(spark)).select("event_id", "anomaly_score").toPandas().sort_values("event_id")
    b = again.score_samples(normal_rows(spark)).select("event_id", "anomaly_score").toPandas().sort_values("event_id")
    assert np.array_equal(a.anomaly_score.to_numpy(), b.anomaly_score.to_numpy())


def test_fit_is_deterministic(spark, model):
    # Same subsample, structure and thresholds under another partitioning.
    again = IsolationForest().fit(normal_rows(spark).repartition(7))
    a = again.nodes.sort_values(["tree_id", "node_id"]).reset_index(drop=True)
    b = model.nodes.sort_values(["tree_id", "node_id"]).reset_index(drop=True)
    assert a.equals(b)
    assert again.offset == model.offset


def test_unfitted_and_missing_columns(spark, model):
    with pytest.raises(RuntimeError):
        IsolationForest().predict(normal_rows(spark))
    with pytest.raises(ValueError):
        model.score_samples(spark.createDataFrame([("x", 1.0)], "event_id string, speed_ms double"))


def test_accel_magnitude_derived(spark, model):
    df = spark.createDataFrame([("x", 1.0, 3.0, 4.0, 0.0, 0.0, 10.0, 90.0)],
                               "event_id string, speed_ms double, accel_x double, accel_y double, accel_z double, "
                               "steering_angle_deg double, brake_pressure_pct double, engine_temp_celsius double")
    r = model.score_samples(df).first()
    assert r["accel_magnitude"] == 5.0


@pytest.mark.parametrize("names, rows, sample", [("ab", 3000, 64), ("abcdef", 700, 256), ("abc", 40, 256)])
def test_forest_equals_sql(spark, names, rows, sample):
    # Ties and a constant feature included; 3,000 rows are not all offered to every tree.
    rng = np.random.default_rng(rows)
    pdf = pd.DataFrame({c: np.round(rng.normal(0, 1 + i, rows), 1) for i, c in enumerate(names)})
    pdf["b"] = 1.5 if len(names) > 2 else pdf["b"]
    pdf.insert(0, "event_id", [f"e{i}" for i in range(rows)])
    df = spark.createDataFrame(pdf)
    model = IsolationForest(n_trees=20, max_samples=sample, features=list(names)).fit(df)
    x = f"SELECT event_id, [{', '.join(names)}] AS v FROM pdf"
    con = duckdb.connect()
    con.register("pdf", pdf)

    def sql(query):
        return con.execute(with_forest(query, {"forest_input": x, **forest_ctes(len(names), 20, sample)})).fetchall()

    nodes = sql("SELECT tree_id, node_id, feature, size, length FROM forest_nodes ORDER BY ALL")
    assert nodes == sorted(model.nodes[["tree_id", "node_id", "feature", "size", "length"]].itertuples(index=False, name=None))
    scores = sorted(tuple(r) for r in model.predict(df).select("event_id", "anomaly_score", "is_anomaly").collect())
    assert scores == sql("SELECT event_id, anomaly_score, anomaly_score < cut FROM forest_scores, forest_cut ORDER BY ALL")


def test_repeated_keys_leave_no_tree_short(spark):
    # All rows share one key, so only one tree is offered rows at first.
    df = spark.range(5000).select(F.lit("same").alias("event_id"), (F.col("id") % 97).cast("double").alias("a"))
    model = IsolationForest(n_trees=100, max_samples=4, features=["a"]).fit(df)
    roots = model.nodes[model.nodes.node_id == 1]
    assert len(roots) == 100 and (roots["size"] == 4).all()


def test_model_inputs_are_decoded_once_and_keep_their_rows(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    can, imu = tables.can_bus_events(spark, sf), tables.imu_events(spark, sf)
    joined = can.join(align_imu(can, imu).select("event_id", "accel_magnitude"), "event_id", "left")
    q_ml.anomaly_input(spark, sf)
    labelled = q_ml.maintenance_input(spark, sf)
    assert set(MAINTENANCE_COLS) < set(labelled.columns) and labelled.count() == can.count() > 0
    monkeypatch.setattr(tables, "processed", lambda *a, **k: pytest.fail("decoded again"))
    monkeypatch.setattr(tables, "can_bus_events", lambda *a, **k: pytest.fail("decoded again"))
    made = q_ml.anomaly_input(spark, sf)
    q_ml.maintenance_input(spark, sf)
    joined = joined.select(*made.columns)
    assert made.count() == joined.count() > 0
    assert made.exceptAll(joined).isEmpty()
