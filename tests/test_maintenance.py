"""The maintenance model on a small frame with separable labels."""

import math
import random

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from roadlens.ml import boosting
from roadlens.ml.boosting import BinnedGBTClassifier
from roadlens.ml.maintenance import FEATURE_COLS, LABEL_COL, MaintenancePredictor


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(7)
    rows = []
    for i in range(240):
        worn = i % 3 == 0
        rows.append([i, 90.0 + 25 * worn + rng.random(), 300.0, 12.5, rng.random() * 1e5, 40.0 + 50 * worn + rng.random(),
                     rng.random() * 30, float(rng.randrange(4)), None if i % 10 == 1 else 0.0, int(worn)])
    fields = ", ".join(f"{c} double" for c in FEATURE_COLS)
    return spark.createDataFrame(rows, f"event_id long, {fields}, {LABEL_COL} int").cache()


@pytest.fixture(scope="module")
def predictor(frame):
    return MaintenancePredictor(n_trees=5).fit(frame)


def test_separable_labels_are_told_apart(frame, predictor):
    scored = predictor.predict_proba(frame).select(
        F.col(LABEL_COL).cast("double").alias("label"),
        array_to_vector(F.array(1 - F.col("maintenance_risk"), F.col("maintenance_risk"))).alias("rawPrediction"))
    assert BinaryClassificationEvaluator().evaluate(scored) > 0.99
    assert predictor.predict(frame).filter(F.col("needs_maintenance") != F.col(LABEL_COL)).count() == 0


def test_threshold_and_missing_features(frame, predictor):
    assert predictor.predict(frame, threshold=0.0).filter("needs_maintenance = 0").count() == 0
    assert predictor.predict(frame, threshold=1.01).filter("needs_maintenance = 1").count() == 0
    # A missing feature counts as 0 when scoring, but not when training.
    filled = predictor.predict_proba(frame.withColumn("odometer_km", F.lit(0.0))).select("event_id", "maintenance_risk")
    absent = predictor.predict_proba(frame.drop("odometer_km")).select("event_id", "maintenance_risk")
    assert filled.exceptAll(absent).count() == 0
    for column in ("odometer_km", LABEL_COL):
        with pytest.raises(ValueError, match="Missing"):
            MaintenancePredictor(n_trees=1).fit(frame.drop(column))
    with pytest.raises(RuntimeError, match="fit"):
        MaintenancePredictor().predict_proba(frame)


def test_importances_and_reload(spark, frame, predictor, tmp_path):
    importances = [r.importance for r in predictor.feature_importance(spark).collect()]
    assert len(importances) == len(FEATURE_COLS) and abs(sum(importances) - 1) < 1e-9
    assert importances == sorted(importances, reverse=True)
    predictor.save(str(tmp_path / "model"))
    again = MaintenancePredictor.load(str(tmp_path / "model"))
    risks = [p.predict_proba(frame).select("event_id", "maintenance_risk") for p in (predictor, again)]
    assert risks[0].exceptAll(risks[1]).count() == 0


def test_binned_fit_is_sparks_and_does_not_depend_on_partitions(spark, monkeypatch):
    # Above 10,000 rows, where Spark draws rows for its candidate splits; three features, one all zero.
    rng = random.Random(11)
    rows = []
    for _ in range(12_000):
        a, b = rng.gauss(0, 1), float(rng.randrange(5))
        rows.append((a, b, 0.0, float(rng.random() < 1 / (1 + math.exp(-2 * a - b * (a > 0) + 1)))))
    plain = spark.createDataFrame(rows, "a double, b double, c double, label double").repartition(3, "a")
    frame = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(plain).cache()
    settings = dict(labelCol="label", featuresCol="features", maxIter=6, stepSize=0.3, maxDepth=4, seed=42)
    own, sparks = (cls(**settings).fit(frame) for cls in (BinnedGBTClassifier, GBTClassifier))
    both = [{r.features: r.p for r in m.transform(frame).select("features", F.element_at(vector_to_array("probability"), 2).alias("p")).collect()}
            for m in (own, sparks)]
    assert max(abs(p - both[1][x]) for x, p in both[0].items()) < 1e-9
    assert own.featureImportances.toArray() == pytest.approx(sparks.featureImportances.toArray(), abs=1e-3)
    few, persisted = frame.limit(9000).cache(), spark.sparkContext._jsc.getPersistentRDDs
    few.count()
    held = set(persisted())
    texts = set()
    for parts, block, rebuild in ((1, 1 << 16, 50), (5, 700, 2), (3, 4000, 3)):
        monkeypatch.setattr(boosting, "BLOCK", block)
        monkeypatch.setattr(boosting, "REBUILD", rebuild)
        texts.add(BinnedGBTClassifier(**settings).fit(few.repartition(parts, "a")).toDebugString.split("\n", 1)[1])
    assert len(texts) == 1 and set(persisted()) == held
