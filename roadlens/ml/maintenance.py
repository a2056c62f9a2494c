"""Maintenance-risk classifier: M1, M7-M12 on Spark ML.

Pipeline = VectorAssembler -> StandardScaler(withMean) -> GBTClassifier
(200 trees, step 0.05, depth 4, seed 42), fitted on binned rows. Training needs every feature and
the label (error otherwise); inference fills a missing feature with 0.0.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.ml.boosting import BinnedGBTClassifier

# Feature columns, label and model parameters.
FEATURE_COLS = [
    "engine_temp_celsius",
    "oil_pressure_kpa",
    "battery_voltage",
    "odometer_km",
    "brake_wear_pct",
    "avg_speed_ms_1h",
    "hard_brake_count_1h",
    "engine_overheating_count_1h",
]
LABEL_COL = "needs_maintenance_24h"
N_TREES = 200
STEP = 0.05
DEPTH = 4
SEED = 42
FOLDS = 5


def _training_frame(df: DataFrame) -> DataFrame:
    missing = [c for c in FEATURE_COLS if c not in df.columns]
    if missing:
        raise ValueError(f"Missing from the training frame: {', '.join(missing)}")
    if LABEL_COL not in df.columns:
        raise ValueError(f"Missing from the training frame: the label {LABEL_COL!r}")
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in FEATURE_COLS}
    ).withColumn("label", F.col(LABEL_COL).cast("double"))


def _inference_frame(df: DataFrame) -> DataFrame:
    cols = set(df.columns)
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in cols else F.lit(0.0) for c in FEATURE_COLS}
    )


def pipeline(n_trees: int = N_TREES, step: float = STEP, depth: int = DEPTH, seed: int = SEED) -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=FEATURE_COLS, outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        BinnedGBTClassifier(labelCol="label", featuresCol="features", maxIter=n_trees, stepSize=step,
                            maxDepth=depth, seed=seed),
    ])


class MaintenancePredictor:
    def __init__(self, n_trees: int = N_TREES, step: float = STEP, depth: int = DEPTH, seed: int = SEED):
        self._pipeline = pipeline(n_trees, step, depth, seed)
        self._model: PipelineModel | None = None

    def fit(self, df: DataFrame) -> "MaintenancePredictor":
        self._model = self._pipeline.fit(_training_frame(df))
        return self

    def cross_validate(self, df: DataFrame, folds: int = FOLDS) -> tuple[float, float]:
        """M8: mean and std of ROC-AUC over ``folds`` folds."""
        cv = CrossValidator(
            estimator=self._pipeline,
            estimatorParamMaps=ParamGridBuilder().build(),
            evaluator=BinaryClassificationEvaluator(metricName="areaUnderROC"),
            numFolds=folds, seed=SEED, collectSubModels=False,
        )
        m = cv.fit(_training_frame(df))
        std = m.stdMetrics[0] if m.stdMetrics else 0.0
        return float(m.avgMetrics[0]), float(std)

    def _require(self) -> PipelineModel:
        if self._model is None:
            raise RuntimeError("no model yet: use fit() or load()")
        return self._model

    def predict_proba(self, df: DataFrame) -> DataFrame:
        """Probability of needing maintenance (class 1)."""
        out = self._require().transform(_inference_frame(df))
        return out.withColumn("maintenance_risk", vector_to_array("probability")[1]).drop(
            "raw_features", "features", "rawPrediction", "probability", "prediction")

    def predict(self, df: DataFrame, threshold: float = 0.5) -> DataFrame:
        return self.predict_proba(df).withColumn(
            "needs_maintenance", (F.col("maintenance_risk") >= threshold).cast("int"))

    def feature_importance(self, spark: SparkSession) -> DataFrame:
        """M9: importances sorted descending."""
        gbt = self._require().stages[-1]
        imp = gbt.featureImportances.toArray().tolist()
        rows = [(c, float(v)) for c, v in zip(FEATURE_COLS, imp)]
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"))

    def save(self, path: str) -> None:
        self._require().write().overwrite().save(path)

    @classmethod
    def load(cls, path: str) -> "MaintenancePredictor":
        p = cls()
        p._model = PipelineModel.load(path)
        return p
