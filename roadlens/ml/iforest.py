"""Isolation forest on Spark: M1-M6, M12, M14.

Spark ML has no isolation forest, so the fit is distributed by hand. All that is
random comes from md5 of names, so another engine can repeat a fit exactly.

* M1 scaling: means and population standard deviations in one aggregate, rounded
  so that they don't depend on the order of summation.
* Subsampling: one hash per row. It names the first of the trees that the row is
  offered to; as many follow as give each tree some ``SPARE`` times its share. A
  tree ranks its offers by a linear map of the hash and takes the first ``psi``.
  About ``SPARE * trees * psi`` rows are ranked, however large the input; where
  repeated keys leave a tree short, more are offered.
* M2 build: ``groupBy(tree).applyInPandas`` grows one tree per group of at most
  ``psi`` rows, numbered as a heap (children of i: 2i and 2i + 1), with a depth
  limit of ceil(log2 psi).
* M3 score: the node table (at most trees x (2 psi - 1) rows, a proven bound) is
  broadcast to an Arrow-batched pandas UDF that walks a tree for a whole batch at
  once, as many steps as the depth limit. Path lengths are whole numbers of
  ``1 / UNIT``, so their sum is exact. Score = -2^(-E[h(x)] / c(psi)) (Liu, Ting
  and Zhou, 2008), rounded; lower is more anomalous.
* M4 predict: the offset is the exact contamination quantile of the training
  scores, from counts per rounded score (at most 10^SCORE_DIGITS + 1 rows); below
  it is -1.
* M12: the node table and one parameter row are written as Parquet.
"""

from __future__ import annotations

import hashlib
import json
import math
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.functions.numeric import round_half_up

# Feature columns and model parameters.
FEATURE_COLS = [
    "speed_ms",
    "accel_magnitude",
    "steering_angle_deg",
    "brake_pressure_pct",
    "engine_temp_celsius",
]
N_TREES = 100
CONTAMINATION = 0.05
SEED = 42
MAX_SAMPLES = 256

STAT_DIGITS = 9
SCORE_DIGITS = 6
UNIT = 10**9
SPARE = 8
#: Modulus of the linear maps that rank the offers.
PRIME = 2**31 - 1

NODE_SCHEMA = T.StructType([
    T.StructField("tree_id", T.IntegerType()),
    T.StructField("node_id", T.IntegerType()),
    T.StructField("feature", T.IntegerType()),  # -1: a leaf
    T.StructField("threshold", T.DoubleType()),  # larger values go right
    T.StructField("size", T.IntegerType()),
    T.StructField("length", T.LongType()),  # a leaf's path length in 1 / UNIT
])


def c_factor(n) -> np.ndarray:
    """Average path length of an unsuccessful BST search over n points."""
    n = np.asarray(n, dtype="float64")
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + np.euler_gamma) - 2.0 * (n[big] - 1.0) / n[big]
    out[n == 2] = 1.0
    return out


def feature_frame(df: DataFrame, features=FEATURE_COLS) -> DataFrame:
    """M5: the feature columns, ``accel_magnitude`` derived from the raw
    components when absent, nulls as 0.0; a missing column is an error at
    plan time."""
    cols = set(df.columns)
    exprs = {}
    missing = []
    for c in features:
        if c in cols:
            exprs[c] = F.col(c).cast("double")
        elif c == "accel_magnitude" and {"accel_x", "accel_y", "accel_z"} <= cols:
            exprs[c] = F.sqrt(F.col("accel_x") ** 2 + F.col("accel_y") ** 2 + F.col("accel_z") ** 2)
        else:
            missing.append(c)
    if missing:
        raise ValueError(f"Missing and not derivable: {', '.join(missing)}")
    return df.withColumns({c: F.coalesce(e, F.lit(0.0)) for c, e in exprs.items()})


def depth_limit(psi: int) -> int:
    return math.ceil(math.log2(max(psi, 2)))


def _digits(*names) -> str:
    return hashlib.md5(":".join(str(n) for n in names).encode()).hexdigest()


def _grow(key, pdf: pd.DataFrame) -> pd.DataFrame:
    tree, seed = int(key[0]), int(pdf["_seed"].iat[0])
    x = np.stack([pdf[c].to_numpy(dtype="float64") for c in pdf.columns if c.startswith("f_")], axis=1)
    limit = depth_limit(len(x))
    nodes, level = [], {1: np.arange(len(x))}
    for depth in range(limit + 1):
        below = {}
        for node, members in level.items():
            sub = x[members]
            lo, hi = sub.min(axis=0), sub.max(axis=0)
            open_to = np.flatnonzero(hi > lo)
            if depth == limit or not len(open_to):
                length = round((depth + float(c_factor(len(members)))) * UNIT)
                nodes.append((tree, node, -1, 0.0, len(members), length))
                continue
            draw = _digits(seed, tree, node)
            f = open_to[int(draw[:7], 16) % len(open_to)]
            cut = lo[f] + int(draw[7:20], 16) / 2**52 * (hi[f] - lo[f])
            cut = cut if cut < hi[f] else lo[f]
            right = sub[:, f] > cut
            nodes.append((tree, node, f, cut, len(members), 0))
            below[2 * node], below[2 * node + 1] = members[~right], members[right]
        level = below
    return pd.DataFrame(nodes, columns=NODE_SCHEMA.fieldNames())


@dataclass
class IsolationForestModel:
    nodes: pd.DataFrame
    means: list[float]
    stds: list[float]
    psi: int
    offset: float
    features: list[str]
    n_trees: int
    seed: int

    # ------------------------------------------------------------------ M3
    def _arrays(self):
        shape = (self.n_trees, 2 << depth_limit(self.psi))
        feature = np.full(shape, -1, dtype="int32")
        threshold = np.zeros(shape)
        length = np.zeros(shape, dtype="int64")
        at = self.nodes["tree_id"].to_numpy(), self.nodes["node_id"].to_numpy()
        feature[at], threshold[at], length[at] = (self.nodes[c] for c in ("feature", "threshold", "length"))
        return feature, threshold, length

    def score_column(self, df: DataFrame):
        """Column expression for ``score_samples`` of the rows of ``df``."""
        spark = df.sparkSession
        from roadlens.session import ship_package

        ship_package(spark)
        arrays = spark.sparkContext.broadcast(self._arrays())
        means = np.array(self.means)
        stds = np.where(np.array(self.stds) > 0, np.array(self.stds), 1.0)
        steps = depth_limit(self.psi)
        whole = float(c_factor(self.psi)) or 1.0

        @F.pandas_udf(T.DoubleType())
        def score(*cols: pd.Series) -> pd.Series:
            feature, threshold, length = arrays.value
            x = (np.stack([c.to_numpy(dtype="float64") for c in cols], axis=1) - means) / stds
            rows = np.arange(len(x))
            total = np.zeros(len(x), dtype="int64")
            for t in range(len(feature)):
                node = np.ones(len(x), dtype="int64")
                for _ in range(steps):
                    f = feature[t, node]
                    right = x[rows, np.maximum(f, 0)] > threshold[t, node]
                    node = np.where(f >= 0, 2 * node + right, node)
                total += length[t, node]
            return pd.Series(-np.power(2.0, -(total / len(feature) / UNIT) / whole))

        feats = feature_frame(df, self.features)
        return feats, round_half_up(score(*[F.col(c) for c in self.features]), SCORE_DIGITS)

    def score_samples(self, df: DataFrame, out: str = "anomaly_score") -> DataFrame:
        feats, col = self.score_column(df)
        return feats.withColumn(out, col)

    def predict(self, df: DataFrame) -> DataFrame:
        """M4: -1 for anomalies (score below the offset), 1 otherwise."""
        scored = self.score_samples(df)
        return scored.withColumn(
            "prediction", F.when(F.col("anomaly_score") < F.lit(self.offset), -1).otherwise(1)
        ).withColumn("is_anomaly", F.col("prediction") == -1)

    def scorer(self):
        """A DataFrame -> DataFrame function for the streaming anomaly
        branch (adds ``anomaly_score``, ``prediction``, ``is_anomaly``)."""
        return self.predict

    # ----------------------------------------------------------------- M12
    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(self.nodes, NODE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        params = {
            "means": self.means, "stds": self.stds, "psi": self.psi, "offset": self.offset,
            "features": self.features, "n_trees": self.n_trees, "seed": self.seed,
        }
        spark.createDataFrame([(json.dumps(params),)], "params string").coalesce(1).write.mode(
            "overwrite").parquet(f"{path}/params")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "IsolationForestModel":
        nodes = spark.read.parquet(f"{path}/nodes").toPandas()
        params = json.loads(spark.read.parquet(f"{path}/params").first()["params"])
        return cls(nodes=nodes, **params)


class IsolationForest:
    """M2: estimator (fit returns an :class:`IsolationForestModel`)."""

    def __init__(self, n_trees: int = N_TREES, contamination: float = CONTAMINATION,
                 max_samples: int = MAX_SAMPLES, seed: int = SEED, features=FEATURE_COLS,
                 key: str = "event_id"):
        self.n_trees = n_trees
        self.contamination = contamination
        self.max_samples = max_samples
        self.seed = seed
        self.features = list(features)
        self.key = key
        self.model: IsolationForestModel | None = None

    def _fitted(self) -> IsolationForestModel:
        if self.model is None:
            raise RuntimeError("no forest yet: use fit() or load()")
        return self.model

    def predict(self, df: DataFrame) -> DataFrame:
        return self._fitted().predict(df)

    def score_samples(self, df: DataFrame) -> DataFrame:
        return self._fitted().score_samples(df)

    def training_rows(self, df: DataFrame, n: int, spare: int = SPARE) -> DataFrame:
        """The rows of each tree: ``tree_id`` and the columns of ``df``, which
        has ``n`` rows."""
        psi = min(self.max_samples, n)
        offers = min(self.n_trees, -(-spare * self.n_trees * psi // n))
        digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(self.seed)), F.col(self.key).cast("string"))), 1, 15)
        hashed = df.withColumn("_h", F.conv(digits, 16, 10).cast("long"))
        mixed = F.expr(f"_h div {self.n_trees} % {PRIME}")
        if offers == 1:  # more rows than needed for one offer each
            hashed = hashed.filter(mixed < -(-PRIME * min(n, spare * self.n_trees * psi) // n))
        maps = [_digits(self.seed, t) for t in range(self.n_trees)]
        slope, shift = (F.array(*[F.lit(int(m[i:i + 7], 16) + 1).cast("long") for m in maps]) for i in (0, 7))
        offered = hashed.withColumn("_j", F.explode(F.sequence(F.lit(0), F.lit(offers - 1)))).withColumn(
            "tree_id", ((F.col("_h") + F.col("_j")) % self.n_trees).cast("int"))
        order = (mixed * F.get(slope, F.col("tree_id")) + F.get(shift, F.col("tree_id"))) % PRIME
        by = Window.partitionBy("tree_id").orderBy("_o", "_h", self.key)
        return (offered.withColumn("_o", order).withColumn("_r", F.row_number().over(by))
                .filter(F.col("_r") <= psi).select("tree_id", *df.columns))

    def fit(self, df: DataFrame) -> IsolationForestModel:
        from roadlens.session import ship_package

        ship_package(df.sparkSession)
        feats = feature_frame(df, self.features).select(self.key, *self.features)
        stats = feats.agg(
            F.count(F.lit(1)).alias("n"),
            *[round_half_up(F.avg(c), STAT_DIGITS).alias(f"m{i}") for i, c in enumerate(self.features)],
            *[round_half_up(F.stddev_pop(c), STAT_DIGITS).alias(f"s{i}") for i, c in enumerate(self.features)],
        ).first()
        n = int(stats["n"])
        if n == 0:
            raise ValueError("no training rows")
        k = len(self.features)
        means = [float(stats[f"m{i}"]) for i in range(k)]
        stds = [float(stats[f"s{i}"]) or 1.0 for i in range(k)]
        psi = min(self.max_samples, n)
        scaled = [((F.col(c) - F.lit(means[i])) / F.lit(stds[i])).alias(f"f_{i}") for i, c in enumerate(self.features)]
        spare = SPARE
        while True:
            rows = self.training_rows(feats, n, spare).select("tree_id", *scaled, F.lit(self.seed).alias("_seed"))
            nodes = rows.groupBy("tree_id").applyInPandas(_grow, NODE_SCHEMA).toPandas()
            roots = nodes[nodes["node_id"] == 1]
            if (len(roots) == self.n_trees and (roots["size"] == psi).all()) or spare * psi >= n:
                break
            spare *= 8
        model = IsolationForestModel(
            nodes=nodes, means=means, stds=stds, psi=psi, offset=0.0, features=self.features,
            n_trees=self.n_trees, seed=self.seed,
        )
        counts = model.score_samples(df).groupBy("anomaly_score").count()
        upto = counts.withColumn("upto", F.sum("count").over(Window.orderBy("anomaly_score")))
        need = max(1, math.ceil(Fraction(str(self.contamination)) * n))
        model.offset = upto.filter(F.col("upto") >= need).agg(F.min("anomaly_score")).first()[0]
        self.model = model
        return model


def anomaly_records(scored: DataFrame, features=FEATURE_COLS) -> DataFrame:
    """Detection records with the features as JSON."""
    return scored.filter(F.col("is_anomaly")).select(
        "event_id", "vehicle_id", "timestamp", "sensor_type", "anomaly_score",
        F.to_json(F.struct(*features)).alias("features"),
        F.current_timestamp().alias("detected_at"),
    )
