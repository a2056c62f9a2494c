"""Operator 10: embedding near-duplicates by an epsilon grid order join.

Vectors are projected on their leading principal dimensions and sorted by
their cells in a grid of width epsilon, the largest distance of unit vectors
that still link. The sorted sequence is cut into intervals. Starting from the
whole sequence, pairs of intervals are split recursively, and a pair whose
bounding boxes lie more than epsilon apart is skipped: a projection never
lengthens a distance, so no link is lost. Leaf pairs are compared with matrix
products in double precision, again split into small boxes first.

Equal vectors are one class with a count, so copies cost nothing. The basis is
fitted on a sample of at most ``SAMPLE`` vectors (any basis gives the same
links); everything else covers all vectors.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadlens.llm.common import kept_table, read, ship_package
from roadlens.llm.graph import components

COSINE = 0.95
DIMENSIONS = 8
SAMPLE = 4096
LEAF = 2048
SMALL = 128
FAN = 16


def principal(classes: DataFrame) -> np.ndarray:
    """Leading principal directions (rows) of a bounded hash-ordered sample."""
    rows = [r.vec for r in classes.select("vec").orderBy(F.xxhash64("vec")).limit(SAMPLE).collect()]
    if not rows:
        return np.zeros((0, 0))
    common = pd.Series([len(v) for v in rows]).mode()[0]
    unit = np.array([v for v in rows if len(v) == common], float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    return np.linalg.svd(unit - unit.mean(axis=0), full_matrices=False)[2][:DIMENSIONS]


def projected(classes: DataFrame, basis: np.ndarray, epsilon: float) -> DataFrame:
    """Adds ``p`` (the projection) and ``cell``; zeros for other lengths."""
    k, d = basis.shape

    def batches(it):
        for batch in it:
            vecs = batch.column("vec").to_pylist()
            p = np.zeros((len(vecs), k))
            fit = [i for i, v in enumerate(vecs) if len(v) == d]
            if fit:
                unit = np.array([vecs[i] for i in fit], float)
                p[fit] = (unit / np.linalg.norm(unit, axis=1, keepdims=True)) @ basis.T
            cell = np.floor(p / epsilon).astype(np.int32)
            ends = pa.array(np.arange(0, (len(vecs) + 1) * k, k or 1)[:len(vecs) + 1] if k else [0] * (len(vecs) + 1),
                            pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(ends, pa.array(p.ravel())),
                 pa.ListArray.from_arrays(ends, pa.array(cell.ravel()))], [*batch.schema.names, "p", "cell"])

    fields = ", ".join(f"{c} {t}" for c, t in classes.dtypes)
    return classes.mapInArrow(batches, f"{fields}, p array<double>, cell array<int>")


def near(a: str, b: str, epsilon: float) -> str:
    """Whether the boxes (lo, hi) of two intervals lie within epsilon."""
    gap = f"zip_with({a}_lo, {b}_hi, (x, y) -> greatest(0D, x - y)), zip_with({b}_lo, {a}_hi, (x, y) -> greatest(0D, x - y))"
    return f"aggregate(zip_with({gap}, (x, y) -> (x + y) * (x + y)), 0D, (t, x) -> t + x) <= {epsilon ** 2!r}"


def interval_pairs(leaves: DataFrame, n: int, epsilon: float) -> DataFrame:
    """Pairs (i, j), i <= j, of leaf intervals (``seq``, ``lo``, ``hi``) whose
    boxes lie within epsilon, by recursion from the whole sequence."""
    levels = max(0, math.ceil(math.log(max(n, 1), FAN) - 1e-9))
    pairs = leaves.sparkSession.range(1).select(F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j"))
    for level in range(levels - 1, -1, -1):
        width = FAN ** level
        box = leaves.withColumn("node", F.expr(f"seq DIV {width}"))
        spans = (box.select("node", F.posexplode(F.arrays_zip("lo", "hi")).alias("d", "x"))
                 .groupBy("node", "d").agg(F.min("x.lo").alias("lo"), F.max("x.hi").alias("hi"))
                 .groupBy("node").agg(F.sort_array(F.collect_list(F.struct("d", "lo", "hi"))).alias("x"))
                 .select("node", F.expr("transform(x, y -> y.lo)").alias("lo"), F.expr("transform(x, y -> y.hi)").alias("hi")))
        spans = spans if level else box.select("node", "lo", "hi")
        a, b = (spans.select(F.col("node").alias(s), F.col("lo").alias(f"{s}_lo"), F.col("hi").alias(f"{s}_hi"))
                for s in ("i", "j"))
        last = (n - 1) // width
        children = f"sequence({{0}} * {FAN}L, least({last}L, {{0}} * {FAN}L + {FAN - 1}))"
        split = (pairs.select(F.explode(F.expr(children.format("i"))).alias("i"), "j")
                 .select("i", F.explode(F.expr(children.format("j"))).alias("j")).filter("i <= j"))
        pairs = split.join(a, "i").join(b, "j").filter(near("i", "j", epsilon)).select("i", "j")
        if level:
            pairs = kept_table(pairs, "intervals")
    return pairs


def leaf_links(rows: DataFrame, cosine: float, epsilon: float) -> DataFrame:
    """Compares the vectors of leaf pairs (i, j): rows (a, b, links), either a
    link needed to connect all that link, or the count of a's links (b null)."""
    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        same = pdf["i"].iat[0] == pdf["j"].iat[0]
        out_a, out_b, out_n = [], [], []
        for _, part in pdf.groupby(pdf["vec"].map(len)):
            left = part[part["side"] == "i"]
            right = left if same else part[part["side"] == "j"]
            if not len(left) or not len(right):
                continue
            sides = []
            for side in (left, right):
                p = np.array(side["p"].to_list(), float).reshape(len(side), -1)
                order = np.lexsort(np.floor(p / epsilon).T[::-1]) if p.shape[1] else np.arange(len(side))
                unit = np.array(side["vec"].to_list(), float)[order]
                unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                sides.append((side["node"].to_numpy()[order], side["m"].to_numpy()[order], unit, p[order]))
            (ia, ma, ua, pa_), (ib, mb, ub, pb) = sides
            na, nb = np.zeros(len(ia), np.int64), np.zeros(len(ib), np.int64)
            label = np.arange(len(ia) + len(ib)) if not same else np.arange(len(ia))
            shift = 0 if same else len(ia)
            for s in range(0, len(ia), SMALL):
                for t in range(s if same else 0, len(ib), SMALL):
                    x, y = pa_[s:s + SMALL], pb[t:t + SMALL]
                    gap = np.maximum(0, np.maximum(x.min(0, initial=9) - y.max(0, initial=-9),
                                                   y.min(0, initial=9) - x.max(0, initial=-9)))
                    if (gap ** 2).sum() > epsilon ** 2:
                        continue
                    hit = ua[s:s + SMALL] @ ub[t:t + SMALL].T >= cosine
                    if same and s == t:
                        np.fill_diagonal(hit, False)
                    na[s:s + SMALL] += hit @ mb[t:t + SMALL]
                    if not same or s != t:
                        nb[t:t + SMALL] += hit.T @ ma[s:s + SMALL]
                    for r in np.flatnonzero(hit.any(axis=1)):
                        ys = np.flatnonzero(hit[r]) + t + shift
                        here = label[s + r]
                        for y_ in ys[label[ys] != here]:
                            if label[y_] != label[s + r]:
                                out_a.append(ia[s + r])
                                out_b.append(ib[y_ - shift])
                                out_n.append(0)
                                label[label == label[y_]] = label[s + r]
            for ids, n in ((ia, na + nb if same else na), (ib, nb if not same else nb[:0])):
                has = np.flatnonzero(n)
                out_a += ids[has].tolist()
                out_b += [None] * len(has)
                out_n += n[has].tolist()
        return pd.DataFrame({"a": pd.array(out_a, "Int64"), "b": pd.array(out_b, "Int64"), "links": pd.array(out_n, "Int64")})

    return rows.groupBy("i", "j").applyInPandas(meet, "a long, b long, links long")


def near_embeddings(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding",
                    cosine: float = COSINE) -> DataFrame:
    """One row per row of ``vectors``: id, ``n_links`` (other rows linked with
    it), ``component_id`` (least id reachable) and ``kept``.

    Vectors that are null, empty, zero, or hold null or non-finite components
    link with nothing, nor do vectors of different lengths or rows with a null
    id (their component is null). Rows that repeat an id with the same vector
    count as other rows. An empty table gives no rows."""
    ship_package(vectors.sparkSession)
    epsilon = math.sqrt(2 - 2 * cosine) + 1e-9
    rows = vectors.select(F.col(id_col).alias("__id"), F.col(vector_col).alias("vec"))
    fine = F.expr("""__id IS NOT NULL AND size(vec) > 0
        AND forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) AND exists(vec, x -> x <> 0)""")
    classes = (rows.filter(fine).groupBy("vec").agg(F.min("__id").alias("rep"), F.count(F.lit(1)).alias("m"))
               .withColumn("node", F.monotonically_increasing_id()))
    classes = kept_table(classes, "vectors")
    n = classes.count()
    spread = max(1, math.ceil(n / (4 * LEAF)))
    ordered = (projected(classes.select("node", "m", "vec"), principal(classes), epsilon)
               .repartitionByRange(spread, "cell", "node").sortWithinPartitions("cell", "node").drop("cell")
               .withColumn("pid", F.spark_partition_id())
               .withColumn("at", F.expr("monotonically_increasing_id() & 8589934591L")))
    ordered = kept_table(ordered, "ordered")
    # Intervals hold LEAF vectors of the whole sequence, however many range
    # partitions it has: one count per partition gives where each starts.
    earlier = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = (ordered.groupBy("pid").agg(F.count(F.lit(1)).alias("held"))
              .select("pid", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before")))
    placed = (ordered.join(starts, "pid").withColumn("seq", F.expr(f"(before + at) DIV {LEAF}"))
              .drop("pid", "at", "before"))
    boxes = (placed.select("seq", F.posexplode("p").alias("d", "x"))
             .groupBy("seq", "d").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
             .groupBy("seq").agg(F.sort_array(F.collect_list(F.struct("d", "lo", "hi"))).alias("x"))
             .select("seq", F.expr("transform(x, y -> y.lo)").alias("lo"), F.expr("transform(x, y -> y.hi)").alias("hi")))
    leaves = kept_table(boxes, "leaves")
    meets = kept_table(interval_pairs(leaves, math.ceil(n / LEAF), epsilon), "meets")
    sides = [placed.join(meets.withColumn("seq", F.col(s)), "seq").withColumn("side", F.lit(s)).drop("seq") for s in ("i", "j")]
    found = kept_table(leaf_links(sides[0].unionByName(sides[1].filter("i < j")), cosine, epsilon), "links")
    counts = found.filter("b IS NULL").groupBy("a").agg(F.sum("links").alias("links"))
    named = classes.select("node", "rep")
    edges = (found.filter("b IS NOT NULL").join(named.select(F.col("node").alias("a"), F.col("rep").alias("ra")), "a")
             .join(named.select(F.col("node").alias("b"), F.col("rep").alias("rb")), "b")
             .select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    roots = components(edges)
    labelled = (classes.join(counts.withColumnRenamed("a", "node"), "node", "left")
                .join(roots.withColumnRenamed("v", "rep"), "rep", "left")
                .select("vec", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("links"),
                        F.coalesce("root", "rep").alias("component")))
    alone, out = rows.filter(~F.coalesce(fine, F.lit(False))), rows.filter(fine)
    result = (out.join(labelled, "vec").select("__id", "links", "component")
              .unionByName(alone.select("__id", F.lit(0).cast("long").alias("links"), F.col("__id").alias("component"))))
    return result.select(F.col("__id").alias(id_col), F.col("links").alias("n_links"),
                         F.col("component").alias("component_id"),
                         F.coalesce(F.col("__id") == F.col("component"), F.lit(True)).alias("kept"))


def op10_epsilon_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embeddings(read(spark, sf_dir, "embeddings"))


ORACLE_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id
      AND list_cosine_similarity(a.e, b.e) >= {COSINE}),
r(x, y) AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y)
SELECT v.vec_id, coalesce(c.n, 0) AS n_links, least(v.vec_id, coalesce(m.y, v.vec_id)) AS component_id,
  v.vec_id = least(v.vec_id, coalesce(m.y, v.vec_id)) AS kept
FROM v LEFT JOIN (SELECT x, count(*) AS n FROM l GROUP BY x) c ON c.x = v.vec_id
LEFT JOIN (SELECT x, min(y) AS y FROM r GROUP BY x) m ON m.x = v.vec_id
"""
