"""Ridge fits from a distributed Gram matrix.

The data pass is one grouped aggregation of power sums (``sum(xi*xj)``,
``sum(xi*y)``, ``sum(y*y)``); the only Python is the tiny
``(k+1) x (k+1)`` solve per (group, alpha) in ``applyInPandas``. R^2 comes
from the same sums, so there is no second pass over the rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def gram(df: DataFrame, xs, y: str, group_col: str | None = None) -> DataFrame:
    feats = [F.lit(1.0)] + [F.col(x).cast("double") for x in xs]
    aggs = [F.count("*").alias("n")]
    k = len(feats)
    for i in range(k):
        for j in range(i, k):
            aggs.append(F.sum(feats[i] * feats[j]).alias(f"g_{i}_{j}"))
        aggs.append(F.sum(feats[i] * F.col(y)).alias(f"b_{i}"))
    aggs.append(F.sum(F.col(y) * F.col(y)).alias("yy"))
    g = df.groupBy(group_col) if group_col else df.groupBy()
    return g.agg(*aggs)


def _solve(row: pd.Series, k: int, alpha: float):
    G = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            G[i, j] = G[j, i] = row[f"g_{i}_{j}"]
    b = np.array([row[f"b_{i}"] for i in range(k)])
    reg = alpha * np.eye(k)
    reg[0, 0] = 0.0                       # the intercept is not penalised
    w = np.linalg.solve(G + reg, b)
    n, yy, sy = row["n"], row["yy"], row["b_0"]
    ss_res = yy - 2 * w @ b + w @ G @ w
    ss_tot = yy - sy * sy / n
    return w, 1.0 - ss_res / ss_tot


def ridge_fit(df: DataFrame, xs, y: str, alphas, group_col: str | None = None) -> DataFrame:
    """Per group and alpha: intercept, weights ``w_<x>``, weight norm, R^2."""
    k = len(xs) + 1
    gcol = group_col or "_all"
    g = gram(df, xs, y, group_col)
    if not group_col:
        g = g.withColumn(gcol, F.lit("all"))
    g = g.withColumn("alpha", F.explode(F.array(*[F.lit(float(a)) for a in alphas])))
    fields = [T.StructField(gcol, T.StringType()), T.StructField("alpha", T.DoubleType()),
              T.StructField("intercept", T.DoubleType())]
    fields += [T.StructField(f"w_{x}", T.DoubleType()) for x in xs]
    fields += [T.StructField("weight_norm", T.DoubleType()), T.StructField("r2", T.DoubleType())]
    schema = T.StructType(fields)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for _, row in pdf.iterrows():
            w, r2 = _solve(row, k, float(row["alpha"]))
            rows.append([str(row[gcol]), float(row["alpha"]), float(w[0]), *map(float, w[1:]),
                         float(np.linalg.norm(w[1:])), float(r2)])
        return pd.DataFrame(rows, columns=[f.name for f in fields])

    out = g.withColumn(gcol, F.col(gcol).cast("string")).groupBy(gcol, "alpha").applyInPandas(solve, schema)
    return out if group_col else out.drop(gcol)


def ensemble_predict(df: DataFrame, xs, y: str, family_col: str, calib: str, target: str,
                     order_col: str, alpha: float = 0.1) -> DataFrame:
    """Fit on the calibration family (simple fit of ``y`` on the mean of
    ``xs``, and ridge), predict the target family with the average of both,
    and union measured + estimated rows sorted by ``order_col``."""
    cal = df.filter(F.col(family_col) == calib)
    xavg = sum((F.col(x) for x in xs), F.lit(0.0)) / len(xs)
    line = cal.agg(F.struct(F.regr_slope(F.col(y), xavg).alias("s"), F.regr_intercept(F.col(y), xavg).alias("i"))).scalar()
    ridge = ridge_fit(cal, xs, y, [alpha]).select(F.struct("intercept", *[f"w_{x}" for x in xs])).scalar()
    ridge_pred = ridge["intercept"] + sum((F.col(x) * ridge[f"w_{x}"] for x in xs), F.lit(0.0))
    simple_pred = line["s"] * xavg + line["i"]
    est = df.filter(F.col(family_col) == target).select(
        F.col("model_id"), F.col(family_col).alias("family"), F.col(order_col),
        simple_pred.alias("simple"), ridge_pred.alias("ridge"),
        ((simple_pred + ridge_pred) / 2).alias(y), F.lit("Estimated").alias("source"))
    meas = cal.select(F.col("model_id"), F.col(family_col).alias("family"), F.col(order_col),
                      F.lit(None).cast("double").alias("simple"), F.lit(None).cast("double").alias("ridge"),
                      F.col(y), F.lit("Measured").alias("source"))
    return meas.unionByName(est).orderBy(order_col, "model_id")
