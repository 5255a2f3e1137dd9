"""Linear models: M3 elastic net, M4 training summary, M5 OLS, M6 ridge (CV alpha)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ols(label: str = "relevance", features: str = "features") -> LinearRegression:
    """M5: ordinary least squares via the normal equations (exact, one pass)."""
    return LinearRegression(featuresCol=features, labelCol=label, solver="normal",
                            regParam=0.0, elasticNetParam=0.0, standardization=False)


def elastic_net(label: str = "relevance", features: str = "features", reg: float = 0.3,
                mix: float = 0.8, max_iter: int = 1000) -> LinearRegression:
    """M3: the reference's elastic-net settings (regParam 0.3, mix 0.8, 1000 iterations)."""
    return LinearRegression(featuresCol=features, labelCol=label, regParam=reg,
                            elasticNetParam=mix, maxIter=max_iter)


def ridge(alpha: float, label_std: float, n: int, label: str = "relevance",
          features: str = "features") -> LinearRegression:
    """M6 for one alpha: minimises ||y - Xb||^2 + alpha ||b||^2 (intercept free).

    Spark's objective is 1/(2n) ||.||^2 + regParam/2 ||b||^2 with the penalty
    scaled by the label's standard deviation when the label is standardised,
    so ``regParam = alpha * std(y) / n`` gives the unscaled ridge solution.
    """
    return LinearRegression(featuresCol=features, labelCol=label, solver="normal",
                            elasticNetParam=0.0, standardization=False,
                            regParam=alpha * label_std / n)


def summary_frame(spark: SparkSession, model: LinearRegressionModel) -> DataFrame:
    """M4: coefficients, intercept, iterations, objective history, RMSE and R²
    of a fitted linear model as one row."""
    s = model.summary
    schema = T.StructType([
        T.StructField("coefficients", T.ArrayType(T.DoubleType())),
        T.StructField("intercept", T.DoubleType()),
        T.StructField("total_iterations", T.IntegerType()),
        T.StructField("objective_history", T.ArrayType(T.DoubleType())),
        T.StructField("rmse", T.DoubleType()),
        T.StructField("r2", T.DoubleType())])
    row = ([float(x) for x in model.coefficients], float(model.intercept),
           int(s.totalIterations), [float(x) for x in s.objectiveHistory],
           float(s.rootMeanSquaredError), float(s.r2))
    return spark.createDataFrame([row], schema)


def closed_form_ols(df: DataFrame, x: str, y: str) -> DataFrame:
    """One-feature OLS in closed form (``regr_slope``/``regr_intercept``); the
    oracle M5 is compared against."""
    return df.agg(F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
                  F.regr_slope(F.col(y), F.col(x)).alias("slope"))


def fold_statistics(df: DataFrame, xs, y, fold_col: str) -> dict:
    """Per fold ``(XᵀX, Xᵀy, yᵀy)`` with a first column of ones, from one
    grouped aggregation (one row per fold reaches the driver)."""
    xs = [F.lit(1.0), *xs]
    d = len(xs)
    aggs = [F.sum(xs[i] * xs[j]).alias(f"xx_{i}_{j}") for i in range(d) for j in range(i, d)]
    aggs += [F.sum(xs[i] * y).alias(f"xy_{i}") for i in range(d)] + [F.sum(y * y).alias("yy")]
    stats = {}
    for r in df.groupBy(fold_col).agg(*aggs).collect():
        xx = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                xx[i, j] = xx[j, i] = r[f"xx_{i}_{j}"]
        stats[r[fold_col]] = (xx, np.array([r[f"xy_{i}"] for i in range(d)]), float(r["yy"]))
    return stats


def ridge_weights(xx: np.ndarray, xy: np.ndarray, alpha: float) -> np.ndarray:
    """Ridge solution ``(intercept, weights...)`` of ``(XᵀX, Xᵀy)``; the
    intercept isn't penalised."""
    penalty = alpha * np.eye(len(xy))
    penalty[0, 0] = 0.0
    return np.linalg.lstsq(xx + penalty, xy, rcond=None)[0]


class RidgeCV:
    """M6: ridge regression with the penalty chosen by K-fold CV on R²
    (alphas 0.1, 1, 10 by default), refitted on all rows.

    Folds come from an explicit ``fold`` column (contiguous, W1).  One
    aggregation gives every fold's sufficient statistics; each fold's fit for
    each alpha and its R² follow from them in closed form.
    """

    def __init__(self, alphas=(0.1, 1.0, 10.0), label: str = "relevance",
                 fold_col: str = "fold", num_folds: int = 10, inner_folds: bool = False, key: str = "id"):
        self.alphas, self.label, self.fold_col, self.num_folds = alphas, label, fold_col, num_folds
        self.inner_folds, self.key = inner_folds, key  # folds of the rows at hand, where none are given

    def _fit_alpha(self, df, alpha):
        st = df.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(self.label).alias("s")).first()
        s = float(st["s"] or 0.0) or 1.0
        return ridge(alpha, s, int(st["n"]), label=self.label).fit(df)

    def fit(self, df: DataFrame):
        from pyspark.ml.functions import vector_to_array
        if self.inner_folds:
            from ..operators.order import assign_folds
            df = assign_folds(df.drop(self.fold_col), [self.key], self.num_folds, self.fold_col)
        dim = len(df.select(vector_to_array("features").alias("x")).first()["x"])
        x = vector_to_array("features")
        wide = df.select(self.fold_col, F.col(self.label).cast("double").alias("_y"),
                         *[x[k].alias(f"_x{k}") for k in range(dim)])
        stats = fold_statistics(wide, [F.col(f"_x{k}") for k in range(dim)], F.col("_y"), self.fold_col)
        xx_all, xy_all = sum(s[0] for s in stats.values()), sum(s[1] for s in stats.values())
        scores = []
        for a in self.alphas:
            r2s = []
            for xx, xy, yy in (stats[f] for f in sorted(stats)):
                w = ridge_weights(xx_all - xx, xy_all - xy, a)
                sse = yy - 2.0 * w @ xy + w @ xx @ w
                spread = yy - xy[0] ** 2 / xx[0, 0]
                r2s.append(1.0 - sse / spread if spread > 0 else 0.0)
            scores.append(float(np.mean(r2s)))
        self.cv_scores = list(zip(self.alphas, scores))
        self.alpha = self.alphas[int(np.argmax(scores))]
        return self._fit_alpha(df, self.alpha)


def ols_cv_rmse(df: DataFrame, features: Sequence[str], label: str = "relevance",
                fold_col: str = "fold") -> tuple[float, list[float]]:
    """M17 for least squares in ONE pass over the data.

    One grouped aggregation gives each fold's sufficient statistics
    (``n, Σx, Σy, XᵀX, Xᵀy, yᵀy``; one row per fold reaches the driver).
    For fold f the model is fitted on ``total - stats_f`` by the normal
    equations, and its held-out squared error follows in closed form:
    ``yᵀy_f - 2 βᵀ(Xᵀy)_f + βᵀ(XᵀX)_f β`` with the intercept as a column of
    ones.  Returns (mean of fold RMSEs, per-fold RMSEs), the same numbers as
    fitting and scoring each fold separately.
    """
    stats = fold_statistics(df, [F.col(c).cast("double") for c in features], F.col(label).cast("double"), fold_col)
    tot_xx = sum(s[0] for s in stats.values())
    tot_xy = sum(s[1] for s in stats.values())
    rmses = []
    for f in sorted(stats):
        xx_f, xy_f, yy_f = stats[f]
        beta = np.linalg.lstsq(tot_xx - xx_f, tot_xy - xy_f, rcond=None)[0]
        sse = yy_f - 2.0 * beta @ xy_f + beta @ xx_f @ beta
        rmses.append(float(np.sqrt(max(sse, 0.0) / xx_f[0, 0])))
    return float(np.mean(rmses)), rmses
