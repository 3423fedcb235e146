"""Pace regression from sufficient statistics.

One aggregation gives the means of features and label; one ``groupBy(fold)``
aggregation then returns, per fold, the moment matrix of the augmented design
``[1, x]`` with the label, both taken from their means: n, sums, cross
products.  Uncentred second moments would lose the variance of a column
whose mean is large against its spread.
Training moments of fold f are total minus fold f, so every fold and every
model (OLS / ridge / lasso, any alpha) is solved on the driver from a few
numbers per fold -- no data pass per fit.  Scoring (MAE, R^2) is one more
pass that applies the per-fold coefficients as a CASE expression.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _pairs(k: int):
    return [(i, j) for i in range(k) for j in range(i, k)]


def moment_columns(features: Sequence[str], label: str,
                   center: dict[str, float] | None = None) -> list[Column]:
    """L0 aggregate expressions: n, sum x, sum y, sum x_i x_j, sum x y, sum y^2,
    of values less ``center`` where it is given."""
    def value(c: str) -> Column:
        x = F.col(c).cast("double")
        return x - F.lit(center[c]) if center else x

    xs = [value(c) for c in features]
    y = value(label)
    cols = [F.count(F.lit(1)).cast("double").alias("n")]
    cols += [F.sum(x).alias(f"s_{c}") for c, x in zip(features, xs)]
    cols.append(F.sum(y).alias("s_y"))
    cols += [F.sum(xs[i] * xs[j]).alias(f"s_{features[i]}__{features[j]}")
             for i, j in _pairs(len(features))]
    cols += [F.sum(x * y).alias(f"s_{c}__y") for c, x in zip(features, xs)]
    cols.append(F.sum(y * y).alias("s_y__y"))
    return cols


def _known(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Every row, as long as features and label are known: a null raises, as
    a fit on missing values does; no row is left out."""
    known = F.col(label).isNotNull()
    for c in features:
        known = known & F.col(c).isNotNull()
    return df.where(F.when(known, True).otherwise(
        F.raise_error("null feature or label in a linear model").cast("boolean")))


def moments(df: DataFrame, features: Sequence[str], label: str = "label",
            by: Sequence[str] = (), center: dict[str, float] | None = None) -> DataFrame:
    """L0 as a DataFrame (one row per ``by`` group); null values raise."""
    return _known(df, features, label).groupBy(*by).agg(*moment_columns(features, label, center))


@dataclass
class Moments:
    """Augmented moment matrix A = [1 x]'[1 x], b = [1 x]'y, yy = y'y of
    features less ``x0`` and label less ``y0``."""
    A: np.ndarray
    b: np.ndarray
    yy: float
    x0: np.ndarray
    y0: float

    def raw(self) -> tuple[np.ndarray, np.ndarray]:
        """X'X and X'y of the values themselves."""
        s, n = self.A[0, 1:], self.n
        x0, y0 = self.x0, self.y0
        xtx = self.A[1:, 1:] + np.outer(x0, s) + np.outer(s, x0) + n * np.outer(x0, x0)
        return xtx, self.b[1:] + x0 * self.b[0] + s * y0 + n * x0 * y0

    @property
    def n(self) -> float:
        return float(self.A[0, 0])

    def __sub__(self, other: "Moments") -> "Moments":
        return Moments(self.A - other.A, self.b - other.b, self.yy - other.yy, self.x0, self.y0)

    def __add__(self, other: "Moments") -> "Moments":
        return Moments(self.A + other.A, self.b + other.b, self.yy + other.yy, self.x0, self.y0)


def _to_moments(row, features: Sequence[str], x0: np.ndarray, y0: float) -> Moments:
    k = len(features)
    A = np.zeros((k + 1, k + 1))
    A[0, 0] = row["n"] or 0.0
    for i, c in enumerate(features):
        A[0, i + 1] = A[i + 1, 0] = row[f"s_{c}"] or 0.0
    for i, j in _pairs(k):
        A[i + 1, j + 1] = A[j + 1, i + 1] = row[f"s_{features[i]}__{features[j]}"] or 0.0
    b = np.zeros(k + 1)
    b[0] = row["s_y"] or 0.0
    for i, c in enumerate(features):
        b[i + 1] = row[f"s_{c}__y"] or 0.0
    return Moments(A, b, float(row["s_y__y"] or 0.0), x0, y0)


def collect_moments(df: DataFrame, features: Sequence[str], label: str = "label",
                    fold: str | None = None) -> dict:
    """Per-fold moments on the driver: (#folds) rows of (k+1)^2 numbers."""
    names = [*features, label]
    means = _known(df, features, label).agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(names)]).first()
    center = {c: float(means[f"m{i}"] or 0.0) for i, c in enumerate(names)}
    x0, y0 = np.array([center[c] for c in features]), center[label]
    rows = moments(df, features, label, [fold] if fold else [], center).collect()
    if fold is None:
        return {None: _to_moments(rows[0], features, x0, y0)}
    return {r[fold]: _to_moments(r, features, x0, y0) for r in rows}


# -- solvers (driver side, k x k) -------------------------------------------

def _standardised(m: Moments):
    """Centred, population-scaled normal equations (StandardScaler + centring).

    Zero-variance columns keep scale 1, so their centred values are 0.
    """
    n = m.n
    mu = m.A[0, 1:] / n
    ybar = m.b[0] / n
    cov = m.A[1:, 1:] / n - np.outer(mu, mu)
    cxy = m.b[1:] / n - mu * ybar
    var = np.clip(np.diag(cov).copy(), 0.0, None)
    sd = np.sqrt(var)
    # a constant column has no spread but rounding
    sd[sd <= 1e-12 * np.maximum(1.0, np.abs(m.x0))] = 1.0
    G = n * cov / np.outer(sd, sd)          # Zc'Zc
    c = n * cxy / sd                        # Zc'yc
    return mu + m.x0, ybar + m.y0, sd, G, c


def solve_ols_no_intercept(m: Moments) -> tuple[np.ndarray, float]:
    """L1: minimum-norm least squares without intercept (an absent one-hot
    level gets coefficient 0, the others are unaffected)."""
    XtX, Xty = m.raw()
    # eigenvalues of X'X are squared singular values of X: an all-zero
    # column gives an exact zero eigenvalue, cut by the relative cutoff
    beta = np.linalg.pinv(XtX, rcond=1e-13, hermitian=True) @ Xty
    return beta, 0.0


def solve_ridge(m: Moments, alpha: float = 1.0) -> tuple[np.ndarray, float]:
    """L2: ridge with intercept on population-standardised features.

    Zc'yc has no part along a direction in which the features do not vary (a
    full set of level dummies has one), so the rounding it holds there is
    left out instead of being divided by ``alpha``.
    """
    mu, ybar, sd, G, c = _standardised(m)
    lam, v = np.linalg.eigh(G)
    varies = lam > 1e-12 * max(lam.max(), 1e-300)
    bz = v[:, varies] @ ((v[:, varies].T @ c) / (lam[varies] + alpha))
    beta = bz / sd
    return beta, float(ybar - mu @ beta)


def solve_lasso(m: Moments, alpha: float = 1.0, max_iter: int = 100_000,
                tol: float = 1e-12) -> tuple[np.ndarray, float]:
    """L3: lasso (objective 1/(2n)|y - Zb - b0|^2 + alpha |b|_1) by cyclic
    coordinate descent on the standardised Gram matrix."""
    mu, ybar, sd, G, c = _standardised(m)
    n = m.n
    k = len(c)
    bz = np.zeros(k)
    for _ in range(max_iter):
        delta = 0.0
        for j in range(k):
            if G[j, j] <= 0:
                continue
            rho = c[j] - G[j] @ bz + G[j, j] * bz[j]
            new = np.sign(rho) * max(abs(rho) - n * alpha, 0.0) / G[j, j]
            delta = max(delta, abs(new - bz[j]))
            bz[j] = new
        if delta <= tol * max(1.0, np.max(np.abs(bz))):
            break
    beta = bz / sd
    return beta, float(ybar - mu @ beta)


SOLVERS = {
    "ols": lambda m, alpha: solve_ols_no_intercept(m),
    "ridge": solve_ridge,
    "lasso": solve_lasso,
}


@dataclass
class LinearModel:
    features: list[str]
    coef: np.ndarray
    intercept: float
    has_intercept: bool

    def prediction(self) -> Column:
        expr = F.lit(float(self.intercept))
        for c, b in zip(self.features, self.coef):
            expr = expr + F.lit(float(b)) * F.col(c).cast("double")
        return expr

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        return df.withColumn(name, self.prediction())

    def coefficients(self, spark: SparkSession) -> DataFrame:
        """Named coefficients (+ intercept when the model has one)."""
        rows = [(f, float(b) + 0.0) for f, b in zip(self.features, self.coef)]
        if self.has_intercept:
            rows.append(("intercept", float(self.intercept)))
        return spark.createDataFrame(rows, "feature string, coef_s double")


def fit_linear(df: DataFrame, features: Sequence[str], label: str = "label",
               method: str = "ols", alpha: float = 1.0) -> LinearModel:
    """Fit on all rows from the total moments (one aggregation)."""
    m = collect_moments(df, features, label)[None]
    beta, b0 = SOLVERS[method](m, alpha)
    return LinearModel(list(features), beta, b0, method != "ols")


def cross_validate_linear(df: DataFrame, features: Sequence[str], label: str = "label",
                          fold: str = "fold", method: str = "ols", alpha: float = 1.0):
    """Per-fold MAE and R^2 of a model trained on the other folds.

    Returns (summary, per_fold): summary has mae_s, mae_s_std, r2, r2_std
    (population std over folds, as numpy's default).
    """
    per = collect_moments(df, features, label, fold)
    total = None
    for m in per.values():
        total = m if total is None else total + m
    coefs = {}
    for f, m in per.items():
        beta, b0 = SOLVERS[method](total - m, alpha)
        coefs[f] = LinearModel(list(features), beta, b0, method != "ols").prediction()
    pred = None
    for f, expr in coefs.items():
        pred = (F.when(F.col(fold) == F.lit(f), expr) if pred is None
                else pred.when(F.col(fold) == F.lit(f), expr))
    y = F.col(label).cast("double")
    valid = _known(df, features, label)
    per_fold = (valid.withColumn("__pred", pred).groupBy(fold).agg(
        F.avg(F.abs(y - F.col("__pred"))).alias("mae_s"),
        F.sum(F.pow(y - F.col("__pred"), 2)).alias("__ss_res"),
        (F.var_pop(y) * F.count(F.lit(1))).alias("__ss_tot"))
        .select(fold, "mae_s", F.when(F.col("__ss_tot") > 0,
                                      1 - F.col("__ss_res") / F.col("__ss_tot")).alias("r2")))
    summary = per_fold.agg(F.avg("mae_s").alias("mae_s"), F.stddev_pop("mae_s").alias("mae_s_std"),
                           F.avg("r2").alias("r2"), F.stddev_pop("r2").alias("r2_std"))
    return summary, per_fold
