"""k-means and full-covariance Gaussian mixtures, all numbers of clusters and all starts in shared passes.

A pass sums, over batches of points, for every fit that hasn't ended: its
objective and, for each cluster, the weight, the sum of the points and the
sum of their products (k (1 + d + d (d + 1) / 2) numbers), added up by a
grouped aggregation.  The driver makes the next centres or the M-step
(``reg_covar`` on the diagonal keeps a component from collapsing onto a few
points) from them.  So the passes are as many as the slowest fit needs,
whatever the number of fits.

Starts are points laid along the principal axes at normal quantiles, one set
for each of the first axes and further sets spread over all axes by an
additive recurrence.  They follow from the moments alone: no draw and no
order of rows has a part in them.  Of a number of clusters the start with
the least squared distances is kept; a mixture begins from its clusters.
Clusters are numbered by their centres, first column first.

A null or NaN raises, no row is left out; so does a table without rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapline.session import ship_code

STARTS = 8
KMEANS_MAX_ITER = 300
KMEANS_TOL = 1e-4  # of the mean variance, as a shift of the centres


@dataclass
class KMeansModel:
    columns: list[str]
    centres: np.ndarray
    inertia: float
    n_iter: int
    converged: bool

    def transform(self, df: DataFrame, label: str = "cluster") -> DataFrame:
        """The nearest centre, the lowest number on ties."""
        far = [sum(((F.col(c) - F.lit(float(v))) ** 2 for c, v in zip(self.columns, centre, strict=True)), F.lit(0.0))
               for centre in self.centres]
        return df.withColumn(label, (F.array_position(F.array(*far), F.array_min(F.array(*far))) - 1).cast("int"))


@dataclass
class MixtureModel:
    columns: list[str]
    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray
    log_likelihood: float
    n: float
    n_iter: int
    converged: bool

    @property
    def k(self) -> int:
        return len(self.weights)

    def _log_prob_columns(self) -> list[Column]:
        d = len(self.columns)
        x = [F.col(c).cast("double") for c in self.columns]
        out = []
        for j in range(self.k):
            prec = np.linalg.inv(self.covariances[j])
            _, logdet = np.linalg.slogdet(self.covariances[j])
            diff = [x[a] - F.lit(float(self.means[j, a])) for a in range(d)]
            quad = F.lit(0.0)
            for a in range(d):
                for b in range(a, d):
                    coef = prec[a, b] * (1.0 if a == b else 2.0)
                    quad = quad + F.lit(float(coef)) * diff[a] * diff[b]
            const = np.log(self.weights[j]) - 0.5 * (d * np.log(2 * np.pi) + logdet)
            out.append((F.lit(float(const)) - 0.5 * quad).alias(f"__lp{j}"))
        return out

    def transform(self, df: DataFrame, label: str = "cluster",
                  probability: str = "probability") -> DataFrame:
        """Hard label (most probable component) and the probabilities."""
        lp = self._log_prob_columns()
        x = df.select("*", *lp)
        mx = F.greatest(*[F.col(f"__lp{j}") for j in range(self.k)]) if self.k > 1 else F.col("__lp0")
        x = x.withColumn("__mx", mx)
        lse = F.col("__mx") + F.log(sum((F.exp(F.col(f"__lp{j}") - F.col("__mx")) for j in range(self.k)),
                                        F.lit(0.0)))
        x = x.withColumn("__lse", lse)
        probs = F.array(*[F.exp(F.col(f"__lp{j}") - F.col("__lse")) for j in range(self.k)])
        x = x.withColumn(probability, probs)
        best = F.array_position(F.col(probability), F.array_max(F.col(probability))) - 1
        return x.withColumn(label, best.cast("int")).drop(
            *[f"__lp{j}" for j in range(self.k)], "__mx", "__lse")

    def bic(self) -> float:
        d = len(self.columns)
        p = self.k * d * (d + 1) / 2 + self.k * d + self.k - 1
        return float(-2 * self.log_likelihood + p * np.log(self.n))


@dataclass
class _Fit:
    """A fit on its way: ``centres`` while it is k-means, ``weights``, ``means`` and ``covariances`` once it is a mixture."""
    centres: np.ndarray
    weights: np.ndarray | None = None
    means: np.ndarray | None = None
    covariances: np.ndarray | None = None
    objective: float = np.inf
    row: np.ndarray = field(default_factory=lambda: np.zeros(0))
    n_iter: int = 0
    ended: bool = False
    converged: bool = False

    @property
    def k(self) -> int:
        return len(self.centres)

    def sums(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            far = ((x[:, None, :] - self.centres) ** 2).sum(axis=2)
            share = np.eye(self.k)[far.argmin(axis=1)]
            objective = far.min(axis=1).sum()
        else:
            logs = _log_densities(x, self.weights, self.means, self.covariances)
            top = logs.max(axis=1, keepdims=True)
            level = top + np.log(np.exp(logs - top).sum(axis=1, keepdims=True))
            share, objective = np.exp(logs - level), level.sum()
        a, b = np.triu_indices(x.shape[1])
        return np.concatenate([[objective], share.sum(axis=0), (share.T @ x).ravel(), (share.T @ (x[:, a] * x[:, b])).ravel()])

    def parts(self, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Weights, sums and products of the clusters in the last pass."""
        n, s, q = np.split(self.row[1:], [self.k, self.k * (1 + d)])
        return n, s.reshape(self.k, d), q.reshape(self.k, -1)

    def move(self, d: int, tol: float, max_iter: int) -> None:
        """A step of k-means: ends with the centres that the last pass measured."""
        n, s, _ = self.parts(d)
        self.objective = float(self.row[0])
        self.n_iter += 1
        # a cluster without points stays where it is
        centres = np.where(n[:, None] > 0, s / np.maximum(n, 1)[:, None], self.centres)
        self.converged = bool(((centres - self.centres) ** 2).sum() <= tol)
        self.ended = self.converged or self.n_iter >= max_iter
        if not self.ended:
            self.centres = centres

    def maximise(self, d: int, reg_covar: float) -> None:
        n, s, q = self.parts(d)
        n = n + 10 * np.finfo(float).eps
        a, b = np.triu_indices(d)
        self.means = s / n[:, None]
        flat = q / n[:, None] - self.means[:, a] * self.means[:, b]
        self.covariances = np.zeros((self.k, d, d))
        self.covariances[:, a, b] = self.covariances[:, b, a] = flat
        self.covariances += reg_covar * np.eye(d)
        self.weights = n / n.sum()


def _log_densities(x: np.ndarray, weights: np.ndarray, means: np.ndarray, covariances: np.ndarray) -> np.ndarray:
    out = np.empty((len(x), len(weights)))
    for j, (w, mean, cov) in enumerate(zip(weights, means, covariances, strict=True)):
        diff = x - mean
        quad = np.einsum("ia,ab,ib->i", diff, np.linalg.inv(cov), diff)
        out[:, j] = np.log(w) - 0.5 * (len(mean) * np.log(2 * np.pi) + np.linalg.slogdet(cov)[1] + quad)
    return out


def start_centres(k: int, covariance: np.ndarray, start: int) -> np.ndarray:
    """The ``start``-th set of ``k`` centres about 0."""
    values, axes = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")
    # an axis points to where its largest entry is positive
    axes = axes[:, order] * np.where(np.take_along_axis(axes, np.abs(axes).argmax(axis=0)[None], 0) < 0, -1.0, 1.0)[0][order]
    spread = np.sqrt(np.maximum(values[order], 0.0))
    d, at = len(spread), (np.arange(k) + 0.5) / k
    if start < d:
        places = np.full((k, d), 0.5)
        places[:, start] = at
    else:  # steps of the powers of the root of x^(d+1) = x + 1
        root = 1.5
        for _ in range(60):
            root = (1 + root) ** (1 / (d + 1))
        places = (0.5 + np.arange(1, k + 1)[:, None] * root ** -np.arange(1.0, d + 1) + (start - d) / (STARTS + 1)) % 1
        places = np.clip(places, 0.02, 0.98)
    return (np.vectorize(NormalDist().inv_cdf)(places) * spread) @ axes.T


class _Points:
    """The columns of a table about their means, kept while fits pass over them."""

    def __init__(self, df: DataFrame, columns: Sequence[str]):
        ship_code(df.sparkSession)
        self.columns, self.d = list(columns), len(columns)
        data = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
        self.data = data.persist(StorageLevel.MEMORY_AND_DISK)
        x = [F.col(c) for c in self.data.columns]
        bad = sum(((v.isNull() | F.isnan(v)).cast("int") for v in x), F.lit(0)) > 0
        a, b = np.triu_indices(self.d)
        row = self.data.agg(F.count(F.lit(1)), F.count_if(bad), *[F.avg(v) for v in x],
                            *[F.covar_pop(x[i], x[j]) for i, j in zip(a, b)]).first()
        self.n = int(row[0])
        if not self.n or row[1]:
            self.data.unpersist()
            raise ValueError(f"{row[1]} of {self.n} rows have a null or NaN in {self.columns}" if self.n else "no rows to fit")
        # second moments about the means: far from zero they would cancel
        self.centre = np.array(row[2:2 + self.d])
        self.covariance = np.zeros((self.d, self.d))
        self.covariance[a, b] = self.covariance[b, a] = row[2 + self.d:]

    def measure(self, fits: Sequence[_Fit]) -> None:
        """One pass: the sums of every fit in its ``row``."""
        centre, d = self.centre, self.d
        sizes = [1 + f.k * (1 + d + d * (d + 1) // 2) for f in fits]

        def run(batches):
            total = np.zeros(sum(sizes))
            for batch in batches:
                if batch.num_rows:
                    x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]) - centre
                    total += np.concatenate([f.sums(x) for f in fits])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int64()), pa.array(total)], names=["place", "v"])

        found = self.data.mapInArrow(run, "place long, v double").groupBy("place").agg(F.sum("v").alias("v")).toArrow()
        flat = np.zeros(sum(sizes))
        flat[found.column("place").to_numpy()] = found.column("v").to_numpy()
        for f, row in zip(fits, np.split(flat, np.cumsum(sizes)[:-1]), strict=True):
            f.row = row

    def clusters(self, candidates: Sequence[int], starts: int, max_iter: int, tol: float) -> dict[int, _Fit]:
        """k-means of every number of clusters: the best of its starts, with the last pass's sums."""
        fits = {k: [_Fit(start_centres(k, self.covariance, s)) for s in range(starts if k > 1 else 1)] for k in candidates}
        bound = tol * float(np.trace(self.covariance)) / self.d
        while live := [f for own in fits.values() for f in own if not f.ended]:
            self.measure(live)
            for f in live:
                f.move(self.d, bound, max_iter)
        # sums of squares that differ in their last digits are a tie, which goes to the earlier start
        return {k: min(own, key=lambda f: float(f"{f.objective:.9e}")) for k, own in fits.items()}


def fit_kmeans_all(df: DataFrame, columns: Sequence[str], candidates: Sequence[int], starts: int = STARTS,
                   max_iter: int = KMEANS_MAX_ITER, tol: float = KMEANS_TOL) -> dict[int, KMeansModel]:
    """k-means for every number of clusters in ``candidates``, all starts in shared passes."""
    points = _Points(df, columns)
    try:
        found = points.clusters(candidates, starts, max_iter, tol)
    finally:
        points.data.unpersist()
    out = {}
    for k, f in found.items():
        order = np.lexsort(f.centres.T[::-1])
        out[k] = KMeansModel(points.columns, f.centres[order] + points.centre, f.objective, f.n_iter, f.converged)
    return out


def fit_mixtures(df: DataFrame, columns: Sequence[str], candidates: Sequence[int], starts: int = STARTS,
                 max_iter: int = 100, tol: float = 1e-3, reg_covar: float = 1e-6) -> dict[int, MixtureModel]:
    """A mixture for every number of components in ``candidates``; EM stops when the mean log-likelihood moves by less than ``tol``."""
    points = _Points(df, columns)
    try:
        fits = points.clusters(candidates, starts, KMEANS_MAX_ITER, KMEANS_TOL)
        for f in fits.values():
            f.maximise(points.d, reg_covar)
            f.objective, f.n_iter, f.ended, f.converged = -np.inf, 0, False, False
        while live := [f for f in fits.values() if not f.ended]:
            points.measure(live)
            for f in live:
                level = float(f.row[0])
                f.converged = abs(level - f.objective) / points.n < tol
                f.objective, f.n_iter = level, f.n_iter + 1
                f.ended = f.converged or f.n_iter >= max_iter
                if not f.ended:
                    f.maximise(points.d, reg_covar)
    finally:
        points.data.unpersist()
    out = {}
    for k, f in fits.items():
        order = np.lexsort(f.means.T[::-1])
        out[k] = MixtureModel(points.columns, f.weights[order], f.means[order] + points.centre, f.covariances[order],
                              f.objective, float(points.n), f.n_iter, f.converged)
    return out


def fit_gaussian_mixture(df: DataFrame, columns: Sequence[str], n_components: int, **options) -> MixtureModel:
    return fit_mixtures(df, columns, [n_components], **options)[n_components]
