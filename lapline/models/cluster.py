"""Unsupervised profiling of lap vectors.

Scaling statistics, PCA covariance, k-means and EM updates are all
distributed aggregations (``pyspark.ml`` for the PCA, else
``lapline.models.mixture``); the driver only holds d x d matrices and k centres.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapline.models.mixture import fit_gaussian_mixture, fit_kmeans_all, fit_mixtures
from lapline.models.silhouette import euclidean_silhouette

# EM stopping rule of the reference's mixture defaults (100 iterations, 1e-3)
GMM_MAX_ITER = 100
GMM_TOL = 1e-3


def standardize(df: DataFrame, columns: Sequence[str], suffix: str = "") -> DataFrame:
    """Z-score with the population std (ddof 0); zero variance -> 0.

    Means and stds are one aggregation (2 numbers per column)."""
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
    st = df.agg(*aggs).first()
    out = []
    for c in columns:
        mu, sd = st[f"m_{c}"], st[f"s_{c}"]
        sd = sd if sd else 1.0
        out.append(((F.col(c) - F.lit(mu)) / F.lit(sd)).alias(c + suffix))
    keep = [c for c in df.columns if c not in columns or suffix]
    return df.select(*keep, *out)


def at_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null and NaN values of ``columns`` at the column's mean, so that every row has a place among the vectors.

    A column without any value stays null, which a fit refuses."""
    known = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    means = df.agg(*[F.avg(v).alias(c) for c, v in known.items()]).first()
    return df.withColumns({c: F.coalesce(v, F.lit(means[c]).cast("double")) for c, v in known.items()})


def assemble(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    """Columns as one vector; a null value raises, no row is dropped."""
    return VectorAssembler(inputCols=list(columns), outputCol=name,
                           handleInvalid="error").transform(df)


def fit_pca(df: DataFrame, columns: Sequence[str], n_components: int = 2,
            prefix: str = "pc"):
    """Principal components of (already scaled) columns.

    Returns (coords, explained): coords adds ``pc1..pck`` (centred on the
    column means, signs fixed so each component's largest-magnitude loading
    is positive); explained has component, explained_variance_ratio."""
    means = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    centred = df.select("*", *[(F.col(c) - F.lit(means[c])).alias(f"__c_{c}") for c in columns])
    vec = assemble(centred, [f"__c_{c}" for c in columns], "__v")
    model = PCA(k=n_components, inputCol="__v", outputCol="__pca").fit(vec)
    comps = model.pc.toArray()  # d x k
    signs = np.sign(comps[np.argmax(np.abs(comps), axis=0), range(comps.shape[1])])
    signs[signs == 0] = 1.0
    coords = model.transform(vec).withColumn("__arr", vector_to_array("__pca"))
    coords = coords.select(*df.columns, *[(F.col("__arr")[i] * float(signs[i])).alias(f"{prefix}{i + 1}")
                                          for i in range(n_components)])
    ratio = [float(v) for v in model.explainedVariance.toArray()]
    spark = df.sparkSession
    explained = spark.createDataFrame([(i + 1, r) for i, r in enumerate(ratio)],
                                      "component int, explained_variance_ratio double")
    return coords, explained


def fit_kmeans(df: DataFrame, columns: Sequence[str], n_clusters: int = 3, name: str = "cluster") -> DataFrame:
    """K-means, the best of several starts that follow from the moments; adds the cluster label."""
    return fit_kmeans_all(df, columns, [n_clusters])[n_clusters].transform(df, name)


def silhouette(df: DataFrame, columns: Sequence[str], cluster: str = "cluster") -> float:
    """U4: mean silhouette on Euclidean distances, within 1e-6 of all pairs' (``lapline.models.silhouette``); one or two columns."""
    return euclidean_silhouette(df, columns, cluster)[0]


def squared_silhouette(df: DataFrame, columns: Sequence[str], cluster: str = "cluster") -> float:
    """Mean silhouette in Spark's linear-time form, on squared Euclidean distances; any number of columns."""
    vec = assemble(df, columns, "__v")
    ev = ClusteringEvaluator(featuresCol="__v", predictionCol=cluster,
                             distanceMeasure="squaredEuclidean")
    return float(ev.evaluate(vec))


def fit_gmm(df: DataFrame, columns: Sequence[str], n_components: int = 3, name: str = "cluster"):
    """U5 + U6: full-covariance EM mixture (``lapline.models.mixture``);
    hard label and the component probabilities as an array column.
    Returns (model, labelled)."""
    model = fit_gaussian_mixture(df, columns, n_components, max_iter=GMM_MAX_ITER, tol=GMM_TOL)
    return model, model.transform(df, label=name, probability="probability")


def select_n_components_by_bic(df: DataFrame, columns: Sequence[str],
                               candidates: Sequence[int] = (1, 2, 3, 4, 5)) -> DataFrame:
    """BIC = -2 logL + p ln n per candidate k (lower is better),
    p = k d(d+1)/2 + k d + k - 1.  All candidates are fitted in shared passes."""
    models = fit_mixtures(df, columns, [int(k) for k in candidates], max_iter=GMM_MAX_ITER, tol=GMM_TOL)
    return df.sparkSession.createDataFrame([(k, m.bic()) for k, m in models.items()], "k int, bic double")


__all__ = ["standardize", "at_mean", "fit_pca", "fit_kmeans", "silhouette", "squared_silhouette", "fit_gmm", "select_n_components_by_bic"]
