"""Classifiers for retirement (DNF) and tyre compound.

Every builder returns an object with ``fit(df) -> model`` where the model
has ``transform(df)`` adding ``probability`` (positive-class score, a
double) and ``prediction``.  Training runs on ``pyspark.ml`` estimators
(distributed tree / gradient / L-BFGS aggregations); balanced class
weights are computed from the *training* rows of each fit.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapline.models.folds import out_of_fold
from lapline.models.kernel_svm import SvmModel, fit_svms
from lapline.models.metrics import scale_pos_weight
from lapline.models.shared_fits import LIGHT

SEED = 0
W = "__w"


def balanced_weight_column(train: DataFrame, label: str = "label", name: str = W) -> DataFrame:
    """Weight n / (k * n_c) from the training labels.  The class table
    has one row per class (bounded), so it is broadcast."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("__nc"))
    stats = counts.agg(F.sum("__nc").alias("n"), F.count(F.lit(1)).alias("k")).first()
    w = counts.select(label, (F.lit(float(stats["n"])) / (F.lit(float(stats["k"])) * F.col("__nc")))
                      .alias(name))
    return train.join(F.broadcast(w), label, "left")


def _assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="__x",
                           handleInvalid="keep").transform(df)


def _positive_probability(df: DataFrame) -> DataFrame:
    return df.withColumn("probability", vector_to_array("__prob")[1]).withColumn(
        "prediction", F.col("__pred").cast("int"))


@dataclass
class SparkBinaryModel:
    model: object
    features: list[str]
    scale: dict = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        x = df
        for c, (mu, sd) in self.scale.items():
            x = x.withColumn(f"__s_{c}", (F.col(c) - F.lit(mu)) / F.lit(sd))
        cols = [f"__s_{c}" if c in self.scale else c for c in self.features]
        out = self.model.transform(_assemble(x, cols))
        out = _positive_probability(out)
        return out.drop("__x", "__prob", "__pred", "__raw",
                        *[f"__s_{c}" for c in self.scale])


@dataclass
class BinaryClassifier:
    """One of C1-C4 with the reference's defaults."""
    kind: str
    features: list[str]
    label: str = "label"
    class_weight: str | None = "balanced"
    max_depth: int = 4
    n_estimators: int = 200
    C: float = 1.0
    scale_pos_weight: float = 1.0
    scale_columns: tuple[str, ...] = ()
    step_size: float = 0.3
    fit_intercept: bool = False  # the logistic kind only

    def _estimator(self, weight_col: str | None, n_train_weight: float):
        common = dict(featuresCol="__x", labelCol=self.label, probabilityCol="__prob",
                      predictionCol="__pred", rawPredictionCol="__raw")
        if weight_col:
            common["weightCol"] = weight_col
        if self.kind == "tree":
            return DecisionTreeClassifier(maxDepth=self.max_depth, maxBins=256, seed=SEED, **common)
        if self.kind == "logistic":
            return LogisticRegression(fitIntercept=self.fit_intercept, standardization=False, maxIter=1000,
                                      regParam=1.0 / (self.C * n_train_weight),
                                      elasticNetParam=0.0, tol=1e-10, **common)
        if self.kind == "forest":
            return RandomForestClassifier(numTrees=self.n_estimators, maxDepth=self.max_depth,
                                          featureSubsetStrategy="sqrt", maxBins=256,
                                          seed=SEED, **common)
        if self.kind == "boosting":
            prob, raw = common.pop("probabilityCol"), common.pop("rawPredictionCol")
            gbt = GBTClassifier(maxIter=self.n_estimators, maxDepth=self.max_depth,
                                stepSize=self.step_size, maxBins=256, seed=SEED, **common)
            return gbt.setProbabilityCol(prob).setRawPredictionCol(raw)
        raise ValueError(self.kind)

    def fit(self, train: DataFrame) -> SparkBinaryModel:
        scale = {}
        if self.scale_columns:
            st = train.agg(*[F.avg(c).alias(f"m_{c}") for c in self.scale_columns],
                           *[F.stddev_pop(c).alias(f"s_{c}") for c in self.scale_columns]).first()
            scale = {c: (float(st[f"m_{c}"]), float(st[f"s_{c}"] or 1.0)) for c in self.scale_columns}
        df = train
        weight_col = None
        if self.kind == "boosting":
            df = df.withColumn(W, F.when(F.col(self.label) == 1, F.lit(float(self.scale_pos_weight)))
                               .otherwise(F.lit(1.0)))
            weight_col = W
        elif self.class_weight == "balanced":
            df = balanced_weight_column(df, self.label)
            weight_col = W
        total_w = (df.agg(F.sum(W)).first()[0] if weight_col else None) or float(df.count())
        for c, (mu, sd) in scale.items():
            df = df.withColumn(f"__s_{c}", (F.col(c) - F.lit(mu)) / F.lit(sd))
        cols = [f"__s_{c}" if c in scale else c for c in self.features]
        design = _assemble(df, cols).persist(StorageLevel.MEMORY_AND_DISK)
        model = self._estimator(weight_col, float(total_w)).fit(design)
        design.unpersist()
        return SparkBinaryModel(model, list(self.features), scale)


def build_dnf_tree(features, max_depth=4, class_weight="balanced") -> BinaryClassifier:
    """C1."""
    return BinaryClassifier("tree", list(features), max_depth=max_depth, class_weight=class_weight)


def build_dnf_logistic(features, class_weight="balanced", C=1.0) -> BinaryClassifier:
    """Only grid_position is scaled; dummies pass through; no intercept."""
    scale = tuple(c for c in features if c == "grid_position")
    return BinaryClassifier("logistic", list(features), class_weight=class_weight, C=C,
                            scale_columns=scale)


def build_dnf_forest(features, n_estimators=200, max_depth=4,
                     class_weight="balanced") -> BinaryClassifier:
    """C3."""
    return BinaryClassifier("forest", list(features), n_estimators=n_estimators,
                            max_depth=max_depth, class_weight=class_weight)


def build_dnf_boosting(features, scale_pos_weight=1.0, n_estimators=200,
                       max_depth=4) -> BinaryClassifier:
    """C4: gradient-boosted trees, positives weighted by ``scale_pos_weight``."""
    return BinaryClassifier("boosting", list(features), class_weight=None,
                            n_estimators=n_estimators, max_depth=max_depth,
                            scale_pos_weight=scale_pos_weight)


# -- stacking (C5) -----------------------------------------------------------

@dataclass
class StackingModel:
    bases: list
    meta: object
    names: list[str]

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for name, m in zip(self.names, self.bases):
            out = m.transform(out).withColumnRenamed("probability", f"__p_{name}").drop("prediction")
        return self.meta.transform(out).drop(*[f"__p_{n}" for n in self.names])


@dataclass
class StackingClassifier:
    """Tree, logistic, forest and a small booster; their inner-fold
    out-of-fold probabilities feed an unweighted logistic meta-model;
    the bases are then refit on all training rows.

    Inner folds are a hash of the row key columns (``group_aware`` hashes
    the group instead, which keeps a driver out of its own meta features).
    """
    features: list[str]
    label: str = "label"
    scale_pos_weight: float = 1.0
    inner_folds: int = 5
    key_columns: tuple[str, ...] = ("row_id",)   # unique row key
    group_aware: bool = False

    def _bases(self):
        return [("tree", build_dnf_tree(self.features)),
                ("logistic", build_dnf_logistic(self.features)),
                ("forest", build_dnf_forest(self.features)),
                ("boosting", build_dnf_boosting(self.features, self.scale_pos_weight, *LIGHT))]

    def fit(self, train: DataFrame) -> StackingModel:
        hashed = ["group"] if self.group_aware else list(self.key_columns)
        keys = list(self.key_columns)
        df = train.withColumn("__inner", F.pmod(F.xxhash64(*[F.col(c) for c in hashed]),
                                                F.lit(self.inner_folds)).cast("int"))
        bases = self._bases()
        names = [n for n, _ in bases]
        meta_in = df.select(*keys, self.label)
        for name, est in bases:
            oof = out_of_fold(df, est.fit, fold="__inner").select(
                *keys, F.col("probability").alias(f"__p_{name}"))
            meta_in = meta_in.join(oof, keys, "inner")
        meta = BinaryClassifier("logistic", [f"__p_{n}" for n in names], class_weight=None,
                                C=1.0, label=self.label, fit_intercept=True)
        meta_model = meta.fit(meta_in)
        fitted = [est.fit(train) for _, est in bases]
        return StackingModel(fitted, meta_model, names)


def build_dnf_stacking(features, scale_pos_weight=1.0, key_columns=("row_id",),
                       group_aware=False) -> StackingClassifier:
    return StackingClassifier(list(features), scale_pos_weight=scale_pos_weight,
                              key_columns=tuple(key_columns), group_aware=group_aware)


# -- multiclass SVM (C6) -----------------------------------------------------

@dataclass
class TyreSvm:
    """All features scaled, balanced class weights, pairs of classes that vote (``lapline.models.kernel_svm``)."""
    features: list[str]
    label: str = "label"
    kernel: str = "rbf"
    C: float = 1.0
    n_landmarks: int = 200

    def fit(self, train: DataFrame, fold: str | None = None) -> SvmModel:
        """On all rows, or, with ``fold``, on the rows outside each fold in shared passes."""
        return fit_svms(train, self.features, self.label, fold, self.kernel, self.C, n_landmarks=self.n_landmarks)


def out_of_fold_probabilities(df: DataFrame, estimator, fold: str = "fold") -> DataFrame:
    """K4: one row per input row with its held-out probability."""
    return out_of_fold(df, estimator.fit, fold=fold)


def default_scale_pos_weight(df: DataFrame, label: str = "label") -> float:
    """A4 from the full data, as the reference does."""
    return scale_pos_weight(df, label)
