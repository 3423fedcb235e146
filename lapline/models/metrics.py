"""Evaluation metrics as DataFrame aggregations.

Input is a scored table: ``label`` (0/1), ``probability`` (positive-class
score), ``prediction`` and optionally ``fold``.  Fold-averaged metrics
(E1, E8) average per-fold values; pooled metrics (E2-E7) use all rows at
once.  Division by zero gives 0, as ``zero_division=0`` does.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapline.operators.prefix import running_totals

F1_EPS = 1e-12


def _div(a, b):
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def _confusion(label: str, prediction: str):
    y = F.col(label).cast("int")
    p = F.col(prediction).cast("int")
    return [
        F.sum(F.when((y == 1) & (p == 1), 1).otherwise(0)).cast("double").alias("tp"),
        F.sum(F.when((y == 0) & (p == 1), 1).otherwise(0)).cast("double").alias("fp"),
        F.sum(F.when((y == 1) & (p == 0), 1).otherwise(0)).cast("double").alias("fn"),
        F.sum(F.when((y == 0) & (p == 0), 1).otherwise(0)).cast("double").alias("tn"),
    ]


def _binary_from_counts(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    precision = _div(tp, tp + fp)
    recall = _div(tp, tp + fn)
    return df.select(
        *keep,
        _div(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        _div(2 * tp, 2 * tp + fp + fn).alias("f1"),
        _div(tp + fn, tp + fp + fn + tn).alias("positive_rate"),
    )


def predict_at(df: DataFrame, threshold: float, probability: str = "probability",
               name: str = "prediction") -> DataFrame:
    return df.withColumn(name, (F.col(probability) >= F.lit(threshold)).cast("int"))


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Pooled accuracy / precision / recall / F1 of the positive class."""
    return _binary_from_counts(df.agg(*_confusion(label, prediction)))


def fold_binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                        fold: str = "fold") -> DataFrame:
    """E1 per fold."""
    return _binary_from_counts(df.groupBy(fold).agg(*_confusion(label, prediction)), [fold])


def fold_summary(per_fold: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """A5: mean and population std over folds of each metric."""
    aggs = []
    for m in metrics:
        aggs += [F.avg(m).alias(m), F.stddev_pop(m).alias(f"{m}_std")]
    return per_fold.agg(*aggs)


def cv_binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                      fold: str = "fold") -> DataFrame:
    """Fold-averaged accuracy, precision, recall, F1 + pooled positive rate."""
    counts = df.groupBy(fold).agg(*_confusion(label, prediction))
    per = _binary_from_counts(counts, [fold, "tp", "fp", "fn", "tn"])
    return per.agg(*[F.avg(m).alias(m) for m in ("accuracy", "precision", "recall", "f1")],
                   (F.sum(F.col("tp") + F.col("fn"))
                    / F.sum(F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))).alias("positive_rate"))


def score_counts(df: DataFrame, label: str = "label", probability: str = "probability") -> DataFrame:
    """Positives and negatives per distinct score (the input of E3, E5)."""
    y = F.col(label).cast("double")
    return (df.where(F.col(probability).isNotNull()).groupBy(probability)
            .agg(F.sum(y).alias("pos"), F.sum(1.0 - y).alias("neg")))


def threshold_curve(df: DataFrame, label: str = "label", probability: str = "probability") -> DataFrame:
    """Precision, recall and F1 when predicting positive at ``p >= threshold``
    for every distinct score."""
    cum = running_totals(score_counts(df, label, probability), probability,
                         ["pos", "neg"], descending=True)
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    precision = _div(tp, tp + fp)
    recall = _div(tp, F.col("total_pos"))
    f1 = 2 * precision * recall / (precision + recall + F.lit(F1_EPS))
    return cum.select(F.col(probability).alias("threshold"), precision.alias("precision"),
                      recall.alias("recall"), f1.alias("f1"))


def best_threshold(df: DataFrame, label: str = "label", probability: str = "probability") -> DataFrame:
    """The threshold with the highest F1 (lowest threshold on ties).

    A top-1 over the distinct-score table (per-partition top-k, then a
    merge of those few rows)."""
    curve = threshold_curve(df, label, probability)
    return curve.orderBy(F.col("f1").desc(), F.col("threshold").asc()).limit(1)


def tuned_binary_metrics(df: DataFrame, label: str = "label",
                         probability: str = "probability") -> DataFrame:
    """Choose the threshold on the scores, then pooled metrics at it."""
    thr = best_threshold(df, label, probability).first()
    t = float(thr["threshold"])
    m = binary_metrics(predict_at(df, t, probability), label, "prediction")
    return m.select(F.lit(t).alias("threshold"), "*")


def roc_auc(df: DataFrame, label: str = "label", probability: str = "probability") -> DataFrame:
    """E5: exact ROC AUC, tied scores count one half (rank-sum form)."""
    cum = running_totals(score_counts(df, label, probability), probability, ["neg"])
    below = F.col("cum_neg") - F.col("neg")
    auc = (F.sum(F.col("pos") * (below + 0.5 * F.col("neg")))
           / (F.sum("pos") * F.sum("neg")))
    return cum.agg(F.when((F.sum("pos") > 0) & (F.sum("neg") > 0), auc).alias("roc_auc"))


def _lerp(a: float, b: float, t: float) -> float:
    # numpy's linear percentile interpolation
    d = b - a
    return b - d * (1.0 - t) if t >= 0.5 else a + d * t


def quantile_edges(df: DataFrame, column: str, probs: Sequence[float]) -> list[float]:
    """Exact linearly interpolated percentiles (numpy default method).

    Counts per distinct value + distributed running totals give each
    value's rank range; one aggregation with a conditional ``min`` per
    needed rank returns only the order statistics (a few numbers).
    """
    counts = (df.where(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).cast("double").alias("cnt")))
    cum = running_totals(counts, column, ["cnt"])
    n = cum.agg(F.max("total_cnt")).first()[0]
    if not n:
        return []
    ranks = set()
    for q in probs:
        pos = q * (n - 1)
        lo = int(np.floor(pos))
        ranks.update({lo, min(lo + 1, int(n) - 1)})
    ranks = sorted(ranks)
    row = cum.agg(*[F.min(F.when(F.col("cum_cnt") > F.lit(float(r)), F.col(column))).alias(f"r{r}")
                    for r in ranks]).first()
    stat = {r: float(row[f"r{r}"]) for r in ranks}
    edges = []
    for q in probs:
        pos = q * (n - 1)
        lo = int(np.floor(pos))
        hi = min(lo + 1, int(n) - 1)
        edges.append(_lerp(stat[lo], stat[hi], pos - lo))
    return edges


def calibration(df: DataFrame, n_bins: int = 10, label: str = "label",
                probability: str = "probability") -> DataFrame:
    """Quantile-binned reliability curve.  Bin = number of inner edges
    strictly below the score; empty bins do not appear."""
    edges = quantile_edges(df, probability, [i / n_bins for i in range(n_bins + 1)])
    inner = edges[1:-1]
    p = F.col(probability)
    b = sum((F.when(p > F.lit(e), 1).otherwise(0) for e in inner), F.lit(0))
    return (df.where(p.isNotNull()).withColumn("bin", b.cast("int")).groupBy("bin")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.avg(p).alias("mean_predicted_value"),
                 F.avg(F.col(label).cast("double")).alias("fraction_of_positives")))


def brier_score(df: DataFrame, label: str = "label", probability: str = "probability") -> DataFrame:
    """Mean squared difference between score and outcome."""
    return df.agg(F.avg(F.pow(F.col(probability) - F.col(label).cast("double"), 2))
                  .alias("brier_score"))


def fold_macro_metrics(df: DataFrame, truth: str = "label", prediction: str = "prediction",
                       fold: str = "fold") -> DataFrame:
    """E8 per fold: accuracy and macro precision / recall / F1 over the
    classes seen in that fold's truth or predictions."""
    counts = df.groupBy(fold, truth, prediction).agg(F.count(F.lit(1)).cast("double").alias("n"))
    t = counts.groupBy(fold, F.col(truth).alias("cls")).agg(
        F.sum("n").alias("n_true"),
        F.sum(F.when(F.col(truth) == F.col(prediction), F.col("n")).otherwise(0.0)).alias("tp"))
    p = counts.groupBy(fold, F.col(prediction).alias("cls")).agg(F.sum("n").alias("n_pred"))
    per_class = t.join(p, [fold, "cls"], "full_outer").na.fill(0.0, ["n_true", "tp", "n_pred"])
    tp, nt, np_ = F.col("tp"), F.col("n_true"), F.col("n_pred")
    per_class = per_class.select(
        fold, "tp", "n_true",
        _div(tp, np_).alias("p"), _div(tp, nt).alias("r"), _div(2 * tp, nt + np_).alias("f"))
    return per_class.groupBy(fold).agg(
        (F.sum("tp") / F.sum("n_true")).alias("accuracy"),
        F.avg("p").alias("precision_macro"),
        F.avg("r").alias("recall_macro"),
        F.avg("f").alias("f1_macro"))


def majority_share(df: DataFrame, truth: str = "label") -> DataFrame:
    """Share of the most common class (the always-majority baseline)."""
    c = df.groupBy(truth).agg(F.count(F.lit(1)).alias("n"))
    return c.agg((F.max("n") / F.sum("n")).alias("majority_share"))


def cv_macro_metrics(df: DataFrame, truth: str = "label", prediction: str = "prediction",
                     fold: str = "fold") -> DataFrame:
    """E8 + E9: fold-averaged macro metrics next to the majority baseline
    (a single scalar from one small aggregation)."""
    per = fold_macro_metrics(df, truth, prediction, fold)
    share = majority_share(df, truth).first()[0]
    return per.agg(*[F.avg(m).alias(m) for m in
                     ("accuracy", "precision_macro", "recall_macro", "f1_macro")],
                   F.lit(share).cast("double").alias("majority_share"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """C0 + A4: balanced weight n / (k * n_c) per class, and the booster's
    negatives / positives ratio (1.0 without positives) on every row.

    The class table has one row per class, so the totals are a window over
    a bounded table."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    allw = Window.partitionBy(F.lit(0))
    total = F.sum("n").over(allw)
    k = F.count(F.lit(1)).over(allw)
    y = F.col(label).cast("double")
    pos = F.sum(F.when(y == 1.0, F.col("n")).otherwise(0)).over(allw)
    neg = F.sum(F.when(y == 0.0, F.col("n")).otherwise(0)).over(allw)
    return c.select(label, "n", (total / (k * F.col("n"))).alias("balanced_weight"),
                    F.when(pos > 0, neg / pos).otherwise(F.lit(1.0)).alias("scale_pos_weight"))


def scale_pos_weight(df: DataFrame, label: str = "label") -> float:
    """A4 as a scalar (negatives / positives, 1.0 when no positive)."""
    y = F.col(label).cast("double")
    r = df.agg(F.sum(y).alias("pos"), F.sum(1.0 - y).alias("neg")).first()
    return float(r["neg"] / r["pos"]) if r["pos"] else 1.0
