import numpy as np
import pytest
from pyspark.sql import functions as F

from lapline.models import metrics
from lapline.operators.prefix import running_totals


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(3)
    n = 3000
    y = rng.integers(0, 2, n)
    p = np.round(np.clip(0.3 * y + rng.random(n) * 0.7, 0, 1), 2)  # heavy ties
    fold = rng.integers(0, 5, n)
    rows = [(int(a), float(b), int(c)) for a, b, c in zip(y, p, fold)]
    return spark.createDataFrame(rows, "label int, probability double, fold int"), y, p, fold


def brute_f1(y, p, t):
    pred = p >= t
    tp = np.sum(pred & (y == 1)); fp = np.sum(pred & (y == 0))
    prec = tp / (tp + fp) if tp + fp else 0.0
    rec = tp / y.sum()
    return 2 * prec * rec / (prec + rec + 1e-12)


def test_running_totals_match_cumsum(spark):
    rng = np.random.default_rng(1)
    vals = rng.permutation(5000).astype(float)
    w = rng.integers(0, 10, 5000).astype(float)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(vals, w)], "k double, v double")
    out = running_totals(df, "k", ["v"], descending=True, n_ranges=16).toPandas().sort_values("k", ascending=False)
    assert np.allclose(out.cum_v.to_numpy(), np.cumsum(out.v.to_numpy()))
    assert (out.total_v == w.sum()).all()


def test_best_threshold_brute_force(scored):
    df, y, p, _ = scored
    r = metrics.best_threshold(df).collect()[0]
    cands = np.unique(p)
    f1s = np.array([brute_f1(y, p, t) for t in cands])
    best = cands[int(np.argmax(f1s))]
    assert r.threshold == pytest.approx(best)
    assert r.f1 == pytest.approx(f1s.max())
    tuned = metrics.tuned_binary_metrics(df).collect()[0]
    default = metrics.binary_metrics(metrics.predict_at(df, 0.5)).collect()[0]
    assert tuned.f1 >= default.f1 - 1e-12


def test_auc_brute_force(scored):
    df, y, p, _ = scored
    pos, neg = p[y == 1], p[y == 0]
    ref = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert metrics.roc_auc(df).collect()[0].roc_auc == pytest.approx(ref)


def test_calibration_quantile_bins(scored):
    df, y, p, _ = scored
    edges = np.percentile(p, np.linspace(0, 100, 11))
    ids = np.searchsorted(edges[1:-1], p)
    out = metrics.calibration(df, 10).toPandas().sort_values("bin")
    ref_bins = sorted(set(ids))
    assert out.bin.tolist() == ref_bins
    for b, row in zip(ref_bins, out.itertuples()):
        assert row.n == int((ids == b).sum())
        assert row.fraction_of_positives == pytest.approx(y[ids == b].mean())
        assert row.mean_predicted_value == pytest.approx(p[ids == b].mean())
    assert metrics.brier_score(df).collect()[0].brier_score == pytest.approx(np.mean((p - y) ** 2))


def test_fold_average_vs_pooled(scored):
    df, y, p, fold = scored
    d = df.withColumn("prediction", (F.col("probability") > 0.5).cast("int"))
    cv = metrics.cv_binary_metrics(d).collect()[0]
    accs = [np.mean((p[fold == f] > 0.5) == y[fold == f]) for f in range(5)]
    assert cv.accuracy == pytest.approx(np.mean(accs))
    assert cv.positive_rate == pytest.approx(y.mean())


def test_macro_metrics_zero_division(spark):
    rows = [(0, "a", "a"), (0, "a", "b"), (0, "b", "b"), (0, "c", "a"),
            (1, "a", "a"), (1, "b", "a")]
    df = spark.createDataFrame(rows, "fold int, label string, prediction string")
    per = {r.fold: r for r in metrics.fold_macro_metrics(df).collect()}
    # fold 0: a p=1/2 r=1/2, b p=1/2 r=1, c p=0 r=0 (never predicted)
    assert per[0].precision_macro == pytest.approx((0.5 + 0.5 + 0) / 3)
    assert per[0].recall_macro == pytest.approx((0.5 + 1 + 0) / 3)
    f_a, f_b = 0.5, 2 * 0.5 * 1 / 1.5
    assert per[0].f1_macro == pytest.approx((f_a + f_b + 0) / 3)
    # fold 1: classes a (truth, predicted) and b (truth only)
    assert per[1].precision_macro == pytest.approx((0.5 + 0) / 2)
    assert metrics.majority_share(df).collect()[0].majority_share == pytest.approx(3 / 6)


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 8 + [(1,)] * 2, "label int")
    rows = {r.label: r for r in metrics.class_weights(df).collect()}
    assert rows[0].balanced_weight == pytest.approx(10 / (2 * 8))
    assert rows[1].balanced_weight == pytest.approx(10 / (2 * 2))
    assert rows[0].scale_pos_weight == pytest.approx(4.0)
    assert metrics.scale_pos_weight(spark.createDataFrame([(0,)], "label int")) == 1.0
