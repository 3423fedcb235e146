from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapline.models import classify, cluster, folds, linear, metrics, mixture


def pace_rows(rng, drivers=6, laps=12, drop_medium=False):
    rows = []
    comps = ["soft", "hard"] if drop_medium else ["soft", "medium", "hard"]
    eff = {"soft": -0.25, "medium": 0.05, "hard": 0.35}
    for d in range(drivers):
        for lap in range(1, laps + 1):
            c = comps[(lap + d) % len(comps)]
            tl = float(1 + (lap + d) % 7)
            y = 0.02 * tl + 0.01 * lap + eff[c]
            rows.append((f"D{d}", tl, float(lap), float(c == "soft"), float(c == "medium"),
                         float(c == "hard"), y))
    return rows


SCHEMA = ("group string, tyre_life double, lap_number double, compound_soft double, "
          "compound_medium double, compound_hard double, label double")
X = ["tyre_life", "lap_number", "compound_soft", "compound_medium", "compound_hard"]


def test_ols_recovers_effects_and_absent_level(spark):
    rng = np.random.default_rng(0)
    for drop in (False, True):
        df = spark.createDataFrame(pace_rows(rng, drop_medium=drop), SCHEMA)
        m = linear.fit_linear(df, X, "label", "ols")
        expect = [0.02, 0.01, -0.25, 0.0 if drop else 0.05, 0.35]
        assert np.allclose(m.coef, expect, atol=1e-9)


def test_cv_perfect_fit_and_errors(spark):
    df = spark.createDataFrame(pace_rows(np.random.default_rng(0)), SCHEMA)
    df = folds.group_kfold(df, "group", 3)
    s = linear.cross_validate_linear(df, X, "label", "fold", "ols")[0].collect()[0]
    assert s.r2 == pytest.approx(1.0) and s.mae_s == pytest.approx(0.0, abs=1e-9)
    with pytest.raises(ValueError):
        folds.group_kfold(df, "group", 7)


def test_group_folds_disjoint_and_balanced(spark):
    rows = [(f"g{g}", i) for g in range(20) for i in range(g + 1)]
    df = folds.group_kfold(spark.createDataFrame(rows, "group string, i int"), "group", 5)
    per_group = df.groupBy("group").agg(F.countDistinct("fold").alias("k")).collect()
    assert all(r.k == 1 for r in per_group)
    sizes = [r["count"] for r in df.groupBy("fold").count().collect()]
    assert max(sizes) - min(sizes) <= 20


def test_stratified_group_folds(spark):
    rng = np.random.default_rng(2)
    rows = [(f"d{d}", int(rng.random() < 0.2)) for d in range(40) for _ in range(6)]
    df = folds.stratified_group_kfold(spark.createDataFrame(rows, "group string, label int"), "group", "label", 5)
    assert all(r.k == 1 for r in df.groupBy("group").agg(F.countDistinct("fold").alias("k")).collect())
    rates = [r.rate for r in df.groupBy("fold").agg(F.avg("label").alias("rate")).collect()]
    assert max(rates) - min(rates) < 0.15


def test_folds_of_null_groups_and_one_rule_at_every_size(spark):
    rows = [(None if g == 3 else f"g{g:03d}", i) for g in range(200) for i in range(1 + g % 7)]
    df = spark.createDataFrame(rows, "group string, i int")
    for deal in (folds.group_kfold(df, "group", 5),
                 folds.stratified_group_kfold(df.withColumn("label", F.col("i") % 2), "group", "label", 5)):
        found = deal.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("fold").alias("k"),
                                          F.min("fold").alias("fold")).collect()
        assert len(found) == 200 and all(r.k == 1 for r in found) and sum(r.n for r in found) == len(rows)
        sizes = [r["count"] for r in deal.groupBy("fold").count().collect()]
        assert max(sizes) - min(sizes) <= 7
    ranked = sorted(((-r.n, r.group is not None, r.group or "", r.fold) for r in folds.group_kfold(df, "group", 5)
                     .groupBy("group", "fold").agg(F.count(F.lit(1)).alias("n")).collect()))
    assert [r[3] for r in ranked[:10]] == [0, 1, 2, 3, 4, 0, 1, 2, 3, 4]
    with pytest.raises(ValueError):
        folds.stratified_group_kfold(df.withColumn("label", F.col("i") % 2), "group", "label", 201)


def _greedy_folds(groups, k, classes=()):
    """One by one: ``groups`` are (name, rows, counts of the classes); the fold of each by plain fractions."""
    totals = {c: sum(g[2].get(c, 0) for g in groups) for c in classes}
    rows, held, out = [0] * k, [dict.fromkeys(classes, 0) for _ in range(k)], {}

    def spread(counts):
        return len(classes) * sum(n * n for n in counts.values()) - sum(counts.values()) ** 2

    def uneven(f, counts):
        total = Fraction(0)
        for c in classes:
            shares = [Fraction(held[i][c] + (counts.get(c, 0) if i == f else 0), totals[c]) for i in range(k)]
            mean = sum(shares) / k
            total += sum((s - mean) ** 2 for s in shares) / k
        return total

    for name, n, counts in sorted(groups, key=lambda g: (-spread(g[2]), -g[1], sorted(g[2].items()), g[0])):
        to = min(range(k), key=lambda f: (uneven(f, counts), rows[f], f))
        out[name] = to
        rows[to] += n
        for c, m in counts.items():
            held[to][c] += m
    return out


def test_runs_are_dealt_as_one_by_one():
    rng = np.random.default_rng(5)
    for _ in range(300):
        k, count = int(rng.integers(1, 7)), int(rng.integers(1, 60))
        keys = [(int(a), int(b)) for a, b in rng.integers(0, 12, size=(k, 2))]
        step = (int(rng.integers(1, 5)), int(rng.integers(0, 4)))
        stretches, taken = folds.deal_run(keys, step, count)
        now, order = list(keys), []
        for _ in range(count):
            f = min(range(k), key=lambda i: (now[i], i))
            order.append(f)
            now[f] = (now[f][0] + step[0], now[f][1] + step[1])
        ends = [first for first, _ in stretches[1:]] + [count]
        assert [turns[i % len(turns)] for (first, turns), end in zip(stretches, ends) for i in range(end - first)] == order
        assert taken == [order.count(f) for f in range(k)] and len(stretches) <= k


def test_a_run_of_a_billion_groups_takes_a_few_stretches():
    stretches, taken = folds.deal_run([(4 * 10 ** 9, 0), (0, 0), (10, 0)], (1, 1), 10 ** 9)
    assert stretches == [(0, [1]), (10, [2, 1])] and taken == [0, 500_000_005, 499_999_995]


def test_greedy_folds_equal_one_by_one(spark):
    rng = np.random.default_rng(11)
    # skewed sizes, a third of all rows in one group, repeated sizes, three classes and rows without a label
    sizes = [400] + [int(n) for n in np.minimum(60, rng.zipf(1.6, size=90))]
    rows = [(f"g{g:02d}", [0, 0, 0, 1, 2, None][int(rng.integers(0, 6))]) for g, n in enumerate(sizes) for _ in range(n)]
    df = spark.createDataFrame(rows, "group string, label int").repartition(7)
    groups = []
    for name in sorted({g for g, _ in rows}):
        labels = [c for g, c in rows if g == name]
        groups.append((name, len(labels), dict(Counter(c for c in labels if c is not None))))
    plain = {r[0]: r[1] for r in folds.group_kfold_table(df, "group", 5).collect()}
    assert plain == _greedy_folds([(g, n, {}) for g, n, _ in groups], 5)
    even = {r[0]: r[1] for r in folds.stratified_group_kfold_table(df, "group", "label", 5).collect()}
    assert even == _greedy_folds(groups, 5, (0, 1, 2))
    empty = df.where("group = 'none'")
    assert folds.group_kfold_table(empty).count() == folds.stratified_group_kfold_table(empty).count() == 0
    unlabelled = df.withColumn("label", F.lit(None).cast("int"))
    assert {r[0]: r[1] for r in folds.stratified_group_kfold_table(unlabelled).collect()} == plain


def test_a_callers_cache_survives_out_of_fold(spark):
    df = spark.createDataFrame([(f"g{i % 6}", float(i), float(i % 2), i % 3) for i in range(60)],
                               "group string, x double, label double, fold int").cache()
    est = classify.build_dnf_tree(["x"])
    assert folds.out_of_fold(df, est.fit).count() == 60
    assert df.is_cached and df.storageLevel.useMemory
    df.unpersist()
    assert folds.out_of_fold(df, est.fit).count() == 60
    assert not df.is_cached


def test_stacking_meta_model_has_an_intercept(spark):
    rng = np.random.default_rng(8)
    rows = [(i, f"g{i % 8}", float(x), float(x + rng.normal() > 1.0)) for i, x in enumerate(rng.normal(size=240))]
    df = spark.createDataFrame(rows, "row_id long, group string, x double, label double")
    model = classify.build_dnf_stacking(["x"]).fit(df)
    assert abs(model.meta.model.intercept) > 1e-6
    scored = model.transform(df).toPandas()
    assert scored.probability[scored.label == 1].mean() > scored.probability[scored.label == 0].mean()


def test_mixture_far_from_zero(spark):
    rng = np.random.default_rng(9)
    x = np.r_[rng.normal(size=(150, 2)), rng.normal(size=(150, 2)) + 12]
    fits = []
    for shift in (0.0, 1e8):
        df = spark.createDataFrame([tuple(map(float, r + shift)) for r in x], "a double, b double")
        fits.append(mixture.fit_gaussian_mixture(df, ["a", "b"], 2))
    near, far = (sorted(zip(m.means.tolist(), m.covariances.tolist())) for m in fits)
    for (m0, c0), (m1, c1) in zip(near, far):
        assert np.allclose(np.array(m0) + 1e8, m1, atol=1e-3)
        assert np.allclose(c0, c1, rtol=1e-3, atol=1e-3) and np.linalg.eigvalsh(c1).min() > 0


def _plain_kmeans(x, k, starts):
    found = []
    for s in range(starts):
        c = mixture.start_centres(k, np.cov(x.T, bias=True), s) + x.mean(axis=0)
        for _ in range(mixture.KMEANS_MAX_ITER):
            lab = np.array([int(np.argmin([((p - q) ** 2).sum() for q in c])) for p in x])
            new = np.array([x[lab == j].mean(axis=0) if (lab == j).any() else c[j] for j in range(k)])
            if ((new - c) ** 2).sum() <= mixture.KMEANS_TOL * x.var(axis=0).mean():
                break
            c = new
        found.append((sum(((p - c[j]) ** 2).sum() for p, j in zip(x, lab)), c, lab))
    return min(found, key=lambda f: f[0])


def _plain_em(x, lab, k, max_iter=100, tol=1e-3):
    d, last = x.shape[1], -np.inf
    share = np.eye(k)[lab]
    for _ in range(max_iter + 1):
        n = share.sum(axis=0)
        means = np.array([(share[:, j, None] * x).sum(axis=0) / n[j] for j in range(k)])
        covs = [((share[:, j, None] * (x - means[j])).T @ (x - means[j])) / n[j] + 1e-6 * np.eye(d) for j in range(k)]
        dens = np.array([[n[j] / n.sum() * np.exp(-0.5 * (p - means[j]) @ np.linalg.solve(covs[j], p - means[j]))
                          / np.sqrt((2 * np.pi) ** d * np.linalg.det(covs[j])) for j in range(k)] for p in x])
        level = np.log(dens.sum(axis=1)).sum()
        share = dens / dens.sum(axis=1, keepdims=True)
        if abs(level - last) / len(x) < tol:
            break
        last = level
    return level, n / n.sum(), means, np.array(covs)


def test_shared_passes_equal_plain_loops(spark):
    rng = np.random.default_rng(13)
    x = np.r_[rng.normal(size=(70, 2)), rng.normal(size=(50, 2)) * [2, 0.4] + [5, 1], rng.normal(size=(30, 2)) + [-1, 6]]
    x = np.r_[x, x[:9]]  # repeated rows
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id int, a double, b double")
    spread = df.repartition(11, "id")
    kmeans = mixture.fit_kmeans_all(spread, ["a", "b"], (1, 2, 3, 4), starts=5)
    mixed = mixture.fit_mixtures(spread, ["a", "b"], (1, 2, 3, 4), starts=5)
    for k in (1, 2, 3, 4):
        inertia, centres, lab = _plain_kmeans(x, k, 5 if k > 1 else 1)
        order = np.lexsort(centres.T[::-1])
        assert np.allclose(kmeans[k].centres, centres[order]) and kmeans[k].inertia == pytest.approx(inertia)
        got = {r.id: r.cluster for r in kmeans[k].transform(df).collect()}
        assert [got[i] for i in range(len(x))] == [int(np.flatnonzero(order == j)[0]) for j in lab]
        level, weights, means, covs = _plain_em(x, lab, k)
        order = np.lexsort(means.T[::-1])
        assert mixed[k].converged and mixed[k].log_likelihood == pytest.approx(level, rel=1e-9)
        assert np.allclose(mixed[k].weights, weights[order]) and np.allclose(mixed[k].means, means[order])
        assert np.allclose(mixed[k].covariances, covs[order])
    # a fit alone is the fit among others
    alone = mixture.fit_gaussian_mixture(df, ["a", "b"], 3, starts=5)
    assert np.allclose(alone.means, mixed[3].means) and alone.n_iter == mixed[3].n_iter


def test_mixtures_of_odd_tables(spark):
    schema = "a double, b double"
    one = spark.createDataFrame([(2.0, 3.0)] * 5, schema)
    found = mixture.fit_mixtures(one, ["a", "b"], (1, 2))
    assert np.allclose(found[1].means, [[2.0, 3.0]]) and found[1].n == 5
    assert mixture.fit_kmeans_all(one, ["a", "b"], (2,))[2].inertia == pytest.approx(0.0)
    for bad in ([(1.0, None), (2.0, 3.0)], [(1.0, float("nan")), (2.0, 3.0)], []):
        with pytest.raises(ValueError):
            mixture.fit_mixtures(spark.createDataFrame(bad, schema), ["a", "b"], (1,))


def test_ridge_matches_closed_form_and_lasso_zeroes(spark):
    rng = np.random.default_rng(5)
    Xm = rng.normal(size=(200, 3))
    y = Xm @ np.array([1.0, -2.0, 0.01]) + rng.normal(scale=0.1, size=200)
    df = spark.createDataFrame([tuple(map(float, r)) + (float(t),) for r, t in zip(Xm, y)],
                               "a double, b double, c double, label double")
    mu, sd = Xm.mean(0), Xm.std(0)
    Z = (Xm - mu) / sd
    bz = np.linalg.solve(Z.T @ Z + 1.0 * np.eye(3), Z.T @ (y - y.mean()))
    ridge = linear.fit_linear(df, ["a", "b", "c"], "label", "ridge", 1.0)
    assert np.allclose(ridge.coef, bz / sd, atol=1e-8)
    lasso = linear.fit_linear(df, ["a", "b", "c"], "label", "lasso", 0.1)
    assert lasso.coef[2] == 0.0 and abs(lasso.coef[1]) < 2.0
    big = linear.fit_linear(df, ["a", "b", "c"], "label", "ridge", 1000.0)
    assert np.linalg.norm(big.coef) < np.linalg.norm(ridge.coef)


def test_tree_learns_or_rule(spark):
    rows = []
    for d in range(20):
        team = "X" if d < 3 else f"T{d % 5}"
        for r in range(6):
            grid = float(1 + (d + r) % 20)
            rows.append((f"D{d}", d * 10 + r, grid, float(team == "X"), int(grid >= 18 or team == "X")))
    df = spark.createDataFrame(rows, "group string, row_id int, grid_position double, team_X double, label int")
    df = folds.stratified_group_kfold(df, "group", "label", 5)
    oof = classify.out_of_fold_probabilities(df, classify.build_dnf_tree(["grid_position", "team_X"]))
    m = metrics.binary_metrics(oof).collect()[0]
    assert m.recall == 1.0 and m.precision == 1.0
    assert metrics.roc_auc(oof).collect()[0].roc_auc == pytest.approx(1.0)


def test_clustering_blobs(spark):
    rng = np.random.default_rng(0)
    centres = np.array([[0, 0, 0], [6, 6, 0], [0, 6, 6]], dtype=float)
    pts = np.vstack([c + rng.normal(scale=0.5, size=(40, 3)) for c in centres])
    truth = np.repeat([0, 1, 2], 40)
    df = spark.createDataFrame([(int(i), int(t), *map(float, p)) for i, (t, p) in enumerate(zip(truth, pts))],
                               "id int, truth int, a double, b double, c double")
    z = cluster.standardize(df, ["a", "b", "c"])
    zs = z.toPandas()
    assert np.allclose(zs[["a", "b", "c"]].std(ddof=0), 1.0)
    coords, explained = cluster.fit_pca(z, ["a", "b", "c"], 2)
    assert sum(r.explained_variance_ratio for r in explained.collect()) > 0.9
    lab = cluster.fit_kmeans(coords, ["pc1", "pc2"], 3).toPandas().sort_values("id")
    tab = {}
    for t, c in zip(lab.truth, lab.cluster):
        tab.setdefault(t, set()).add(c)
    assert all(len(v) == 1 for v in tab.values()) and len({min(v) for v in tab.values()}) == 3
    lab_df = cluster.fit_kmeans(coords, ["pc1", "pc2"], 3)
    assert cluster.silhouette(lab_df, ["pc1", "pc2"]) > 0.5
    bic = {r.k: r.bic for r in cluster.select_n_components_by_bic(coords, ["pc1", "pc2"], (1, 2, 3, 4, 5)).collect()}
    assert min(bic, key=bic.get) == 3
    _, g = cluster.fit_gmm(coords, ["pc1", "pc2"], 3)
    probs = np.array(g.select("probability").toPandas().probability.tolist())
    assert np.allclose(probs.sum(axis=1), 1.0) and probs.max(axis=1).mean() > 0.95


def test_linear_fit_survives_a_large_shift(spark):
    import numpy as np

    from lapline.models import linear

    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 2))
    y = 2.0 * x[:, 0] - 0.5 * x[:, 1] + 7.0
    for shift in (0.0, 1e8):
        rows = [(float(a + shift), float(b), float(c)) for (a, b), c in zip(x, y)]
        df = spark.createDataFrame(rows, "a double, b double, label double")
        m = linear.fit_linear(df, ["a", "b"], method="ridge", alpha=1e-9)
        assert np.allclose(m.coef, [2.0, -0.5], atol=1e-5)


def test_linear_fit_raises_on_null(spark):
    import pytest

    from lapline.models import linear

    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "a double, label double")
    with pytest.raises(Exception, match="null feature or label"):
        linear.fit_linear(df, ["a"])


def test_sparse_teams_at_any_width(spark):
    from lapline.operators.features import build_dnf_features

    rows = [(f"T{i:05d}", f"D{i}", float(i % 20), i % 3 == 0) for i in range(1500)] + [(None, "X", 1.0, False)]
    df = spark.createDataFrame(rows, "team string, driver string, grid_position double, dnf boolean")
    out = {r.group: r.team_levels for r in build_dnf_features(df, sparse_teams=True).collect()}
    assert len(out) == 1501 and out["D7"].size == 1500
    assert list(out["D7"].indices) == [7] and out["X"].numNonzeros() == 0


def dnf_rows(spark, n=400, seed=11):
    """One row in six retires, more often from the back of the grid and in team X."""
    rng = np.random.default_rng(seed)
    grid = rng.integers(1, 21, n).astype(float)
    team = rng.random(n) < 0.3
    p = 1 / (1 + np.exp(-(0.25 * (grid - 17) + 1.5 * team)))
    y = (rng.random(n) < p).astype(float)
    rows = [(i, f"D{i % 40}", float(g), float(t), float(not t), float(v)) for i, (g, t, v) in enumerate(zip(grid, team, y))]
    return spark.createDataFrame(rows, "row_id long, group string, grid_position double, team_X double, team_Y double, label double").coalesce(1)


DNF = ["grid_position", "team_X", "team_Y"]


def test_logistic_equals_a_newton_solve(spark):
    df = dnf_rows(spark)
    pdf = df.toPandas()
    model = classify.build_dnf_logistic(DNF).fit(df)
    x = pdf[DNF].to_numpy()
    x[:, 0] = (x[:, 0] - x[:, 0].mean()) / x[:, 0].std()
    y = pdf.label.to_numpy()
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    b = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ b))
        h = (x * (w * p * (1 - p))[:, None]).T @ x + np.eye(3)
        b -= np.linalg.solve(h, x.T @ (w * (p - y)) + b)
    assert np.allclose(model.model.coefficients.toArray(), b, atol=1e-6)
    assert model.model.intercept == 0.0


def mean_probability(est, df):
    return est.fit(df).transform(df).agg(F.avg("probability")).first()[0]


def test_balanced_weights_raise_the_rare_class(spark):
    df = dnf_rows(spark)
    for make in (classify.build_dnf_tree, classify.build_dnf_logistic):
        assert mean_probability(make(DNF), df) > mean_probability(make(DNF, class_weight=None), df) + 0.02


def test_forest_and_booster_learn_and_weigh(spark):
    df = dnf_rows(spark).cache()
    forest = classify.build_dnf_forest(DNF, n_estimators=20)
    booster = classify.build_dnf_boosting(DNF, 1.0, 10, 2)
    for est in (forest, booster):
        scored = est.fit(df).transform(df)
        assert scored.count() == df.count()
        assert metrics.roc_auc(scored).first().roc_auc > 0.75
    assert mean_probability(classify.build_dnf_boosting(DNF, 5.0, 10, 2), df) > mean_probability(booster, df) + 0.02
    df.unpersist()


@pytest.mark.parametrize("kernel", ["linear", "rbf"])
def test_svm_separates_compounds(spark, kernel):
    rng = np.random.default_rng(4)
    rows = [(c, *map(float, rng.normal(size=2) * 0.4 + m)) for c, m in (("hard", (0, 4)), ("medium", (4, 0)), ("soft", (-4, -4)))
            for _ in range(40 if c != "soft" else 8)]
    df = spark.createDataFrame(rows, "label string, a double, b double").coalesce(1)
    found = classify.TyreSvm(["a", "b"], kernel=kernel).fit(df).transform(df)
    assert found.where("prediction = label").count() >= 86
