"""Shared-pass fits against plain loops over rows."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from lapline.models import cells as ce
from lapline.models import shared_fits as sf

LEVELS = ["ant", "bee", "cat", "dog"]


def make_rows(n=600, seed=4, nulls=True):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        a, b, t = float(rng.integers(1, 9)), float(np.round(rng.random(), 1)), rng.choice(LEVELS)
        z = 0.5 * (a - 4) + (1.5 if t == "bee" else -1.0 if t == "dog" else 0) + (2 if b > 0.5 else 0) * (a < 4)
        label = float(rng.random() < 1 / (1 + np.exp(-z)))
        if nulls and i % 50 == 0:
            a = None
        rows.append((i, a, b, None if i % 97 == 3 else str(t), int(i % 4), label))
    return rows


@pytest.fixture(scope="module")
def table(spark):
    df = spark.createDataFrame(make_rows(), "row_id long, a double, b double, team string, fold int, label double")
    return ce.shared_cut(sf.with_inner_folds(df, ["row_id"], folds=3))


@pytest.fixture(scope="module")
def cells(table):
    return ce.build_cells(table, ["a", "b"], "team", inner="inner_fold")


def cell_arrays(cells):
    blocks = [b for batch in cells.blocks.toArrow().to_batches() for b in ce.unpack(batch)]
    return {n: np.concatenate([getattr(b, n) for b in blocks]) for n in
            ("numeric", "code", "fold", "inner", "negatives", "positives", "hash")}


def candidates(code, slots):
    """(feature, cut, goes right) of every split, in the order of ties."""
    out = []
    for f, n in enumerate(slots):
        for c in range(n - 1):
            out.append((f, c, code[:, f] == c if f == len(slots) - 1 else code[:, f] > c))
    return out


def plain_tree(code, n0, n1, weights, slots, depth, choose=None, node=0):
    """Nested dict of the splits and leaves, one split after the other."""
    w0, w1 = n0.sum() * weights[0], n1.sum() * weights[1]
    out = {"value": w1 / (w0 + w1) if w0 + w1 else 0.0}
    if not depth or not n0.sum() or not n1.sum():
        return out

    def impurity(a, b):
        return 2 * a * b / (a + b) if a + b else 0.0

    allowed = choose(code, n0 + n1, node) if choose else None
    best = None
    starts = np.concatenate([[0], np.cumsum(slots)])
    for f, c, right in candidates(code, slots):
        if allowed is not None and not allowed[starts[f] + c]:
            continue
        if not (n0 + n1)[right].sum() or not (n0 + n1)[~right].sum():
            continue
        gain = impurity(w0, w1) - sum(impurity(n0[s].sum() * weights[0], n1[s].sum() * weights[1]) for s in (right, ~right))
        if best is None or gain > best[0] + 1e-10 * abs(best[0]):
            best = gain, f, c, right
    if best:
        _, f, c, right = best
        out |= {"split": (f, c), "left": plain_tree(code[~right], n0[~right], n1[~right], weights, slots, depth - 1, choose, 2 * node + 1),
                "right": plain_tree(code[right], n0[right], n1[right], weights, slots, depth - 1, choose, 2 * node + 2)}
    return out


def as_dict(trees, t, node=0):
    out = {"value": pytest.approx(float(trees.value[t, node]))}
    if trees.feature[t, node] >= 0:
        out |= {"split": (int(trees.feature[t, node]), int(trees.cut[t, node])), "left": as_dict(trees, t, 2 * node + 1),
                "right": as_dict(trees, t, 2 * node + 2)}
    return out


def test_cells_count_the_rows(table, cells):
    x = cell_arrays(cells)
    assert len(x["fold"]) == table.select("a", "b", "team", "fold", "inner_fold").distinct().count()
    assert (x["negatives"].sum(), x["positives"].sum()) == (table.where("label = 0").count(), table.where("label = 1").count())
    assert cells.slots == [9 + 0, 12, 5] and (x["code"][np.isnan(x["numeric"][:, 0]), 0] == 0).all()


def test_trees_of_all_folds_equal_plain_loops(cells):
    x = cell_arrays(cells)
    fits = [sf.Fit("tree", (0, 1, 2), outer=o, depth=d) for o in cells.folds for d in (2, 4)]
    found = sf.fit_all(cells, fits)
    for f in fits:
        own = f.trains(x["fold"], x["inner"])
        n0, n1 = x["negatives"] * own, x["positives"] * own
        weights = n0.sum() + n1.sum()
        weights = weights / (2 * n0.sum()), weights / (2 * n1.sum())
        assert f.class_weights(cells) == pytest.approx(weights)
        keep = own
        assert plain_tree(x["code"][keep], n0[keep], n1[keep], f.class_weights(cells), cells.slots, f.depth) == as_dict(found[f], 0)


def test_forest_equals_a_plain_loop(cells):
    x = cell_arrays(cells)
    fit = sf.Fit("forest", (0, 1, 2), outer=1, n_trees=6, depth=3)
    found = sf.fit_all(cells, [fit])[fit]
    own = fit.trains(x["fold"], x["inner"])
    starts = np.concatenate([[0], np.cumsum(cells.slots)])
    for t in range(6):
        n0, n1 = (sf.bootstrap_counts(x["hash"], x[n], t, label) * own for label, n in enumerate(("negatives", "positives")))
        keep = n0 + n1 > 0

        def choose(code, n, node):
            present = np.concatenate([np.bincount(code[:, f], weights=n, minlength=k) for f, k in enumerate(cells.slots)])
            assert len(present) == starts[-1]
            return sf._chosen_features(cells, fit, present, t, node)

        assert plain_tree(x["code"][keep], n0[keep], n1[keep], fit.class_weights(cells), cells.slots, 3, choose) == as_dict(found, t)


def test_bootstrap_draws_are_poisson():
    hashes = np.arange(40_000, dtype=np.int64) * 7919
    for n in (1, 5, 64, 400):
        drawn = sf.bootstrap_counts(hashes, np.full(len(hashes), n), 3, 1)
        assert abs(drawn.mean() - n) < 0.03 * n and abs(drawn.var() - n) < 0.06 * n
        assert (drawn != sf.bootstrap_counts(hashes, np.full(len(hashes), n), 4, 1)).any()
    share = np.bincount(sf.bootstrap_counts(hashes, np.full(len(hashes), 1), 0, 0), minlength=4)[:4] / len(hashes)
    assert share == pytest.approx(np.exp(-1) / np.array([1, 1, 2, 6]), abs=0.01)


def plain_boosting(code, n0, n1, slots, rounds, depth, spw):
    margin, trees = np.zeros(len(code)), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = n0 * p - n1 * spw * (1 - p), (n0 + n1 * spw) * p * (1 - p)

        def grow(at, left):
            G, H = g[at].sum(), h[at].sum()
            out = {"value": pytest.approx(-0.3 * G / (H + 1))}
            best = None
            for f, c, right in candidates(code[at], slots) if left else []:
                a, b = at[~right], at[right]
                if h[a].sum() < 1 or h[b].sum() < 1:
                    continue
                gain = sum(g[s].sum() ** 2 / (h[s].sum() + 1) for s in (a, b)) - G * G / (H + 1)
                if gain > 1e-6 and (best is None or gain > best[0] * (1 + 1e-10)):
                    best = gain, f, c, a, b
            if best:
                out |= {"split": best[1:3], "left": grow(best[3], left - 1), "right": grow(best[4], left - 1)}
            else:
                margin[at] -= 0.3 * G / (H + 1)
            return out

        trees.append(grow(np.arange(len(code)), depth))
    return trees, margin


def plain_values(tree):
    return {k: (plain_values(v) if isinstance(v, dict) else v) for k, v in tree.items()}


def found_values(trees, t, node=0):
    out = {"value": float(trees.value[t, node])}
    if trees.feature[t, node] >= 0:
        out |= {"split": (int(trees.feature[t, node]), int(trees.cut[t, node])), "left": found_values(trees, t, 2 * node + 1),
                "right": found_values(trees, t, 2 * node + 2)}
    return out


def test_boosting_equals_a_plain_booster(cells):
    x = cell_arrays(cells)
    fits = [sf.Fit("boosting", (0, 1, 2), outer=o, n_trees=n, depth=d, pos_weight=2.5) for o, n, d in ((0, 20, 3), (2, 20, 3), (2, 5, 2))]
    found = sf.fit_all(cells, fits)
    for f in fits:
        own = f.trains(x["fold"], x["inner"])
        trees, margin = plain_boosting(x["code"][own], x["negatives"][own], x["positives"][own], cells.slots, f.n_trees, f.depth, 2.5)
        assert [found_values(found[f], t) for t in range(f.n_trees)] == [plain_values(t) for t in trees]
        assert found[f].probability(x["code"][own], 2) == pytest.approx(1 / (1 + np.exp(-margin)))


def dense(x, mean, sd):
    return np.c_[(x["numeric"][:, 1] - mean) / sd, np.eye(len(LEVELS) + 1)[x["code"][:, 2]][:, :-1]]


def test_logistic_is_the_optimum(cells):
    x = cell_arrays(cells)
    fits = [sf.Fit("logistic", (1, 2), outer=o, C=c, scaled=(1,)) for o in cells.folds for c in (1.0, 0.1)]
    found = sf.fit_all(cells, fits)
    for f in fits:
        own = f.trains(x["fold"], x["inner"])
        n0, n1 = x["negatives"] * own, x["positives"] * own
        n = n0 + n1
        mean = (n @ x["numeric"][:, 1]) / n.sum()
        sd = np.sqrt(n @ (x["numeric"][:, 1] - mean) ** 2 / n.sum())
        X, (w0, w1), b = dense(x, mean, sd), f.class_weights(cells), np.zeros(5)
        for _ in range(30):
            p = 1 / (1 + np.exp(-X @ b))
            g = f.C * X.T @ (n0 * w0 * p - n1 * w1 * (1 - p)) + b
            H = f.C * (X * ((n0 * w0 + n1 * w1) * p * (1 - p))[:, None]).T @ X + np.eye(5)
            b -= np.linalg.solve(H, g)
        m = found[f]
        assert np.r_[m.numeric[1], m.level[:-1]] == pytest.approx(b, abs=1e-6) and m.numeric[0] == 0 and m.intercept == 0
        assert m.mean[1] == pytest.approx(mean) and m.scale[1] == pytest.approx(sd) and m.steps < 20
    with pytest.raises(ValueError, match="null features"):
        sf.fit_all(cells, [sf.Fit("logistic", (0, 2), scaled=(0,))])


def test_results_do_not_follow_partitions(table, cells, monkeypatch):
    monkeypatch.setattr(ce, "CELLS_PER_PARTITION", 60)
    monkeypatch.setattr(ce, "BLOCK_CELLS", 25)
    monkeypatch.setattr(sf, "PASS_SUMS", 150)
    monkeypatch.setattr(sf, "WORK", 100)
    many = ce.build_cells(table, ["a", "b"], "team", inner="inner_fold")
    assert many.parts > 3
    fits = [sf.Fit("tree", (0, 1, 2), outer=0), sf.Fit("forest", (0, 1, 2), outer=0, n_trees=3), sf.Fit("logistic", (1, 2), outer=0, scaled=(1,)),
            sf.Fit("boosting", (0, 1, 2), outer=0, n_trees=3, depth=2)]
    a, b = sf.fit_all(cells, fits), sf.fit_all(many, fits)
    for f in fits:
        if f.kind == "logistic":
            assert a[f].numeric == pytest.approx(b[f].numeric) and a[f].level == pytest.approx(b[f].level)
        else:
            assert (a[f].feature == b[f].feature).all() and (a[f].cut == b[f].cut).all() and a[f].value == pytest.approx(b[f].value)


def test_out_of_fold_rows(table, cells):
    fits = [sf.Fit("tree", (0, 1, 2), outer=o) for o in cells.folds]
    models = {f.outer: m for f, m in sf.fit_all(cells, fits).items()}
    rows = sf.out_of_fold(table, cells, fits).collect()
    assert sorted(r["row_id"] for r in rows) == list(range(600))
    for r in rows:
        x = np.array([[np.nan if r["a"] is None else r["a"], r["b"]]])
        code = cells.codes(x, np.array([len(cells.levels) if r["team"] is None else cells.levels.index(r["team"])]))
        assert r["probability"] == pytest.approx(models[r["fold"]].probability(code, 2)[0])
        assert r["prediction"] == int(r["probability"] > 0.5)


def test_stack_equals_nested_loops(spark):
    df = spark.createDataFrame(make_rows(400, 9, nulls=False), "row_id long, a double, b double, team string, fold int, label double")
    df = ce.shared_cut(sf.with_inner_folds(df, ["row_id"], folds=3))
    cells = ce.build_cells(df, ["a", "b"], "team", inner="inner_fold")
    features = (0, 1, 2)
    found = {r["row_id"]: r["probability"] for r in sf.out_of_fold_stack(df, cells, features, 2.0, forest_trees=5).collect()}
    rows = df.orderBy("row_id").collect()
    numeric = np.array([[r["a"], r["b"]] for r in rows])
    code = cells.codes(numeric, np.array([len(cells.levels) if r["team"] is None else cells.levels.index(r["team"]) for r in rows]))
    fold, inner, label = (np.array([r[c] for r in rows]) for c in ("fold", "inner_fold", "label"))

    def fitted(outer, held):  # one fit after the other, each in passes of its own
        return [sf.probability(sf.fit_all(cells, [f])[f], numeric, code) for f in sf.base_fits(features, outer, held, 2.0, 5)]

    for outer in (0, 3):
        x = np.zeros((len(rows), 4))
        for i in range(3):
            p = np.stack(fitted(outer, i), axis=1)
            x[inner == i] = p[inner == i]
        train = fold != outer
        X, b = np.c_[x[train], np.ones(train.sum())], np.zeros(5)
        for _ in range(30):
            p = 1 / (1 + np.exp(-X @ b))
            penal = np.array([1, 1, 1, 1, 0.0])
            b -= np.linalg.solve((X * (p * (1 - p))[:, None]).T @ X + np.diag(penal), X.T @ (p - label[train]) + penal * b)
        final = np.stack(fitted(outer, None), axis=1)
        expected = 1 / (1 + np.exp(-(np.c_[final, np.ones(len(rows))] @ b)))
        for k in np.flatnonzero(fold == outer):
            assert found[int(rows[k]["row_id"])] == pytest.approx(expected[k], abs=1e-6)


def test_experiments_equal_separate_fits(spark, table):
    df = table.where(F.col("a").isNotNull())
    cells = ce.build_cells(df, ["a", "b"], "team", inner="inner_fold")
    swept = {(r["n_estimators"], r["max_depth"]): r for r in sf.capacity_sweep(df, cells, (0, 2), 2.0, grid=((6, 2), (3, 3))).collect()}
    for (n, d), r in swept.items():
        oof = sf.out_of_fold(df, cells, [sf.dnf_fit("boosting", (0, 2), o, None, 2.0, n, d) for o in cells.folds])
        assert (r["threshold"], r["f1"]) == pytest.approx(sf._tuned_f1(oof))
    ablation = sf.feature_ablation(df, cells, {"base": (0, 2), "more": (0, 1, 2)}, 2.0, kinds=("tree", "logistic"))
    rows = {(r["model"], r["variant"]): r for r in ablation.collect()}
    assert rows["tree", "base"]["delta_f1"] == 0
    for (kind, variant), r in rows.items():
        own = (0, 2) if variant == "base" else (0, 1, 2)
        oof = sf.out_of_fold(df, cells, [sf.dnf_fit(kind, own, o) for o in cells.folds])
        assert r["f1"] == pytest.approx(sf._tuned_f1(oof)[1])
    assert rows["tree", "more"]["delta_f1"] == pytest.approx(rows["tree", "more"]["f1"] - rows["tree", "base"]["f1"])


def test_bad_labels_and_empty_tables(spark):
    schema = "a double, team string, fold int, label double"
    with pytest.raises(ValueError, match="folds must not be null"):
        ce.build_cells(spark.createDataFrame([(1.0, "x", None, 1.0)], schema), ["a"], "team")
    with pytest.raises(ValueError, match="labels must be 0 or 1"):
        ce.build_cells(spark.createDataFrame([(1.0, "x", 0, 2.0)], schema), ["a"], "team")
    empty = ce.build_cells(spark.createDataFrame([], schema), ["a"], "team")
    fit = sf.Fit("tree", (0, 1))
    assert sf.fit_all(empty, [fit])[fit].probability(np.zeros((0, 2), np.int32), 1).tolist() == []


def test_many_values_fall_into_quantile_bins(spark):
    df = spark.range(5000).select((F.col("id") * 1.5).alias("a"), (F.col("id") % 2).cast("int").alias("fold"),
                                  (F.col("id") > 3000).cast("double").alias("label"))
    cells = ce.build_cells(df, ["a"], max_bins=64)
    assert 50 <= len(cells.edges[0]) <= 63 and cells.slots == [len(cells.edges[0]) + 2, 1]
    fit = sf.Fit("tree", (0,), depth=1)
    tree = sf.fit_all(cells, [fit])[fit]
    assert abs(cells.edges[0][tree.cut[0, 0] - 1] - 4500) < 160


def test_trees_are_grown_by_tasks(table, cells, monkeypatch):
    """Parts of the cells and shares of the trees give the same forest; no sums reach the driver."""
    fits = [sf.Fit("forest", (0, 1, 2), outer=o, inner=i, n_trees=4) for o in (0, 2) for i in (1, None)] + [sf.Fit("forest", (1, 2), outer=0, n_trees=3)]
    whole = sf.fit_all(cells, fits)
    monkeypatch.setattr(ce, "CELLS_PER_PARTITION", 60)
    many = ce.build_cells(table, ["a", "b"], "team", inner="inner_fold")
    monkeypatch.setattr(sf, "TASK_CELLS", many.number // 3)
    monkeypatch.setattr(sf, "TASK_SUMS", 400)
    monkeypatch.setattr(sf, "WORK", 500)
    monkeypatch.setattr(sf, "_level_sums", None)
    dealt, parts, shares = sf._dealt(many, 19)
    assert parts >= 3 and shares > 1 and dealt.rdd.getNumPartitions() == parts * shares
    split = sf.fit_all(many, fits)
    for f in fits:
        assert (whole[f].feature == split[f].feature).all() and (whole[f].cut == split[f].cut).all()
        assert (whole[f].value == split[f].value).all() and (whole[f].gain == split[f].gain).all()
