"""U4 against all pairs."""

import numpy as np
import pytest

from lapline.models import silhouette
from lapline.models.silhouette import euclidean_silhouette, worst_error


def plain(x, c):
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    s = np.zeros(len(x))
    for i in range(len(x)):
        own = (c == c[i]).sum()
        if own == 1:
            continue
        a = far[i, c == c[i]].sum() / (own - 1)
        b = min(far[i, c == v].mean() for v in set(c) - {c[i]})
        s[i] = (b - a) / max(a, b) if max(a, b) > 0 else 0.0
    return s.mean()


def table(spark, x, c):
    names = ", ".join(f"x{i} double" for i in range(x.shape[1]))
    return spark.createDataFrame([(*map(float, row), int(v)) for row, v in zip(x, c)], f"{names}, cluster int")


def blobs(n, d, seed):
    rng = np.random.default_rng(seed)
    c = rng.choice(3, n, p=[0.6, 0.3, 0.1])
    return rng.normal(size=(n, d)) + 1.5 * np.eye(3)[c][:, :d] + 7, c


def test_errors_fall_with_nodes():
    assert worst_error(8, 2) < 1e-5 and worst_error(12, 2) < 1e-7 and worst_error(10, 2) < worst_error(8, 2)


@pytest.mark.parametrize("d,n,leaf", [(1, 300, 20), (2, 700, 10)])
def test_equals_all_pairs(spark, d, n, leaf):
    x, c = blobs(n, d, d)
    value, bound = euclidean_silhouette(table(spark, x, c), [f"x{i}" for i in range(d)], leaf_points=leaf)
    assert bound <= 1e-6 and abs(value - plain(x, c)) <= max(bound, 1e-12)


def test_dense_spot_copies_and_a_lone_point(spark):
    """A third of the rows are copies, a third lie within a hundredth, one cluster has one point."""
    x, c = blobs(240, 2, 5)
    x[:80] = x[0]
    c[:80] = 1
    x[80:160] = x[80] + 1e-2 * np.random.default_rng(1).normal(size=(80, 2))
    c[-1] = 9
    value, bound = euclidean_silhouette(table(spark, x, c), ["x0", "x1"], leaf_points=16)
    assert bound <= 1e-6 and abs(value - plain(x, c)) <= max(bound, 1e-12)


def test_odd_tables(spark):
    x, c = blobs(20, 2, 7)
    df = table(spark, x, c)
    same = table(spark, np.ones((6, 2)), np.array([0, 0, 0, 1, 1, 2]))
    assert euclidean_silhouette(same, ["x0", "x1"]) == (0.0, 0.0)
    for bad in (df.where("cluster = 0"), df.where("false"), df.selectExpr("x0", "x1", "row_number() over (order by x0) as cluster"),
                df.selectExpr("x0", "if(x0 > 7, null, x1) as x1", "cluster")):
        with pytest.raises(ValueError):
            euclidean_silhouette(bad, ["x0", "x1"])


def test_a_dense_spot_does_not_halve_all_leaves(spark):
    """Forty points within a millionth of the cube are met one by one, the others' leaves stay as they are."""
    rng = np.random.default_rng(3)
    x, c = rng.uniform(size=(900, 2)), rng.integers(0, 3, 900)
    x[:40] = x[0] + 1e-6 * rng.normal(size=(40, 2))
    cells = silhouette._Cells(table(spark, x, c), ["x0", "x1"], "cluster", 16)
    assert cells.level <= 4 and cells.leaves.selectExpr("max(length(points))").first()[0] <= 40 * 32
    value, bound = cells.mean(12)
    assert bound <= 1e-6 and abs(value - plain(x, c)) <= bound


def test_points_equal_but_for_the_last_digit_are_one(spark):
    """Every point twenty times, up to rounding: leaves stay as wide as for the points alone."""
    x, c = blobs(150, 2, 8)
    x, c = np.repeat(x, 20, axis=0) * (1 + 2.2e-16 * np.tile(np.arange(20) % 2, 150))[:, None], np.repeat(c, 20)
    cells = silhouette._Cells(table(spark, x, c), ["x0", "x1"], "cluster", 16)
    assert cells.level <= 5
    value, bound = cells.mean(12)
    assert bound <= 1e-6 and abs(value - plain(x, c)) <= bound
