import numpy as np
from pyspark.sql import functions as F

from lapline.llm import topk

SCHEMA = "vec_id long, embedding array<float>, block int, part int"


def plain(rows, k=5):
    good = [(r[0], [int(np.floor(256 * float(np.float32(x)))) for x in r[1]]) for r in rows
            if r[0] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1])]
    out = []
    for q, x in {(q, tuple(x)) for q, x in good if q % 50 == 0}:
        found = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in good if i != q and len(y) == len(x))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return sorted(out)


def run(df, **options):
    v = topk.quantised(df)
    return sorted(tuple(r) for r in topk.top_k(v.where(F.col("vec_id") % 50 == 0), v, 5, **options).collect())


def test_against_brute_force(spark):
    draw = np.random.default_rng(6)
    rows = [(i, [float(x) for x in draw.normal(size=12)], 0, 0) for i in range(400)]
    rows += [(1000 + i, rows[i % 3][1], 0, 0) for i in range(20)]  # ties
    rows += [(50_000, None, 0, 0), (50_050, [], 0, 0), (50_100, [None, 1.0], 0, 0), (50_150, [float("nan"), 1.0], 0, 0),
             (None, [1.0, 2.0], 0, 0), (50_200, [0.0] * 12, 0, 0), (50_250, [1.0, 2.0], 0, 0), (50_251, [-1.0, 2.0], 0, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert run(df) == plain(rows)
    assert run(df, block_size=64, query_block=3) == plain(rows)


def test_large_components_stay_exact(spark):
    rows = [(50 * i, [1e12 * (i + 1), -3e11 + i], 0, 0) for i in range(4)]
    rows = [(r[0], [float(np.float32(x)) for x in r[1]], 0, 0) for r in rows]
    small = [(r[0], [x / 1e6 for x in r[1]], 0, 0) for r in rows]
    assert run(spark.createDataFrame(small, SCHEMA)) == plain(small)


def test_pruned_before_the_last_segment():
    """Close neighbours are proved before all segments are read."""
    draw = np.random.default_rng(7)
    x = np.floor(256 * draw.normal(size=(2000, 64)) / 8).astype(np.int64)
    x[1] = x[0] + 1
    read = []

    def segments():
        size = np.abs(x.astype(float))
        level = np.where(size > 0, np.frexp(size)[1] - 1, -1)
        rest = (size ** 2).sum(axis=1)
        for l in range(8, -1, -1):
            row, at = np.nonzero(level == l)
            rest = rest - np.bincount(row, weights=size[row, at] ** 2, minlength=len(x))
            read.append(l)
            yield row, at, x[row, at], np.sqrt(np.maximum(rest, 0))

    q, found, score = topk.search_block(x[:1], np.array([0]), np.arange(2000), x, segments(), 1)
    assert found.tolist() == [1] and score[0] == x[0] @ x[1] and min(read) > 0


def test_empty(spark):
    assert run(spark.createDataFrame([], SCHEMA)) == []
    assert run(spark.createDataFrame([(50, [1.0], 0, 0)], SCHEMA)) == []
