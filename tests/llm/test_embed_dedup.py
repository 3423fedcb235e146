import numpy as np
import pytest

from lapline.llm import embed_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, vec string, node int"


def plain(rows, threshold=0.93):
    good = [i for i, r in enumerate(rows) if r[1] and r[2] is not None and all(x is not None and np.isfinite(x) for x in r[1])
            and any(r[1])]
    links = {i: set() for i in range(len(rows))}
    for i in good:
        for j in good:
            if i < j and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], np.float32).astype(float), np.array(rows[j][1], np.float32).astype(float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    links[i].add(j)
                    links[j].add(i)
    out = []
    for i, r in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids, default=None)
        out.append((r[0], len(links[i]), least, r[0] is not None and r[0] == least))
    return sorted(out, key=str)


def run(df, **options):
    return sorted((tuple(r) for r in embed_dedup.near_duplicates(df, **options).collect()), key=str)


@pytest.mark.parametrize("leaf", [2048, 12])
def test_against_brute_force(spark, leaf):
    draw = np.random.default_rng(4)
    rows = []
    for label in (0, 1, 2):
        for centre in draw.normal(size=(6, 16)):
            for spread in (0, 0.05, 0.12, 0.2, 0.3):
                rows += [(len(rows) + 100 * k, [float(x) for x in centre + spread * draw.normal(size=16)], label, "x", 1) for k in range(2)]
    rows += [rows[0], rows[0], (7, None, 1, "", 0), (8, [], 1, "", 0), (9, [0.0] * 16, 1, "", 0), (10, [float("nan")] * 16, 1, "", 0),
             (11, [None, *[1.0] * 15], 1, "", 0), (12, rows[3][1], None, "", 0), (None, rows[3][1], 0, "", 0),
             (13, [1.0, 0.0], 0, "", 0), (14, [2.0, -0.0], 0, "", 0), (15, [float("inf")] * 16, 0, "", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert run(df, leaf=leaf, fanout=4, sample=16) == plain(rows)


def test_a_leaf_of_close_copies_is_dealt_out(spark):
    draw = np.random.default_rng(5)
    base = draw.normal(size=8)
    rows = [(i, [float(x) for x in base + 1e-6 * draw.normal(size=8)], 1, "", 0) for i in range(120)]
    found = run(spark.createDataFrame(rows, SCHEMA), leaf=10, fanout=2, sample=8, levels=3)
    assert {r[1:] for r in found} == {(119, 0, i == 0) for i in range(2)} and len(found) == 120


def test_empty(spark):
    assert run(spark.createDataFrame([], SCHEMA)) == []
    assert run(spark.createDataFrame([(1, None, None, "", 0)], SCHEMA)) == [(1, 0, 1, True)]
