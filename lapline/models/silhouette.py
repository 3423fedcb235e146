"""Mean silhouette on Euclidean distances, in time linear in the points and with a bound on its error (U4).

All pairs would be quadratic.  Here the columns' cube is cut into cells, halved
until a point shares its leaf with ``leaf_points`` distinct points on average
(a dense spot of few points doesn't halve the leaves of all others).  Distances
between points of the same or of touching leaves are taken one by one.  All
others are met at the first level at which their cells don't touch but their
parents do: there the distance is smooth in both points, so polynomials
through ``q`` Chebyshev nodes an axis stand for it.  A cell then is its weights
on the nodes, one set for each cluster (upwards, children to parent), takes the sums
of distances to at most 6^d - 3^d cells of its own level, and hands them down.
Every step is a grouping of cells on their places, whose groups are bounded
(children; the children of a cell and of those that touch it).

The polynomials' largest error over all such pairs of cells, in units of a
cell's side, is measured on the driver on a fine lattice and doubled; it
bounds every mean distance and so the silhouette.  ``q`` begins where distances
of a tenth of the cube would do, and rises until the bound is within ``tol``.

Equal points of a cluster are one point with a count; in more points than a leaf
has, so are those that agree to 48 bits of the cube's side (rows whose values are
the same but for the order of a sum), which the bound takes in.  A null or NaN raises;
so do fewer than two clusters or as many as rows.  A point alone in its
cluster has silhouette 0; so has every point if all are equal.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import lru_cache
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapline.session import ensure_checkpoint_dir, ship_code

LEAF_POINTS = 512
MAX_LEVEL = 30
MAX_CLUSTERS = 64
TOL = 1e-6
NODES = (8, 10, 12, 14, 16)
SNAP = 2.0 ** 48


@lru_cache
def nodes(q: int, d: int) -> np.ndarray:
    """The q^d nodes in [-1, 1]^d, the last axis fastest."""
    axis = np.cos((2 * np.arange(q) + 1) * np.pi / (2 * q))
    return np.stack(np.meshgrid(*[axis] * d, indexing="ij"), axis=-1).reshape(-1, d)


def weights(x: np.ndarray, q: int) -> np.ndarray:
    """Interpolation weights of points in [-1, 1]^d on the nodes: (points, q^d)."""
    axis = np.cos((2 * np.arange(q) + 1) * np.pi / (2 * q))
    degree = np.arange(q)
    at_nodes = np.cos(degree * np.arccos(axis)[:, None]) * np.where(degree, 2.0, 1.0) / q
    out = np.ones((len(x), 1))
    for a in range(x.shape[1]):
        at_points = np.cos(degree * np.arccos(np.clip(x[:, a], -1, 1))[:, None])
        out = (out[:, :, None] * (at_points @ at_nodes.T)[:, None, :]).reshape(len(x), -1)
    return out


@lru_cache
def from_parent(q: int, bits: tuple[int, ...]) -> np.ndarray:
    """Weights of a child's nodes on its parent's; ``bits``: the child's half on each axis."""
    return weights((nodes(q, len(bits)) + 2 * np.array(bits) - 1) / 2, q)


@lru_cache
def between(q: int, offset: tuple[int, ...]) -> np.ndarray:
    """Distances, in cell sides, of a cell's nodes to those of the cell ``offset`` away."""
    own = nodes(q, len(offset)) / 2
    return np.sqrt(((own[:, None] - own[None] - np.array(offset)) ** 2).sum(axis=2))


@lru_cache
def worst_error(q: int, d: int) -> float:
    """The largest error of an interpolated distance between cells that don't touch, in cell sides, doubled."""
    lattice = np.stack(np.meshgrid(*[np.linspace(-1, 1, 9)] * d, indexing="ij"), axis=-1).reshape(-1, d)
    s, worst = weights(lattice, q), 0.0
    for offset in product(range(4), repeat=d):
        # by symmetry the sorted offsets stand for all
        if max(offset) >= 2 and list(offset) == sorted(offset):
            true = np.sqrt(((lattice[:, None] / 2 - lattice[None] / 2 - np.array(offset)) ** 2).sum(axis=2))
            worst = max(worst, float(np.abs(s @ between(q, offset) @ s.T - true).max()))
    return 2 * worst


def _blob(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a, dtype=np.float64).tobytes()


class _Cells:
    """The points' cells: leaves with their points, and the steps between levels."""

    def __init__(self, df: DataFrame, columns: Sequence[str], cluster: str, leaf_points: int):
        ensure_checkpoint_dir(df.sparkSession)
        ship_code(df.sparkSession)
        self.d = len(columns)
        x = [f"x{i}" for i in range(self.d)]
        points = df.select(*(F.col(c).cast("double").alias(v) for c, v in zip(columns, x, strict=True)),
                           F.col(cluster).cast("string").alias("c")).groupBy(*x, "c").agg(F.count(F.lit(1)).alias("n")).checkpoint()
        bad = F.col("c").isNull()
        for v in x:
            bad = bad | F.col(v).isNull() | F.isnan(v)
        row = points.agg(F.sum("n"), F.count_if(bad), F.count(F.lit(1)), *(F.min(v) for v in x), *(F.max(v) for v in x)).first()
        if row[1]:
            raise ValueError(f"{row[1]} distinct points have a null or NaN in {[*columns, cluster]}")
        self.n = int(row[0] or 0)
        sizes = sorted(points.groupBy("c").agg(F.sum("n")).limit(MAX_CLUSTERS + 1).collect())
        if not 2 <= len(sizes) < self.n or len(sizes) > MAX_CLUSTERS:
            raise ValueError(f"{len(sizes)} clusters in {self.n} rows: at least 2, at most {MAX_CLUSTERS} and fewer than the rows")
        self.sizes = np.array([s[1] for s in sizes], float)
        low, high = np.array(row[3:3 + self.d]), np.array(row[3 + self.d:])
        self.side = float((high - low).max()) * (1 + 1e-9)
        if not self.side:
            return
        self.place = [f"i{a}" for a in range(self.d)]
        unit = [(F.col(v) - F.lit(float(lo))) / F.lit(self.side) for v, lo in zip(x, low, strict=True)]
        self.snapped = row[2] > leaf_points
        if self.snapped:
            unit = [F.floor(u * F.lit(SNAP)).cast("double") / F.lit(SNAP) for u in unit]
        points = points.select(*(u.alias(v) for u, v in zip(unit, x, strict=True)), "n",
                               (F.array_position(F.lit([s[0] for s in sizes]), F.col("c")) - 1).cast("int").alias("c"))
        number = row[2]
        if self.snapped:
            points = points.groupBy(*x, "c").agg(F.sum("n").alias("n")).checkpoint()
            number = points.count()
        self.level = max(0, math.ceil(math.log2(max(1.0, number / leaf_points)) / self.d))
        while True:
            placed = points.select("*", *(F.floor(F.col(v) * F.lit(float(2 ** self.level))).cast("long").alias(i)
                                          for v, i in zip(x, self.place, strict=True)))
            sizes_of = placed.groupBy(*self.place).agg(F.count(F.lit(1)).alias("size"))
            # the distances to be taken one by one go by this sum
            together = sizes_of.agg(F.sum(F.col("size").cast("double") * F.col("size"))).first()[0]
            if together <= leaf_points * number or self.level >= MAX_LEVEL:
                break
            self.level += 1
        # leaves that are fuller are dealt out over chunks, which all meet
        packed = F.collect_list(F.struct(*(F.col(v).alias(v) for v in x), F.col("c").cast("double").alias("c"), F.col("n").cast("double").alias("n")))
        chunk = F.pmod(F.xxhash64(*x), F.ceil(F.col("size") / F.lit(leaf_points)))
        place, width = self.place, self.d + 2

        def pack(frames):
            for frame in frames:
                yield frame[[*place, "chunk"]].assign(points=[_blob(np.stack(p).reshape(-1, width)) for p in frame["points"]])

        self.leaves = placed.join(sizes_of, place).groupBy(*place, chunk.alias("chunk")) \
            .agg(F.transform(packed, lambda p: F.array(*(p[v] for v in [*x, "c", "n"]))).alias("points")) \
            .mapInPandas(pack, self._schema("chunk long", "points binary")).checkpoint()

    def _schema(self, *more: str) -> str:
        return ", ".join([*(f"{i} long" for i in self.place), *more])

    def upward(self, q: int) -> dict[int, DataFrame]:
        """The weights of the cells of levels 2 and finer."""
        place, d, k, level = self.place, self.d, len(self.sizes), self.level

        def start(frames):
            for frame in frames:
                out = []
                for points, *at in zip(frame["points"], *(frame[i] for i in place), strict=True):
                    p = np.frombuffer(points).reshape(-1, d + 2)
                    own = np.zeros((len(p), k))
                    own[np.arange(len(p)), p[:, d].astype(int)] = p[:, d + 1]
                    out.append(_blob(weights(2 * (p[:, :d] * 2.0 ** level - np.array(at)) - 1, q).T @ own))
                yield frame[place].assign(w=out)

        def join(key, frame):
            total = np.zeros((q ** d, k))
            for w, *bits in zip(frame["w"], *(frame[f"b{a}"] for a in range(d)), strict=True):
                child = np.frombuffer(w).reshape(-1, k)
                total += child if bits[0] < 0 else from_parent(q, tuple(int(b) for b in bits)).T @ child
            return pd.DataFrame([[*key, _blob(total)]], columns=[*place, "w"])

        schema = self._schema("w binary")
        cells = self.leaves.mapInPandas(start, schema)
        # chunks of one leaf add up as they are
        cells = cells.select("*", *(F.lit(-1).alias(f"b{a}") for a in range(d)))
        out = {}
        for at in range(level, 1, -1):
            if at < level:
                cells = out[at + 1].select(*(F.floor(F.col(i) / 2).alias(i) for i in place), "w",
                                           *(F.pmod(F.col(i), F.lit(2)).alias(f"b{a}") for a, i in enumerate(place)))
            out[at] = cells.groupBy(*place).applyInPandas(join, schema).checkpoint()
        return out

    def downward(self, q: int) -> DataFrame | None:
        """The leaves' sums of distances, at the nodes, to all points outside the leaves that they touch."""
        place, d, k = self.place, self.d, len(self.sizes)
        around = F.explode(F.lit([list(o) for o in product((-1, 0, 1), repeat=d)]))
        parent = [f"p{a}" for a in range(d)]
        schema = self._schema("near binary")
        local = None
        for at, cells in sorted(self.upward(q).items()):
            side = self.side / 2 ** at

            def gather(key, frame):
                """The sums of a cell's children: from the children of the cells around it, and what it hands down."""
                known = frame[place[0]].notna()
                met = frame[known]
                cell, w = met[place].to_numpy(np.int64), [np.frombuffer(b).reshape(-1, k) for b in met["w"]]
                far = [np.frombuffer(b).reshape(-1, k) for b in frame["w"][~known]]
                out = []
                for own in cell[(cell // 2 == np.array(key)).all(axis=1)]:
                    total = np.zeros((q ** d, k))
                    for source, weight in zip(cell - own, w, strict=True):
                        if np.abs(source).max() > 1:
                            total += between(q, tuple(source.tolist())) @ weight
                    total *= side
                    for f in far:
                        total += from_parent(q, tuple((own % 2).tolist())) @ f
                    out.append([*own.tolist(), _blob(total)])
                return pd.DataFrame(out, columns=[*place, "near"])

            sent = cells.select(*place, "w", around.alias("o")).select(
                *((F.floor(F.col(i) / 2) + F.col("o")[a]).alias(v) for a, (i, v) in enumerate(zip(place, parent, strict=True))), *place, "w")
            if local is not None:
                sent = sent.unionByName(local.select(*(F.col(i).alias(v) for i, v in zip(place, parent, strict=True)),
                                                     *(F.lit(None).cast("long").alias(i) for i in place), F.col("near").alias("w")))
            local = sent.groupBy(*parent).applyInPandas(gather, schema).checkpoint()
        return local

    def mean(self, q: int) -> tuple[float, float]:
        """The mean silhouette and a bound on its error."""
        place, d, sizes, level, side, n = self.place, self.d, self.sizes, self.level, self.side, self.n
        local = self.downward(q)
        own = self.leaves.withColumn("far", F.lit(None).cast("binary")) if local is None else \
            self.leaves.join(local.withColumnRenamed("near", "far"), place)
        # cells that don't touch are at most a quarter of the cube wide
        error = worst_error(q, d) * side / 4 if local is not None else 0.0
        if self.snapped:
            error += 2 * math.sqrt(d) / SNAP * side
        around = F.explode(F.lit([list(o) for o in product((-1, 0, 1), repeat=d)]))
        sent = self.leaves.select(*place, "points", around.alias("o")).select(
            *((F.col(i) + F.col("o")[a]).alias(i) for a, i in enumerate(place)), F.col("points").alias("met"))

        def finish(key, frame, sources):
            out = [_chunk(np.array(key), *row, sources["met"]) for row in zip(frame["points"], frame["far"], strict=True)]
            return pd.DataFrame(out, columns=["s", "off"])

        def _chunk(at, points, far, met_points):
            p = np.frombuffer(points).reshape(-1, d + 2)
            total = np.zeros((len(p), len(sizes)))
            if far is not None:
                total += weights(2 * (p[:, :d] * 2.0 ** level - at) - 1, q) @ np.frombuffer(far).reshape(-1, len(sizes))
            for met in met_points:
                m = np.frombuffer(met).reshape(-1, d + 2)
                apart = np.sqrt(((p[:, None, :d] - m[None, :, :d]) ** 2).sum(axis=2)) * side
                share = np.zeros((len(m), len(sizes)))
                share[np.arange(len(m)), m[:, d].astype(int)] = m[:, d + 1]
                total += apart @ share
            c, rows = p[:, d].astype(int), np.arange(len(p))
            a = total[rows, c] / np.maximum(sizes[c] - 1, 1)
            others = total / sizes
            others[rows, c] = np.inf
            b = others.min(axis=1)
            top = np.maximum(a, b)
            alone = (sizes[c] == 1) | (top <= 0)
            value = np.where(alone, 0.0, (b - a) / np.where(alone, 1.0, top))
            # a mean over all but the point itself weighs each error by up to n / (n - 1)
            off = np.where(alone, 0.0, np.minimum(2.0, 4 * error / np.where(alone, 1.0, top)))
            return p[:, d + 1] @ value, p[:, d + 1] @ off

        found = own.groupBy(*place).cogroup(sent.groupBy(*place)).applyInPandas(finish, "s double, off double")
        row = found.agg(F.sum("s"), F.sum("off")).first()
        return float(row[0] / n), float(row[1] / n)


def euclidean_silhouette(df: DataFrame, columns: Sequence[str], cluster: str = "cluster", tol: float = TOL,
                         leaf_points: int = LEAF_POINTS) -> tuple[float, float]:
    """The mean silhouette and a bound on its error, at most ``tol``; one or two columns (nodes grow as q^d)."""
    if not 1 <= len(columns) <= 2:
        raise ValueError("cells are built on one or two columns")
    cells = _Cells(df, columns, cluster, leaf_points)
    if not cells.side:
        return 0.0, 0.0
    d, wanted = len(columns), tol / 10
    while True:
        q = next((q for q in NODES if worst_error(q, d) <= wanted), NODES[-1])
        value, bound = cells.mean(q)
        if bound <= tol:
            return value, bound
        if q == NODES[-1]:
            raise ValueError(f"the error is only bounded by {bound:.1e}")
        # the bound goes with the polynomials' error
        wanted = min(worst_error(q, d) * tol / bound, worst_error(NODES[NODES.index(q) + 1], d))
