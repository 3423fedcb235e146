"""Support-vector classification, one class against one, all folds and pairs of classes in shared passes.

The RBF kernel is taken through landmarks (Nystroem): ``n_landmarks`` vectors,
those with the least hashes among the distinct training vectors, and a map
whitened by their kernel matrix, in which inner products are the kernel's
wherever the landmarks span the data (exactly, if there are no more distinct
vectors than landmarks).  ``kernel="linear"`` takes the scaled columns.

In that space each pair of classes solves the soft-margin problem with an
unpenalised intercept by an interior-point method, whose passes hardly grow
with rows or costs.  The first pass is a Newton step on the hinge smoothed over
a width of 2.  From there a row has a dual variable inside its box and two
slacks; a pass sums, for every pair and fold that hasn't ended, the terms of
the Newton step on all optimality conditions, and the driver solves these
small systems and lowers the barrier.  Each row damps its own part of a step,
so no pass looks for a common length; a step after which the mean product of
variables and slacks is ``RISE`` times as large is shortened.  Nothing is
stored with a row: its variables follow from the points that its pair went
through.  A fit ends when its duality gap, from the same sums, is within
``tol`` of the objective.  Every training set has its own scaling, class
weights (n / (k n_c)) and kernel width (1 / (d var)).

Rows: a null or NaN feature stands at the training mean (0 once scaled), no
row goes; a row with a null label is scored but trains nothing; a null fold
raises.  Votes of the pairs decide, the first class on ties; a training set
with one class predicts it.  More classes than ``MAX_CLASSES`` raise: the
fits grow with their square.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapline.session import ship_code

MAX_CLASSES = 32
ROWS_PER_PART = 50_000
PARTS_PER_CORE = 2
SLICE = 4096             # rows whose kernel values are held at once
PASS_SUMS = 4_000_000    # numbers that a pass may sum
EIGEN_CUT = 1e-10        # of the landmarks' largest eigenvalue
BARRIER = 0.3            # product of a row's variable, as a share of its cost, and slack at the start
LOWER = 0.25             # a step aims at this share of the mean product, at more after steps that were shortened
HOLD = 0.6               # share of the allowed gap; the barrier stays once the products are within
KEEP = 0.1               # share of a row's variable or slack that a step leaves at least
RISE = 2.0
LEAST = 1e-100
WHOLE = -1               # the training set of all rows


@dataclass
class Space:
    """A training set's scaling and kernel map."""
    mean: np.ndarray
    scale: np.ndarray
    gamma: float
    landmarks: np.ndarray | None = None
    whiten: np.ndarray | None = None

    def scaled(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.scale
        return np.where(np.isnan(z), 0.0, z)

    def kernel(self, z: np.ndarray) -> np.ndarray:
        near = z @ (2 * self.gamma * self.landmarks.T)
        near -= self.gamma * (z ** 2).sum(axis=1)[:, None]
        near -= self.gamma * (self.landmarks ** 2).sum(axis=1)
        return np.exp(np.minimum(near, 0.0, out=near), out=near)

    def settle(self, landmarks: np.ndarray) -> None:
        self.landmarks = self.scaled(landmarks)
        values, axes = np.linalg.eigh(self.kernel(self.landmarks))
        kept = values > EIGEN_CUT * values[-1]
        self.whiten = axes[:, kept] / np.sqrt(values[kept])

    def plain(self, x: np.ndarray) -> np.ndarray:
        """Kernel values of rows (the scaled columns, if linear), with a last column of ones for the intercept."""
        z = self.scaled(x)
        return np.column_stack([z if self.whiten is None else self.kernel(z), np.ones(len(x))])

    @property
    def turn(self) -> np.ndarray:
        """The matrix that takes plain rows to the kernel's space."""
        if self.whiten is None:
            return np.eye(self.width)
        out = np.zeros((len(self.whiten) + 1, self.width))
        out[:-1, :-1], out[-1, -1] = self.whiten, 1.0
        return out

    @property
    def width(self) -> int:
        return 1 + (len(self.mean) if self.whiten is None else self.whiten.shape[1])


@dataclass
class Inside:
    """Variables of rows: dual ones as shares of the costs, what is left to 1, slacks of the margin and of the loss."""
    share: np.ndarray
    left: np.ndarray
    short: np.ndarray   # loss - r, the slack of ``share``
    loss: np.ndarray    # the slack of ``left``
    r: np.ndarray       # 1 - sign * margin

    @classmethod
    def central(cls, r: np.ndarray, barrier: float) -> Inside:
        """The variables whose products with their slacks all are ``barrier``."""
        q = np.sqrt(r ** 2 + 4 * barrier ** 2)
        short, loss = (2 * barrier - r + q) / 2, (2 * barrier + r + q) / 2
        short, loss = np.maximum(short, LEAST), np.maximum(loss, LEAST)
        return cls(np.minimum(barrier / short, 1.0), np.minimum(barrier / loss, 1.0), short, loss, r)

    @property
    def bend(self) -> np.ndarray:
        """Growth of a row's share with r."""
        return 1 / (self.loss / self.left + self.short / self.share)

    @property
    def pull(self) -> np.ndarray:
        """1 / share - 1 / left: the barrier's pull towards the middle."""
        return 1 / self.share - 1 / self.left

    def moved(self, r: np.ndarray, barrier: float, length: float) -> Inside:
        """After ``length`` of the Newton step that led to ``r``; a row that would leave its limits stops before."""
        step = self.bend * (r - self.r + length * (self.r + barrier * self.pull))
        loss = self.loss + length * (barrier / self.left - self.loss) + self.loss / self.left * step
        short = self.short + length * (barrier / self.share - self.short) - self.short / self.share * step
        loss, short = np.maximum(loss, KEEP * self.loss), np.maximum(short, KEEP * self.short)
        lift = r - (loss - short)
        step = np.clip(step, (KEEP - 1) * self.share, (1 - KEEP) * self.left)
        return Inside(*(np.maximum(v, LEAST) for v in (np.minimum(self.share + step, 1.0), np.minimum(self.left - step, 1.0),
                                                       short + np.maximum(-lift, 0), loss + np.maximum(lift, 0))), r)


@dataclass
class PairFit:
    """Class ``first`` (positive) against ``second`` on the rows outside ``fold``."""
    fold: int
    first: int
    second: int
    costs: tuple[float, float]
    total_cost: float
    w: np.ndarray
    h: float = 2.0
    path: tuple = ()            # (point, barrier, length) of the start and of every step, the last one on trial
    base: tuple | None = None   # (path, point, mean product, step, barrier, length) of a step on trial
    best: tuple = (math.inf, None)
    lower: float = LOWER
    gap: float = math.inf
    primal: float = math.inf
    n_iter: int = 0
    ended: bool = False
    converged: bool = False

    @property
    def size(self) -> int:
        p = len(self.w)
        return 3 + p + p * (p + 1) // 2 + (1 + 2 * p if self.path else 0)

    def signed(self, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """1 or -1 for each row of the pair, else 0, and costs."""
        sign = np.where(y == self.first, 1.0, np.where(y == self.second, -1.0, 0.0))
        return sign, np.where(sign > 0, self.costs[0], np.where(sign < 0, self.costs[1], 0.0))

    def sums(self, plain: np.ndarray, turn: np.ndarray, margin: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Of the smoothed hinge: hinge losses, smoothed losses, dual variables, their weighted rows, curvature.

        ``margin``: of all ``plain`` rows.  Points and sums are turned, not
        the rows; only those that bend are mapped one by one.
        """
        sign, cost = self.signed(y)
        r = 1 - sign * margin
        alpha = cost * np.clip(r / self.h, 0, 1)
        smooth = np.where(r >= self.h, r - self.h / 2, np.maximum(r, 0) ** 2 / (2 * self.h))
        bent = np.flatnonzero((r > 0) & (r < self.h) & (sign != 0))
        rows = plain[bent] @ turn
        rows *= np.sqrt(cost[bent] / self.h)[:, None]
        curve = rows.T @ rows
        return np.concatenate([[cost @ np.maximum(r, 0), cost @ smooth, alpha.sum()], ((alpha * sign) @ plain) @ turn,
                               curve[np.triu_indices(len(self.w))]])

    def inside(self, rows: np.ndarray, sign: np.ndarray) -> Inside:
        """The variables of mapped rows, followed along the path."""
        margins = rows @ np.column_stack([w for w, _, _ in self.path])
        (_, barrier, _), *steps = self.path
        now = Inside.central(1 - sign * margins[:, 0], barrier)
        for (_, barrier, length), margin in zip(steps, margins.T[1:], strict=True):
            now = now.moved(1 - sign * margin, barrier, length)
        return now

    def inner_sums(self, mapped: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Hinge losses, products of dual variables and slacks, dual variables and their weighted rows,
        products over what a row may lose, the step's two right sides (without and by the barrier), curvature."""
        sign, cost = self.signed(y)
        at = np.flatnonzero(sign)
        rows, sign, cost = mapped[at], sign[at], cost[at]
        now = self.inside(rows, sign)
        bend = cost * now.bend
        right = np.column_stack([cost * now.share, bend * now.r, bend * now.pull]) * sign[:, None]
        sides = right.T @ rows
        rows *= np.sqrt(bend)[:, None]
        curve = rows.T @ rows
        return np.concatenate([
            [cost @ np.maximum(now.r, 0), cost @ (now.share * now.short + now.left * now.loss), cost @ now.share],
            sides[0], curve[np.triu_indices(len(self.w))],
            [cost @ (np.maximum(now.r, 0) - now.share * now.r)], sides[1], sides[2]])

    def advance(self, row: np.ndarray, tol: float, max_iter: int) -> None:
        p = len(self.w)
        start = 3 + p + p * (p + 1) // 2
        hinge, products, duals = row[:3]
        pull, flat = row[3:3 + p], row[3 + p:start]
        half = 0.5 * self.w[:-1] @ self.w[:-1]
        self.n_iter += 1
        self.primal = half + hinge
        # the intercept is free, so the dual variables of both classes must balance
        self.gap = self.primal - (duals - 0.5 * pull[:-1] @ pull[:-1]) + abs(pull[-1] * self.w[-1])
        self.converged = bool(self.gap <= tol * self.primal and abs(pull[-1]) <= tol * max(duals, 1e-300))
        if self.primal < self.best[0]:
            self.best = self.primal, self.w
        self.ended = self.converged or self.n_iter >= max_iter
        if self.ended:
            if not self.converged:
                self.primal, self.w = self.best
            return
        mean = products / (2 * self.total_cost)
        if self.base is not None:
            path, point, before, step, barrier, length = self.base
            if mean > RISE * before and length > 1e-3:
                self.lower = min(0.9, 2 * self.lower)
                self._go(path, point, before, step, barrier, 0.25 * length)
                return
        hessian = np.zeros((p, p))
        a, b = np.triu_indices(p)
        hessian[a, b] = hessian[b, a] = flat
        bend = hessian[-1, -1]
        hessian[np.diag_indices(p - 1)] += 1.0
        hessian[-1, -1] += 1e-9 * bend if bend > 0 else self.total_cost
        downhill = pull - np.append(self.w[:-1], 0.0)
        if not self.path:
            self.w = self.w + np.linalg.solve(hessian, downhill)
            self.path = ((self.w, BARRIER, 1.0),)
            return
        between, (off, push) = row[start], row[start + 1:].reshape(2, p)
        barrier = mean * (1.0 if between <= HOLD * tol * self.primal else self.lower)
        self.lower = max(LOWER, 0.7 * self.lower)
        self._go(self.path, self.w, mean, np.linalg.solve(hessian, downhill + off + barrier * push), barrier, 1.0)

    def _go(self, path, point, before, step, barrier, length) -> None:
        self.base = path, point, before, step, barrier, length
        self.w = point + length * step
        self.path = (*path, (self.w, barrier, length))


@dataclass
class SvmModel:
    features: list[str]
    classes: list[str]
    label_type: T.DataType
    spaces: dict[int, Space]
    fits: list[PairFit]
    present: dict[int, list[int]]   # classes of each training set

    def votes(self, fold: int, x: np.ndarray) -> np.ndarray:
        """The class number of each row, by the fits of one training set."""
        found = np.zeros((len(x), len(self.classes)), np.int64)
        own = [f for f in self.fits if f.fold == fold]
        if not own:
            return np.full(len(x), self.present[fold][0])
        points = self.spaces[fold].turn @ np.column_stack([f.w for f in own])
        for lo in range(0, len(x), SLICE):
            margins = self.spaces[fold].plain(x[lo:lo + SLICE]) @ points
            for f, margin in zip(own, margins.T, strict=True):
                won = np.where(margin > 0, f.first, f.second)
                np.add.at(found, (np.arange(lo, lo + len(won)), won), 1)
        return found.argmax(axis=1)

    def transform(self, df: DataFrame, fold: str | None = None, name: str = "prediction") -> DataFrame:
        """Append ``name``; with ``fold``, each row by the fits that left its fold out.  No exchange."""
        columns, features, classes = [c for c in df.columns if c != name], self.features, pa.array(self.classes, pa.string())
        ship_code(df.sparkSession)

        def run(batches):
            for batch in batches:
                column = {c: batch.column(batch.schema.get_field_index(c)) for c in batch.schema.names}
                x = _matrix([column[c] for c in features], batch.num_rows)
                folds = column[fold].to_numpy(zero_copy_only=False) if fold else np.full(batch.num_rows, WHOLE)
                won = np.zeros(batch.num_rows, np.int64)
                for f in np.unique(folds):
                    won[folds == f] = self.votes(int(f), x[folds == f])
                yield pa.RecordBatch.from_arrays([*(column[c] for c in columns), classes.take(pa.array(won))], names=[*columns, name])

        schema = T.StructType([*df.select(*columns).schema.fields, T.StructField(name, T.StringType())])
        return df.mapInArrow(run, schema).withColumn(name, F.col(name).cast(self.label_type))


def _matrix(columns, n: int) -> np.ndarray:
    """Columns of a batch side by side, nulls as NaN."""
    return np.column_stack([pc.fill_null(pc.cast(c, pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
                            for c in columns]).reshape(n, len(columns))


def fit_svms(df: DataFrame, features: Sequence[str], label: str = "label", fold: str | None = None, kernel: str = "rbf",
             C: float = 1.0, balanced: bool = True, n_landmarks: int = 200, tol: float = 1e-3, max_iter: int = 300) -> SvmModel:
    """The pairs of all classes: on all rows, or, with ``fold``, on the rows outside each fold."""
    if kernel not in ("rbf", "linear"):
        raise ValueError(f"kernel {kernel!r}: rbf or linear")
    ship_code(df.sparkSession)
    found = df.where(F.col(label).isNotNull()).select(F.col(label).cast("string")).distinct().limit(MAX_CLASSES + 1).collect()
    classes = sorted(r[0] for r in found)
    if not classes or len(classes) > MAX_CLASSES:
        raise ValueError(f"{len(classes)} classes, 1 to {MAX_CLASSES} can be fitted")
    values = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in features]
    names = [f"x{i}" for i in range(len(features))]
    # every distinct vector has one hash, the same in all layouts
    data = df.select(F.col(fold).cast("int").alias("fold") if fold else F.lit(WHOLE - 1).alias("fold"),
                     F.coalesce(F.array_position(F.lit(classes), F.col(label).cast("string")) - 1, F.lit(-1)).cast("int").alias("y"),
                     *(v.alias(n) for v, n in zip(values, names, strict=True)), F.xxhash64(*values).alias("h")) \
        .persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _fit(data, list(features), names, classes, df.schema[label].dataType, bool(fold), kernel, C, balanced, n_landmarks, tol, max_iter)
    finally:
        data.unpersist()


def _fit(data, features, names, classes, label_type, folded, kernel, C, balanced, n_landmarks, tol, max_iter):
    d = len(names)
    stats = data.groupBy("fold", "y").agg(
        F.count(F.lit(1)).alias("n"), F.approx_count_distinct("h").alias("distinct"), *(F.count(x) for x in names),
        *(F.coalesce(F.avg(x), F.lit(0.0)) for x in names), *(F.coalesce(F.var_pop(x), F.lit(0.0)) for x in names)).collect()
    if any(r["fold"] is None for r in stats):
        raise ValueError("a row has no fold")
    folds = sorted({r["fold"] for r in stats}) if folded else [WHOLE]
    spaces, present, fits = {}, {}, []
    weights = {}
    for f in folds:
        rows = [r for r in stats if r["fold"] != f and r["y"] >= 0]
        if not rows:
            raise ValueError(f"no labelled rows outside fold {f}")
        counts = np.bincount([r["y"] for r in rows], [r["n"] for r in rows], len(classes))
        present[f] = [int(c) for c in np.flatnonzero(counts)]
        n, mean, var = (np.array([r[4 + k * d:4 + (k + 1) * d] for r in rows], float) for k in range(3))
        seen = np.maximum(n.sum(axis=0), 1)
        centre = (n * mean).sum(axis=0) / seen
        spread = (n * (var + (mean - centre) ** 2)).sum(axis=0) / seen
        scale = np.where(spread > 0, np.sqrt(spread), 1.0)
        # missing values stand at 0 of the scaled columns and count in their variance
        total = (np.where(spread > 0, n.sum(axis=0), 0.0) / counts.sum()).mean()
        spaces[f] = Space(centre, scale, 1.0 / (d * total) if total > 0 else 1.0)
        weights[f] = counts.sum() / (len(present[f]) * np.maximum(counts, 1)) if balanced else np.ones(len(classes))
        weights[f] = C * weights[f]
    if kernel == "rbf":
        for f, points in _landmarks(data, stats, folds, names, n_landmarks).items():
            spaces[f].settle(points)
    for f in folds:
        counts = np.bincount([r["y"] for r in stats if r["fold"] != f and r["y"] >= 0],
                             [r["n"] for r in stats if r["fold"] != f and r["y"] >= 0], len(classes))
        for a, b in combinations(present[f], 2):
            ca, cb = float(weights[f][a]), float(weights[f][b])
            fits.append(PairFit(f, a, b, (ca, cb), float(ca * counts[a] + cb * counts[b]), np.zeros(spaces[f].width)))
    # a task emits all sums, however many rows it has: few rows need few tasks, many no more than keep the cores busy
    most = PARTS_PER_CORE * data.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(most, math.ceil(sum(r["n"] for r in stats) / ROWS_PER_PART)))
    blocks = data.where("y >= 0").drop("h").coalesce(parts)
    while live := [f for f in fits if not f.ended]:
        for group in _passes(live):
            _measure(blocks, spaces, group, parts, tol, max_iter)
    return SvmModel(features, classes, label_type, spaces, fits, present)


def _passes(live: list[PairFit]):
    """The fits in groups of at most ``PASS_SUMS`` numbers, one at least."""
    group, size = [], 0
    for f in live:
        if group and size + f.size > PASS_SUMS:
            yield group
            group, size = [], 0
        group.append(f)
        size += f.size
    yield group


def _landmarks(data, stats, folds, names, m) -> dict[int, np.ndarray]:
    """For every training set its ``m`` distinct vectors of least hash.

    Hashes are uniform: a bound that about ``4 m`` vectors of each fold's
    largest class pass is raised until every set has its number, or until
    all rows pass.
    """
    largest: dict[int, int] = {}
    for r in stats:
        largest[r["fold"]] = max(largest.get(r["fold"], 1), r["distinct"] if r["y"] >= 0 else 1)
    share = min(1.0, 4.0 * m / min(largest.values())) if len(largest) else 1.0
    share = min(share, max(4.0 * m / max(largest.values()), 1e-18))
    while True:
        near = data.where("y >= 0")
        if share < 1:
            near = near.where(F.col("h") <= F.lit(int(-2 ** 63 + share * 2 ** 64)))
        rows = near.select("fold", "h", *names).distinct().collect()
        out, short = {}, False
        for f in folds:
            own = {r["h"]: [float("nan") if v is None else v for v in r[2:]] for r in rows if r["fold"] != f}
            short |= len(own) < m
            out[f] = np.array([own[h] for h in sorted(own)[:m]], float).reshape(-1, len(names))
        if share >= 1 or not short:
            return out
        share *= 8


def _measure(blocks, spaces, fits, parts, tol, max_iter) -> None:
    sizes = [f.size for f in fits]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    # only what a task needs: points, widths and paths, not what judges a step
    bare = [PairFit(f.fold, f.first, f.second, f.costs, f.total_cost, f.w, f.h, f.path) for f in fits]
    used = [(f, spaces[f], [k for k, x in enumerate(bare) if x.fold == f]) for f in sorted({x.fold for x in fits})]

    def run(batches):
        total = np.zeros(starts[-1])
        turns = [space.turn for _, space, _ in used]
        for batch in batches:
            fold, y = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            x = _matrix(batch.columns[2:], batch.num_rows)
            for (f, space, own), turn in zip(used, turns, strict=True):
                at = np.flatnonzero(fold != f)
                for lo in range(0, len(at), SLICE):
                    rows = at[lo:lo + SLICE]
                    plain = space.plain(x[rows])
                    inner = plain @ turn if any(bare[k].path for k in own) else None
                    for k in own:
                        g = bare[k]
                        total[starts[k]:starts[k + 1]] += g.inner_sums(inner, y[rows]) if g.path else \
                            g.sums(plain, turn, plain @ (turn @ g.w), y[rows])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["place", "v"])

    found = blocks.mapInArrow(run, "place long, v double")
    if parts > 1:
        found = found.groupBy("place").agg(F.sum("v").alias("v"))
    table = found.toArrow()
    flat = np.zeros(starts[-1])
    np.add.at(flat, table.column("place").to_numpy(), table.column("v").to_numpy())
    for k, f in enumerate(fits):
        f.advance(flat[starts[k]:starts[k + 1]], tol, max_iter)
