"""Fits of many models in shared passes over counted cells.

A *fit* is a model for one held-out fold (and, for stacking, one held-out
inner fold) with its own features and parameters.  All fits of a call
advance together: a pass sums, for every (fit, tree, node, feature code) at once,
two statistics of the cells, and the splits are taken from these
sums, whose number depends on trees, nodes and codes but not on rows.

* trees and forests: weighted Gini; a task takes a share of the trees over a
  part of the cells, those that differ in no feature of a fit as one, and
  only splits reach the driver.  The sums are whole numbers, class weights
  come in afterwards, so results don't depend on partitions;
* boosting: Newton steps on gradient and hessian sums, leaf ``-eta G / (H + lambda)``;
* logistic regression: Newton's method on the gradient and the bordered-diagonal
  hessian (numeric columns dense, the one-hot diagonal), ended by the gradient's norm.

A forest's bootstrap draws, for each cell and tree, the number of drawn rows
from hashes of both: the sum of its rows' Poisson(1) draws.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapline.models.cells import Block, Cells, shared_cut, summed, unpack, with_scores

#: Sums that one pass may bring to the driver.
PASS_SUMS = 4_000_000
#: Entries of a worker's arrays of (tree, cell).
WORK = 2_000_000
#: Cells that a task of classification trees holds, and sums that it makes at once.
TASK_CELLS, TASK_SUMS = 1_000_000, 250_000
#: Rounds of boosting between two rewrites of the margins, fewer if walking them anew exceeds so many (model, cell) pairs of a block.
REFRESH, REWALK = 16, 1_000_000
ETA, LEAF_L2, MIN_HESSIAN, MIN_GAIN = 0.3, 1.0, 1.0, 1e-6
GRADIENT_END, NEWTON_STEPS = 1e-9, 60


@dataclass(frozen=True)
class Fit:
    """One model: ``features`` are positions of numeric columns, then that of the level column."""
    kind: str
    features: tuple[int, ...]
    outer: int | None = None
    inner: int | None = None
    n_trees: int = 1
    depth: int = 4
    balanced: bool = True
    pos_weight: float = 1.0
    C: float = 1.0
    scaled: tuple[int, ...] = ()

    def trains(self, fold, inner):
        """Which cells (or folds) the model learns from."""
        used = np.ones(np.shape(fold), bool)
        if self.outer is not None:
            used &= fold != self.outer
        if self.inner is not None:
            used &= inner != self.inner
        return used

    def class_weights(self, cells: Cells) -> tuple[float, float]:
        used = [n for (f, i), n in cells.counts.items() if self.trains(np.int64(f), np.int64(i))]
        n0, n1 = (sum(x[k] for x in used) for k in (0, 1))
        if self.kind == "boosting":
            return 1.0, self.pos_weight
        if not self.balanced:
            return 1.0, 1.0
        present = (n0 > 0) + (n1 > 0)
        return tuple((n0 + n1) / (present * n) if n else 0.0 for n in (n0, n1))


@dataclass
class Trees:
    """Trees as heaps: feature -1 is a leaf; a level goes right if it equals ``cut``, a number's code if it is above."""
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    boosted: bool
    gain: np.ndarray | None = None

    def leaves(self, code: np.ndarray, level_feature: int) -> np.ndarray:
        """Value of each row's leaf in each tree."""
        return np.take_along_axis(self.value, _route(self.feature, self.cut, code, level_feature), axis=1)

    def probability(self, code: np.ndarray, level_feature: int) -> np.ndarray:
        out = np.zeros(len(code))
        step = max(1, WORK // max(1, len(code)))
        for at in range(0, len(self.feature), step):
            part = Trees(self.feature[at:at + step], self.cut[at:at + step], self.value[at:at + step], self.boosted)
            out += part.leaves(code, level_feature).sum(axis=0)
        return _sigmoid(out) if self.boosted else out / max(1, len(self.feature))


@dataclass
class Logistic:
    mean: np.ndarray
    scale: np.ndarray
    numeric: np.ndarray
    level: np.ndarray  # an entry for each level and 0 for null
    intercept: float
    gradient: float = 0.0
    steps: int = 0

    def probability(self, x: np.ndarray, level: np.ndarray) -> np.ndarray:
        z = (np.nan_to_num(x) - self.mean) / self.scale
        return _sigmoid(z @ self.numeric + self.level[level] + self.intercept)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _route(feature, cut, code, level_feature: int) -> np.ndarray:
    """The leaf of each (tree, row)."""
    n, nodes = len(code), feature.shape[1]
    by_feature, row = np.ascontiguousarray(code.T).ravel(), np.arange(n)
    flat_feature, flat_cut = feature.ravel(), cut.ravel()
    first = np.arange(len(feature))[:, None] * nodes
    node = np.zeros((len(feature), n), np.int64)
    while True:
        f = flat_feature.take(first + node)
        if (f < 0).all():
            return node
        x, c = by_feature.take(np.maximum(f, 0) * n + row), flat_cut.take(first + node)
        right = np.where(f == level_feature, x == c, x > c)
        node = np.where(f < 0, node, 2 * node + 1 + right)


# -- bootstrap ---------------------------------------------------------------

def _mixed(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


def bootstrap_counts(hashes: np.ndarray, n: np.ndarray, tree: int, label: int) -> np.ndarray:
    """How often a cell's ``n`` rows are drawn for a tree, Poisson with mean n.

    Up to 64 rows by the inverse distribution function; beyond, a
    normal draw of the same mean and variance, rounded.
    """
    with np.errstate(over="ignore"):
        h = _mixed(hashes.view(np.uint64) ^ _mixed(np.full(1, 2 * tree + label, np.uint64)))
        other = _mixed(h)
    u, out = _uniform(h), np.zeros(len(n), np.int64)
    few = (n > 0) & (n <= 64)
    if few.any():
        mean, left = n[few].astype(float), u[few].copy()
        p, k = np.exp(-mean), np.zeros(few.sum(), np.int64)
        going = left >= p
        step = 0
        while going.any() and step < 400:
            step += 1
            left = np.where(going, left - p, left)
            p = p * mean / step
            k = np.where(going, step, k)
            going &= left >= p
        out[few] = k
    many = n > 64
    if many.any():
        normal = np.sqrt(-2 * np.log(u[many])) * np.cos(2 * np.pi * _uniform(other[many]))
        out[many] = np.maximum(0, np.rint(n[many] + np.sqrt(n[many]) * normal)).astype(np.int64)
    return out


# -- growing a level of many trees -------------------------------------------

@dataclass
class _Growing:
    """Trees that grow together, one for each entry: the fit's place, the tree's number, heaps."""
    fit: np.ndarray
    number: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    gain: np.ndarray


def _start(places: Sequence[int], numbers: Sequence[int], depth: int) -> _Growing:
    shape = len(places), (1 << (depth + 1)) - 1
    return _Growing(np.array(places), np.array(numbers), np.full(shape, -1, np.int32), np.zeros(shape, np.int32),
                    np.zeros(shape), np.zeros(shape))


def _level_sums(cells: Cells, fits: Sequence[Fit], grown: _Growing, level: int, stats) -> np.ndarray:
    """(tree, node of the level, slot, 2): the statistics of every code, from as many passes as ``PASS_SUMS`` asks for."""
    slots, nodes = cells.slots, 1 << level
    starts = np.concatenate([[0], np.cumsum(slots)])
    each = nodes * int(starts[-1])
    out = np.zeros((len(grown.fit), nodes, int(starts[-1]), 2))
    step = max(1, PASS_SUMS // each)
    level_feature = len(slots) - 1
    for at in range(0, len(grown.fit), step):
        own = slice(at, at + step)
        fit, number, feature, cut = grown.fit[own], grown.number[own], grown.feature[own], grown.cut[own]

        def work(block: Block):
            total = np.zeros((len(fit) * each, 2))
            few = max(1, WORK // max(1, len(block)))
            columns = [np.ascontiguousarray(c) for c in block.code.T]
            for a in range(0, len(fit), few):
                part = slice(a, a + few)
                values = stats(block, fit[part], number[part])
                # pairs (tree, cell) that have any weight are walked down together, as one list
                t, i = np.nonzero((values != 0).any(axis=2))
                v = values[t, i]
                node = np.zeros(len(t), np.int64)
                trees = feature[part].shape[1]
                flat_feature, flat_cut = feature[part].ravel(), cut[part].ravel()
                for _ in range(level):
                    at_node = t * trees + node
                    f = flat_feature[at_node]
                    live = f >= 0
                    if not live.all():
                        t, i, v, node, f, at_node = t[live], i[live], v[live], node[live], f[live], at_node[live]
                    c, right = flat_cut[at_node], np.zeros(len(t), bool)
                    for k, x in enumerate(columns):
                        own = np.flatnonzero(f == k)
                        if len(own):
                            x = x[i[own]]
                            right[own] = x == c[own] if k == level_feature else x > c[own]
                    node = 2 * node + 1 + right
                base = (t * nodes + node - (nodes - 1)) * int(starts[-1])
                own_total = total[a * each:(a + few) * each]
                for f, x in enumerate(columns):
                    key = base + (starts[f] + x[i])
                    for k in (0, 1):
                        own_total[:, k] += np.bincount(key, weights=v[:, k], minlength=len(own_total))
            place = np.flatnonzero(total.any(axis=1))
            return place, total[place]

        place, values = summed(cells, work, 2)
        out[own].reshape(-1, 2)[place] = values
    return out


def _sides(sums: np.ndarray, slots: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """Node totals, and the left side's statistics for a cut at every slot."""
    total = sums[:, :, :slots[0]].sum(axis=2)  # every row has one code of each feature
    left, at = np.zeros_like(sums), 0
    for k, n in enumerate(slots):
        own = sums[:, :, at:at + n]
        left[:, :, at:at + n] = total[:, :, None] - own if k == len(slots) - 1 else np.cumsum(own, axis=2)
        at += n
    return total, left


def _allowed(cells: Cells, features: Sequence[int]) -> np.ndarray:
    """Slots at which a fit may cut: not the last code of a number, not the null level."""
    out, at = np.zeros(sum(cells.slots), bool), 0
    for k, n in enumerate(cells.slots):
        if k in features:
            out[at:at + n - 1] = True
        at += n
    return out


def _best(gain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best slot of each node and its gain; ties, up to the tenth digit, go to the first slot."""
    with np.errstate(invalid="ignore"):
        top = gain.max(axis=2, keepdims=True)
        near = gain >= top - 1e-10 * np.maximum(1e-300, np.abs(top))
    slot = near.argmax(axis=2)
    return slot, np.take_along_axis(gain, slot[:, :, None], axis=2)[:, :, 0]


def _split(cells: Cells, grown: _Growing, level: int, slot, gain, taken, left_value, right_value) -> None:
    """Write the chosen splits and their children's values."""
    starts = np.concatenate([[0], np.cumsum(cells.slots)])
    t, k = np.nonzero(taken)
    node, own = (1 << level) - 1 + k, slot[t, k]
    f = np.searchsorted(starts, own, side="right") - 1
    grown.feature[t, node], grown.cut[t, node], grown.gain[t, node] = f, own - starts[f], gain[t, k]
    grown.value[t, 2 * node + 1], grown.value[t, 2 * node + 2] = left_value[t, k], right_value[t, k]


@lru_cache(64)
def _spans(slots: tuple[int, ...], features: tuple[int, ...]) -> list[tuple[int, int]]:
    """The slots of each feature of a fit; every level is a feature of its own, as in the one-hot."""
    spans, at = [], 0
    for k, n in enumerate(slots):
        if k in features:
            spans += [(at, at + n)] if k < len(slots) - 1 else [(at + j, at + j + 1) for j in range(n - 1)]
        at += n
    return spans


@lru_cache(1 << 16)
def _drawn_order(number: int, tree: int, node: int) -> list[int]:
    return np.random.default_rng([tree, node]).permutation(number).tolist()


def _chosen_features(cells: Cells, fit: Fit, present: np.ndarray, tree: int, node: int) -> np.ndarray:
    """A node's slots of a forest: of its features in a drawn order, the first sqrt(number) that aren't constant there."""
    slots = tuple(cells.slots)
    spans, level_start = _spans(slots, fit.features), sum(slots[:-1])
    rows = present[level_start:].sum()
    wanted = max(1, int(np.sqrt(len(spans))))
    out = np.zeros(len(present), bool)
    for j in _drawn_order(len(spans), tree, node):
        a, b = spans[j]
        varies = 0 < present[a] < rows if a >= level_start else np.count_nonzero(present[a:b]) > 1
        if varies:
            out[a:b] = True
            wanted -= 1
            if not wanted:
                break
    return out


def _gini_trees(cells: Cells, fits: Sequence[Fit]) -> dict[Fit, Trees]:
    """Classification trees and forests, all trees of all fits level by level, a pass for each."""
    out = {}
    for depth in sorted({f.depth for f in fits}):
        own = [f for f in fits if f.depth == depth]
        # trees of a number lie together: fits that hold out other folds share its draw
        places, numbers = zip(*((k, t) for t in range(max(f.n_trees for f in own)) for k, f in enumerate(own) if t < f.n_trees), strict=True)
        grown = _grow_gini(cells, own, places, numbers, depth)
        for k, f in enumerate(own):
            out[f] = Trees(*(getattr(grown, n)[grown.fit == k] for n in ("feature", "cut", "value")), False, grown.gain[grown.fit == k])
    return out


class _Merged:
    """All cells of a task, and those with equal codes as one for each set of features."""

    def __init__(self, blocks: Sequence[Block], slots: Sequence[int]):
        self.code = np.concatenate([b.code for b in blocks])
        self.fold, self.inner, self.hash, self.negatives, self.positives = (
            np.concatenate([getattr(b, n) for b in blocks]) for n in ("fold", "inner", "hash", "negatives", "positives"))
        self.slots, self.made, self.rows = slots, {}, {}

    def codes(self, features: Sequence[int]) -> tuple[list[int], np.ndarray, np.ndarray]:
        """The features, the distinct codes of these, and the place of each cell's among them.

        The first and the last feature are always there: totals are read from their sums."""
        key = tuple(sorted({0, *features, len(self.slots) - 1}))
        if key not in self.made:
            at = np.zeros(len(self.code), np.int64)
            for k in key:  # numbered anew at each feature, so that no product of slots overflows
                _, first, at = np.unique(at * self.slots[k] + self.code[:, k], return_index=True, return_inverse=True)
            self.made[key] = list(key), np.ascontiguousarray(self.code[first].T), at
        return self.made[key]

    def trained(self, fit: Fit) -> np.ndarray:
        key = fit.outer, fit.inner
        if key not in self.rows:
            self.rows[key] = fit.trains(self.fold, self.inner)
        return self.rows[key]

    def sums(self, fits: Sequence[Fit], grown: _Growing, own: slice, level: int) -> np.ndarray:
        """(tree, node of the level, slot, 2): how many negatives and positives have each code."""
        starts, nodes, last = np.concatenate([[0], np.cumsum(self.slots)]), 1 << level, len(self.slots) - 1
        width = int(starts[-1])
        out = np.zeros((len(grown.fit[own]), 2, nodes * width))
        tree, drawn = None, None
        for t, (k, number) in enumerate(zip(grown.fit[own].tolist(), grown.number[own].tolist(), strict=True)):
            if fits[k].kind != "forest":
                counts = self.negatives, self.positives
            else:
                if tree != number:  # fits that hold out other folds share the draw
                    tree, drawn = number, [bootstrap_counts(self.hash, n, number, label) for label, n in enumerate((self.negatives, self.positives))]
                counts = drawn
            features, code, at = self.codes(fits[k].features)
            rows = self.trained(fits[k])
            v = [np.bincount(at, weights=c * rows, minlength=code.shape[1]) for c in counts]
            i = np.flatnonzero((v[0] > 0) | (v[1] > 0))
            v, node = [x[i] for x in v], np.zeros(len(i), np.int64)
            feature, cut = grown.feature[own][t], grown.cut[own][t]
            for _ in range(level):
                f = feature[node]
                if not (f >= 0).all():
                    live = np.flatnonzero(f >= 0)
                    i, v, node, f = i[live], [x[live] for x in v], node[live], f[live]
                c, right = cut[node], np.zeros(len(i), bool)
                for j in np.unique(f).tolist():
                    here = np.flatnonzero(f == j)
                    x = code[j][i[here]]
                    right[here] = x == c[here] if j == last else x > c[here]
                node = 2 * node + 1 + right
            base = (node - (nodes - 1)) * width
            for j in features:
                key = base + (starts[j] + code[j][i])
                for side in (0, 1):
                    out[t, side] += np.bincount(key, weights=v[side], minlength=nodes * width)
        return np.moveaxis(out.reshape(-1, 2, nodes, width), 1, 3)


def _dealt(cells: Cells, trees: int) -> tuple[DataFrame, int, int]:
    """The cells in parts of at most ``TASK_CELLS``, each part once for every share of the trees; a partition for each of both."""
    parts = max(1, math.ceil(cells.number / TASK_CELLS))
    tasks = 2 * cells.blocks.sparkSession.sparkContext.defaultParallelism
    shares = min(trees, max(1, min(math.ceil(tasks / parts), math.ceil(trees * cells.number / WORK))))
    names = cells.blocks.columns
    wide = cells.blocks.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(parts))) \
        .select(*names, "part", F.explode(F.lit(list(range(shares)))).alias("share"))
    return shared_cut(wide.repartitionById(parts * shares, F.col("part") * F.lit(shares) + F.col("share"))), parts, shares


def _grow_gini(cells: Cells, fits: Sequence[Fit], places, numbers, depth: int) -> _Growing:
    """A task sums and splits the trees of its share over the cells of its part; with several parts the sums of a few trees meet first."""
    grown = _start(places, numbers, depth)
    bare, slots = cells.bare(), cells.slots
    weights = np.array([f.class_weights(cells) for f in fits])
    allowed = np.stack([_allowed(cells, f.features) for f in fits])
    bagged = np.array([f.kind == "forest" for f in fits])
    names, trees = cells.blocks.columns, len(grown.fit)
    dealt, parts, shares = _dealt(cells, trees)
    edges = [trees * i // shares for i in range(shares + 1)]
    open_ = np.ones((trees, 1), bool)
    for level in range(depth):
        few = max(1, TASK_SUMS // ((1 << level) * sum(slots)))
        # what tasks read of the trees so far
        so_far, still = _Growing(grown.fit, grown.number, grown.feature, grown.cut, None, None), open_

        def choose(first, sums, level=level, so_far=so_far, still=still):
            own = slice(first, first + len(sums))
            return _gini_splits(bare, fits, so_far.fit[own], so_far.number[own], level, sums, still[own], weights, allowed, bagged)

        def run(batches, level=level, so_far=so_far, few=few):
            blocks, share = [], None
            for batch in batches:
                if batch.num_rows:
                    share = batch.column(batch.schema.get_field_index("share"))[0].as_py()
                    blocks += list(unpack(batch.select(names)))
            if share is None:
                return
            merged = _Merged(blocks, slots)
            for a in range(edges[share], edges[share + 1], few):
                sums = merged.sums(fits, so_far, slice(a, min(a + few, edges[share + 1])), level)
                made = sums if parts > 1 else choose(a, sums)
                yield pa.RecordBatch.from_arrays([pa.array([a], pa.int32()), pa.array([made.tobytes()], pa.binary())], names=["first", "made"])

        def meet(key, table):
            a = key[0].as_py()
            sums = sum(np.frombuffer(x.as_buffer()) for x in table.column("made")).reshape(-1, 1 << level, sum(slots), 2)
            return pa.table({"first": pa.array([a], pa.int32()), "made": pa.array([choose(a, sums).tobytes()], pa.binary())})

        found = dealt.mapInArrow(run, "first int, made binary")
        if parts > 1:
            found = found.groupBy("first").applyInArrow(meet, "first int, made binary")
        made = np.zeros((6, trees, 1 << level))
        for first, blob in found.collect():
            own = np.frombuffer(blob).reshape(6, -1, 1 << level)
            made[:, first:first + own.shape[1]] = own
        slot, gain, taken, left, right, whole = made
        if level == 0:
            grown.value[:, 0] = whole[:, 0]
        _split(cells, grown, level, slot.astype(np.int64), gain, taken > 0, left, right)
        open_ = np.repeat(taken > 0, 2, axis=1)
    return grown


def _gini_splits(cells: Cells, fits: Sequence[Fit], fit, number, level: int, sums, open_, weights, allowed, bagged) -> np.ndarray:
    """(6, tree, node): slot and gain of the best cut, whether it is taken, the values of both sides and of the node."""
    weights = weights[fit]
    total, left = _sides(sums, cells.slots)
    right = total[:, :, None] - left

    def impurity(x):  # weight times Gini
        w = x * weights[:, None, None, :] if x.ndim == 4 else x * weights[:, None, :]
        both = w.sum(axis=-1)
        return 2 * w[..., 0] * w[..., 1] / np.where(both > 0, both, 1)

    gain = impurity(total)[:, :, None] - impurity(left) - impurity(right)
    usable = allowed[fit][:, None, :] & (left.sum(axis=3) > 0) & (right.sum(axis=3) > 0)
    if bagged[fit].any():
        present = sums.sum(axis=3)
        for t in np.flatnonzero(bagged[fit]):
            for k in np.flatnonzero(open_[t]):
                usable[t, k] &= _chosen_features(cells, fits[fit[t]], present[t, k], int(number[t]), (1 << level) - 1 + int(k))
    slot, best = _best(np.where(usable, gain, -np.inf))
    taken = open_ & (best > -np.inf) & (total > 0).all(axis=2)

    def share(x):
        w = x * weights[:, None, :]
        return w[..., 1] / np.where(w.sum(axis=-1) > 0, w.sum(axis=-1), 1)

    at = slot[:, :, None, None].repeat(2, axis=3)
    a, b = (np.take_along_axis(x, at, axis=2)[:, :, 0] for x in (left, right))
    return np.stack([slot, best, taken, share(a), share(b), share(total)]).astype(float)


# -- boosting ----------------------------------------------------------------

def _boosted_trees(cells: Cells, fits: Sequence[Fit]) -> dict[Fit, Trees]:
    """Newton boosting of all fits, a round of all together: a pass for each level of its trees.

    Margins are arrays beside the cells, rewritten every few rounds; workers add the trees since.
    """
    level_feature = len(cells.slots) - 1
    allowed = np.stack([_allowed(cells, f.features) for f in fits])
    deepest = max(f.depth for f in fits)
    made: list[list] = [[] for _ in fits]
    at = replace_margins(cells, None, [], level_feature, len(fits))
    pending: list[_Growing] = []
    per_block = cells.number / cells.parts
    for tree in range(max(f.n_trees for f in fits)):
        active = [k for k, f in enumerate(fits) if f.n_trees > tree]
        grown = _start(active, [tree] * len(active), deepest)
        since = list(pending)

        def stats(block, fit, number):
            margin = block.extra["margin"].reshape(-1, len(block))[fit]
            for past in since:
                margin = margin + _added(past, block.code, level_feature, len(fits))[fit]
            p = _sigmoid(margin)
            own = np.stack([fits[k].trains(block.fold, block.inner) for k in fit.tolist()])
            weight = np.array([fits[k].pos_weight for k in fit.tolist()])[:, None]
            n0, n1 = block.negatives * own, block.positives * own * weight
            return np.stack([n0 * p - n1 * (1 - p), (n0 + n1) * p * (1 - p)], axis=2)

        open_ = np.ones((len(active), 1), bool)
        for level in range(deepest):
            open_ &= np.array([fits[k].depth > level for k in active])[:, None]
            if not open_.any():
                break
            sums = _level_sums(at, fits, grown, level, stats)
            total, left = _sides(sums, cells.slots)
            right = total[:, :, None] - left

            def score(x):
                return x[..., 0] ** 2 / (x[..., 1] + LEAF_L2)

            gain = score(left) + score(right) - score(total)[:, :, None]
            usable = allowed[active][:, None, :] & (left[..., 1] >= MIN_HESSIAN) & (right[..., 1] >= MIN_HESSIAN)
            slot, best = _best(np.where(usable, gain, -np.inf))
            taken = open_ & (best > MIN_GAIN)

            def leaf(x):
                return -ETA * x[..., 0] / (x[..., 1] + LEAF_L2)

            if level == 0:
                grown.value[:, 0] = leaf(total)[:, 0]
            place = slot[:, :, None, None].repeat(2, axis=3)
            a, b = (np.take_along_axis(x, place, axis=2)[:, :, 0] for x in (left, right))
            _split(cells, grown, level, slot, best, taken, leaf(a), leaf(b))
            open_ = np.repeat(taken, 2, axis=1)
        for t, k in enumerate(active):
            made[k].append((grown.feature[t], grown.cut[t], grown.value[t], grown.gain[t]))
        pending.append(grown)
        if len(pending) == REFRESH or len(pending) * len(fits) * per_block > REWALK:
            at = replace_margins(cells, at, pending, level_feature, len(fits))
            pending = []
    return {f: Trees(*(np.stack([x[i] for x in made[k]]) for i in range(3)), True, np.stack([x[3] for x in made[k]]))
            for k, f in enumerate(fits)}


def _added(grown: _Growing, code: np.ndarray, level_feature: int, models: int) -> np.ndarray:
    """What a round adds to the margins: (model, cell)."""
    out = np.zeros((models, len(code)))
    out[grown.fit] = Trees(grown.feature, grown.cut, grown.value, True).leaves(code, level_feature)
    return out


def replace_margins(cells: Cells, at: Cells | None, rounds: Sequence[_Growing], level_feature: int, models: int) -> Cells:
    """The cells with the margins of all models after further rounds; without margins before, all are 0."""
    def run(batches):
        for batch in batches:
            margins = []
            for block in unpack(batch):
                margin = block.extra["margin"].reshape(models, -1).copy() if "margin" in block.extra else np.zeros((models, len(block)))
                for past in rounds:
                    margin += _added(past, block.code, level_feature, models)
                margins.append(margin.tobytes())
            kept = [i for i, n in enumerate(batch.schema.names) if n != "margin"]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), pa.array(margins, pa.binary())],
                                             names=[*(batch.schema.names[i] for i in kept), "margin"])

    source = (at or cells).blocks
    names = [*cells.blocks.columns, "margin"]
    made = source.mapInArrow(run, ", ".join(f"{n} binary" for n in names))
    return replace(cells, blocks=shared_cut(made))


# -- logistic regression -----------------------------------------------------

def _moments(cells: Cells, fits: Sequence[Fit]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Mean and population deviation of the scaled columns over each fit's training rows; others 0 and 1."""
    m = len(cells.numeric)

    def work(block):
        n = (block.negatives + block.positives).astype(float)
        rows = []
        for f in fits:
            w = n * f.trains(block.fold, block.inner)
            rows += [np.r_[w.sum(), w @ block.numeric, w @ (block.numeric ** 2)]]
        flat = np.concatenate(rows)
        return np.arange(len(flat)), flat[:, None]

    place, values = summed(cells, work, 1)
    flat = np.zeros(len(fits) * (1 + 2 * m))
    flat[place] = values[:, 0]
    out = []
    for f, row in zip(fits, flat.reshape(len(fits), -1), strict=True):
        n = max(row[0], 1.0)
        mean = row[1:1 + m] / n
        if np.isnan(mean[[k for k in f.features if k < m]]).any():
            raise ValueError("null features")
        deviation = np.sqrt(np.maximum(row[1 + m:] / n - mean ** 2, 0))
        use = np.isin(np.arange(m), f.scaled)
        out.append((np.where(use, mean, 0.0), np.where(use & (deviation > 0), deviation, 1.0)))
    return out


def _logistic_fits(cells: Cells, fits: Sequence[Fit], intercept: bool = False, design=None) -> dict[Fit, Logistic]:
    """L2-regularised logistic regression, ``C`` times the weighted loss plus half the squared coefficients.

    All fits take each Newton step from one pass.  A step that raised the
    objective is halved.  ``design(block, k)`` may give (numeric columns, row
    weights of negatives and positives) of the k-th fit instead of the cells' own.
    """
    m, t = (design.width if design else len(cells.numeric)), 0 if design else len(cells.levels)
    moments = [(np.zeros(m), np.ones(m))] * len(fits) if design else _moments(cells, fits)
    weights = [f.class_weights(cells) for f in fits]
    used = [np.ones(m, bool) if design else np.isin(np.arange(m), f.features) for f in fits]
    leveled = [not design and len(cells.numeric) in f.features for f in fits]
    size = 2 + m + t + (m + 1) * (m + 1) + (m + 1) * t + t  # objective, gradient, dense, border, diagonal

    def sums(betas):
        def work(block):
            rows = []
            for k, f in enumerate(fits):
                if design:
                    x, n0, n1 = design(block, k)
                else:
                    x = np.where(used[k], (block.numeric - moments[k][0]) / moments[k][1], 0.0)
                    own = f.trains(block.fold, block.inner)
                    n0, n1 = block.negatives * own * weights[k][0], block.positives * own * weights[k][1]
                x = np.c_[x, np.ones(len(x))]  # the last column is the intercept's
                b = betas[k]
                level = block.code[:, -1] if t else np.zeros(len(x), np.int64)
                z = x @ b[:m + 1] + (np.r_[b[m + 1:], 0.0][level] if t and leveled[k] else 0.0)
                p = _sigmoid(z)
                loss = n1 @ np.logaddexp(0, -z) + n0 @ np.logaddexp(0, z)
                g, h = n0 * p - n1 * (1 - p), (n0 + n1) * p * (1 - p)
                one = [np.bincount(level, weights=v, minlength=t + 1)[:t] for v in (g, h)] if t else [np.zeros(0)] * 2
                border = np.stack([np.bincount(level, weights=h * c, minlength=t + 1)[:t] for c in x.T]) if t else np.zeros((m + 1, 0))
                rows.append(np.concatenate([[loss], x.T @ g, one[0], ((x * h[:, None]).T @ x).ravel(), border.ravel(), one[1]]))
            flat = np.concatenate(rows)
            return np.arange(len(flat)), flat[:, None]

        place, values = summed(cells, work, 1)
        flat = np.zeros(len(fits) * size)
        flat[place] = values[:, 0]
        return flat.reshape(len(fits), size)

    betas = [np.zeros(m + 1 + t) for _ in fits]
    steps, last, ended = [np.zeros(m + 1 + t) for _ in fits], [np.inf] * len(fits), [False] * len(fits)
    norms, taken = [np.inf] * len(fits), [0] * len(fits)
    for _ in range(NEWTON_STEPS):
        if all(ended):
            break
        for k, (f, row) in enumerate(zip(fits, sums(betas), strict=True)):
            if ended[k]:
                continue
            b = betas[k]
            free = np.r_[used[k], intercept, np.full(t, leveled[k])]
            penal = np.r_[np.ones(m), 0.0, np.ones(t)]  # the intercept is not penalised
            value = f.C * row[0] + 0.5 * (penal * b) @ b
            if value > last[k] + 1e-9 * abs(last[k]):
                steps[k] = steps[k] / 2
                betas[k] = b - steps[k]
                continue
            last[k] = value
            gradient = (f.C * row[1:2 + m + t] + penal * b) * free
            norms[k] = float(np.abs(gradient).max())
            scale = f.C * sum(n0 * weights[k][0] + n1 * weights[k][1] for n0, n1 in cells.counts.values())
            # the step that these sums give is still taken: it costs no pass and about doubles the right digits
            ended[k] = norms[k] <= GRADIENT_END * max(1.0, scale)
            at = 2 + m + t
            dense = f.C * row[at:at + (m + 1) ** 2].reshape(m + 1, m + 1) + np.diag(penal[:m + 1])
            border = f.C * row[at + (m + 1) ** 2:at + (m + 1) ** 2 + (m + 1) * t].reshape(m + 1, t)
            diagonal = f.C * row[size - t:] + 1.0 if t else np.zeros(0)
            d = free[:m + 1]
            dense = np.where(np.outer(d, d), dense, 0) + np.diag((~d).astype(float))
            border = border * np.outer(d, free[m + 1:])
            g1, g2 = gradient[:m + 1], gradient[m + 1:]
            schur = dense - (border / diagonal) @ border.T if t else dense
            s1 = np.linalg.solve(schur, g1 - (border / diagonal) @ g2 if t else g1)
            s2 = (g2 - border.T @ s1) / diagonal if t else np.zeros(0)
            steps[k] = -np.r_[s1, s2]
            betas[k] = b + steps[k]
            taken[k] += 1
    if not all(ended):
        raise RuntimeError(f"Newton's method did not end: gradients {norms}")
    return {f: Logistic(*moments[k], betas[k][:m], np.r_[betas[k][m + 1:], 0.0], float(betas[k][m]), norms[k], taken[k])
            for k, f in enumerate(fits)}


# -- fitting and scoring -----------------------------------------------------

def fit_all(cells: Cells, fits: Sequence[Fit]) -> dict[Fit, Trees | Logistic]:
    """All fits, those of a kind in shared passes."""
    out: dict[Fit, Trees | Logistic] = {}
    trees = [f for f in dict.fromkeys(fits) if f.kind in ("tree", "forest")]
    boosted = [f for f in dict.fromkeys(fits) if f.kind == "boosting"]
    logistic = [f for f in dict.fromkeys(fits) if f.kind == "logistic"]
    if trees:
        out |= _gini_trees(cells, trees)
    if boosted:
        out |= _boosted_trees(cells, boosted)
    if logistic:
        out |= _logistic_fits(cells, logistic)
    return out


def probability(model, x: np.ndarray, code: np.ndarray) -> np.ndarray:
    return model.probability(x, code[:, -1]) if isinstance(model, Logistic) else model.probability(code, code.shape[1] - 1)


def split_table(spark: SparkSession, cells: Cells, models: dict[int, Trees]) -> DataFrame:
    """The splits of each fold's first tree: fold, node (of a heap), feature, cut or level, gain, the values of both sides."""
    rows = []
    for f, m in models.items():
        for node in np.flatnonzero(m.feature[0] >= 0).tolist():
            k, cut = int(m.feature[0, node]), int(m.cut[0, node])
            of_level = k == len(cells.numeric)
            rows.append((f, node, cells.level_col if of_level else cells.numeric[k],
                         # a cut at the null code parts the nulls from all others
                         None if of_level else float(cells.edges[k][cut - 1]) if cut else float("-inf"),
                         cells.levels[cut] if of_level else None, float(m.gain[0, node]), float(m.value[0, 2 * node + 1]),
                         float(m.value[0, 2 * node + 2])))
    return spark.createDataFrame(rows, "fold int, node int, feature string, cut double, level string, gain double, "
                                       "left_value double, right_value double")


def out_of_fold(df: DataFrame, cells: Cells, fits: Sequence[Fit], fold: str = "fold") -> DataFrame:
    """K4: each row with the probability of the fit that held its fold out, and the prediction at 0.5."""
    models = {f.outer: m for f, m in fit_all(cells, fits).items()}
    return scored(df, cells, lambda f, x, code: probability(models[f], x, code), fold)


def scored(df: DataFrame, cells: Cells, score, fold: str = "fold") -> DataFrame:
    return with_scores(df, cells, fold, score).withColumn("prediction", (F.col("probability") > 0.5).cast("int"))


# -- stacking and the documented experiments ---------------------------------

#: Rounds and depth of the light booster of stacking and of the feature ablation.
LIGHT = (20, 2)
#: The capacity grid of the booster sweep (n_estimators, max_depth).
CAPACITY_GRID = ((200, 4), (100, 3), (50, 3), (50, 2), (20, 2))
FOREST_TREES = 200
INNER_FOLDS = 5


def dnf_fit(kind: str, features: Sequence[int], outer: int | None = None, inner: int | None = None, pos_weight: float = 1.0,
            n_trees: int | None = None, depth: int = 4, scaled: Sequence[int] = (0,)) -> Fit:
    """C1 to C4 with their defaults: tree, logistic (only the grid position is scaled), forest, boosting."""
    n = n_trees or {"forest": FOREST_TREES, "boosting": 200}.get(kind, 1)
    return Fit(kind, tuple(features), outer, inner, n, depth, kind != "boosting", pos_weight,
               scaled=tuple(scaled) if kind == "logistic" else ())


def base_fits(features: Sequence[int], outer: int | None, inner: int | None, pos_weight: float, forest_trees: int = FOREST_TREES) -> list[Fit]:
    """The four base models of the stack."""
    return [dnf_fit("tree", features, outer, inner), dnf_fit("logistic", features, outer, inner),
            dnf_fit("forest", features, outer, inner, n_trees=forest_trees),
            dnf_fit("boosting", features, outer, inner, pos_weight, *LIGHT)]


class _Meta:
    """The meta-model's design: inner out-of-fold probabilities of each outer fold's training cells."""

    def __init__(self, outers: Sequence[int], width: int):
        self.outers, self.width = list(outers), width

    def __call__(self, block: Block, k: int):
        x = block.extra["meta"].reshape(len(self.outers), len(block), self.width)[k]
        own = block.fold != self.outers[k]
        return x, block.negatives * own, block.positives * own


def stack_fits(cells: Cells, features: Sequence[int], pos_weight: float, forest_trees: int = FOREST_TREES) -> list[Fit]:
    """All base fits of C5: for every outer fold one of each inner fold held out, and the refit on all its training rows."""
    inners = sorted({i for _, i in cells.counts})
    return [f for o in cells.folds for i in [*inners, None] for f in base_fits(features, o, i, pos_weight, forest_trees)]


def stack_metas(cells: Cells, models: dict, features: Sequence[int], pos_weight: float, forest_trees: int = FOREST_TREES) -> dict[int, Logistic]:
    """The meta-model of each outer fold, all fitted together: logistic with intercept, no class weights."""
    outers, inners = cells.folds, sorted({i for _, i in cells.counts})
    own = {(o, i): [models[f] for f in base_fits(features, o, i, pos_weight, forest_trees)] for o in outers for i in inners}
    width = len(next(iter(own.values())))

    def run(batches):
        for batch in batches:
            made = []
            for block in unpack(batch):
                x = np.zeros((len(outers), len(block), width))
                for k, o in enumerate(outers):
                    for i in np.unique(block.inner):
                        at = np.flatnonzero((block.inner == i) & (block.fold != o))
                        for j, m in enumerate(own[o, int(i)]):
                            x[k, at, j] = probability(m, block.numeric[at], block.code[at])
                made.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], names=[*batch.schema.names, "meta"])

    with_meta = replace(cells, blocks=shared_cut(cells.blocks.mapInArrow(run, ", ".join(f"{n} binary" for n in [*cells.blocks.columns, "meta"]))))
    fits = [Fit("logistic", (), o, balanced=False) for o in outers]
    found = _logistic_fits(with_meta, fits, intercept=True, design=_Meta(outers, width))
    return {f.outer: m for f, m in found.items()}


def stack_score(models: dict, metas: dict[int, Logistic], features: Sequence[int], pos_weight: float, forest_trees: int = FOREST_TREES):
    """score(fold, numeric, code) of the stack that held the fold out."""
    bases = {o: [models[f] for f in base_fits(features, o, None, pos_weight, forest_trees)] for o in metas}

    def score(fold, x, code):
        p = np.stack([probability(m, x, code) for m in bases[fold]], axis=1)
        return metas[fold].probability(p, np.zeros(len(p), np.int64))

    return score


def out_of_fold_stack(df: DataFrame, cells: Cells, features: Sequence[int], pos_weight: float, fold: str = "fold",
                      forest_trees: int = FOREST_TREES) -> DataFrame:
    """C5 with K4: nested cross-fitting, every kind of base model over all (outer, inner) pairs in shared passes."""
    models = fit_all(cells, stack_fits(cells, features, pos_weight, forest_trees))
    metas = stack_metas(cells, models, features, pos_weight, forest_trees)
    return scored(df, cells, stack_score(models, metas, features, pos_weight, forest_trees), fold)


def with_inner_folds(df: DataFrame, keys: Sequence[str], name: str = "inner_fold", folds: int = INNER_FOLDS) -> DataFrame:
    """Inner folds by a hash of the key columns; they ignore groups, as the reference's stack does."""
    return df.withColumn(name, F.pmod(F.xxhash64(*keys), F.lit(folds)).cast("int"))


def _tuned_f1(oof: DataFrame) -> tuple[float, float]:
    from lapline.models.metrics import tuned_binary_metrics

    r = tuned_binary_metrics(oof).first()
    return float(r["threshold"]), float(r["f1"])


def _tuned(df: DataFrame, cells: Cells, scores: dict, fold: str) -> dict:
    """Threshold and F1 of every score, a few sweeps at a time, as ``CrossValidator(parallelism=...)`` runs its fits."""
    with ThreadPoolExecutor(4) as pool:
        return dict(zip(scores, pool.map(lambda s: _tuned_f1(scored(df, cells, s, fold).select("label", "probability")), scores.values()),
                        strict=True))


def capacity_sweep(df: DataFrame, cells: Cells, features: Sequence[int], pos_weight: float, grid=CAPACITY_GRID,
                   fold: str = "fold") -> DataFrame:
    """All capacities and folds boosted together; each capacity's out-of-fold threshold and F1."""
    fits = {(n, d): [dnf_fit("boosting", features, o, None, pos_weight, n, d) for o in cells.folds] for n, d in grid}
    models = fit_all(cells, [f for own in fits.values() for f in own])
    scores = {}
    for key, own in fits.items():
        by_fold = {f.outer: models[f] for f in own}
        scores[key] = lambda f, x, code, m=by_fold: probability(m[f], x, code)
    tuned = _tuned(df, cells, scores, fold)
    return df.sparkSession.createDataFrame([(*key, *tuned[key]) for key in fits],
                                           "n_estimators int, max_depth int, threshold double, f1 double")


def feature_ablation(df: DataFrame, cells: Cells, variants: dict[str, Sequence[int]], pos_weight: float, fold: str = "fold",
                     kinds: Sequence[str] = ("tree", "logistic", "forest", "boosting", "stacking"),
                     forest_trees: int = FOREST_TREES) -> DataFrame:
    """Tuned F1 of every model on every feature set, and the change against the set before it (0 for the first).

    The fits of all models, feature sets and folds, the inner ones of the stacks among them, are made together.
    """
    def own(kind, features):
        if kind == "boosting":
            return [dnf_fit(kind, features, o, None, pos_weight, *LIGHT) for o in cells.folds]
        return [dnf_fit(kind, features, o, n_trees=forest_trees if kind == "forest" else None) for o in cells.folds]

    fits = [f for v in variants.values() for k in kinds
            for f in (stack_fits(cells, v, pos_weight, forest_trees) if k == "stacking" else own(k, v))]
    models = fit_all(cells, fits)
    scores = {}
    for kind in kinds:
        for name, features in variants.items():
            if kind == "stacking":
                metas = stack_metas(cells, models, features, pos_weight, forest_trees)
                scores[kind, name] = stack_score(models, metas, features, pos_weight, forest_trees)
            else:
                by_fold = {f.outer: models[f] for f in own(kind, features)}
                scores[kind, name] = lambda f, x, code, m=by_fold: probability(m[f], x, code)
    tuned = _tuned(df, cells, scores, fold)
    rows = []
    for kind in kinds:
        before = None
        for name in variants:
            f1 = tuned[kind, name][1]
            rows.append((kind, name, f1, 0.0 if before is None else f1 - before))
            before = f1
    return df.sparkSession.createDataFrame(rows, "model string, variant string, f1 double, delta_f1 double")
