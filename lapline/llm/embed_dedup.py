"""Near-duplicate embeddings: exact cosine links by a distributed cover tree and a dual traversal.

Tree.  Unit vectors of a label start in one root node.  Level i has the radius 2 /
2^i.  A node with too many vectors is split: from a hash sample of it, centres
at least one radius apart are picked farthest first, and every vector goes to
its nearest centre.  The sample only places the centres: a node's covering
radius is the largest distance of all its vectors from the centre, so bounds hold
for every row.  All steps are joins and aggregations keyed by node.

Dual traversal.  Node pairs start with (root, root) and are replaced, level by
level, by the pairs of their children; a pair goes when the distance of the centres is
above both covering radii plus the link distance.  Leaf pairs that are left are
compared exactly, after vectors that are too far from the other leaf's ball
are put aside.  A leaf that stays too large, as thousands of close copies do, is
dealt out over chunks.  A comparison gives link counts and the star edges of its
components, never the pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapline.llm.common import cut
from lapline.llm.graph import components, forest

THRESHOLD = 0.93
#: Vectors in a leaf, children of a node, sampled vectors for each node, levels.
LEAF, FANOUT, SAMPLE, LEVELS = 2048, 16, 256, 12
_SAFE = 1e-9


def valid_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(row, vec_id, label, vec): ``vec`` is the vector as raw doubles, null where it can't link.

    That is a null label or vector, no or null or non-finite components, or
    all of them zero.
    """
    narrow = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("x"))

    def pack(batches):
        for batch in batches:
            column, label = batch.column(3), batch.column(2)
            out = []
            for i in range(batch.num_rows):
                x = column[i]
                if not x.is_valid or not label[i].is_valid or x.values.null_count or not len(x.values):
                    out.append(None)
                    continue
                v = np.asarray(x.values) + 0.0  # no negative zero
                out.append(v.tobytes() if np.isfinite(v).all() and v.any() else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), label, pa.array(out, pa.binary())], names=["row", "vec_id", "label", "vec"])

    return narrow.mapInArrow(pack, "row long, vec_id long, label string, vec binary")


def _unit(column: pa.Array) -> np.ndarray:
    """Rows of raw doubles, scaled to length 1."""
    rows = column.to_pylist()
    x = np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True, initial=0)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * a @ b.T))


def _pick(radius: float, fanout: int):
    """Centres for one node from its sample: farthest first, as long as one is a radius away from all picked."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("vid")
        x = _unit(table.column("vec").combine_chunks())
        chosen = [0]
        away = _distance(x, x[:1])[:, 0]
        while len(chosen) < fanout:
            far = int(away.argmax())
            if away[far] <= radius:
                break
            chosen.append(far)
            away = np.minimum(away, _distance(x, x[far:far + 1])[:, 0])
        return pa.Table.from_arrays(
            [pa.array([table.column("node")[0].as_py()], pa.int64()), pa.array([x[chosen].tobytes()], pa.binary()),
             pa.array([x.shape[1]], pa.int32())], names=["node", "centres", "dim"])

    return run


def _child(node: int, child: np.ndarray) -> np.ndarray:
    """Ids of a node's children: a hash of the node's id and the number of the child."""
    return np.array([xxhash.xxh64_intdigest(f"{node}/{i}") >> 1 for i in range(int(child.max(initial=0)) + 1)], np.int64)[child]


def _assign():
    """Rows with their node's centres -> child, its centre and the distance from it."""

    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch]).sort_by("node")
            node = np.asarray(table.column("node"))
            start = np.flatnonzero(np.r_[True, node[1:] != node[:-1]]) if len(node) else []
            for a, b in zip(start, [*start[1:], len(node)], strict=True):
                part = table.slice(int(a), int(b - a)).combine_chunks()
                blob = part.column("centres")[0].as_py()
                names = ["vid", "mult", "vec", "node", "parent", "centre", "away"]
                if blob is None:  # not split: stays as it is
                    columns = [part.column(c).combine_chunks() for c in ("vid", "mult", "vec", "node")]
                    columns += [part.column("node").combine_chunks(), part.column("centre").combine_chunks(),
                                part.column("away").combine_chunks()]
                else:
                    x = _unit(part.column("vec").combine_chunks())
                    c = np.frombuffer(blob, np.float64).reshape(-1, x.shape[1])
                    d = _distance(x, c)
                    child = d.argmin(axis=1)
                    columns = [part.column(n).combine_chunks() for n in ("vid", "mult", "vec")]
                    columns += [pa.array(_child(int(node[a]), child)), part.column("node").combine_chunks(),
                                pa.array([c[i].tobytes() for i in child], pa.binary()),
                                pa.array(d[np.arange(len(x)), child])]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _apart(batches):
    """Node pairs whose balls come within the link distance."""
    for batch in batches:
        a, b = batch.column(batch.schema.get_field_index("ca")).to_pylist(), batch.column(batch.schema.get_field_index("cb")).to_pylist()
        ra, rb, reach = (np.asarray(batch.column(batch.schema.get_field_index(n))) for n in ("ra", "rb", "reach"))
        gap = [0.0 if x is None or y is None else float(np.linalg.norm(np.frombuffer(x) - np.frombuffer(y)))
               for x, y in zip(a, b, strict=True)]
        yield batch.filter(pa.array(np.array(gap) <= ra + rb + reach + _SAFE)).select(["a", "b"])


def _compare(threshold: float):
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)))

    def near(x, other):
        """Rows of x that come within reach of the other side's ball."""
        centre, radius = other
        return np.ones(len(x), bool) if centre is None else _distance(x, centre[None, :])[:, 0] <= radius + reach + _SAFE

    def run(table: pa.Table) -> pa.Table:
        side = np.asarray(table.column("side"))
        parts = []
        for s in (0, 1):
            part = table.filter(pa.array(side == s)).combine_chunks()
            parts.append((np.asarray(part.column("vid")), np.asarray(part.column("mult")).astype(np.float64),
                          _unit(part.column("vec").combine_chunks()) if part.num_rows else None, part))
        same = bool(table.column("same")[0].as_py())
        kinds, xs, ys = [], [], []
        if parts[0][2] is not None and (same or parts[1][2] is not None):
            ids, mult, x, part = parts[0]
            ids2, mult2, y, part2 = parts[0] if same else parts[1]
            if not same:
                ball = [(np.frombuffer(p.column("other_centre")[0].as_py()) if p.column("other_centre")[0].is_valid else None,
                         p.column("other_radius")[0].as_py()) for p in (part, part2)]
                k, k2 = near(x, ball[0]), near(y, ball[1])
                ids, mult, x, ids2, mult2, y = ids[k], mult[k], x[k], ids2[k2], mult2[k2], y[k2]
            back = np.zeros(len(ids2))
            ahead = np.zeros(len(ids))
            edges = []
            for at in range(0, len(x), 256):
                link = x[at:at + 256] @ y.T >= threshold
                if same:
                    link[np.arange(len(link)), at + np.arange(len(link))] = False
                ahead[at:at + 256] = link @ mult2
                if not same:
                    back += mult[at:at + 256] @ link
                i, j = np.nonzero(link)
                if len(i):
                    edges.append(forest(ids[at + i], ids2[j]))
            counts = [(ids, ahead)] if same else [(ids, ahead), (ids2, back)]
            for who, n in counts:
                has = n > 0
                kinds += [0] * int(has.sum())
                xs.append(who[has])
                ys.append(n[has].astype(np.int64))
            if edges:
                u, v = forest(np.concatenate([e[0] for e in edges]), np.concatenate([e[1] for e in edges]))
                kinds += [1] * len(u)
                xs.append(u)
                ys.append(v)
        flat = [np.concatenate(z) if z else np.empty(0, np.int64) for z in (xs, ys)]
        return pa.Table.from_arrays([pa.array(kinds, pa.int32()), pa.array(flat[0], pa.int64()), pa.array(flat[1], pa.int64())],
                                    names=["kind", "a", "b"])

    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, leaf: int = LEAF, fanout: int = FANOUT,
                    sample: int = SAMPLE, levels: int = LEVELS, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row for each row of ``vectors``.

    Two rows link if labels are equal and their cosine, in doubles, is at
    least ``threshold``.  Rows that can't link (``valid_vectors``) and vectors
    of different lengths have no links with each other.  Rows with equal ids are
    linked like any others; a null id is never a component's smallest id unless
    all are null.  An empty table gives no rows.
    """
    rows = cut(valid_vectors(vectors, id_col, vector_col, label_col))
    good = rows.where("vec is not null")
    distinct = cut(good.groupBy("label", "vec").agg(
        F.min("row").alias("vid"), F.min("vec_id").alias("least"), F.count("*").alias("mult")))
    points = distinct.select("vid", "mult", "vec", F.lit(None).cast("binary").alias("centre"), F.lit(2.0).alias("away"),
                             "label", F.octet_length("vec").alias("width"))
    # one root for each label and length
    roots = cut(points.select("label", "width").distinct().select("label", "width", F.monotonically_increasing_id().alias("n")))
    points = cut(points.join(roots, ["label", "width"]).select(
        "vid", "mult", "vec", F.col("n").alias("node"), F.col("n").alias("parent"), "centre", "away"))
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    pairs = points.select(F.col("node").alias("a"), F.col("node").alias("b")).distinct()
    schema = "vid long, mult long, vec binary, node long, parent long, centre binary, away double"
    for level in range(1, levels + 1):
        sizes = points.groupBy("node").agg(F.count("*").alias("n"))
        large = cut(sizes.where(F.col("n") > leaf))
        if large.isEmpty():
            break
        radius = 2.0 / 2 ** level
        fraction = F.least(F.lit(1.0), F.lit(float(sample)) / F.col("n"))
        drawn = points.select("node", "vid", "vec").join(large, "node") \
            .where(F.pmod(F.xxhash64("vid", F.lit(level)), F.lit(1 << 20)) < fraction * (1 << 20)).select("node", "vid", "vec")
        centres = drawn.groupBy("node").applyInArrow(
            _pick(radius, fanout), "node long, centres binary, dim int").select("node", "centres")
        points = cut(points.drop("parent").join(centres, "node", "left").mapInArrow(_assign(), schema))
        nodes = points.groupBy("node").agg(
            F.min("parent").alias("parent"), F.min("centre").alias("c"), F.max("away").alias("r"))
        left = nodes.select(F.col("node").alias("a"), F.col("parent").alias("pa"), F.col("c").alias("ca"), F.col("r").alias("ra"))
        right = nodes.select(F.col("node").alias("b"), F.col("parent").alias("pb"), F.col("c").alias("cb"), F.col("r").alias("rb"))
        kids = pairs.select(F.col("a").alias("pa"), F.col("b").alias("pb")).join(left, "pa").join(right, "pb") \
            .where("pa != pb or a <= b").withColumn("reach", F.lit(reach))
        pairs = cut(kids.select("a", "b", "ca", "cb", "ra", "rb", "reach").mapInArrow(_apart, "a long, b long"))
    nodes = points.groupBy("node").agg(F.count("*").alias("n"), F.min("centre").alias("c"), F.max("away").alias("r"))
    nodes = cut(nodes.withColumn("chunks", F.ceil(F.col("n") / leaf).cast("int")))
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("c").alias(f"c{x}"), F.col("r").alias(f"r{x}"), F.col("chunks").alias(f"k{x}"))
    cells = pairs.join(side("a"), "a").join(side("b"), "b") \
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("ka") - 1))) \
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("kb") - 1))).where("a != b or i <= j") \
        .withColumn("same", F.expr("a = b and i = j"))
    cells = cut(cells.withColumn("cell", F.monotonically_increasing_id()))
    members = cells.select("cell", "same", F.lit(0).alias("side"), F.col("a").alias("node"), F.col("i").alias("chunk"),
                           F.when(F.expr("a != b"), F.col("cb")).alias("other_centre"), F.col("rb").alias("other_radius")) \
        .unionByName(cells.where("not same").select(
            "cell", "same", F.lit(1).alias("side"), F.col("b").alias("node"), F.col("j").alias("chunk"),
            F.when(F.expr("a != b"), F.col("ca")).alias("other_centre"), F.col("ra").alias("other_radius")))
    dealt = points.select("vid", "mult", "vec", "node").join(nodes.select("node", "chunks"), "node") \
        .withColumn("chunk", F.pmod(F.xxhash64("vid"), F.col("chunks")).cast("int")).drop("chunks")
    found = cut(dealt.join(members, ["node", "chunk"])
                .select("cell", "same", "side", "vid", "mult", "vec", "other_centre", "other_radius")
                .groupBy("cell").applyInArrow(_compare(threshold), "kind int, a long, b long"))
    counts = found.where("kind = 0").groupBy(F.col("a").alias("vid")).agg(F.sum("b").alias("others"))
    linked = components(found.where("kind = 1").select("a", "b"))
    classes = distinct.join(counts, "vid", "left").join(linked, distinct["vid"] == linked["node"], "left") \
        .select("label", "vec", "vid", "least", (F.coalesce("others", F.lit(0)) + F.col("mult") - 1).alias("n_links"),
                F.coalesce("root", "vid").alias("root"))
    ids = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    answer = classes.join(ids, "root").select("label", "vec", "n_links", "component_id")
    return rows.join(answer, ["label", "vec"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("vec").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
