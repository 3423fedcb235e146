"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapline.llm.common import cut


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, smallest node) with the same components as the edges a-b."""
    nodes, flat = np.unique(np.r_[a, b], return_inverse=True)
    u, v = flat[: len(a)], flat[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        new = new[new]
        new = np.minimum(new, new[label])
        if np.array_equal(new, label):
            break
        label = new
    own = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[own], nodes[label[own]]


def _contract(batches):
    """Star edges of each batch: fewer rows, the same components."""
    for batch in batches:
        if batch.num_rows:
            u, v = forest(np.asarray(batch.column(0)), np.asarray(batch.column(1)))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges``; the root is the smallest node reachable.

    ``edges`` has two long columns.  Null ends and loops are ignored; an
    empty table gives an empty result.  Each round is a large-star and a
    small-star step (joins and grouped minima); the edges of each batch are
    contracted first, so that large groups shrink before they are shuffled.
    Edge tables are cut in the shared checkpoint folder after each round.
    """
    a, b = edges.columns
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
    e = cut(e.mapInArrow(_contract, "u long, v long").distinct())
    state = None
    for _ in range(max_rounds):
        sign = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003), F.sum(F.xxhash64("v", "u") % 1_000_033)).first()
        if tuple(sign) == state:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        state = tuple(sign)
        # large star: every larger neighbour of u is linked to u's smallest neighbour
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours are linked to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(small.unionByName(low.select("u", F.col("m").alias("v"))).where("u != v")
                .mapInArrow(_contract, "u long, v long").distinct())
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
