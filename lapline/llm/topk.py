"""Exact top-k inner products with an impact-ordered index, score at a time.

Index.  Candidates are dealt into blocks.  In a block, every non-zero
component is a posting (vector, dimension, value), and postings are laid down in
segments of falling impact: segment l holds the values of 2^l <= |value| <
2^(l+1).  Each segment row also carries the norm of what follows it, for each vector.

Search.  A block's segments are added to the scores in order of impact, for
all queries of a cell at once.  After each segment the rest of any score is at
most |query| times the vector's remaining norm (Cauchy-Schwarz), so every score has a
lower and an upper bound.  The k-th largest lower bound is the bar;
vectors whose upper bound is below it can't be members.  The scan stops only
when few enough are left (or all segments are read), and those are rescored
exactly from the block's vectors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapline.llm.common import cut

BLOCK = 8192
QUERY_BLOCK = 1024
SCALE = 256


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, dim, values): floor(scale * component), as arrays of longs.

    Vectors that are null or empty, or hold null or non-finite components (or such
    as a long can't hold), are left out, and so are rows with a null id.
    """
    x = F.transform(F.col(vector_col), lambda v: v.cast("double") * scale)
    limit = float(1 << 62)
    good = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < limit))
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x")) \
        .where(F.col("x").isNotNull() & (F.size("x") > 0) & F.col("vec_id").isNotNull()).where(good) \
        .select("vec_id", F.size("x").alias("dim"), F.transform("x", lambda v: F.floor(v).cast("long")).alias("values"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).reshape(-1, dim).astype(np.int64)


def build_index(vectors: DataFrame, block_size: int = BLOCK) -> tuple[DataFrame, int]:
    """Segments (block, dim, level, vec, at, value, rest) of all vectors, and the number of blocks.

    ``level`` falls with impact; level -1 carries the vectors themselves, for
    rescoring.  Blocks are hash-dealt, about ``block_size`` vectors each.
    """
    blocks = max(1, -(-vectors.count() // block_size))
    schema = "block int, dim int, level int, ids binary, row binary, at binary, value binary, rest binary"

    def index(table: pa.Table) -> pa.Table:
        dim, block = table.column("dim")[0].as_py(), table.column("block")[0].as_py()
        ids = np.asarray(table.column("vec_id")).astype(np.int64)
        x = _matrix(table.column("values"), dim)
        size = np.abs(x.astype(np.float64))
        level = np.where(size > 0, np.frexp(size)[1] - 1, -1)
        rows = [(block, dim, -1, ids.tobytes(), b"", b"", x.tobytes(), b"")]
        rest = (size ** 2).sum(axis=1)
        for l in sorted(set(np.unique(level)) - {-1}, reverse=True):
            row, at = np.nonzero(level == l)
            rest = rest - np.bincount(row, weights=size[row, at] ** 2, minlength=len(x))
            rows.append((block, dim, int(l), b"", row.astype(np.int32).tobytes(), at.astype(np.int32).tobytes(),
                         x[row, at].tobytes(), np.sqrt(np.maximum(rest, 0)).tobytes()))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [
            *[pa.int32()] * 3, *[pa.binary()] * 5], strict=True)],
            names=["block", "dim", "level", "ids", "row", "at", "value", "rest"])

    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("vec_id", "values"), F.lit(blocks)).cast("int"))
    return dealt.groupBy("block", "dim").applyInArrow(index, schema), blocks


def search_block(queries: np.ndarray, query_ids: np.ndarray, ids: np.ndarray, x: np.ndarray, segments, k: int):
    """(query id, vec id, score) of every query's k best in a block, ties to the smaller id.

    ``segments``: (row, at, value, rest) in order of impact.
    """
    exact = float(np.abs(queries).max(initial=0)) * float(np.abs(x).max(initial=0)) * x.shape[1] < 2.0 ** 52
    number, n = len(queries), len(ids)
    own = query_ids[:, None] == ids[None, :]
    if exact:
        q = queries.astype(np.float64)
        norm = np.sqrt((q ** 2).sum(axis=1))
        score = np.zeros((number, n))
        alive = ~own
        for row, at, value, rest in segments:
            plane = np.zeros(x.shape)
            plane[row, at] = value
            score += q @ plane.T
            slack = norm[:, None] * rest[None, :] * (1 + 1e-9)
            low = np.where(own, -np.inf, score - slack)
            if n > k:
                bar = np.partition(low, n - k, axis=1)[:, n - k]
                alive = ~own & (score + slack >= bar[:, None])
            if alive.sum() <= 4 * k * number:
                break
        a, b = np.nonzero(alive)
    else:
        a, b = np.nonzero(~own)
    total = np.empty(len(a), object if not exact else np.int64)
    for at in range(0, len(a), 1 << 16):
        s = slice(at, at + (1 << 16))
        left, right = queries[a[s]], x[b[s]]
        total[s] = (left.astype(object) * right.astype(object)).sum(axis=1) if not exact else (left * right).sum(axis=1)
    order = np.lexsort((ids[b], -total, a)) if exact else np.array(
        sorted(range(len(a)), key=lambda i: (a[i], -total[i], ids[b[i]])), np.int64)
    a, b, total = a[order], b[order], total[order]
    first = np.searchsorted(a, a)
    keep = np.arange(len(a)) - first < k
    return query_ids[a[keep]], ids[b[keep]], total[keep]


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 5, block_size: int = BLOCK,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of each query, all if fewer.

    Both tables are ``quantised``.  A query doesn't meet rows with its own id;
    vectors of other lengths don't meet; ties go to the smaller id.  Repeated
    candidate rows count once each; repeated query ids are answered once for
    each distinct vector, as one query.  Scores beyond a long are not defined.
    Every (index block, query block) is one cell; each gives k rows for a query.
    """
    index, blocks = build_index(cut(vectors), block_size)
    asked = cut(queries.distinct())
    parts = max(1, -(-asked.count() // query_block))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int"))
    index = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    sent = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    schema = "query_id long, vec_id long, score long"

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [np.empty(0, np.int64)] * 3
        if left.num_rows and right.num_rows:
            dim = left.column("dim")[0].as_py()
            table = left.sort_by([("level", "descending")]).to_pylist()
            whole = table.pop()
            read = np.frombuffer
            ids = read(whole["ids"], np.int64)
            segments = [(read(r["row"], np.int32), read(r["at"], np.int32), read(r["value"], np.int64),
                         read(r["rest"], np.float64)) for r in table]
            found = search_block(_matrix(right.column("values"), dim), np.asarray(right.column("vec_id")).astype(np.int64),
                                 ids, read(whole["value"], np.int64).reshape(-1, dim), segments, k)
        return pa.Table.from_arrays([pa.array(f.astype(np.int64)) for f in found], names=["query_id", "vec_id", "score"])

    keys = ["block", "part", "dim"]
    best = index.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(cell, schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
