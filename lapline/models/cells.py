"""Training tables as counted cells, the input of fits that share their passes.

Rows with the same feature values, fold and inner fold are one *cell* with its
numbers of negatives and positives: one grouped aggregation, pre-aggregated
map-side, after which every pass of every fit reads cells instead of rows.  Cells are
written once as *blocks* (packed arrays of up to ``BLOCK_CELLS`` cells) in the
checkpoint folder; the number of partitions follows from their count.

Features are numeric columns and one optional column of levels, which stands for
its full one-hot.  For trees a numeric value has a code: 0 if it is null, else
its bin from 1 on.  Bins are the distinct values where there are at most
``max_bins`` of them, else quantile ranges.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapline.operators.features import distinct_levels
from lapline.session import ensure_checkpoint_dir, ship_code

BLOCK_CELLS = 16_384
#: A partition has at least this many cells, more only once every core has several partitions.
CELLS_PER_PARTITION = 4096
PARTITIONS_PER_CORE = 4
MOST_CELLS = 200_000
MAX_BINS = 256

_PACKED = (("numeric", np.float64), ("code", np.int32), ("fold", np.int32), ("inner", np.int32),
           ("negatives", np.int64), ("positives", np.int64), ("hash", np.int64))


@dataclass
class Block:
    """Arrays of a block's cells."""
    numeric: np.ndarray     # cells x numeric features
    code: np.ndarray        # cells x all features; the last one is the level, len(levels) if null
    fold: np.ndarray
    inner: np.ndarray
    negatives: np.ndarray
    positives: np.ndarray
    hash: np.ndarray
    extra: dict[str, np.ndarray]

    def __len__(self) -> int:
        return len(self.fold)


@dataclass
class Cells:
    blocks: DataFrame
    numeric: tuple[str, ...]
    level_col: str | None
    levels: list[str]
    edges: list[np.ndarray]
    counts: dict[tuple[int, int], tuple[int, int]]  # (fold, inner) -> negatives, positives
    parts: int = 1
    number: int = 0

    def bare(self) -> Cells:
        """What workers need: all but the table."""
        return replace(self, blocks=None)

    @property
    def folds(self) -> list[int]:
        return sorted({f for f, _ in self.counts})

    @property
    def slots(self) -> list[int]:
        """Number of codes of each feature; without levels the last one has the null code alone."""
        return [len(e) + 2 for e in self.edges] + [len(self.levels) + 1]

    def codes(self, numeric: np.ndarray, level: np.ndarray) -> np.ndarray:
        bins = [np.where(np.isnan(x), 0, 1 + np.searchsorted(e, x, side="left")) for x, e in zip(numeric.T, self.edges)]
        return np.stack([*bins, level], axis=1).astype(np.int32)


def shared_cut(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    ship_code(df.sparkSession)
    return df.checkpoint()


def unpack(batch: pa.RecordBatch):
    """The blocks of a batch."""
    names = batch.schema.names
    for i in range(batch.num_rows):
        raw = {n: batch.column(k)[i].as_py() for k, n in enumerate(names)}
        arrays = {n: np.frombuffer(raw.pop(n), t) for n, t in _PACKED}
        size = len(arrays["fold"])
        for n in ("numeric", "code"):
            arrays[n] = arrays[n].reshape(size, -1)
        yield Block(**arrays, extra={n: np.frombuffer(b, np.float64) for n, b in raw.items()})


def _bin_edges(df: DataFrame, column: str, max_bins: int) -> np.ndarray:
    known = df.where(F.col(column).isNotNull()).select(column)
    values = [r[0] for r in known.distinct().limit(max_bins + 1).collect()]
    if len(values) <= max_bins:
        x = np.sort(np.array(values, float))
        return (x[1:] + x[:-1]) / 2
    return np.unique(known.approxQuantile(column, np.linspace(0, 1, max_bins + 1)[1:-1].tolist(), 1e-4))


def build_cells(df: DataFrame, numeric: Sequence[str], level_col: str | None = None, label: str = "label", fold: str = "fold",
                inner: str | None = None, max_bins: int = MAX_BINS) -> Cells:
    """The cells of a table with a 0/1 label and a fold for each row; nulls in either raise.

    ``inner``: a column of inner folds.  The level list is as long as the
    one-hot that it stands for, which the fitted models hold too.
    """
    values = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"x{i}") for i, c in enumerate(numeric)]
    levels = distinct_levels(df, level_col) if level_col else []
    rows = df
    if levels:
        index = StringIndexerModel.from_labels(levels, inputCol=level_col, outputCol="__level", handleInvalid="keep")
        rows = index.transform(df)
    level = F.col("__level").cast("int") if levels else F.lit(0)
    keys = [*(f"x{i}" for i in range(len(numeric))), "level", "fold", "inner"]
    cells = rows.select(*values, level.alias("level"), F.col(fold).cast("int").alias("fold"),
                        (F.col(inner) if inner else F.lit(0)).cast("int").alias("inner"), F.col(label).cast("double").alias("label")) \
        .groupBy(*keys).agg(F.count("*").alias("n"), F.count(F.when(F.col("label") == 1, 1)).alias("positives"),
                            F.count(F.when(F.col("label") == 0, 1)).alias("negatives"))
    # averages differ in their last digits from run to run, the bootstrap's hashes must not
    rounded = [F.round(k, 9) if k.startswith("x") else F.col(k) for k in keys]
    cells = shared_cut(cells.withColumn("hash", F.xxhash64(*rounded)))
    found = cells.groupBy("fold", "inner").agg(F.sum("n").alias("n"), F.sum("negatives").alias("n0"), F.sum("positives").alias("n1"),
                                               F.count("*").alias("cells")).collect()
    if any(r.fold is None or r.inner is None or r.n != r.n0 + r.n1 for r in found):
        raise ValueError("folds must not be null and labels must be 0 or 1")
    edges = [_bin_edges(cells, f"x{i}", max_bins) for i in range(len(numeric))]
    out = Cells(None, tuple(numeric), level_col, levels, edges, {(r.fold, r.inner): (r.n0, r.n1) for r in found})

    def pack(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= BLOCK_CELLS:
                yield packed(held)
                held, size = [], 0
        if size:
            yield packed(held)

    def packed(batches):
        table = pa.Table.from_batches(batches)
        x = np.stack([np.zeros(table.num_rows), *(table.column(f"x{i}").to_numpy() for i in range(len(numeric)))], axis=1)[:, 1:]
        x = x.astype(np.float64)
        arrays = {n: table.column(n).to_numpy() for n in ("fold", "inner", "negatives", "positives", "hash")}
        arrays |= {"numeric": x, "code": out.codes(x, table.column("level").to_numpy())}
        return pa.RecordBatch.from_arrays(
            [pa.array([np.ascontiguousarray(arrays[n], t).tobytes()], pa.binary()) for n, t in _PACKED], names=[n for n, _ in _PACKED])

    n, cores = sum(r.cells for r in found), df.sparkSession.sparkContext.defaultParallelism
    out.number, out.parts = n, max(1, min(math.ceil(n / CELLS_PER_PARTITION), max(PARTITIONS_PER_CORE * cores, math.ceil(n / MOST_CELLS))))
    dealt = cells.drop("n").coalesce(1) if out.parts == 1 else cells.drop("n").repartition(out.parts, "hash")
    blocks = shared_cut(dealt.sortWithinPartitions("hash", *keys)
                            .mapInArrow(pack, ", ".join(f"{n} binary" for n, _ in _PACKED)))
    return replace(out, blocks=blocks)


def summed(cells: Cells, work, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, sums): over all blocks, the added up rows of ``work(block)`` -> (places, values with ``width`` columns).

    Equal places are added up within a partition, then by a grouped
    aggregation; the caller bounds the number of places, since the sums reach the driver.
    """
    def run(batches):
        places, values = [np.zeros(0, np.int64)], [np.zeros((0, width))]
        for batch in batches:
            for block in unpack(batch):
                p, v = work(block)
                place, at = np.unique(np.concatenate([places[0], p]), return_inverse=True)
                added = np.zeros((len(place), width))
                np.add.at(added, at, np.concatenate([values[0], v]))
                places, values = [place], [added]
        yield pa.RecordBatch.from_arrays([pa.array(places[0], pa.int64()), *(pa.array(values[0][:, k]) for k in range(width))],
                                         names=["place", *(f"v{k}" for k in range(width))])

    found = cells.blocks.mapInArrow(run, "place long, " + ", ".join(f"v{k} double" for k in range(width)))
    if cells.parts > 1:
        found = found.groupBy("place").agg(*(F.sum(f"v{k}").alias(f"v{k}") for k in range(width)))
    table = found.toArrow()
    return table.column("place").to_numpy(), np.stack([table.column(f"v{k}").to_numpy() for k in range(width)], axis=1)


def encoded(cells: Cells, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Numeric values and codes of a batch of rows; a level that the cells don't know counts as null."""
    def column(name):
        return batch.column(batch.schema.get_field_index(name))

    x = np.zeros((batch.num_rows, len(cells.numeric)))
    for i, c in enumerate(cells.numeric):
        x[:, i] = pc.cast(column(c), pa.float64()).to_numpy(zero_copy_only=False)
    level = np.zeros(batch.num_rows, np.int64)
    if cells.levels:
        found = pc.index_in(pc.cast(column(cells.level_col), pa.string()), value_set=pa.array(cells.levels, pa.string()))
        level = pc.fill_null(found, len(cells.levels)).to_numpy(zero_copy_only=False)
    return x, cells.codes(x, level)


def with_scores(df: DataFrame, cells: Cells, fold: str, score, name: str = "probability") -> DataFrame:
    """Append ``name``: ``score(fold, numeric, code)`` for the rows of each fold, in Arrow batches; no exchange."""
    bare = cells.bare()
    columns = [c for c in df.columns if c != name]

    def run(batches):
        for batch in batches:
            x, code = encoded(bare, batch)
            folds = batch.column(batch.schema.get_field_index(fold)).to_numpy(zero_copy_only=False)
            out = np.zeros(batch.num_rows)
            for f in np.unique(folds):
                at = folds == f
                out[at] = score(int(f), x[at], code[at])
            kept = [batch.column(batch.schema.get_field_index(c)) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(out)], names=[*columns, name])

    kept = df.select(*columns)
    return df.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(name, T.DoubleType())]))
