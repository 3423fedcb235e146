"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapline.session import ensure_checkpoint_dir


_shipped: set[str] = set()
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the executors, once for each application, as ``--py-files`` would.

    Texts are long, so Arrow batches get fewer rows unless the session says otherwise.
    """
    if spark.conf.get(_BATCH_ROWS) == "10000":  # Spark's default
        spark.conf.set(_BATCH_ROWS, "1000")
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        folder = tempfile.mkdtemp()
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/lapline", "zip", root, "lapline"))
        _shipped.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; where it is unset, a local session gets its own."""
    ensure_checkpoint_dir(spark)
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` materialised in the shared checkpoint folder, partitions and order kept."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/lapline-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(taken: Sequence[str], name: str) -> str:
    """``name``, or with underscores before it: a column name that none of ``taken`` equals, letter case aside."""
    have = {x.lower() for x in taken}
    while name.lower() in have:
        name = "_" + name
    return name


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return (F.crc32(text.cast("binary")) % modulus).cast("int")


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def pieces(batch: pa.RecordBatch, column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``limit`` bytes of ``column`` each (one row at least)."""
    sizes = np.asarray(
        pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    part = np.cumsum(sizes) // limit if len(sizes) else sizes
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else []
    for a, b in zip(starts, [*starts[1:], len(part)], strict=False):
        yield batch.slice(int(a), int(b - a))


def with_columns(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], list]], fields: Sequence[tuple[str, T.DataType]],
    text_col: str, limit: int = 8 << 20,
) -> DataFrame:
    """Append columns computed in Arrow batches; same-named columns of ``df`` are replaced.

    ``make`` runs once for each task and returns a function from a batch to
    one array (or list) for each of ``fields``; a batch has about ``limit`` bytes of text.
    """
    names = {n for n, _ in fields}
    keep = [f for f in df.schema.fields if f.name not in names]
    schema = T.StructType([*keep, *(T.StructField(n, t) for n, t in fields)])
    kept_names, types = [f.name for f in keep], [_ARROW[type(t)] for _, t in fields]

    def run(batches):
        compute = make()
        for whole in batches:
            for batch in pieces(whole, text_col, limit):
                made = compute(batch)
                arrays = [batch.column(batch.schema.get_field_index(n)) for n in kept_names]
                arrays += [pa.array(x, type=t) for x, t in zip(made, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*kept_names, *(n for n, _ in fields)])

    return df.mapInArrow(run, schema)


_ARROW = {
    T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64(),
    T.StringType: pa.string(), T.BooleanType: pa.bool_(), T.BinaryType: pa.binary(),
}


def running_total(df: DataFrame, group: str, order: Sequence[str], value: str, out: str) -> DataFrame:
    """Append ``out``: the sum of ``value`` over the earlier rows of the same ``group``.

    Rows are range-sorted by (group, order), so that a group may span any
    number of partitions; it is never brought together.  One row for each
    partition goes to the driver: only the first group of a partition can
    have begun in an earlier one.  ``group`` is a long, ``value`` a long; no
    nulls.  The result keeps the range order.
    """
    ordered = cut(df.repartitionByRange(group, *order).sortWithinPartitions(group, *order))
    edge_schema = "pid int, first long, first_sum long, last long, last_sum long"

    def edges(batches):
        from pyspark import TaskContext

        first = last = None
        first_sum = last_sum = 0
        for batch in batches:
            g = np.asarray(batch.column(0))
            v = np.asarray(batch.column(1))
            if not len(g):
                continue
            if first is None:
                first = last = int(g[0])
            first_sum += int(v[g == first].sum())
            end = int(g[-1])
            last_sum = int(v[g == end].sum()) + (last_sum if end == last else 0)
            last = end
        if first is not None:
            row = [TaskContext.get().partitionId(), first, first_sum, last, last_sum]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip(row, [pa.int32(), *[pa.int64()] * 4], strict=True)],
                names=["pid", "first", "first_sum", "last", "last_sum"])

    narrow = ordered.select(F.col(group).cast("long").alias("g"), F.col(value).cast("long").alias("v"))
    carry, before = {}, None
    for r in sorted(narrow.mapInArrow(edges, edge_schema).collect(), key=lambda r: r.pid):
        brought = before[1] if before and before[0] == r.first else 0
        carry[r.pid] = brought
        before = (r.last, r.last_sum + (brought if r.first == r.last else 0))
    sent = df.sparkSession.sparkContext.broadcast(carry)
    columns = ordered.columns
    schema = T.StructType([*ordered.schema.fields, T.StructField(out, T.LongType())])

    def totals(batches):
        from pyspark import TaskContext

        at, total = None, sent.value.get(TaskContext.get().partitionId(), 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            g = np.asarray(batch.column(batch.schema.get_field_index(group))).astype(np.int64)
            v = np.asarray(batch.column(batch.schema.get_field_index(value))).astype(np.int64)
            start = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
            length = np.diff(np.r_[start, len(g)])
            before = np.cumsum(v) - v
            base = np.repeat(before[start], length)
            result = before - base
            if at is None or int(g[0]) == at:
                result[: length[0]] += total
            total = int(result[-1] + v[-1])
            at = int(g[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(result)], names=[*columns, out])

    return ordered.mapInArrow(totals, schema)


#: A key is hot if it holds this part of all rows or more; there are at most this many such keys.
HOT_SHARE = 4096


def skewed_join(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """``left`` joined with ``right`` (one row for each ``key``), whatever part of ``left`` one key holds.

    Keys of at least one row in ``HOT_SHARE`` are found by a count that is
    pre-aggregated map-side; there can be no more than ``HOT_SHARE`` of them, so
    their rows of ``right`` are broadcast.  All others meet in a plain join.
    ``left`` is read three times: pass a stored table.  Null keys match nothing.
    """
    sizes = left.groupBy(key).agg(F.count("*").alias("n"))
    total = left.count()
    hot = sizes.where((F.col("n") * HOT_SHARE >= total) & F.col(key).isNotNull()).select(key)
    rows = [(r[0],) for r in hot.collect()]
    schema = T.StructType([T.StructField(key, left.schema[key].dataType)])
    few = F.broadcast(left.sparkSession.createDataFrame(rows, schema))
    by_broadcast = left.join(few, key, "left_semi").join(F.broadcast(right.join(few, key, "left_semi")), key, how)
    return by_broadcast.unionByName(left.join(few, key, "left_anti").join(right, key, how))
