"""Distributed running totals over an ordered column.

A running sum over a whole table ordered by one column is a window without
``partitionBy``: Spark moves every row into one task.  Here the table is
written once to the checkpoint folder and counted, range-partitioned into
``ceil(rows / rows_per_range)`` ranges of the order column, and summed
inside each range (one window per range, in parallel); each range is
shifted by the total of the ranges before it, which comes from a table
with one row per range.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapline.operators.buckets import sized
from lapline.session import ensure_checkpoint_dir

DEFAULT_ROWS_PER_RANGE = 1_000_000
_R = "__range"


def running_totals(df: DataFrame, order_col: str, value_cols: Sequence[str],
                   descending: bool = False, n_ranges: int | None = None,
                   prefix: str = "cum_", rows_per_range: int = DEFAULT_ROWS_PER_RANGE) -> DataFrame:
    """Add ``cum_<v>``: sum of ``v`` over rows whose ``order_col`` comes at
    or before this row's (inclusive), and ``total_<v>``: the grand total.

    ``order_col`` must be unique (aggregate to distinct values first) and
    not null.  ``n_ranges`` overrides the counted number of ranges.
    """
    ensure_checkpoint_dir(df.sparkSession)
    sign = -1.0 if descending else 1.0
    key = "__ord"
    # read by the count, the range bounds and the sums: computed once
    base = df.withColumn(key, F.col(order_col).cast("double") * F.lit(sign)).checkpoint()
    n_ranges = n_ranges or max(1, math.ceil(base.count() / rows_per_range))
    if n_ranges == 1:
        ranged = base.withColumn(_R, F.lit(0))
    else:
        # range bounds come from a sample: cut, so that every reader sees the same
        ranged = base.repartitionByRange(n_ranges, key).withColumn(_R, F.spark_partition_id()).checkpoint()
    w = (Window.partitionBy(_R).orderBy(key)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.select("*", *[F.sum(v).over(w).alias(f"__loc_{v}") for v in value_cols])
    totals = ranged.groupBy(_R).agg(*[F.sum(v).alias(f"__tot_{v}") for v in value_cols])
    # one row per range: rows / rows_per_range of them
    wt = Window.partitionBy(F.lit(0)).orderBy(_R)
    wall = Window.partitionBy(F.lit(0))
    offsets = totals.select(
        _R,
        *[F.coalesce(F.sum(f"__tot_{v}").over(wt.rowsBetween(Window.unboundedPreceding, -1)),
                     F.lit(0)).alias(f"__off_{v}") for v in value_cols],
        *[F.sum(f"__tot_{v}").over(wall).alias(f"total_{v}") for v in value_cols],
    )
    out = local.join(sized(offsets, n_ranges), _R, "inner")
    return out.select(
        *[F.col(c) for c in df.columns],
        *[(F.col(f"__loc_{v}") + F.col(f"__off_{v}")).alias(f"{prefix}{v}") for v in value_cols],
        *[F.col(f"total_{v}") for v in value_cols],
    )


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Add ``name``: the row's place, from 0, in the order of ``order``.

    Rows are range-sorted and cut in the checkpoint folder, so that a row
    keeps its partition; places within a partition are shifted by the row
    counts of the partitions before it (one row for each partition).
    """
    ensure_checkpoint_dir(df.sparkSession)
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("__pid"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("__pos")).checkpoint()
    before = Window.partitionBy(F.lit(0)).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ordered.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n")).select(
        "__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    # one row for each partition
    return ordered.join(F.broadcast(offsets), "__pid").withColumn(name, F.col("__off") + F.col("__pos")) \
        .drop("__pid", "__pos", "__off")
