"""Per-key position and predecessor in time order, split for hot keys.

``row_number()`` and ``lag()`` over ``Window.partitionBy(key)`` put every
row of a key into one task.  Here keys with more than ``rows_per_bucket``
rows are cut into equal-depth time buckets (``operators/buckets.py``);
numbering and ``lag`` run per (key, bucket), and each bucket is shifted by
the row count of the earlier buckets of its key, taken from a table with
one row per bucket.  The predecessor of a bucket's first row is the latest
time of the earlier buckets.  Without hot keys one window does it all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapline.operators.buckets import BUCKET, time_layout

DEFAULT_ROWS_PER_BUCKET = 1_000_000


def number_within_key(df: DataFrame, by: Sequence[str], t: Column, order: Sequence[str],
                      lag_col: str, number: str = "n", previous: str = "prev",
                      rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET) -> DataFrame:
    """Add ``number`` (1-based position of the row inside its key, ordered
    by ``order``) and ``previous`` (``lag_col`` of the preceding row).

    ``t`` is a double time coordinate that is non-decreasing in ``order``
    (used only to cut buckets); ``lag_col`` must be non-decreasing in
    ``order`` as well (the predecessor across a bucket border is the
    maximum of the earlier buckets).
    """
    by = list(by)
    layout = time_layout(df, by, t, rows_per_bucket)
    if layout.table is None:
        w = Window.partitionBy(*by).orderBy(*order)
        return df.withColumn(number, F.row_number().over(w)).withColumn(previous, F.lag(lag_col).over(w))
    x = layout.assign(df, t)
    w = Window.partitionBy(*by, BUCKET).orderBy(*order)
    x = x.withColumn("__ln", F.row_number().over(w)).withColumn("__lp", F.lag(lag_col).over(w))
    per_bucket = x.groupBy(*by, BUCKET).agg(F.count(F.lit(1)).alias("__c"), F.max(lag_col).alias("__mx"))
    wb = Window.partitionBy(*by).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(*by, BUCKET, F.coalesce(F.sum("__c").over(wb), F.lit(0)).alias("__off"),
                                F.max("__mx").over(wb).alias("__pmx"))
    x = x.join(offsets, [*by, BUCKET], "left")
    return (x.withColumn(number, (F.col("__ln") + F.col("__off")).cast("int"))
            .withColumn(previous, F.coalesce(F.col("__lp"), F.col("__pmx")))
            .drop(BUCKET, "__ln", "__lp", "__off", "__pmx"))
