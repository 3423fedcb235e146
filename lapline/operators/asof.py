"""Forward as-of join by key (J1) as a skew-safe window plan.

Semantics: every left row is kept; it receives the carry columns of the
first right row with the same ``by`` key whose ``on`` value is >= the left
row's ``on`` value (an exact match counts).  Among right rows with equal
``on`` the one with the smallest ``tie`` value wins.  Left rows with a null
key or a null ``on`` value, or with no right row at or after them, get
nulls.

Plan (no Python, no pairs):

1. Layout: one partial aggregation counts the left rows of each key; keys
   above ``rows_per_bucket`` are cut into equal-depth time buckets
   (``operators/buckets.py``).  Rows without key or time get salted buckets
   of their own.
2. Phase 1: union of left and right rows; one window per ``(key, bucket)``
   ordered by time *descending* carries the nearest right row forward with
   ``last(ignorenulls)`` -- linear per partition, one exchange of the left
   rows.
3. Phase 2, for keys with several buckets: left rows still unmatched at the
   end of their bucket take the first right row of any later bucket.  That
   table is built from the right side alone, one row per bucket.  Without
   such keys there is no later bucket, and the step is left out.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapline.operators.buckets import BUCKET, sized, time_layout

DEFAULT_ROWS_PER_BUCKET = 1_000_000

_T = "__asof_t"
_S = "__asof_side"
_M = "__asof_match"
_N = "__asof_next"
_L = "__asof_local"


def asof_forward(
    left: DataFrame,
    right: DataFrame,
    on: str,
    by: Sequence[str],
    carry: Sequence[str],
    tie: Sequence[str] = (),
    right_on: str | None = None,
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
) -> DataFrame:
    by = list(by)
    right_on = right_on or on
    out_cols = left.columns
    clash = [c for c in carry if c in out_cols]
    if clash:
        raise ValueError(f"carry columns already on the left side: {clash}")

    # 1. layout and buckets
    t = F.col(on).cast("double")
    layout = time_layout(left, by, t, rows_per_bucket)
    lhs = layout.assign(left.withColumn(_T, t), F.col(_T))
    if layout.invalid:
        valid = F.col(_T).isNotNull()
        for k in by:
            valid = valid & F.col(k).isNotNull()
        salts = math.ceil(layout.invalid / rows_per_bucket)
        salted = -1 - F.pmod(F.monotonically_increasing_id(), F.lit(salts))
        lhs = lhs.withColumn(BUCKET, F.when(valid, F.col(BUCKET)).otherwise(salted))
    rvalid = F.col(right_on).isNotNull()
    for k in by:
        rvalid = rvalid & F.col(k).isNotNull()
    match = F.struct(
        F.col(right_on).cast("double").alias(_T),
        *[F.col(c).alias(f"__tie_{i}") for i, c in enumerate(tie)],
        *[F.col(c) for c in carry],
    )
    rhs = right.where(rvalid).select(*by, F.col(right_on).cast("double").alias(_T), match.alias(_M))
    rhs = layout.assign(rhs, F.col(_T))

    # 2. phase 1: nearest right row at or after each left row, inside the bucket
    match_type = rhs.schema[_M].dataType
    u = lhs.withColumn(_S, F.lit(0)).withColumn(_M, F.lit(None).cast(match_type)).unionByName(
        rhs.withColumn(_S, F.lit(1)), allowMissingColumns=True)
    single = layout.table is None and not layout.invalid
    w = (Window.partitionBy(*by, *([] if single else [BUCKET]))
         .orderBy(F.col(_T).desc(), F.col(_S).desc(), F.col(_M).desc_nulls_last())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    matched = u.withColumn(_L, F.last(_M, ignorenulls=True).over(w)).where(F.col(_S) == 0)

    # 3. phase 2: first right row of any later bucket of the same key
    found = F.col(_L)
    if layout.table is not None:
        firsts = rhs.groupBy(*by, BUCKET).agg(F.min(_M).alias(_M))
        later = (Window.partitionBy(*by).orderBy(F.col(BUCKET).desc())
                 .rowsBetween(Window.unboundedPreceding, -1))
        nxt = (layout.buckets().join(firsts, [*by, BUCKET], "left")
               .select(*by, BUCKET, F.min(_M).over(later).alias(_N)))
        matched = matched.join(sized(nxt, layout.entries), [*by, BUCKET], "left")
        found = F.coalesce(found, F.col(_N))
    return matched.withColumn(_M, found).select(*out_cols, *[F.col(f"{_M}.{c}").alias(c) for c in carry])
