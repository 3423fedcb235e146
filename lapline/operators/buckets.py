"""Equal-depth time buckets for hot keys, shared by the as-of join and the
per-key numbering.

A window over one key puts every row of the key into one task.  A key with
more than ``rows_per_bucket`` rows is therefore cut into
``ceil(n / rows_per_bucket)`` time ranges at approximate percentiles of its
own times, so a burst is split as well; only equal times stay together.  A
key at or below the bound has the single bucket 0 and needs no layout row:
the layout table holds hot keys only.

Layout jobs: one partial aggregation that counts rows for each key, and,
only if some key is hot, one percentile aggregation over the rows of the
hot keys.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapline.session import ensure_checkpoint_dir

BUCKET = "__bucket"
# a layout of at most this many edges (8 bytes each) is broadcast, a larger
# one is left to Spark's own choice of join
BROADCAST_EDGES = 2_000_000


def sized(df: DataFrame, entries: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted entries are few."""
    return F.broadcast(df) if entries <= BROADCAST_EDGES else df


@dataclass
class Layout:
    """``table``: (keys, __heads, __blocks), a row for each hot key, or None;
    ``entries``: bound on the edges in it; ``invalid``: rows without key or time."""
    by: list[str]
    table: DataFrame | None
    entries: int
    invalid: int

    def assign(self, df: DataFrame, t: Column) -> DataFrame:
        """Add ``__bucket``: the number of the key's edges below ``t``."""
        if self.table is None:
            return df.withColumn(BUCKET, F.lit(0).cast("long"))
        joined = df.withColumn("__bt", t).join(sized(self.table, self.entries), self.by, "left")
        t = F.col("__bt")
        block = F.size(F.filter("__heads", lambda e: e < t))
        inside = F.size(F.filter(F.coalesce(F.get("__blocks", block), F.array().cast("array<double>")),
                                 lambda e: e < t))
        bucket = F.when(F.col("__heads").isNull(), 0).otherwise(block * F.size(F.get("__blocks", F.lit(0))) + inside)
        return joined.withColumn(BUCKET, bucket.cast("long")).drop("__heads", "__blocks", "__bt")

    def buckets(self) -> DataFrame:
        """(keys, __bucket): every bucket of every hot key."""
        n_edges = F.aggregate("__blocks", F.lit(0), lambda a, b: a + F.size(b)).cast("long")
        return self.table.select(*self.by, F.explode(F.sequence(F.lit(0).cast("long"), n_edges)).alias(BUCKET))


def time_layout(df: DataFrame, by: Sequence[str], t: Column, rows_per_bucket: int) -> Layout:
    """Count the rows of each key and cut the hot keys into buckets."""
    by = list(by)
    valid = t.isNotNull()
    for k in by:
        valid = valid & F.col(k).isNotNull()
    counts = df.groupBy(*by).agg(F.count(F.when(valid, 1)).alias("__n"),
                                 F.count(F.when(~valid, 1)).alias("__m"))
    hot = F.col("__n") > rows_per_bucket
    row = counts.agg(F.max("__n").alias("most"), F.sum("__m").alias("invalid"),
                     F.sum(F.when(hot, F.ceil(F.col("__n") / rows_per_bucket))).alias("entries")).first()
    invalid = row["invalid"] or 0
    if not row["entries"]:
        return Layout(by, None, 0, invalid)
    # edges at i/k of the hottest key's own count; smaller hot keys keep every step-th
    k = math.ceil(row["most"] / rows_per_bucket)
    hot_keys = counts.where(hot).select(*by, "__n")
    rows = df.where(valid).select(*by, t.alias("__t")).join(
        sized(hot_keys.select(*by), row["entries"]), by, "left_semi")
    edges = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("__n"),
        F.percentile_approx("__t", [i / k for i in range(1, k)], max(10_000, 20 * k)).alias("__e"))
    step = F.floor(F.lit(k) / F.ceil(F.col("__n") / rows_per_bucket)).cast("int")
    kept = edges.withColumn("__step", step).withColumn(
        "__e", F.array_distinct(F.expr("filter(__e, (e, i) -> (i + 1) % __step = 0)")))
    # two levels, so that a look-up reads about 2 sqrt(edges) of them
    blocks = kept.withColumn("__w", F.greatest(F.lit(1), F.ceil(F.sqrt(F.size("__e"))).cast("int"))).withColumn(
        "__blocks", F.expr("transform(sequence(0, greatest(0, cast(ceil(size(__e) / __w) as int) - 1)), "
                           "i -> slice(__e, i * __w + 1, __w))"))
    heads = F.transform(F.expr("slice(__blocks, 1, greatest(0, size(__blocks) - 1))"), lambda b: F.element_at(b, -1))
    ensure_checkpoint_dir(df.sparkSession)
    table = blocks.select(*by, heads.alias("__heads"), "__blocks").checkpoint()
    return Layout(by, table, row["entries"], invalid)
