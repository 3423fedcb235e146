"""Frequency tables and cluster profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapline.schemas import COMPOUND_LEVELS


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of each value (null included as its own row)."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def cluster_crosstab(df: DataFrame, cluster: str = "cluster", compound: str = "compound",
                     levels: Sequence[str] = COMPOUND_LEVELS, focus: str = "soft") -> DataFrame:
    """Laps per cluster and compound, total, share of ``focus`` in %, and
    the overall share for comparison.  The pivot has fixed levels, so no
    extra job discovers them; the result has one row per cluster, so the
    overall share is a window over that small table."""
    piv = (df.groupBy(cluster).pivot(compound, list(levels)).agg(F.count(F.lit(1)))
           .na.fill(0, subset=list(levels)))
    total = sum((F.col(v) for v in levels), F.lit(0))
    out = piv.select(cluster, *[F.col(v).cast("long").alias(f"n_{v}") for v in levels],
                     total.cast("long").alias("n_total"))
    share = 100.0 * F.col(f"n_{focus}") / F.col("n_total")
    everything = Window.partitionBy(F.lit(0))  # one row per cluster: bounded
    overall = 100.0 * F.sum(f"n_{focus}").over(everything) / F.sum("n_total").over(everything)
    return out.select("*", share.alias(f"pct_{focus}"), overall.alias(f"overall_pct_{focus}"))


def compound_spread(crosstab: DataFrame, focus: str = "soft") -> DataFrame:
    """A10: spread (max - min, percentage points) of the focus share."""
    c = F.col(f"pct_{focus}")
    return crosstab.agg((F.max(c) - F.min(c)).alias(f"spread_pct_{focus}"),
                        F.count(F.lit(1)).alias("n_clusters"))


def mean_top_probability(df: DataFrame, probability: str = "probability") -> DataFrame:
    """A10: mean of the largest component probability per row."""
    col = F.col(probability)
    if df.schema[probability].dataType.typeName() == "vector":
        from pyspark.ml.functions import vector_to_array
        col = vector_to_array(col)
    return df.agg(F.avg(F.array_max(col)).alias("mean_top_probability"))


def cluster_profile(clusters: DataFrame, laps: DataFrame, cluster: str = "cluster",
                    keys: Sequence[str] = ("driver", "lap_number")) -> DataFrame:
    """A9 + J4: join cluster labels to laps, then mean lap number, mean tyre
    life and the most common stint (smallest on ties) per cluster."""
    lap_cols = laps.select(*keys, "tyre_life", "stint")
    j = clusters.select(*keys, cluster).join(lap_cols, list(keys), "inner")
    return j.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n_laps"),
        F.avg("lap_number").alias("mean_lap_number"),
        F.avg("tyre_life").alias("mean_tyre_life"),
        F.mode("stint", deterministic=True).alias("stint_mode"),
    )
