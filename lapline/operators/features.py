"""Leak-free feature tables.

Per-driver statistics (means, regression slopes) are computed with a
``groupBy`` -- partial aggregation first, so a hot driver is pre-reduced
map-side -- and joined back on the key.  The per-key table is small
relative to the laps and AQE broadcasts it when its measured size is under
the threshold; otherwise a sort-merge join with skew splitting is used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapline.functions import eq_or_false, is_street_circuit, one_hot
from lapline.schemas import COMPOUND_LEVELS, RETIRED, STYLE_COLUMNS


# -- DNF history -------------------------------------------------------------

def team_round_dnf_rate(results: DataFrame, season_keys: Sequence[str] = ("season",)) -> DataFrame:
    """A2: DNF rate per (season, team, round): one number per round, so a
    team-mate in the same round cannot leak into the history."""
    keys = [*season_keys, "team", "round_number"]
    return (results.where(F.col("team").isNotNull())
            .groupBy(*keys).agg(F.avg(F.col("dnf").cast("double")).alias("dnf_rate")))


def team_reliability_table(results: DataFrame, season_keys: Sequence[str] = ("season",)) -> DataFrame:
    """W1 on the (small) team-round table: unweighted mean of the strictly
    earlier round rates of the same team and season; first round -> null."""
    rate = team_round_dnf_rate(results, season_keys)
    w = (Window.partitionBy(*season_keys, "team").orderBy("round_number")
         .rowsBetween(Window.unboundedPreceding, -1))
    return rate.withColumn("team_reliability", F.avg("dnf_rate").over(w))


def compute_team_reliability_feature(results: DataFrame,
                                     season_keys: Sequence[str] = ("season",)) -> DataFrame:
    """W1 + J3: every result row gets its team's prior-round reliability."""
    table = team_reliability_table(results, season_keys).drop("dnf_rate")
    return results.join(table, [*season_keys, "team", "round_number"], "left")


def fill_missing_team_reliability(df: DataFrame, column: str = "team_reliability") -> DataFrame:
    """T5: fill nulls with the mean over rows of the known values.

    The mean is one scalar (one aggregation job); all-null stays null.
    """
    mean = df.agg(F.avg(column)).first()[0]
    if mean is None:
        return df
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(float(mean))))


# -- targets -----------------------------------------------------------------

def build_retirement_target(results: DataFrame, name: str = "retired") -> DataFrame:
    """On-track retirement only (disqualification excluded)."""
    return results.withColumn(name, eq_or_false("status", RETIRED))


def compute_circuit_type_feature(results: DataFrame) -> DataFrame:
    """T4: street-circuit flag from the event name."""
    return results.withColumn("is_street_circuit", is_street_circuit("event_name"))


def compute_driver_delta_target(laps: DataFrame, session_keys: Sequence[str] = (),
                                column: str = "lap_time_s",
                                name: str = "lap_time_delta_s") -> DataFrame:
    """Lap time minus the driver's mean lap time; null driver -> null."""
    keys = [*session_keys, "driver"]
    means = (laps.where(F.col("driver").isNotNull()).groupBy(*keys)
             .agg(F.avg(column).alias("__mean")))
    return (laps.join(means, keys, "left")
            .withColumn(name, F.col(column) - F.col("__mean")).drop("__mean"))


# -- feature matrices --------------------------------------------------------

def build_pace_features(laps: DataFrame, keep: Sequence[str] = ("driver",),
                        target: str = "lap_time_s") -> DataFrame:
    """tyre_life, lap_number and the full fixed compound one-hot (no
    level dropped; an unknown compound is all zeros); label = lap time."""
    return laps.select(
        *[F.col(c) for c in keep],
        F.col("driver").alias("group"),
        F.col("tyre_life").cast("double").alias("tyre_life"),
        F.col("lap_number").cast("double").alias("lap_number"),
        *one_hot("compound", COMPOUND_LEVELS, "compound"),
        F.col(target).cast("double").alias("label"),
    )


def distinct_levels(df: DataFrame, column: str) -> list[str]:
    """Sorted distinct non-null values.  The wide matrix has a column for
    each, so the list is part of its schema; models take ``encode_levels``."""
    return sorted(r[0] for r in df.where(F.col(column).isNotNull()).select(column).distinct().collect())


def encode_levels(df: DataFrame, column: str, name: str) -> DataFrame:
    """Add ``name``: the one-hot of ``column`` as one sparse vector, levels in
    alphabetical order, no level dropped; a null is all zeros."""
    index = StringIndexer(inputCol=column, outputCol="__level", stringOrderType="alphabetAsc",
                          handleInvalid="keep")
    # "keep" adds a last level for nulls, which dropLast turns into zeros
    hot = OneHotEncoder(inputCol="__level", outputCol=name, dropLast=True, handleInvalid="error")
    return Pipeline(stages=[index, hot]).fit(df).transform(df).drop("__level")


def build_dnf_features(
    results: DataFrame,
    target_column: str = "dnf",
    *,
    include_team_reliability: bool = False,
    include_circuit_type: bool = False,
    keep: Sequence[str] = (),
    teams: Sequence[str] | None = None,
    season_keys: Sequence[str] = ("season",),
    sparse_teams: bool = False,
) -> DataFrame:
    """Grid position + one-hot of the observed teams (+ options).

    ``sparse_teams`` gives the teams as one sparse vector ``team_levels``
    (what the models take, at any number of teams) instead of a column for
    each team.

    Outcome columns (position, points, status, ...) never enter the
    features: only grid_position, team dummies and the two opt-in
    history / circuit features are built.
    """
    outcome = {"position", "classified_position", "points", "race_time_s",
               "laps_completed", "status", "positions_gained"}
    df = results
    if sparse_teams:
        df = encode_levels(df, "team", "team_levels")
        team_columns = [F.col("team_levels")]
    else:
        team_columns = one_hot("team", teams if teams is not None else distinct_levels(results, "team"), "team")
    extra = []
    if include_team_reliability:
        df = fill_missing_team_reliability(compute_team_reliability_feature(df, season_keys))
        extra.append(F.col("team_reliability").cast("double"))
    if include_circuit_type:
        extra.append(is_street_circuit("event_name").cast("double").alias("is_street_circuit"))
    feats = [F.col("grid_position").cast("double").alias("grid_position"),
             *team_columns, *extra]
    names = [c for c in df.select(*feats).columns]
    leaked = outcome.intersection(names)
    if leaked:
        raise ValueError(f"outcome columns in features: {sorted(leaked)}")
    return df.select(*[F.col(c) for c in keep], F.col("driver").alias("group"), *feats,
                     F.col(target_column).cast("double").alias("label"))


def build_tyre_features(summary: DataFrame, keep: Sequence[str] = ("driver", "lap_number")) -> DataFrame:
    """Six lap statistics; label = compound; group = driver."""
    return summary.select(*[F.col(c) for c in keep], F.col("driver").alias("group"),
                          *[F.col(c).cast("double") for c in STYLE_COLUMNS],
                          F.col("compound").alias("label"))


def build_driving_style_features(
    summary: DataFrame,
    *,
    relative_to_driver: bool = False,
    detrend_lap_number: bool = False,
    session_keys: Sequence[str] = (),
    columns: Sequence[str] = STYLE_COLUMNS,
) -> DataFrame:
    """T7 with W3 (centre by driver) or W4 (per-driver linear detrend on
    lap_number, which takes precedence).  Metadata (driver, lap_number,
    compound) comes from the unmodified summary."""
    keys = [*session_keys, "driver"]
    meta = [*session_keys, "driver", "lap_number", "compound"]
    if not (relative_to_driver or detrend_lap_number):
        return summary.select(*meta, *columns)
    aggs = [F.avg(c).alias(f"__m_{c}") for c in columns]
    if detrend_lap_number:
        # x mean over the rows where y is present, as the fit ignores null pairs
        aggs += [F.avg(F.when(F.col(c).isNotNull(), F.col("lap_number"))).alias(f"__mx_{c}")
                 for c in columns]
        aggs += [F.regr_slope(c, "lap_number").alias(f"__b_{c}") for c in columns]
    stats = summary.where(F.col("driver").isNotNull()).groupBy(*keys).agg(*aggs)
    joined = summary.join(stats, keys, "left")
    out = []
    for c in columns:
        centred = F.col(c) - F.col(f"__m_{c}")
        if detrend_lap_number:
            slope = F.coalesce(F.col(f"__b_{c}"), F.lit(0.0))
            centred = centred - slope * (F.col("lap_number") - F.col(f"__mx_{c}"))
        out.append(centred.alias(c))
    return joined.select(*meta, *out)
