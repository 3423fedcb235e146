"""Shape the generated benchmark tables into raw lap / telemetry / result
tables (and a scored table for the metric queries).

Every adapter reads whole tables; the derived columns are deterministic
functions of the input rows, so the DuckDB oracle can rebuild them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapline.operators.sequence import number_within_key
from lapline.session import table_path

EPOCH = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"

# Calendar of the derived result table, one event per month.
EVENT_NAMES = (
    "Bahrain Grand Prix", "Saudi Arabian Grand Prix", "Australian Grand Prix",
    "Japanese Grand Prix", "Miami Grand Prix", "Monaco Grand Prix",
    "British Grand Prix", "Belgian Grand Prix", "Azerbaijan Grand Prix",
    "Singapore Grand Prix", "Las Vegas Grand Prix", "Abu Dhabi Grand Prix",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _t() -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, {EPOCH}, ts)") / F.lit(1e6)


def _since_epoch() -> Column:
    return F.col("ts") - F.expr(EPOCH)


def raw_laps_from_events(events: DataFrame) -> DataFrame:
    """Purchases become lap ends of driver 'U<user_id>' (raw lap schema).

    The lap number is the per-user order of (ts, event_id), computed with
    per-user time buckets so a hot user is not one task.
    """
    purchases = (events.where(F.col("event_type") == "purchase")
                 .select("user_id", "ts", "event_id", _k().alias("k")))
    base = number_within_key(purchases, ["user_id"], _t(), ["ts", "event_id"], "ts",
                             number="n", previous="prev_ts")
    n = F.col("n")
    k = F.col("k")
    lap_time = F.col("ts") - F.col("prev_ts")
    compound = (F.when(k % 3 == 0, "SOFT").when(k % 3 == 1, "MEDIUM").otherwise("HARD"))
    status = (F.when(k % 5 == 0, "2").when(k % 7 == 0, "12").otherwise("1"))
    return base.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("Driver"),
        F.col("user_id").cast("string").alias("DriverNumber"),
        F.concat(F.lit("T"), (F.col("user_id") % 10).cast("string")).alias("Team"),
        n.cast("double").alias("LapNumber"),
        _since_epoch().alias("Time"),
        lap_time.alias("LapTime"),
        lap_time.alias("Sector1Time"),
        F.lit(None).cast("interval day to second").alias("Sector2Time"),
        F.lit(None).cast("interval day to second").alias("Sector3Time"),
        (F.lit(1) + F.floor((n - 1) / 5)).cast("double").alias("Stint"),
        compound.alias("Compound"),
        (F.lit(1) + (n - 1) % 5).cast("double").alias("TyreLife"),
        ((n - 1) % 5 == 0).alias("FreshTyre"),
        status.alias("TrackStatus"),
        (F.lit(1) + F.col("user_id") % 20).cast("double").alias("Position"),
        (k % 11 != 0).alias("IsAccurate"),
        F.when(k % 13 == 0, F.lit(None).cast("boolean")).otherwise(k % 17 == 0).alias("Deleted"),
        F.when(n % 5 == 0, _since_epoch()).alias("PitInTime"),
        F.when((n % 5 == 1) & (n > 1), _since_epoch()).alias("PitOutTime"),
    )


def raw_telemetry_from_events(events: DataFrame) -> DataFrame:
    """All non-purchase events become samples (raw telemetry + driver)."""
    k = F.col("k")
    et = F.col("event_type")
    return (
        events.where(F.col("event_type") != "purchase")
        .select("user_id", "ts", "event_type", "value", _k().alias("k"))
        .select(
            F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("driver"),
            F.col("ts").alias("Date"),
            _since_epoch().alias("Time"),
            _since_epoch().alias("SessionTime"),
            F.col("value").alias("Speed"),
            (F.lit(9000) + 30 * k).cast("double").alias("RPM"),
            (F.lit(1) + k % 8).cast("int").alias("nGear"),
            F.when(k >= 95, F.lit(104.0)).otherwise(k.cast("double")).alias("Throttle"),
            (et == "error").alias("Brake"),
            F.when(et == "click", F.lit(12)).otherwise(F.lit(0)).alias("DRS"),
            et.alias("Source"),
            (F.col("value") * 10).alias("X"),
            (k * 10).cast("double").alias("Y"),
            F.lit(0.0).alias("Z"),
            F.when(et == "signup", "OffTrack").otherwise("OnTrack").alias("Status"),
        )
    )


def schedule(spark: SparkSession) -> DataFrame:
    """Bounded calendar table (12 rows): month -> event name.

    Spark can't tell the size of a table made from Python rows and would
    exchange and sort the results by round; hence the hint.
    """
    rows = [(i + 1, name, False) for i, name in enumerate(EVENT_NAMES)]
    return F.broadcast(spark.createDataFrame(rows, "round_number int, event_name string, is_testing boolean"))


def raw_results_from_orders(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Orders of a customer become race classifications.

    season/round = year/month of the order date; team = 'N<nationkey>'.
    """
    ok = F.col("o_orderkey")
    status = (
        F.when(F.col("o_orderstatus") == "F", "Finished")
        .when(F.col("o_orderstatus") == "O", "Lapped")
        .when(ok % 3 == 0, "Retired")
        .when(ok % 3 == 1, "Did not start")
        .otherwise("Disqualified")
    )
    finished = F.col("o_orderstatus").isin("F", "O")
    position = F.when(finished, (F.lit(1) + (7 * ok) % 20).cast("double"))
    grid = (F.lit(1) + ok % 20).cast("double")
    q1 = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(1), ((ok % 1000) / 100).cast("decimal(18,6)"))
    race = F.make_dt_interval(F.lit(0), F.lit(1), F.lit(30), (ok % 3600).cast("decimal(18,6)"))
    cust = customer.select("c_custkey", "c_name", "c_nationkey")
    return (
        orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
        .join(cust, F.col("o_custkey") == F.col("c_custkey"), "inner")
        .select(
            F.year("o_orderdate").alias("season"),
            F.month("o_orderdate").alias("round_number"),
            F.col("o_orderkey").alias("entry_id"),
            F.col("o_custkey").cast("string").alias("DriverNumber"),
            F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("Abbreviation"),
            F.col("c_name").alias("FullName"),
            F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("TeamName"),
            F.concat(F.lit("CC"), F.col("c_nationkey").cast("string")).alias("CountryCode"),
            position.alias("Position"),
            F.coalesce(position.cast("int").cast("string"), F.lit("R")).alias("ClassifiedPosition"),
            grid.alias("GridPosition"),
            q1.alias("Q1"),
            F.when(grid <= 15, q1).alias("Q2"),
            F.when(grid <= 10, q1).alias("Q3"),
            F.when(finished, race).alias("Time"),
            status.alias("Status"),
            F.col("o_totalprice").alias("Points"),
            (F.lit(50) - ok % 7).cast("double").alias("Laps"),
        )
    )


def scored_lineitems(lineitem: DataFrame) -> DataFrame:
    """Binary and 3-class scores derived from line items (no fitted model).

    group = supplier, fold = supplier % 5, label = return flag 'R',
    probability = rounded mix of discount and quantity (heavy ties).
    """
    q = F.col("l_quantity")
    return lineitem.select(
        F.col("l_suppkey").alias("grp"),
        (F.col("l_suppkey") % 5).cast("int").alias("fold"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        F.round(0.5 * F.col("l_discount") / 0.10 + 0.5 * q / 50, 6).alias("probability"),
        F.col("l_returnflag").alias("truth"),
        F.when(q <= 17, "A").when(q <= 34, "N").otherwise("R").alias("prediction"),
    )


def pace_laps_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Large normalised-lap-like table for the pace model."""
    rf = F.col("l_returnflag")
    return lineitem.select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("driver"),
        (F.col("l_suppkey") % 5).cast("int").alias("fold"),
        F.col("l_linenumber").cast("double").alias("lap_number"),
        F.col("l_quantity").alias("tyre_life"),
        F.when(rf == "A", "soft").when(rf == "N", "medium").otherwise("hard").alias("compound"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("lap_time_s"),
    )
