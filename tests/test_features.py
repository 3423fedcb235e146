import numpy as np
import pytest

from lapline.operators import features

RES = "season int, team string, round_number int, driver string, dnf boolean"


def test_team_reliability_no_same_round_leak(spark):
    rows = [(2024, "A", 1, "a1", True), (2024, "A", 1, "a2", False),
            (2024, "B", 1, "b1", False), (2024, "B", 1, "b2", False),
            (2024, "A", 2, "a1", False), (2024, "A", 2, "a2", True),
            (2024, "B", 2, "b1", False), (2024, "B", 2, "b2", False)]
    out = features.compute_team_reliability_feature(spark.createDataFrame(rows, RES)).collect()
    got = {(r.team, r.round_number, r.driver): r.team_reliability for r in out}
    assert got[("A", 1, "a1")] is None and got[("B", 1, "b1")] is None
    assert got[("A", 2, "a1")] == 0.5 and got[("A", 2, "a2")] == 0.5
    assert got[("B", 2, "b2")] == 0.0


def test_team_reliability_mean_of_prior_rounds(spark):
    rows = [(2024, "A", r, d, v) for r, v in [(1, True), (2, False), (3, False)] for d in ("x", "y")]
    out = {r.round_number: r.team_reliability for r in
           features.compute_team_reliability_feature(spark.createDataFrame(rows, RES)).collect()}
    assert out == {1: None, 2: 1.0, 3: 0.5}


def test_fill_missing_reliability_over_rows(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, 0.5), (4, 0.0)], "i int, team_reliability double")
    got = [r.team_reliability for r in features.fill_missing_team_reliability(df).orderBy("i").collect()]
    assert got == [0.25, 0.25, 0.5, 0.0]


def test_dnf_features_exclude_outcomes(spark):
    df = spark.createDataFrame([("V", "A", 1.0, 1.0, 25.0, "Finished", False),
                                ("H", "B", 5.0, None, 0.0, "Retired", True)],
                               "driver string, team string, grid_position double, position double, "
                               "points double, status string, dnf boolean")
    out = features.build_dnf_features(df)
    assert set(out.columns) == {"group", "grid_position", "team_A", "team_B", "label"}


def test_pace_features_fixed_one_hot(spark):
    df = spark.createDataFrame([("V", 3.0, 1.0, "soft", 90.0), ("V", 4.0, 2.0, "intermediate", 91.0)],
                               "driver string, tyre_life double, lap_number double, compound string, "
                               "lap_time_s double")
    rows = features.build_pace_features(df).orderBy("lap_number").collect()
    assert (rows[0].compound_soft, rows[0].compound_medium, rows[0].compound_hard) == (1.0, 0.0, 0.0)
    assert (rows[1].compound_soft, rows[1].compound_medium, rows[1].compound_hard) == (0.0, 0.0, 0.0)


def test_centering_and_delta(spark):
    rows = [("A", 1.0, "soft", 295.0), ("A", 2.0, "soft", 300.0),
            ("B", 1.0, "hard", 250.0), ("B", 2.0, "hard", 255.0)]
    cols = ["mean_speed_kmh"]
    df = spark.createDataFrame(rows, "driver string, lap_number double, compound string, mean_speed_kmh double")
    out = features.build_driving_style_features(df, relative_to_driver=True, columns=cols)
    assert sorted(r.mean_speed_kmh for r in out.collect()) == [-2.5, -2.5, 2.5, 2.5]
    d = features.compute_driver_delta_target(df.withColumnRenamed("mean_speed_kmh", "lap_time_s"))
    assert sorted(r.lap_time_delta_s for r in d.collect()) == [-2.5, -2.5, 2.5, 2.5]


def test_detrend_recovers_injected_effect(spark):
    rng = np.random.default_rng(0)
    rows = []
    for d, base in [("A", 300.0), ("B", 280.0)]:
        comp = np.array(["soft", "hard"] * 10)
        rng.shuffle(comp)
        for lap in range(1, 21):
            c = comp[lap - 1]
            rows.append((d, float(lap), c, base + 0.5 * lap + (3.0 if c == "soft" else 0.0)))
    df = spark.createDataFrame(rows, "driver string, lap_number double, compound string, mean_speed_kmh double")
    out = features.build_driving_style_features(df, detrend_lap_number=True,
                                                columns=["mean_speed_kmh"]).toPandas()
    spread = (out[out.compound == "soft"].mean_speed_kmh.mean()
              - out[out.compound == "hard"].mean_speed_kmh.mean())
    assert spread > 2.5
    ref = []
    for d in ("A", "B"):
        g = [r for r in rows if r[0] == d]
        x = np.array([r[1] for r in g]); y = np.array([r[3] for r in g])
        b, a = np.polyfit(x, y, 1)
        ref += list(y - (b * x + a))
    assert sorted(np.round(out.mean_speed_kmh, 9)) == pytest.approx(sorted(np.round(ref, 9)))


def test_detrend_single_lap_driver(spark):
    df = spark.createDataFrame([("A", 1.0, "soft", 300.0)],
                               "driver string, lap_number double, compound string, mean_speed_kmh double")
    out = features.build_driving_style_features(df, detrend_lap_number=True, columns=["mean_speed_kmh"])
    assert out.collect()[0].mean_speed_kmh == 0.0
