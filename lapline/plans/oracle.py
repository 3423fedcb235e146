"""DuckDB oracle SQL for the registered queries.

The CTEs rebuild the adapter tables with plain SQL (same rules as
``lapline.sources.adapters``); each query then states the operator's
semantics directly.  Float outputs are rounded to 6 places on both sides.
"""

from __future__ import annotations

from lapline.plans.oracle_fits import fits
from lapline.plans.oracle_folds import fewest_rows, most_even
from lapline.sources.adapters import EVENT_NAMES

EV = """
ev AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         date_diff('microsecond', TIMESTAMP '2024-01-01 00:00:00', ts) / 1e6 AS t
  FROM events)"""

LAPS = EV + """,
lp AS (
  SELECT user_id, t, k,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n,
         date_diff('microsecond', lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts) / 1e6 AS lt
  FROM ev WHERE event_type = 'purchase'),
laps AS (
  SELECT 'U' || user_id AS driver, CAST(user_id AS VARCHAR) AS driver_number,
         'T' || (user_id % 10) AS team, CAST(n AS DOUBLE) AS lap_number,
         t AS session_time_s, lt AS lap_time_s, lt AS sector1_s,
         CAST(NULL AS DOUBLE) AS sector2_s, CAST(NULL AS DOUBLE) AS sector3_s,
         CAST(1 + (n - 1) // 5 AS DOUBLE) AS stint,
         CASE k % 3 WHEN 0 THEN 'soft' WHEN 1 THEN 'medium' ELSE 'hard' END AS compound,
         CAST(1 + (n - 1) % 5 AS DOUBLE) AS tyre_life,
         (n - 1) % 5 = 0 AS fresh_tyre,
         CASE WHEN k % 5 = 0 THEN '2' WHEN k % 7 = 0 THEN '12' ELSE '1' END AS track_status,
         CAST(1 + user_id % 20 AS DOUBLE) AS position,
         k % 11 <> 0 AS is_accurate,
         CASE WHEN k % 13 = 0 THEN NULL ELSE k % 17 = 0 END AS deleted,
         n % 5 = 0 AS is_pit_in_lap,
         n % 5 = 1 AND n > 1 AS is_pit_out_lap
  FROM lp),
green AS (
  SELECT * FROM laps
  WHERE coalesce(is_accurate, false) AND NOT coalesce(deleted, false)
    AND lap_time_s IS NOT NULL AND track_status = '1')"""

TEL = """,
tel AS (
  SELECT 'U' || user_id AS driver, ts AS "timestamp", t AS time_s, t AS session_time_s,
         value AS speed_kmh, CAST(9000 + 30 * k AS DOUBLE) AS rpm,
         CAST(1 + k % 8 AS INTEGER) AS gear,
         k >= 95 AS throttle_invalid,
         CASE WHEN k >= 95 THEN NULL ELSE CAST(k AS DOUBLE) END AS throttle_pct,
         event_type = 'error' AS brake,
         CAST(CASE WHEN event_type = 'click' THEN 12 ELSE 0 END AS INTEGER) AS drs,
         event_type AS source, value * 10 * 0.1 AS x_m, CAST(k * 10 AS DOUBLE) * 0.1 AS y_m,
         0.0 * 0.1 AS z_m, event_type <> 'signup' AS on_track
  FROM ev WHERE event_type <> 'purchase'),
tagged AS (
  SELECT tl.*, l.lap_number, l.compound
  FROM tel tl ASOF LEFT JOIN laps l
    ON tl.driver = l.driver AND tl.session_time_s <= l.session_time_s),
clean AS (
  SELECT * FROM tagged
  WHERE (driver, lap_number) IN (SELECT (driver, lap_number) FROM green)),
summary AS (
  SELECT driver, lap_number, min(compound) AS compound,
         avg(speed_kmh) AS mean_speed_kmh, max(speed_kmh) AS max_speed_kmh,
         avg(throttle_pct) AS mean_throttle_pct,
         avg(CAST(brake AS DOUBLE)) AS brake_fraction, avg(rpm) AS mean_rpm,
         avg(gear) AS mean_gear
  FROM clean WHERE lap_number IS NOT NULL
  GROUP BY driver, lap_number)"""

_EVENTS_VALUES = ", ".join(
    f"({i + 1}, '{name}')" for i, name in enumerate(EVENT_NAMES))

RES = """
res AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS season,
         CAST(month(o_orderdate) AS INTEGER) AS round_number,
         o_orderkey AS entry_id,
         'C' || o_custkey AS driver, CAST(o_custkey AS VARCHAR) AS driver_number,
         c_name AS driver_name, 'N' || c_nationkey AS team,
         'CC' || c_nationkey AS country_code,
         CASE WHEN o_orderstatus IN ('F', 'O') THEN CAST(1 + (7 * o_orderkey) % 20 AS DOUBLE) END AS position,
         coalesce(CAST(CASE WHEN o_orderstatus IN ('F', 'O') THEN 1 + (7 * o_orderkey) % 20 END AS VARCHAR), 'R') AS classified_position,
         CAST(1 + o_orderkey % 20 AS DOUBLE) AS grid_position,
         CAST(1 + o_orderkey % 20 AS DOUBLE)
           - CASE WHEN o_orderstatus IN ('F', 'O') THEN CAST(1 + (7 * o_orderkey) % 20 AS DOUBLE) END AS positions_gained,
         60 + (o_orderkey % 1000) / 100 AS q1_s,
         CASE WHEN 1 + o_orderkey % 20 <= 15 THEN 60 + (o_orderkey % 1000) / 100 END AS q2_s,
         CASE WHEN 1 + o_orderkey % 20 <= 10 THEN 60 + (o_orderkey % 1000) / 100 END AS q3_s,
         CASE WHEN o_orderstatus IN ('F', 'O') THEN CAST(5400 + o_orderkey % 3600 AS DOUBLE) END AS race_time_s,
         CASE WHEN o_orderstatus = 'F' THEN 'Finished' WHEN o_orderstatus = 'O' THEN 'Lapped'
              WHEN o_orderkey % 3 = 0 THEN 'Retired' WHEN o_orderkey % 3 = 1 THEN 'Did not start'
              ELSE 'Disqualified' END AS status,
         o_totalprice AS points, CAST(50 - o_orderkey % 7 AS DOUBLE) AS laps_completed,
         o_orderstatus NOT IN ('F', 'O') AS dnf
  FROM orders JOIN customer ON o_custkey = c_custkey),
sched(round_number, event_name) AS (VALUES """ + _EVENTS_VALUES + """),
sres AS (SELECT res.*, s.event_name FROM res JOIN sched s USING (round_number))"""

SCORES = """
sc AS (
  SELECT l_suppkey AS grp, CAST(l_suppkey % 5 AS INTEGER) AS fold,
         CAST(l_returnflag = 'R' AS INTEGER) AS label,
         round(0.5 * l_discount / 0.10 + 0.5 * l_quantity / 50, 6) AS probability,
         l_returnflag AS truth,
         CASE WHEN l_quantity <= 17 THEN 'A' WHEN l_quantity <= 34 THEN 'N' ELSE 'R' END AS prediction
  FROM lineitem)"""


def _r(expr: str, name: str) -> str:
    return f"round({expr}, 6) AS {name}"


LAP_COLS = ("driver driver_number team lap_number session_time_s lap_time_s sector1_s "
            "sector2_s sector3_s stint compound tyre_life fresh_tyre track_status position "
            "is_accurate deleted is_pit_in_lap is_pit_out_lap").split()
_LAP_DOUBLE = {"lap_number", "session_time_s", "lap_time_s", "sector1_s", "sector2_s",
               "sector3_s", "stint", "tyre_life", "position"}


def _lap_select(alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    return ", ".join(_r(p + c, c) if c in _LAP_DOUBLE else p + c for c in LAP_COLS)


TEL_COLS = ("driver timestamp time_s session_time_s speed_kmh rpm gear throttle_invalid "
            "throttle_pct brake drs source x_m y_m z_m on_track").split()
_TEL_DOUBLE = {"time_s", "session_time_s", "speed_kmh", "rpm", "throttle_pct", "x_m", "y_m", "z_m"}


def _tel_select() -> str:
    return ", ".join(_r(c, c) if c in _TEL_DOUBLE else f'"{c}"' if c == "timestamp" else c
                     for c in TEL_COLS)


RES_COLS = ("season round_number entry_id driver driver_number driver_name team country_code "
            "position classified_position grid_position positions_gained q1_s q2_s q3_s "
            "race_time_s status points laps_completed dnf").split()
_RES_DOUBLE = {"position", "grid_position", "positions_gained", "q1_s", "q2_s", "q3_s",
               "race_time_s", "points", "laps_completed"}


def _res_select(extra: str = "") -> str:
    cols = ", ".join(_r(c, c) if c in _RES_DOUBLE else c for c in RES_COLS)
    return cols + (", " + extra if extra else "")


SUMMARY_COLS = ("driver, lap_number, compound, round(mean_speed_kmh, 6) AS mean_speed_kmh, "
                "round(max_speed_kmh, 6) AS max_speed_kmh, "
                "round(mean_throttle_pct, 6) AS mean_throttle_pct, "
                "round(brake_fraction, 6) AS brake_fraction, round(mean_rpm, 6) AS mean_rpm, "
                "round(mean_gear, 6) AS mean_gear")


def oracle() -> dict[str, str]:
    q: dict[str, str] = {}
    q["normalize_laps"] = f"WITH {LAPS} SELECT {_lap_select()} FROM laps"
    q["accurate_laps"] = (
        f"WITH {LAPS} SELECT {_lap_select()} FROM laps WHERE coalesce(is_accurate, false) "
        "AND NOT coalesce(deleted, false) AND lap_time_s IS NOT NULL")
    q["green_laps"] = f"WITH {LAPS} SELECT {_lap_select()} FROM green"
    q["normalize_telemetry"] = f"WITH {LAPS}{TEL} SELECT {_tel_select()} FROM tel"
    q["asof_tag"] = (f"WITH {LAPS}{TEL} SELECT {_tel_select()}, round(lap_number, 6) AS lap_number, "
                     "compound FROM tagged")
    q["clean_samples"] = (f"WITH {LAPS}{TEL} SELECT {_tel_select()}, round(lap_number, 6) AS lap_number, "
                          "compound FROM clean")
    q["lap_telemetry_summary"] = f"WITH {LAPS}{TEL} SELECT {SUMMARY_COLS} FROM summary"
    q["normalize_results"] = f"WITH {RES} SELECT {_res_select()} FROM res"
    q["race_starters"] = (f"WITH {RES} SELECT {_res_select()} FROM res "
                          "WHERE status IS DISTINCT FROM 'Did not start'")
    q["season_results_subset"] = (f"WITH {RES} SELECT {_res_select('event_name')} FROM sres "
                                   "WHERE round_number IN (3, 6, 9)")
    q["street_flag"] = (
        f"WITH {RES} SELECT event_name, (lower(event_name) LIKE '%monaco%' OR lower(event_name) LIKE '%azerbaijan%' "
        "OR lower(event_name) LIKE '%singapore%' OR lower(event_name) LIKE '%las vegas%' "
        "OR lower(event_name) LIKE '%miami%' OR lower(event_name) LIKE '%saudi arabian%') AS is_street_circuit, "
        "count(*) AS n_entries FROM sres GROUP BY event_name")
    _more(q)
    _models(q)
    _sources(q)
    return q


STYLE = ("mean_speed_kmh", "max_speed_kmh", "mean_throttle_pct", "brake_fraction",
         "mean_rpm", "mean_gear")

REL = """,
tr AS (SELECT season, team, round_number, avg(CAST(dnf AS DOUBLE)) AS dnf_rate
       FROM res GROUP BY season, team, round_number),
rel AS (SELECT *, avg(dnf_rate) OVER (PARTITION BY season, team ORDER BY round_number
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS team_reliability FROM tr),
rres AS (SELECT res.*, rel.team_reliability FROM res LEFT JOIN rel USING (season, team, round_number)),
frel AS (SELECT rres.* REPLACE (coalesce(team_reliability,
           (SELECT avg(team_reliability) FROM rres)) AS team_reliability) FROM rres)"""


def _metric_select(tp="tp", fp="fp", fn="fn", tn="tn") -> str:
    n = f"({tp} + {fp} + {fn} + {tn})"
    return (f"round(CASE WHEN {n} <> 0 THEN ({tp} + {tn}) / {n} ELSE 0 END, 6) AS accuracy, "
            f"round(CASE WHEN {tp} + {fp} <> 0 THEN {tp} / ({tp} + {fp}) ELSE 0 END, 6) AS precision, "
            f"round(CASE WHEN {tp} + {fn} <> 0 THEN {tp} / ({tp} + {fn}) ELSE 0 END, 6) AS recall, "
            f"round(CASE WHEN 2 * {tp} + {fp} + {fn} <> 0 THEN 2 * {tp} / (2 * {tp} + {fp} + {fn}) ELSE 0 END, 6) AS f1")


_CONF = ("CAST(sum(CASE WHEN label = 1 AND pr = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp, "
         "CAST(sum(CASE WHEN label = 0 AND pr = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fp, "
         "CAST(sum(CASE WHEN label = 1 AND pr = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS fn, "
         "CAST(sum(CASE WHEN label = 0 AND pr = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS tn")

CURVE = """,
sd AS (SELECT probability AS p, CAST(sum(label) AS DOUBLE) AS pos, CAST(sum(1 - label) AS DOUBLE) AS neg
       FROM sc GROUP BY probability),
cu AS (SELECT p, sum(pos) OVER (ORDER BY p DESC) AS tp, sum(neg) OVER (ORDER BY p DESC) AS fp,
              sum(pos) OVER () AS tot FROM sd),
pr AS (SELECT p AS threshold, CASE WHEN tp + fp <> 0 THEN tp / (tp + fp) ELSE 0 END AS prec,
              CASE WHEN tot <> 0 THEN tp / tot ELSE 0 END AS rec FROM cu),
best AS (SELECT threshold, prec, rec, 2 * prec * rec / (prec + rec + 1e-12) AS f1 FROM pr
         ORDER BY f1 DESC, threshold ASC LIMIT 1)"""


def nudged(sql: str) -> str:
    """Same tie-breaking as ``finish(nudge=1e-9)``; ``+ 0.0`` turns -0.0 into 0.0."""
    return sql.replace(", 6) AS", " + 1e-9, 6) + 0.0 AS")


def _more(q: dict[str, str]) -> None:
    team_cols = ", ".join(f"CAST(team = 'N{i}' AS DOUBLE) AS team_N{i}" for i in range(25))
    q["team_round_rate"] = (f"WITH {RES} SELECT season, team, round_number, "
                            "round(avg(CAST(dnf AS DOUBLE)), 6) AS dnf_rate FROM res "
                            "GROUP BY season, team, round_number")
    q["team_reliability"] = (f"WITH {RES}{REL} SELECT entry_id, season, round_number, team, driver, "
                             "round(team_reliability, 6) AS team_reliability FROM rres")
    q["team_reliability_filled"] = (f"WITH {RES}{REL} SELECT entry_id, team, "
                                    "round(team_reliability, 6) AS team_reliability FROM frel")
    q["driver_delta"] = (f"WITH {LAPS} SELECT driver, round(lap_number, 6) AS lap_number, "
                         "round(lap_time_s, 6) AS lap_time_s, "
                         "round(lap_time_s - avg(lap_time_s) OVER (PARTITION BY driver), 6) AS lap_time_delta_s "
                         "FROM green")
    centred = ", ".join(f"round({c} - avg({c}) OVER w, 6) AS {c}" for c in STYLE)
    q["style_centered"] = (f"WITH {LAPS}{TEL} SELECT driver, lap_number, compound, {centred} "
                           "FROM summary WINDOW w AS (PARTITION BY driver)")

    def detr(c):
        s = f"regr_slope({c}, lap_number) OVER w"
        slope = f"(CASE WHEN isnan({s}) THEN 0 ELSE coalesce({s}, 0) END)"
        mx = f"avg(CASE WHEN {c} IS NOT NULL THEN lap_number END) OVER w"
        return f"round({c} - avg({c}) OVER w - {slope} * (lap_number - {mx}), 6) AS {c}"
    q["style_detrended"] = (f"WITH {LAPS}{TEL} SELECT driver, lap_number, compound, "
                            f"{', '.join(detr(c) for c in STYLE)} FROM summary "
                            "WINDOW w AS (PARTITION BY driver)")
    q["driver_delta"] = nudged(q["driver_delta"])
    q["style_detrended"] = nudged(q["style_detrended"])
    q["pace_matrix"] = (f"WITH {LAPS} SELECT driver AS \"group\", round(tyre_life, 6) AS tyre_life, "
                        "round(lap_number, 6) AS lap_number, "
                        "CAST(coalesce(compound = 'soft', false) AS DOUBLE) AS compound_soft, "
                        "CAST(coalesce(compound = 'medium', false) AS DOUBLE) AS compound_medium, "
                        "CAST(coalesce(compound = 'hard', false) AS DOUBLE) AS compound_hard, "
                        "round(lap_time_s, 6) AS label FROM green")
    q["dnf_matrix"] = (
        f"WITH {RES}{REL}, fs AS (SELECT frel.*, s.event_name FROM frel JOIN sched s USING (round_number)) "
        f"SELECT entry_id, driver AS \"group\", round(grid_position, 6) AS grid_position, {team_cols}, "
        "round(team_reliability, 6) AS team_reliability, "
        "CAST((lower(event_name) LIKE '%monaco%' OR lower(event_name) LIKE '%azerbaijan%' "
        "OR lower(event_name) LIKE '%singapore%' OR lower(event_name) LIKE '%las vegas%' "
        "OR lower(event_name) LIKE '%miami%' OR lower(event_name) LIKE '%saudi arabian%') AS DOUBLE) "
        "AS is_street_circuit, CAST(dnf AS DOUBLE) AS label FROM fs")
    q["retirement_target"] = (f"WITH {RES} SELECT entry_id, status, coalesce(status = 'Retired', false) "
                              "AS retired FROM res WHERE status IS DISTINCT FROM 'Did not start'")
    q["tyre_matrix"] = (f"WITH {LAPS}{TEL} SELECT driver, lap_number, driver AS \"group\", "
                        + ", ".join(f"round({c}, 6) AS {c}" for c in STYLE)
                        + ", compound AS label FROM summary")
    q["class_weights"] = (
        f"WITH {RES}, c AS (SELECT CAST(dnf AS DOUBLE) AS label, count(*) AS n FROM res GROUP BY 1) "
        "SELECT label, n, round(sum(n) OVER () / (count(*) OVER () * n), 6) AS balanced_weight, "
        "round(CASE WHEN sum(CASE WHEN label = 1 THEN n ELSE 0 END) OVER () > 0 "
        "THEN sum(CASE WHEN label = 0 THEN n ELSE 0 END) OVER () / sum(CASE WHEN label = 1 THEN n ELSE 0 END) OVER () "
        "ELSE 1.0 END, 6) AS scale_pos_weight FROM c")
    q["binary_metrics"] = (
        f"WITH {SCORES}, c AS (SELECT {_CONF} FROM (SELECT label, CAST(probability >= 0.5 AS INTEGER) AS pr FROM sc)) "
        f"SELECT {_metric_select()}, round((tp + fn) / (tp + fp + fn + tn), 6) AS positive_rate FROM c")
    q["fold_metrics"] = (
        f"WITH {SCORES}, c AS (SELECT fold, {_CONF} FROM (SELECT fold, label, CAST(probability > 0.5 AS INTEGER) AS pr FROM sc) GROUP BY fold), "
        f"m AS (SELECT tp, fp, fn, tn, {_metric_select()} FROM c) "
        "SELECT round(avg(accuracy), 6) AS accuracy, round(avg(precision), 6) AS precision, "
        "round(avg(recall), 6) AS recall, round(avg(f1), 6) AS f1, "
        "round(sum(tp + fn) / sum(tp + fp + fn + tn), 6) AS positive_rate FROM m")
    q["best_threshold"] = (f"WITH {SCORES}{CURVE} SELECT round(threshold, 6) AS threshold, "
                           "round(prec, 6) AS precision, round(rec, 6) AS recall, round(f1, 6) AS f1 FROM best")
    q["tuned_metrics"] = (
        f"WITH {SCORES}{CURVE}, c AS (SELECT {_CONF} FROM (SELECT label, "
        "CAST(probability >= (SELECT threshold FROM best) AS INTEGER) AS pr FROM sc)) "
        f"SELECT round((SELECT threshold FROM best), 6) AS threshold, {_metric_select()}, "
        "round((tp + fn) / (tp + fp + fn + tn), 6) AS positive_rate FROM c")
    q["roc_auc"] = (
        f"WITH {SCORES}, sd AS (SELECT probability AS p, CAST(sum(label) AS DOUBLE) AS pos, "
        "CAST(sum(1 - label) AS DOUBLE) AS neg FROM sc GROUP BY probability), "
        "c AS (SELECT pos, neg, sum(neg) OVER (ORDER BY p) - neg AS below FROM sd) "
        "SELECT round(sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS roc_auc FROM c")
    qs = ", ".join(str(i / 10) for i in range(1, 10))
    bins = " + ".join(f"CAST(probability > e.q[{i}] AS INTEGER)" for i in range(1, 10))
    q["calibration"] = (
        f"WITH {SCORES}, e AS (SELECT quantile_cont(probability, [{qs}]) AS q FROM sc), "
        f"b AS (SELECT sc.probability, sc.label, CAST({bins} AS INTEGER) AS bin FROM sc, e) "
        "SELECT bin, count(*) AS n, round(avg(probability), 6) AS mean_predicted_value, "
        "round(avg(CAST(label AS DOUBLE)), 6) AS fraction_of_positives FROM b GROUP BY bin")
    q["brier"] = (f"WITH {SCORES} SELECT round(avg(power(probability - label, 2)), 6) AS brier_score FROM sc")
    q["macro_metrics"] = (
        f"WITH {SCORES}, c AS (SELECT fold, truth, prediction, CAST(count(*) AS DOUBLE) AS n FROM sc GROUP BY ALL), "
        "t AS (SELECT fold, truth AS cls, sum(n) AS n_true, sum(CASE WHEN truth = prediction THEN n ELSE 0 END) AS tp "
        "      FROM c GROUP BY ALL), "
        "p AS (SELECT fold, prediction AS cls, sum(n) AS n_pred FROM c GROUP BY ALL), "
        "pc AS (SELECT coalesce(t.fold, p.fold) AS fold, coalesce(tp, 0) AS tp, coalesce(n_true, 0) AS nt, "
        "       coalesce(n_pred, 0) AS np FROM t FULL JOIN p ON t.fold = p.fold AND t.cls = p.cls), "
        "pf AS (SELECT fold, sum(tp) / sum(nt) AS acc, avg(CASE WHEN np <> 0 THEN tp / np ELSE 0 END) AS pm, "
        "       avg(CASE WHEN nt <> 0 THEN tp / nt ELSE 0 END) AS rm, "
        "       avg(CASE WHEN nt + np <> 0 THEN 2 * tp / (nt + np) ELSE 0 END) AS fm FROM pc GROUP BY fold), "
        "maj AS (SELECT max(n) / sum(n) AS ms FROM (SELECT truth, count(*) AS n FROM sc GROUP BY truth)) "
        "SELECT round(avg(acc), 6) AS accuracy, round(avg(pm), 6) AS precision_macro, "
        "round(avg(rm), 6) AS recall_macro, round(avg(fm), 6) AS f1_macro, "
        "round((SELECT ms FROM maj), 6) AS majority_share FROM pf")
    q["status_counts"] = f"WITH {RES} SELECT status, count(*) AS n FROM res GROUP BY status"
    clus = f"WITH {LAPS}{TEL}, cl AS (SELECT *, CAST(floor(mean_gear) AS INTEGER) % 3 AS cluster FROM summary)"
    q["cluster_crosstab"] = (
        clus + ", ct AS (SELECT cluster, count(*) FILTER (WHERE compound = 'soft') AS n_soft, "
        "count(*) FILTER (WHERE compound = 'medium') AS n_medium, count(*) FILTER (WHERE compound = 'hard') AS n_hard "
        "FROM cl GROUP BY cluster) "
        "SELECT cluster, n_soft, n_medium, n_hard, n_soft + n_medium + n_hard AS n_total, "
        "round(100.0 * n_soft / (n_soft + n_medium + n_hard), 6) AS pct_soft, "
        "round(100.0 * sum(n_soft) OVER () / sum(n_soft + n_medium + n_hard) OVER (), 6) AS overall_pct_soft FROM ct")
    q["cluster_profile"] = (
        clus + ", j AS (SELECT cl.cluster, l.lap_number, l.tyre_life, l.stint FROM cl "
        "JOIN laps l ON cl.driver = l.driver AND cl.lap_number = l.lap_number), "
        "m AS (SELECT cluster, stint, count(*) AS c FROM j GROUP BY ALL), "
        "m2 AS (SELECT *, max(c) OVER (PARTITION BY cluster) AS mc FROM m), "
        "md AS (SELECT cluster, min(stint) AS stint_mode FROM m2 WHERE c = mc GROUP BY cluster) "
        "SELECT cluster, count(*) AS n_laps, round(avg(lap_number), 6) AS mean_lap_number, "
        "round(avg(tyre_life), 6) AS mean_tyre_life, round(any_value(md.stint_mode), 6) AS stint_mode "
        "FROM j JOIN md USING (cluster) GROUP BY cluster")


def _sources(q: dict[str, str]) -> None:
    tel = f"WITH {LAPS}{TEL} SELECT {_tel_select()} FROM tel"
    q["driver_telemetry"] = tel + " WHERE driver = 'U7'"
    q["session_telemetry"] = tel + " WHERE driver IN (SELECT driver FROM laps)"
    q["lap_drivers"] = f"WITH {LAPS} SELECT DISTINCT driver FROM laps"
    q["timeline_union"] = (
        f"WITH {LAPS}{TEL} SELECT driver, round(session_time_s, 6) AS session_time_s, lap_number, "
        "CAST(NULL AS DOUBLE) AS speed_kmh FROM laps UNION ALL SELECT driver, round(session_time_s, 6), "
        "NULL, round(speed_kmh, 6) FROM tel")
    names = ("accuracy", "precision", "recall", "f1")
    q["fold_summary"] = (
        f"WITH {SCORES}, c AS (SELECT fold, {_CONF} FROM (SELECT fold, label, "
        "CAST(probability > 0.5 AS INTEGER) AS pr FROM sc) GROUP BY fold), "
        "m AS (SELECT (tp + tn) / (tp + fp + fn + tn) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, "
        "coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 "
        "FROM c) SELECT "
        + ", ".join(f"round(avg({n}), 6) AS {n}, round(stddev_pop({n}), 6) AS {n}_std" for n in names)
        + " FROM m")


def _standard_normal_equations(feats: list[str]) -> str:
    """CTE ``ne``: Gram matrix a_i_j and right side c_i of the centred,
    population-scaled features, with their means, deviations, n and mean label."""
    k = len(feats)
    z = ", ".join(f"({f} - avg({f}) OVER ()) / stddev_pop({f}) OVER () AS z{i}, avg({f}) OVER () AS mu{i}, "
                  f"stddev_pop({f}) OVER () AS sd{i}" for i, f in enumerate(feats))
    a = ", ".join([f"sum(z{i} * z{j}) AS a_{i}_{j}" for i in range(k) for j in range(k)]
                  + [f"sum(z{i} * yc) AS c_{i}, any_value(mu{i}) AS mu{i}, any_value(sd{i}) AS sd{i}"
                     for i in range(k)])
    return (f"zz AS (SELECT {z}, label - avg(label) OVER () AS yc, label FROM pl), "
            f"ne AS (SELECT {a}, CAST(count(*) AS DOUBLE) AS n, avg(label) AS ybar FROM zz)")


def _unscaled(feats: list[str], source: str) -> str:
    """Rows (feature, coef_s) from standardised coefficients b_i in ``source``."""
    rows = [f"SELECT '{f}' AS feature, round(b_{i} / sd{i} + 0.0, 6) AS coef_s FROM {source}, ne"
            for i, f in enumerate(feats)]
    shift = " - ".join(["ybar"] + [f"mu{i} * b_{i} / sd{i}" for i in range(len(feats))])
    rows.append(f"SELECT 'intercept', round({shift}, 6) FROM {source}, ne")
    return " UNION ALL ".join(rows)


def _pace_models(q: dict[str, str], pace: str, feats: list[str]) -> None:
    """Pace regressions: OLS with a full set of level dummies is a regression
    centred within each level (two unknowns); ridge by Gaussian elimination;
    lasso by coordinate descent."""
    level = ("CASE WHEN compound_soft = 1 THEN 'compound_soft' WHEN compound_medium = 1 THEN 'compound_medium' "
             "ELSE 'compound_hard' END AS lev")

    def ols(rows: str, by: str) -> str:
        part = f"PARTITION BY {by}lev"
        group = f"GROUP BY {by[:-2]}" if by else ""
        return (f"w AS (SELECT *, tyre_life - avg(tyre_life) OVER ({part}) AS t, "
                f"lap_number - avg(lap_number) OVER ({part}) AS l, label - avg(label) OVER ({part}) AS y FROM {rows}), "
                f"s AS (SELECT {by}sum(t * t) AS tt, sum(t * l) AS tl, sum(l * l) AS ll, sum(t * y) AS ty, "
                f"sum(l * y) AS ly FROM w {group}), "
                f"sl AS (SELECT {by}(ty * ll - ly * tl) / (tt * ll - tl * tl) AS bt, "
                "(ly * tt - ty * tl) / (tt * ll - tl * tl) AS bl FROM s)")

    q["pace_ols"] = (
        f"WITH {pace}, x AS (SELECT *, {level} FROM pl), " + ols("x", "") + ", "
        "lv AS (SELECT lev, avg(label) - any_value(bt) * avg(tyre_life) - any_value(bl) * avg(lap_number) AS b "
        "FROM x, sl GROUP BY lev) SELECT 'tyre_life' AS feature, round(bt, 6) AS coef_s FROM sl "
        "UNION ALL SELECT 'lap_number', round(bl, 6) FROM sl UNION ALL "
        "SELECT f.feature, round(coalesce(b, 0), 6) FROM (VALUES ('compound_soft'), ('compound_medium'), "
        "('compound_hard')) f(feature) LEFT JOIN lv ON lev = f.feature")
    q["pace_cv"] = (
        f"WITH RECURSIVE {pace.replace('AS fold,', 'AS sfold, l_suppkey,')}, "
        "c AS (SELECT l_suppkey, 'S' || l_suppkey AS g, count(*) AS n FROM lineitem GROUP BY l_suppkey), "
        + fewest_rows("c", "g") +
        ", x AS (SELECT pl.*, " + level + ", fold FROM pl JOIN dealt USING (l_suppkey)), "
        "tr AS (SELECT f.f, x.* FROM x JOIN (VALUES (0), (1), (2), (3), (4)) f(f) ON x.fold <> f.f), "
        + ols("tr", "f, ") + ", "
        "lv AS (SELECT tr.f, lev, avg(label) - any_value(bt) * avg(tyre_life) - any_value(bl) * avg(lap_number) AS b "
        "FROM tr JOIN sl ON sl.f = tr.f GROUP BY tr.f, lev), "
        "p AS (SELECT x.fold, label, coalesce(b, 0) + bt * tyre_life + bl * lap_number AS p FROM x "
        "JOIN sl ON sl.f = x.fold LEFT JOIN lv ON lv.f = x.fold AND lv.lev = x.lev), "
        "m AS (SELECT avg(abs(label - p)) AS mae, 1 - sum((label - p) ** 2) / (var_pop(label) * count(*)) AS r2 "
        "FROM p GROUP BY fold) SELECT round(avg(mae), 6) AS mae_s, round(stddev_pop(mae), 6) AS mae_s_std, "
        "round(avg(r2), 6) AS r2, round(stddev_pop(r2), 6) AS r2_std FROM m")
    k = len(feats)
    # eliminate one column after the other, then substitute back
    steps = ["e0 AS (SELECT " + ", ".join(
        [f"a_{i}_{j} + {1.0 if i == j else 0.0} AS a_{i}_{j}" for i in range(k) for j in range(k)]
        + [f"c_{i}" for i in range(k)]) + " FROM ne)"]
    for p in range(k - 1):
        cols = [f"a_{i}_{j} - a_{i}_{p} * a_{p}_{j} / a_{p}_{p} AS a_{i}_{j}" if i > p else f"a_{i}_{j}"
                for i in range(k) for j in range(k)]
        cols += [f"c_{i} - a_{i}_{p} * c_{p} / a_{p}_{p} AS c_{i}" if i > p else f"c_{i}" for i in range(k)]
        steps.append(f"e{p + 1} AS (SELECT {', '.join(cols)} FROM e{p})")
    back = f"e{k - 1}"
    for i in reversed(range(k)):
        rest = "".join(f" - a_{i}_{j} * b_{j}" for j in range(i + 1, k))
        steps.append(f"s{i} AS (SELECT *, (c_{i}{rest}) / a_{i}_{i} AS b_{i} FROM {back})")
        back = f"s{i}"
    names = ", ".join(f"b_{i}" for i in range(k))
    q["pace_ridge"] = (f"WITH {pace}, {_standard_normal_equations(feats)}, {', '.join(steps)}, "
                       # the dummies add up to 1, so the exact solution is orthogonal to their deviations
                       f"sol AS (SELECT b_0, b_1, "
                       + ", ".join(f"b_{i} - sd{i} * (sd2 * b_2 + sd3 * b_3 + sd4 * b_4) "
                                   f"/ (sd2 * sd2 + sd3 * sd3 + sd4 * sd4) AS b_{i}" for i in (2, 3, 4))
                       + f" FROM {back}, (SELECT sd2, sd3, sd4 FROM ne)) " + _unscaled(feats, "sol"))
    sweep = "SELECT it, " + ", ".join(f"b_{i}" for i in range(k)) + " FROM cd"
    for i in range(k):
        rho = f"(c_{i} - " + " - ".join(f"a_{i}_{j} * b_{j}" for j in range(k) if j != i) + ")"
        new = f"sign({rho}) * greatest(abs({rho}) - n, 0) / a_{i}_{i} AS b_{i}"
        cols = ", ".join(new if j == i else f"b_{j}" for j in range(k))
        sweep = f"SELECT it, {cols} FROM ({sweep}), ne"
    q["pace_lasso"] = (
        f"WITH RECURSIVE {pace}, {_standard_normal_equations(feats)}, cd AS (SELECT 0 AS it, "
        + ", ".join(f"CAST(0 AS DOUBLE) AS b_{i}" for i in range(k))
        + f" UNION ALL SELECT it + 1, {names} FROM ({sweep}) WHERE it < 400), "
        "sol AS (SELECT * FROM cd WHERE it = 400) " + _unscaled(feats, "sol"))


def _models(q: dict[str, str]) -> None:
    feats = ["tyre_life", "lap_number", "compound_soft", "compound_medium", "compound_hard"]
    pace = """
pl AS (
  SELECT CAST(l_suppkey % 5 AS INTEGER) AS fold, l_quantity AS tyre_life,
         CAST(l_linenumber AS DOUBLE) AS lap_number,
         CAST(l_returnflag = 'A' AS DOUBLE) AS compound_soft,
         CAST(l_returnflag = 'N' AS DOUBLE) AS compound_medium,
         CAST(l_returnflag NOT IN ('A', 'N') AS DOUBLE) AS compound_hard,
         l_extendedprice / l_quantity AS label
  FROM lineitem)"""
    cols = [f"avg({c}) AS m_{c}" for c in feats] + ["avg(label) AS m_y"]
    cols += [f"avg({feats[i]} * {feats[j]}) AS m_{feats[i]}__{feats[j]}"
             for i in range(len(feats)) for j in range(i, len(feats))]
    cols += [f"avg({c} * label) AS m_{c}__y" for c in feats] + ["avg(label * label) AS m_y__y"]
    q["pace_moments"] = (f"WITH {pace} SELECT fold, count(*) AS n, "
                         + ", ".join(c.replace("avg(", "round(avg(").replace(") AS", "), 6) AS")
                                     for c in cols)
                         + " FROM pl GROUP BY fold")
    _pace_models(q, pace, feats)
    z = ", ".join(f"round(({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () > 0 "
                  f"THEN stddev_pop({c}) OVER () ELSE 1 END, 6) AS {c}" for c in STYLE)
    q["zscore"] = nudged(f"WITH {LAPS}{TEL} SELECT driver, lap_number, compound, {z} FROM summary")
    # log likelihood of one full-covariance normal, 1e-6 on the diagonal, at its own moments
    q["gmm_bic_one"] = (
        f"WITH {LAPS}{TEL}, m AS (SELECT count(*) AS n, var_pop(x) AS sx, var_pop(y) AS sy, covar_pop(x, y) AS sxy "
        "FROM (SELECT coalesce(mean_speed_kmh, avg(mean_speed_kmh) OVER ()) AS x, "
        "coalesce(mean_throttle_pct, avg(mean_throttle_pct) OVER ()) AS y FROM summary)), "
        "c AS (SELECT *, sx + 1e-6 AS a, sy + 1e-6 AS b, (sx + 1e-6) * (sy + 1e-6) - sxy * sxy AS det FROM m) "
        "SELECT CAST(1 AS INTEGER) AS k, round(n * (2 * ln(2 * pi()) + ln(det) + (b * sx - 2 * sxy * sxy + a * sy) / det) "
        "+ 5 * ln(n), 6) AS bic FROM c")
    # all pairs: mean distance of each lap to each compound, its own lap apart
    q["silhouette_compound"] = (
        f"WITH {LAPS}{TEL}, v AS (SELECT row_number() OVER () AS r, compound AS c, "
        "coalesce(mean_speed_kmh, avg(mean_speed_kmh) OVER ()) AS x, "
        "coalesce(mean_throttle_pct, avg(mean_throttle_pct) OVER ()) AS y FROM summary), "
        "g AS (SELECT a.r, a.c = b.c AS own, sum(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))) AS far, count(*) AS n "
        "FROM v a JOIN v b ON true GROUP BY a.r, a.c, b.c), "
        "m AS (SELECT r, max(n) FILTER (WHERE own) AS size, max(far / greatest(n - 1, 1)) FILTER (WHERE own) AS a, "
        "min(far / n) FILTER (WHERE NOT own) AS b FROM g GROUP BY r) "
        "SELECT round(avg(CASE WHEN size = 1 OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM m")
    q.update(fits(RES))
    q["group_folds"] = (
        "WITH RECURSIVE c AS (SELECT 'S' || l_suppkey AS \"group\", count(*) AS n FROM lineitem GROUP BY 1), "
        + fewest_rows("c", '"group"') + "SELECT \"group\", fold, n FROM dealt")
    q["stratified_group_folds"] = (
        f"WITH RECURSIVE {RES}, l AS (SELECT driver AS \"group\", CAST(dnf AS DOUBLE) AS label FROM res), "
        "c AS (SELECT \"group\", count(*) AS n, count(*) FILTER (WHERE label = 0) AS n0, "
        "count(*) FILTER (WHERE label = 1) AS n1 FROM l GROUP BY 1), "
        + most_even("c", '"group"') + "SELECT \"group\", fold, n, CAST(n1 AS DOUBLE) AS positives FROM dealt")
