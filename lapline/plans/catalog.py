"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads whole generated tables through the adapters and runs one
lapline operator (or a short composition).  Float outputs are rounded to
6 places by ``finish`` so they compare exactly with the DuckDB oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapline.functions import is_street_circuit
from lapline.models import cells, classify, cluster, folds, linear, metrics, shared_fits
from lapline.operators import features, profile, quality, telemetry
from lapline.plans import inputs as I
from lapline.plans.inputs import finish
from lapline.session import ensure_checkpoint_dir
from lapline.sources import adapters as A
from lapline.sources import readers
from lapline.schemas import PACE_FEATURES, STYLE_COLUMNS

NUDGE = 1e-9
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# -- normalisation and filters (N1-N7, Q1-Q4, S4, S6) -----------------------

@register("normalize_laps")
def q_normalize_laps(spark, sf):
    return finish(I.laps(spark, sf))


@register("accurate_laps")
def q_accurate_laps(spark, sf):
    return finish(quality.filter_accurate_laps(I.laps(spark, sf)))


@register("green_laps")
def q_green_laps(spark, sf):
    return finish(quality.select_green_flag_laps(I.laps(spark, sf)))


@register("normalize_telemetry")
def q_normalize_telemetry(spark, sf):
    return finish(I.telemetry(spark, sf))


@register("normalize_results")
def q_normalize_results(spark, sf):
    return finish(I.results(spark, sf))


@register("race_starters")
def q_race_starters(spark, sf):
    return finish(quality.select_race_starters(I.results(spark, sf)))


@register("season_results_subset")
def q_season_results_subset(spark, sf):
    return finish(I.season_results(spark, sf, rounds=(3, 6, 9)))


@register("street_flag")
def q_street_flag(spark, sf):
    df = I.season_results(spark, sf)
    return (df.groupBy("event_name")
            .agg(F.count(F.lit(1)).alias("n_entries"))
            .select("event_name", is_street_circuit("event_name").alias("is_street_circuit"),
                    "n_entries"))


# -- as-of join, clean filter, lap summary (J1, J2, A1) ---------------------

@register("asof_tag")
def q_asof_tag(spark, sf):
    return finish(telemetry.tag_telemetry_with_lap(I.telemetry(spark, sf), I.laps(spark, sf)))


@register("clean_samples")
def q_clean_samples(spark, sf):
    laps = I.laps(spark, sf)
    tagged = telemetry.tag_telemetry_with_lap(I.telemetry(spark, sf), laps)
    return finish(telemetry.filter_to_clean_laps(tagged, laps))


@register("lap_telemetry_summary")
def q_lap_telemetry_summary(spark, sf):
    return finish(telemetry.clean_lap_summary(I.telemetry(spark, sf), I.laps(spark, sf)))


# -- sources over the given tables (S3, S5, S6, A6) -------------------------

@register("driver_telemetry")
def q_driver_telemetry(spark, sf):
    """S3: the samples of driver U7, named by the code."""
    return finish(readers.select_driver(I.telemetry(spark, sf), "U7"))


@register("session_telemetry")
def q_session_telemetry(spark, sf):
    """The samples of the drivers that have laps."""
    return finish(readers.select_session_drivers(I.telemetry(spark, sf), I.laps(spark, sf)))


@register("lap_drivers")
def q_lap_drivers(spark, sf):
    return readers.lap_drivers(I.laps(spark, sf))


@register("timeline_union")
def q_timeline_union(spark, sf):
    """Lap ends and samples in one table, absent columns null."""
    laps = I.laps(spark, sf).select("driver", "session_time_s", "lap_number")
    samples = I.telemetry(spark, sf).select("driver", "session_time_s", "speed_kmh")
    return finish(readers.concat_frames([laps, samples]))


# -- history, targets, feature matrices (A2, W1-W4, J3, T1-T7) --------------

def _lap_summary(spark, sf):
    return telemetry.clean_lap_summary(I.telemetry(spark, sf), I.laps(spark, sf))


@register("team_round_rate")
def q_team_round_rate(spark, sf):
    return finish(features.team_round_dnf_rate(I.results(spark, sf)))


@register("team_reliability")
def q_team_reliability(spark, sf):
    df = features.compute_team_reliability_feature(I.results(spark, sf))
    return finish(df.select("entry_id", "season", "round_number", "team", "driver",
                            "team_reliability"))


@register("team_reliability_filled")
def q_team_reliability_filled(spark, sf):
    df = features.fill_missing_team_reliability(
        features.compute_team_reliability_feature(I.results(spark, sf)))
    return finish(df.select("entry_id", "team", "team_reliability"))


@register("driver_delta")
def q_driver_delta(spark, sf):
    laps = quality.select_green_flag_laps(I.laps(spark, sf))
    df = features.compute_driver_delta_target(laps)
    return finish(df.select("driver", "lap_number", "lap_time_s", "lap_time_delta_s"), nudge=NUDGE)


@register("style_centered")
def q_style_centered(spark, sf):
    return finish(features.build_driving_style_features(_lap_summary(spark, sf),
                                                        relative_to_driver=True))


@register("style_detrended")
def q_style_detrended(spark, sf):
    return finish(features.build_driving_style_features(_lap_summary(spark, sf),
                                                        detrend_lap_number=True), nudge=NUDGE)


@register("pace_matrix")
def q_pace_matrix(spark, sf):
    laps = quality.select_green_flag_laps(I.laps(spark, sf))
    return finish(features.build_pace_features(laps, keep=()))


@register("dnf_matrix")
def q_dnf_matrix(spark, sf):
    df = features.build_dnf_features(I.season_results(spark, sf), include_team_reliability=True,
                                     include_circuit_type=True, keep=("entry_id",))
    return finish(df)


@register("retirement_target")
def q_retirement_target(spark, sf):
    df = features.build_retirement_target(quality.select_race_starters(I.results(spark, sf)))
    return df.select("entry_id", "status", "retired")


@register("tyre_matrix")
def q_tyre_matrix(spark, sf):
    return finish(features.build_tyre_features(_lap_summary(spark, sf)))


# -- metrics on a data-derived score (A3-A5, C0, E1-E9) ---------------------

@register("class_weights")
def q_class_weights(spark, sf):
    df = I.results(spark, sf).select(F.col("dnf").cast("double").alias("label"))
    return finish(metrics.class_weights(df))


@register("binary_metrics")
def q_binary_metrics(spark, sf):
    return finish(metrics.binary_metrics(metrics.predict_at(I.scores(spark, sf), 0.5)))


@register("fold_metrics")
def q_fold_metrics(spark, sf):
    sc = I.scores(spark, sf).withColumn("prediction", (F.col("probability") > 0.5).cast("int"))
    return finish(metrics.cv_binary_metrics(sc))


@register("fold_summary")
def q_fold_summary(spark, sf):
    sc = I.scores(spark, sf).withColumn("prediction", (F.col("probability") > 0.5).cast("int"))
    per = metrics.fold_binary_metrics(sc)
    return finish(metrics.fold_summary(per, ["accuracy", "precision", "recall", "f1"]))


@register("best_threshold")
def q_best_threshold(spark, sf):
    return finish(metrics.best_threshold(I.scores(spark, sf)))


@register("tuned_metrics")
def q_tuned_metrics(spark, sf):
    return finish(metrics.tuned_binary_metrics(I.scores(spark, sf)))


@register("roc_auc")
def q_roc_auc(spark, sf):
    return finish(metrics.roc_auc(I.scores(spark, sf)))


@register("calibration")
def q_calibration(spark, sf):
    return finish(metrics.calibration(I.scores(spark, sf), n_bins=10))


@register("brier")
def q_brier(spark, sf):
    return finish(metrics.brier_score(I.scores(spark, sf)))


@register("macro_metrics")
def q_macro_metrics(spark, sf):
    return finish(metrics.cv_macro_metrics(I.scores(spark, sf), truth="truth"))


# -- profiles (A7-A10, J4) ---------------------------------------------------

def _gear_clusters(summary):
    return summary.withColumn("cluster", (F.floor("mean_gear").cast("int") % 3))


@register("status_counts")
def q_status_counts(spark, sf):
    return profile.value_counts(I.results(spark, sf), "status")


@register("cluster_crosstab")
def q_cluster_crosstab(spark, sf):
    return finish(profile.cluster_crosstab(_gear_clusters(_lap_summary(spark, sf))))


@register("cluster_profile")
def q_cluster_profile(spark, sf):
    clusters = _gear_clusters(_lap_summary(spark, sf))
    return finish(profile.cluster_profile(clusters, I.laps(spark, sf)))


# -- folds and pace regression (K1, K2, L0-L7) ------------------------------

PACE_X = list(PACE_FEATURES)


def _pace_set(spark, sf):
    """Large pace table (lineitem based) with its group-derived fold."""
    return features.build_pace_features(I.pace_laps(spark, sf), keep=("fold",))


@register("pace_moments")
def q_pace_moments(spark, sf):
    m = linear.moments(_pace_set(spark, sf), PACE_X, "label", by=["fold"])
    n = F.col("n")
    cols = [F.col("fold"), n.cast("long").alias("n")]
    cols += [(F.col(c) / n).alias("m" + c[1:]) for c in m.columns if c.startswith("s_")]
    return finish(m.select(*cols))


@register("group_folds")
def q_group_folds(spark, sf):
    df = features.build_pace_features(I.pace_laps(spark, sf), keep=())
    with_fold = folds.group_kfold(df, "group", n_splits=5)
    return with_fold.groupBy("group", "fold").agg(F.count(F.lit(1)).alias("n"))


@register("stratified_group_folds")
def q_stratified_group_folds(spark, sf):
    df = features.build_dnf_features(I.results(spark, sf), teams=(), keep=())
    with_fold = folds.stratified_group_kfold(df, "group", "label", n_splits=5)
    return with_fold.groupBy("group", "fold").agg(F.count(F.lit(1)).alias("n"),
                                                  F.sum("label").alias("positives"))


def _pace_fit(method, alpha=1.0):
    def q(spark, sf):
        model = linear.fit_linear(_pace_set(spark, sf), PACE_X, "label", method, alpha)
        return finish(model.coefficients(spark))
    return q


register("pace_ols")(_pace_fit("ols"))
register("pace_ridge")(_pace_fit("ridge", 1.0))
register("pace_lasso")(_pace_fit("lasso", 1.0))


@register("pace_cv")
def q_pace_cv(spark, sf):
    df = folds.group_kfold(features.build_pace_features(I.pace_laps(spark, sf), keep=()),
                           "group", n_splits=5)
    summary, _ = linear.cross_validate_linear(df, PACE_X, "label", "fold", "ols")
    return finish(summary)


# -- classifiers (C0-C8, K3, K4) ---------------------------------------------

#: Positions of the grid position and of the team among the cells' features.
DNF_X = (0, 1)


def _dnf_cv_table(spark, sf):
    df = features.build_dnf_features(I.season_results(spark, sf), teams=(), keep=("entry_id", "team"))
    return shared_fits.with_inner_folds(folds.stratified_group_kfold(df, "group", "label", n_splits=5), ("entry_id",))


def _dnf_cells(spark, sf, inner=None):
    """The table, written once, and its cells."""
    df = cells.shared_cut(_dnf_cv_table(spark, sf))
    return df, cells.build_cells(df, ["grid_position"], "team", inner=inner)


OOF_COLUMNS = ("entry_id", "fold", "label", "probability", "prediction")


def _oof(kind):
    def q(spark, sf):
        df, own = _dnf_cells(spark, sf, "inner_fold" if kind == "stacking" else None)
        weight = classify.default_scale_pos_weight(df) if kind in ("boosting", "stacking") else 1.0
        if kind == "stacking":
            oof = shared_fits.out_of_fold_stack(df, own, DNF_X, weight)
        else:
            oof = shared_fits.out_of_fold(df, own, [shared_fits.dnf_fit(kind, DNF_X, f, None, weight) for f in own.folds])
        oof = oof.select(*OOF_COLUMNS)
        return finish(oof) if kind in ("tree", "logistic") else oof
    return q


for _k in ("tree", "logistic", "forest", "boosting", "stacking"):
    register(f"oof_{_k}")(_oof(_k))


@register("tree_splits")
def q_tree_splits(spark, sf):
    """C1 at depth 2: the splits of every fold's tree."""
    _, own = _dnf_cells(spark, sf)
    fits = {f: shared_fits.dnf_fit("tree", DNF_X, f, depth=2) for f in own.folds}
    models = shared_fits.fit_all(own, list(fits.values()))
    return finish(shared_fits.split_table(spark, own, {f: models[x] for f, x in fits.items()}))


@register("boosting_splits")
def q_boosting_splits(spark, sf):
    """C4: the splits of every fold's first round at depth 4."""
    df, own = _dnf_cells(spark, sf)
    weight = classify.default_scale_pos_weight(df)
    fits = {f: shared_fits.dnf_fit("boosting", DNF_X, f, None, weight, 1) for f in own.folds}
    models = shared_fits.fit_all(own, list(fits.values()))
    return finish(shared_fits.split_table(spark, own, {f: models[x] for f, x in fits.items()}))


@register("logistic_coefficients")
def q_logistic_coefficients(spark, sf):
    """The coefficients of every fold's fit."""
    _, own = _dnf_cells(spark, sf)
    fits = {f: shared_fits.dnf_fit("logistic", DNF_X, f) for f in own.folds}
    models = shared_fits.fit_all(own, list(fits.values()))
    rows = [(f, name, float(v)) for f, x in fits.items()
            for name, v in zip(["grid_position", *(f"team {t}" for t in own.levels)], [*models[x].numeric, *models[x].level[:-1]], strict=True)]
    return finish(spark.createDataFrame(rows, "fold int, feature string, coefficient double"))


@register("tyre_svm")
def q_tyre_svm(spark, sf):
    df = features.build_tyre_features(_lap_summary(spark, sf))
    df = cells.shared_cut(folds.stratified_group_kfold(df, "group", "label", n_splits=5))
    model = classify.TyreSvm(list(STYLE_COLUMNS), kernel="rbf").fit(df, "fold")
    oof = model.transform(df, "fold")
    return metrics.cv_macro_metrics(oof, truth="label", prediction="prediction")


# -- clustering (U1-U7) ------------------------------------------------------

def _style_scaled(spark, sf, detrend=False):
    style = features.build_driving_style_features(_lap_summary(spark, sf), relative_to_driver=not detrend,
                                                  detrend_lap_number=detrend)
    # scaling, PCA and the clustering iterations each re-read this table:
    # write it once to the checkpoint folder instead of re-running the
    # as-of join for every pass
    ensure_checkpoint_dir(spark)
    style = style.checkpoint(eager=True)
    # laps without samples of a channel stand at its mean
    return cluster.standardize(cluster.at_mean(style, STYLE_COLUMNS), list(STYLE_COLUMNS))


@register("zscore")
def q_zscore(spark, sf):
    return finish(cluster.standardize(_lap_summary(spark, sf), list(STYLE_COLUMNS)), nudge=NUDGE)


def _coords(spark, sf):
    coords, _ = cluster.fit_pca(_style_scaled(spark, sf), list(STYLE_COLUMNS), 2)
    return coords


@register("pca_explained")
def q_pca_explained(spark, sf):
    _, explained = cluster.fit_pca(_style_scaled(spark, sf), list(STYLE_COLUMNS), 2)
    return finish(explained)


@register("pca")
def q_pca(spark, sf):
    return _coords(spark, sf).select("driver", "lap_number", "compound", "pc1", "pc2")


@register("kmeans")
def q_kmeans(spark, sf):
    return cluster.fit_kmeans(_coords(spark, sf), ["pc1", "pc2"], 3).select(
        "driver", "lap_number", "compound", "cluster")


@register("gmm")
def q_gmm(spark, sf):
    _, out = cluster.fit_gmm(_coords(spark, sf), ["pc1", "pc2"], 2)
    return out.select("driver", "lap_number", "compound", "cluster", "probability")


@register("gmm_bic")
def q_gmm_bic(spark, sf):
    return cluster.select_n_components_by_bic(_coords(spark, sf), ["pc1", "pc2"], (1, 2, 3, 4, 5))


#: Two columns, so that the closed form of one component stays short in SQL.
ONE_COMPONENT_COLUMNS = ("mean_speed_kmh", "mean_throttle_pct")


@register("gmm_bic_one")
def q_gmm_bic_one(spark, sf):
    """U7 at k = 1: the fit has a closed form."""
    laps = cluster.at_mean(cells.shared_cut(_lap_summary(spark, sf).select(*ONE_COMPONENT_COLUMNS)), ONE_COMPONENT_COLUMNS)
    return finish(cluster.select_n_components_by_bic(laps, ONE_COMPONENT_COLUMNS, (1,)))


@register("silhouette")
def q_silhouette(spark, sf):
    labelled = cluster.fit_kmeans(_coords(spark, sf), ["pc1", "pc2"], 3).cache()
    value = cluster.silhouette(labelled, ["pc1", "pc2"])
    labelled.unpersist()
    return spark.createDataFrame([(value,)], "silhouette double")


@register("silhouette_compound")
def q_silhouette_compound(spark, sf):
    """U4 of the compounds as clusters, on speed and throttle."""
    laps = cells.shared_cut(_lap_summary(spark, sf).select(*ONE_COMPONENT_COLUMNS, "compound"))
    value = cluster.silhouette(cluster.at_mean(laps, ONE_COMPONENT_COLUMNS), ONE_COMPONENT_COLUMNS, "compound")
    return finish(spark.createDataFrame([(value,)], "silhouette double"))


# -- documented experiments and profiles (C7, C8, A10, embeddings) ----------

@register("capacity_sweep")
def q_capacity_sweep(spark, sf):
    df, own = _dnf_cells(spark, sf)
    return shared_fits.capacity_sweep(df, own, DNF_X, classify.default_scale_pos_weight(df))


@register("feature_ablation")
def q_feature_ablation(spark, sf):
    """Grid position and team, with the team's history, with the circuit as well."""
    season = I.season_results(spark, sf)
    df = features.build_dnf_features(season, teams=(), include_team_reliability=True, include_circuit_type=True, keep=("entry_id", "team"))
    df = folds.stratified_group_kfold(df, "group", "label", n_splits=5)
    df = cells.shared_cut(shared_fits.with_inner_folds(df, ("entry_id",)))
    own = cells.build_cells(df, ["grid_position", "team_reliability", "is_street_circuit"], "team", inner="inner_fold")
    variants = {"base": (0, 3), "reliability": (0, 1, 3), "reliability_circuit": (0, 1, 2, 3)}
    return shared_fits.feature_ablation(df, own, variants, classify.default_scale_pos_weight(df))


@register("compound_spread")
def q_compound_spread(spark, sf):
    """Spread of the two-component mixture on driver-centred and on detrended laps."""
    out = []
    for name, detrend in (("centered", False), ("detrended", True)):
        coords, _ = cluster.fit_pca(_style_scaled(spark, sf, detrend), list(STYLE_COLUMNS), 2)
        _, labelled = cluster.fit_gmm(coords, ["pc1", "pc2"], 2)
        spread = profile.compound_spread(profile.cluster_crosstab(labelled))
        out.append(spread.select(F.lit(name).alias("variant"), "*"))
    return out[0].unionByName(out[1])


@register("gmm_top_probability")
def q_gmm_top_probability(spark, sf):
    _, out = cluster.fit_gmm(_coords(spark, sf), ["pc1", "pc2"], 2)
    return profile.mean_top_probability(out)
