"""End-to-end batch jobs composed from the operators (query lifecycles L1-L4).

Each job takes DataFrames or paths and writes Parquet / JSON outputs; any
orchestrator can call them in order:

* ``profile_job``      - dataset profile as a nested JSON report (G1-G3, S6, S7)
* ``prepare_job``      - dedup on the flight key, parse dates, write (D1, F20, S2)
* ``featurize_job``    - derived flags + projection of features and targets (F, P1)
* ``train_job``        - split train/valid/test, fit both models, tune the
                         threshold on *valid*, report on *test*, log the run,
                         save bundles (T1, T3, M4-M7, E1-E5, R1, S5)
* ``report_job``       - predictions tables and the combined summary (L3, P7, E9)
* ``compare_job``      - version statistics and comparison (L4, S4, G7, G8)
* ``evolution_job``    - the distinct versions in order with their statistics (S4, G7, D5)
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.functions.calendar import enrich_features
from contrail.functions.flags import add_derived_features
from contrail.operators import dedup, learn, lineage, metrics, profile, sampling
from contrail.operators.features import prediction_report, reason_subset, select_features
from contrail.operators.report import prediction_summary
from contrail.schema import FEATURE_COLS, RAW_TARGET, TARGET_DELAY, TARGET_REASON
from contrail.session import cut_lineage
from contrail.sources.io import source_stats, write_report, write_table

# --- fixed values: columns that the prediction tables carry beside the scores
DESCRIPTIVE_COLS = [
    "airline_code", "origin_airport", "destination_airport", "route", "aircraft_type", "departure_hour",
    "weather_origin", "weather_destination", "visibility_origin_km", "precipitation_origin_mm",
    "airport_load_index", "airline_load_factor", "previous_flight_delay_min", "technical_check_required",
    "crew_change_required",
]
TEST_FRACTION = 0.2


def profile_job(spark: SparkSession, df: DataFrame, out: str, source_path: str | None = None,
                key: str = "flight_id") -> DataFrame:
    """One nested row: file facts, rows, duplicates, positives, reason counts,
    delay summary and the content fingerprint; written as JSON."""
    stats = profile.dataset_stats(df, key)
    reasons = profile.value_counts(df, TARGET_REASON).agg(
        F.map_from_entries(F.collect_list(F.struct(TARGET_REASON, "n_rows"))).alias("m"))
    summary = profile.delay_summary(df)
    fp = lineage.fingerprint(df, df.columns)
    # one-row parts assembled as scalar subqueries: no joins
    cols = [stats.select(F.struct(*stats.columns)).scalar().alias("profile"),
            reasons.select("m").scalar().alias("delay_reason_counts"),
            summary.select(F.struct(*summary.columns)).scalar().alias("delay_minutes_when_significant"),
            fp.select(F.col("fingerprint").cast("string")).scalar().alias("fingerprint")]
    if source_path:
        st = source_stats(spark, source_path)
        cols.append(st.select(F.struct("n_files", "size_bytes")).scalar().alias("file"))
    parts = spark.range(1).select(*cols)
    report = parts.select("profile.*", *[c for c in parts.columns if c != "profile"])
    write_report(report, out)
    return report


def prepare_job(df: DataFrame, out: str, key: str = "flight_id", order_by: Sequence[str] = ()) -> DataFrame:
    """Keep the first row per key and write Parquet.  ``order_by`` says which
    row is first and must be given: files have no row order."""
    clean = dedup.dedup_first(df, [key], list(order_by))
    write_table(clean, out)
    return clean


def featurize_job(df: DataFrame, out: str, features: Sequence[str] = FEATURE_COLS, key: str = "flight_id") -> DataFrame:
    """Calendar fields where absent, the flags, then key, features and
    targets.  A feature that the input neither has nor gives is an error."""
    feat = add_derived_features(enrich_features(df))
    out_df = select_features(feat, list(dict.fromkeys([key, *features, TARGET_DELAY, TARGET_REASON, RAW_TARGET])))
    write_table(out_df, out)
    return out_df


def _reason_rows(data: DataFrame, key: str, seed: int) -> DataFrame:
    """The reason subset with its own split, stratified by reason."""
    return sampling.stratified_split(reason_subset(data), TARGET_REASON, key, TEST_FRACTION, seed)


def train_job(spark: SparkSession, df: DataFrame, out_dir: str, run_log: str, key: str = "flight_id",
              delay_params: Mapping[str, object] = learn.DELAY_PARAMS,
              reason_params: Mapping[str, object] = learn.REASON_PARAMS,
              data_version: str | None = None, seed: int = 42) -> dict:
    """Fit both models, each on its own split: delay stratified by the flag,
    reason stratified by the reason.  The threshold is tuned on a *valid*
    split carved from train, never on the test rows it is reported on.

    The split tables and the scored rows are written once and read from
    there.  Both runs are logged with their row counts, positive share and the
    data fingerprint; the top importances are written beside the models."""
    spec = learn.FeatureSpec()
    data = cut_lineage(learn.prepare(df, spec))
    s1 = sampling.stratified_split(data, TARGET_DELAY, key, TEST_FRACTION, seed)
    s1 = cut_lineage(s1)
    rest = s1.filter("split = 'train'").drop("split")
    inner = cut_lineage(sampling.stratified_split(rest, TARGET_DELAY, key, TEST_FRACTION, seed + 1, "inner"))
    train = inner.filter("inner = 'train'").drop("inner")
    feats = learn.build_features(train, spec)
    delay_model = learn.train_delay(train, feats, params=delay_params)
    rated = inner.filter("inner = 'test'").drop("inner").withColumn("part", F.lit("valid")).unionByName(
        s1.filter("split = 'test'").drop("split").withColumn("part", F.lit("test")))
    rated = cut_lineage(learn.delay_probability(rated, feats, delay_model).select(
        "part", F.col("delay_probability").alias("p"), F.col(TARGET_DELAY).alias("y")))
    best = metrics.best_threshold(metrics.threshold_sweep(rated.filter("part = 'valid'"), **learn.THRESHOLD_GRID)).first()
    t = float(best.best_threshold)
    test_scored = rated.filter("part = 'test'").withColumn("y_pred", (F.col("p") >= t).cast("int"))
    bm = metrics.binary_metrics(test_scored).first().asDict()
    bm["roc_auc"] = metrics.roc_auc(test_scored).first()[0]
    bm["pr_auc"] = metrics.average_precision(test_scored).first()[0]

    reason_split = cut_lineage(_reason_rows(data, key, seed))
    reason_train = reason_split.filter("split = 'train'").drop("split")
    reason_feats = learn.build_features(reason_train, spec)
    reason_model, classes = learn.train_reason(reason_train, reason_feats, params=reason_params)
    named = learn.reason_prediction(reason_split.filter("split = 'test'"), reason_feats, reason_model, classes)
    named = cut_lineage(named.select(F.col(TARGET_REASON).alias("actual"), F.col("predicted_reason").alias("predicted")))
    rm = metrics.multiclass_summary(named).first().asDict()

    fp_txt = str(lineage.fingerprint(df, df.columns).first()["fingerprint"])
    size = s1.agg(F.count_if(F.col("split") == "train").alias("rows_train"), F.count_if(F.col("split") == "test")
                  .alias("rows_test"), F.avg(TARGET_DELAY).alias("positive_share")).first().asDict()
    rsize = reason_split.agg(F.count_if(F.col("split") == "train").alias("rows_train"),
                             F.count_if(F.col("split") == "test").alias("rows_test")).first().asDict()
    delay_dir, reason_dir = os.path.join(out_dir, "delay_model"), os.path.join(out_dir, "reason_model")
    learn.save_bundle(delay_dir, feats, delay_model, {
        "threshold": t, "valid_f1": best.best_f1, "metrics": bm, "params": dict(delay_params), "data": size,
        "data_fingerprint": fp_txt})
    learn.save_bundle(reason_dir, reason_feats, reason_model, {
        "classes": classes, "metrics": rm, "params": dict(reason_params), "data": rsize, "data_fingerprint": fp_txt})
    for name, model in (("delay", delay_model), ("reason", reason_model)):
        write_report(learn.top_importances(spark, model, spec.all), os.path.join(out_dir, f"importances_{name}"))
    lineage.log_run(spark, run_log, "delay", "train_delay", dict(delay_params, threshold=t), {**bm, "data": size},
                    data_version, fp_txt)
    lineage.log_run(spark, run_log, "reason", "train_reason", reason_params, {**rm, "data": rsize}, data_version, fp_txt)
    return {"threshold": t, "metrics": bm, "classes": classes, "reason_metrics": rm}


def report_job(spark: SparkSession, df: DataFrame, model_dir: str, out_dir: str,
               key: str = "flight_id", seed: int = 42) -> DataFrame | None:
    """Rebuild both test splits (same seed and key), score them, write the
    prediction tables with their descriptive columns and the combined summary.
    Either model missing -> nothing is written and None comes back."""
    delay = learn.load_bundle(os.path.join(model_dir, "delay_model"))
    reason = learn.load_bundle(os.path.join(model_dir, "reason_model"))
    if delay is None or reason is None:
        return None
    feats, delay_model, meta = delay
    reason_feats, reason_model, rmeta = reason
    t, classes = float(meta["threshold"]), rmeta["classes"]
    data = cut_lineage(learn.prepare(df, learn.FeatureSpec()))
    shown = [c for c in DESCRIPTIVE_COLS if c in data.columns]
    test = sampling.stratified_split(data, TARGET_DELAY, key, TEST_FRACTION, seed).filter("split = 'test'")
    p = cut_lineage(learn.delay_probability(test, feats, delay_model).select(
        key, F.col(TARGET_DELAY).alias("y"), F.col("delay_probability").alias("p"), *shown))
    write_table(prediction_report(p, [key, *shown], "y", "p", t), os.path.join(out_dir, "predictions_delay"))
    rtest = _reason_rows(data, key, seed).filter("split = 'test'")
    named = learn.reason_prediction(rtest, reason_feats, reason_model, classes)
    correct = F.col(TARGET_REASON) == F.col("predicted_reason")
    write_table(named.select(key, F.col(TARGET_REASON).alias("actual"), F.col("predicted_reason").alias("predicted"),
                             correct.alias("reason_correct"), "reason_probability", *shown),
                os.path.join(out_dir, "predictions_reason"))
    rp = spark.read.parquet(os.path.join(out_dir, "predictions_reason"))
    summary = prediction_summary(p.withColumn("y_pred", (F.col("p") >= t).cast("int")), rp, classes,
                                 facts={"test_fraction": TEST_FRACTION, "seed": seed, "threshold": t})
    write_report(summary, os.path.join(out_dir, "predictions_summary"))
    return summary


def evolution_job(versions: DataFrame, out: str) -> DataFrame:
    """Statistics of every version in order, versions with the content of an
    earlier one left out (S4 -> G7 -> D5); written as a table."""
    versions = cut_lineage(versions)
    cols = [c for c in versions.columns if c != "version"]
    stats = profile.version_stats(versions).join(lineage.fingerprint(versions, cols, by=["version"]), "version")
    kept = dedup.distinct_versions(stats, ["n_rows", "fingerprint"]).orderBy("version")
    write_table(kept, out)
    return kept


def compare_job(versions: DataFrame, old: str, new: str, out: str) -> DataFrame:
    """Statistics per version and the old/new comparison table."""
    cmp = profile.compare_versions(versions, old, new)
    write_table(cmp, out)
    return cmp
