"""Composed jobs end to end on the smallest tables (L1-L4)."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from contrail.plans import jobs
from contrail.sources import fixtures as fx
from contrail.sources.tables import table_path

from driver_tables import SF_SMALL

SMALL = {"n_estimators": 6, "max_depth": 4, "min_child_samples": 5, "seed": 1}


def flights(spark):
    """The raw fixture with the remaining columns of the flight schema."""
    raw = fx.trips_raw(spark, SF_SMALL)
    return raw.withColumns({
        "distance_km": F.col("l_extendedprice") / 10, "planned_duration_min": F.col("l_extendedprice") / 100,
        "temperature_origin_c": (F.col("l_partkey") % 40 - 10).cast("double"), "weather_destination": F.col("weather_origin"),
        "route_avg_delay_min": (F.col("l_suppkey") % 30).cast("double"),
        "aircraft_age_years": (F.col("l_suppkey") % 20).cast("double")})


def test_profile_prepare_featurize(spark):
    base = tempfile.mkdtemp(prefix="contrail-jobs-")
    raw = flights(spark)
    rep = jobs.profile_job(spark, raw, os.path.join(base, "stats"), table_path(SF_SMALL, "lineitem")).first()
    assert rep.rows_total == raw.count() and rep.file.n_files == 1
    assert rep.duplicate_keys == raw.count() - raw.select("flight_id").distinct().count()
    files = [f for f in os.listdir(os.path.join(base, "stats")) if f.endswith(".json")]
    doc = json.loads(open(os.path.join(base, "stats", files[0])).read())
    assert set(doc["delay_minutes_when_significant"]) == {"mean_delay", "max_delay", "median_delay", "p95_delay"}
    clean = jobs.prepare_job(raw, os.path.join(base, "clean"), order_by=fx.DEDUP_ORDER)
    assert clean.count() == raw.select("flight_id").distinct().count()
    feat = jobs.featurize_job(spark.read.parquet(os.path.join(base, "clean")), os.path.join(base, "features"))
    assert {"flight_id", "weather_severity_score", "delay_reason"} <= set(feat.columns)
    with pytest.raises(ValueError, match="distance_km"):
        jobs.featurize_job(fx.trips(spark, SF_SMALL), os.path.join(base, "none"))
    with pytest.raises(ValueError, match="order"):
        jobs.prepare_job(raw, os.path.join(base, "none"))


def test_compare_job(spark):
    v = fx.dataset_versions(spark, SF_SMALL)
    out = jobs.compare_job(v, "v1", "v2", os.path.join(tempfile.mkdtemp(), "cmp"))
    assert all(r.delta == 0 for r in out.collect())  # v2 is a copy of v1


def test_every_stage_of_the_command_line_in_order(spark):
    """profile -> prepare -> relabel -> featurize -> train -> report -> compare -> evolution on one dataset."""
    from contrail.__main__ import main

    base = tempfile.mkdtemp(prefix="contrail-cli-")

    def at(name):
        return os.path.join(base, name)

    def run(*args):
        assert main(list(args), spark) == 0
    flights(spark).write.parquet(at("raw"))
    run("profile", "--input", at("raw"), "--out", at("stats"))
    run("prepare", "--input", at("raw"), "--out", at("clean"), "--order-by", *fx.DEDUP_ORDER)
    run("relabel", "--input", at("clean"), "--out", at("v1"), "--rules", "v1")
    run("featurize", "--input", at("v1"), "--out", at("features"))
    run("train", "--input", at("features"), "--out", at("models"), "--runs", at("runs"), "--version", "v1",
        "--trees", "5", "--depth", "4")
    run("report", "--input", at("features"), "--models", at("models"), "--out", at("report"))
    run("compare", "--old", at("clean"), "--new", at("v1"), "--out", at("cmp"))
    run("evolution", "--versions", f"v0={at('clean')}", f"v1={at('v1')}", f"v2={at('v1')}", "--out", at("evolution"))

    runs = {r.run_name: r for r in spark.read.parquet(at("runs")).collect()}
    n = spark.read.parquet(at("features")).count()
    assert set(runs) == {"train_delay", "train_reason"} and all(r.data_version == "v1" for r in runs.values())
    data = runs["train_delay"].metrics
    assert data["data.rows_train"] + data["data.rows_test"] == n and 0 < data["data.positive_share"] < 1
    assert runs["train_reason"].metrics["data.rows_test"] > 0 and runs["train_reason"].data_fingerprint
    delay = spark.read.parquet(at("report/predictions_delay"))
    reason = spark.read.parquet(at("report/predictions_reason"))
    assert set(jobs.DESCRIPTIVE_COLS) <= set(delay.columns) & set(reason.columns) and "reason_correct" in reason.columns
    assert delay.count() == data["data.rows_test"]
    summary = spark.read.json(at("report/predictions_summary")).first()
    assert summary.delay.support_total == delay.count() and summary.reason.support_total == reason.count()
    assert summary.split.threshold == float(runs["train_delay"].params["threshold"])
    assert summary.delay.predicted_positives == summary.delay.tp + summary.delay.fp
    classes = [r.actual for r in summary.matrix]
    assert classes == sorted(classes) and {r["class"] for r in summary.distribution} <= set(classes)
    for name in ("delay", "reason"):
        assert spark.read.json(at(f"models/importances_{name}")).count() == 20
    cmp = {r.measure: r for r in spark.read.parquet(at("cmp")).collect()}
    assert cmp["positive_count"].delta > 0 and cmp["rows_total"].delta == 0
    assert [r.version for r in spark.read.parquet(at("evolution")).orderBy("version").collect()] == ["v0", "v1"]
    assert jobs.report_job(spark, flights(spark), at("nothing"), at("none")) is None
