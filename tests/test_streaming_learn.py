"""MLlib training/scoring, bundles and the streaming forms."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from contrail.operators import learn, sampling, traffic
from contrail.sources import fixtures as fx
from contrail.streaming import request_log, score_stream, traffic_stream

from driver_tables import SF_SMALL


@pytest.fixture(scope="module")
def models(spark):
    t = fx.trips(spark, SF_SMALL)
    seed, rules = sampling.RULE_SETS["v1"]
    t = sampling.relabel(t, rules, "flight_id", seed)  # plants weather/load/cascade structure
    spec = learn.FeatureSpec()
    data = learn.prepare(t, spec)
    split = sampling.stratified_split(data, "is_significant_delay", "flight_id", 0.2, 42).cache()
    train, test = split.filter("split = 'train'"), split.filter("split = 'test'")
    feats = learn.build_features(train, spec)
    delay = learn.train_delay(train, feats, params=dict(learn.DELAY_PARAMS, n_estimators=8, max_depth=4))
    reasons = train.filter("is_significant_delay = 1 AND delay_reason <> 'none'")
    reason, classes = learn.train_reason(reasons, feats, params=dict(learn.REASON_PARAMS, n_estimators=8,
                                                                     max_depth=4))
    return spec, feats, delay, reason, classes, test


def test_feature_vector_order_and_unseen(spark, models):
    spec, feats, *_ = models
    cols = feats.stages[-1].getInputCols()
    assert cols[:12] == [f"{c}__f" for c in spec.numeric]
    assert cols[-9:] == [f"{c}__i" for c in spec.categorical]
    labels = [list(v) for s in feats.stages if hasattr(s, "labelsArray") for v in s.labelsArray]
    assert len(labels) == 9 and all(v == sorted(v) for v in labels)
    one = learn.prepare(spark.createDataFrame([("zz-new", "2025-01-01 10:00")],
                                              "airline_code string, scheduled_departure_local string"), spec)
    v = feats.transform(one).select("features").first()[0]
    assert v[len(spec.numeric) + len(spec.ints)] == float(len(labels[0]))  # unseen bucket


def test_score_and_quality(spark, models):
    spec, feats, delay, reason, classes, test = models
    scored = learn.score(test, feats, delay, 0.5, reason, classes, keep=["flight_id"])
    rows = scored.collect()
    assert len(rows) == test.count()
    assert all(0 <= r.delay_probability <= 1 for r in rows)
    assert all((r.predicted_reason is None) == (not r.is_significant_delay) for r in rows)
    assert all(r.predicted_reason in classes for r in rows if r.predicted_reason)
    from contrail.operators import metrics
    p = learn.delay_probability(test, feats, delay).select(
        F.col("delay_probability").alias("p"), F.col("is_significant_delay").alias("y"))
    assert metrics.roc_auc(p).first()[0] > 0.6


def test_bundle_roundtrip_and_importances(spark, models):
    spec, feats, delay, *_ = models
    path = tempfile.mkdtemp(prefix="contrail-bundle-")
    learn.save_bundle(path, feats, delay, {"threshold": 0.52})
    got = learn.load_bundle(path)
    assert got is not None and got[2]["threshold"] == 0.52
    assert learn.load_bundle(os.path.join(path, "missing")) is None
    with pytest.raises(Exception):  # a folder that is no bundle is an error, not a missing model
        learn.load_bundle(os.path.join(path, "metadata"))
    top = learn.top_importances(spark, delay, spec.all, k=5).collect()
    assert len(top) == 5 and [r.importance for r in top] == sorted((r.importance for r in top), reverse=True)


def test_score_stream(spark, models):
    spec, feats, delay, reason, classes, _ = models
    src = tempfile.mkdtemp(prefix="contrail-req-")
    req = fx.score_requests(spark, SF_SMALL).withColumnRenamed("flight_id", "request_id")
    bad = F.col("request_id").endswith("7-1")
    req = req.withColumn("scheduled_departure_local", F.when(bad, "not a date").otherwise(F.col("scheduled_departure_local")))
    req.write.mode("overwrite").parquet(os.path.join(src, "batch1"))
    stream = spark.readStream.schema(req.schema).parquet(os.path.join(src, "batch1"))
    for name, part in zip(("scored_requests", "rejected_requests"),
                          score_stream(stream, feats, delay, 0.5, reason, classes)):
        q = part.writeStream.format("memory").queryName(name).outputMode("append").start()
        q.processAllAvailable()
        q.stop()
    n_valid = req.filter(" AND ".join(f"{c} IS NOT NULL" for c in ["aircraft_type", "distance_km"])).filter(~bad).count()
    assert spark.table("scored_requests").count() == n_valid
    assert spark.table("rejected_requests").count() == req.count() - n_valid
    why = {r.rejected_for for r in spark.table("rejected_requests").collect()}
    assert why == {"aircraft_type", "distance_km", "scheduled_departure_local"}


def test_traffic_stream_equals_batch_on_closed_windows(spark):
    ev = spark.read.parquet(os.path.join(SF_SMALL, "events.parquet"))
    src = tempfile.mkdtemp(prefix="contrail-ev-")
    mid = ev.agg(F.expr("percentile_approx(ts, 0.5)")).first()[0]
    ev.filter(F.col("ts") < F.lit(mid)).write.parquet(os.path.join(src, "a"))
    ev.filter(F.col("ts") >= F.lit(mid)).write.mode("append").parquet(os.path.join(src, "a"))
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(src, "a"))
    q = traffic_stream(request_log(stream), "0 seconds", "1 hour", "15 minutes", "rate").writeStream \
        .format("memory").queryName("rates").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = {r.window_start: r.n_requests for r in spark.table("rates").collect()}
    batch = {r.window_start: r.n_requests for r in traffic.request_rate(
        request_log(ev), "1 hour", "15 minutes").collect()}
    assert got, "no window was closed"
    assert all(batch[k] == v for k, v in got.items())
    max_us = ev.select(F.unix_micros(F.max("ts").cast("timestamp"))).first()[0]
    closed = {k for k in batch if k + 3600 * 10**6 <= max_us}
    assert closed <= set(got)


@pytest.mark.parametrize("kind", ["errors", "latency"])
def test_traffic_stream_other_kinds(spark, kind):
    ev = spark.read.parquet(os.path.join(SF_SMALL, "events.parquet"))
    src = tempfile.mkdtemp(prefix="contrail-ev2-")
    ev.write.parquet(os.path.join(src, "a"))
    stream = spark.readStream.schema(ev.schema).parquet(os.path.join(src, "a"))
    q = traffic_stream(request_log(stream), "0 seconds", "1 hour", "15 minutes", kind).writeStream \
        .format("memory").queryName(f"t_{kind}").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = spark.table(f"t_{kind}").collect()
    batch_fn = traffic.error_rate if kind == "errors" else traffic.latency_quantiles
    args = ("1 hour", "15 minutes") if kind == "errors" else ([0.5, 0.95], "1 hour", "15 minutes")
    batch = {r.window_start: r for r in batch_fn(request_log(ev), *args).collect()}
    for r in got:
        assert r.n_requests == batch[r.window_start].n_requests
