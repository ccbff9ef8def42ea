"""Streaming jobs over folders, the model store, stored versions, the run log's retries."""

import os

import pytest
from pyspark.sql import functions as F

from contrail.operators import boosting, learn, lineage
from contrail.operators.learn import FeatureSpec
from contrail.sources import fixtures as fx
from contrail.sources import read_versions
from contrail.streaming import run_scoring, run_traffic, write_scored

from driver_tables import SF_SMALL

EVENTS = "event_id bigint, ts timestamp_ntz, event_type string, value double"


def events(spark, rows):
    return spark.createDataFrame(rows, "event_id bigint, ts string, event_type string, value double") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def test_late_file_is_dropped_and_a_restart_goes_on(spark, tmp_path):
    feed, out, progress = (str(tmp_path / n) for n in ("feed", "out", "progress"))
    schema = events(spark, []).schema

    def arrive(rows):
        events(spark, rows).coalesce(1).write.mode("append").parquet(feed)
        run_traffic(spark, feed, schema, out, progress, watermark="10 minutes", length="10 minutes", slide="10 minutes")
        return {r.window_start // 60_000_000 % 1440: r.n_requests for r in spark.read.parquet(out).collect()}

    assert arrive([(1, "2024-01-01 00:01:00", "a", 1.0), (2, "2024-01-01 00:12:00", "a", 1.0),
                   (3, "2024-01-01 00:31:00", "a", 1.0)]) == {0: 1, 10: 1}
    # 00:02 is behind the watermark of 00:21, 00:25 is not
    assert arrive([(4, "2024-01-01 00:02:00", "a", 1.0), (5, "2024-01-01 00:25:00", "error", 1.0),
                   (6, "2024-01-01 01:00:00", "a", 1.0)]) == {0: 1, 10: 1, 20: 1, 30: 1}
    assert arrive([]) == {0: 1, 10: 1, 20: 1, 30: 1}


@pytest.fixture(scope="module")
def fitted(spark):
    spec = FeatureSpec(numeric=["visibility_origin_km"], ints=["departure_hour"], categorical=["weather_origin"])
    t = fx.trips(spark, SF_SMALL).cache()
    feats = learn.build_features(t, spec)
    params = {"n_estimators": 1, "learning_rate": 0.3, "num_leaves": 4, "max_depth": 2, "min_child_samples": 5}
    return spec, feats, learn.train_delay(t, feats, params=params), t


def test_a_batch_run_twice_leaves_its_rows_once(spark, tmp_path, fitted):
    spec, feats, delay, _ = fitted
    requests = fx.score_requests(spark, SF_SMALL).cache()
    out = str(tmp_path / "out")
    args = (out, feats, delay, 0.5, None, (), spec, ["flight_id"])
    write_scored(requests.filter("flight_id LIKE '%-1'"), 0, *args)
    write_scored(requests.filter("flight_id LIKE '%-2'"), 1, *args)
    n = [spark.read.parquet(os.path.join(out, k)).count() for k in ("accepted", "rejected")]
    write_scored(requests.filter("flight_id LIKE '%-2'"), 1, *args)
    assert [spark.read.parquet(os.path.join(out, k)).count() for k in ("accepted", "rejected")] == n
    assert sum(n) == requests.filter("flight_id LIKE '%-1' OR flight_id LIKE '%-2'").count()


def test_a_failed_run_is_taken_up_again(spark, tmp_path, fitted):
    spec, feats, delay, _ = fitted
    feed, out, progress = (str(tmp_path / n) for n in ("feed", "out", "progress"))
    requests = fx.score_requests(spark, SF_SMALL).limit(200)
    requests.write.parquet(feed)
    with pytest.raises(Exception):  # the rejected rows can't be written: a file is in the way
        os.makedirs(out)
        open(os.path.join(out, "rejected"), "w").close()
        run_scoring(spark, feed, requests.schema, out, progress, feats, delay, 0.5, spec=spec, keep=["flight_id"])
    os.replace(os.path.join(out, "rejected"), str(tmp_path / "aside"))
    for _ in range(2):  # the second run finds nothing new
        run_scoring(spark, feed, requests.schema, out, progress, feats, delay, 0.5, spec=spec, keep=["flight_id"])
        assert sum(spark.read.parquet(os.path.join(out, k)).count() for k in ("accepted", "rejected")) == 200


def test_store_shows_published_versions_only(spark, tmp_path, fitted):
    spec, feats, delay, t = fitted
    store = str(tmp_path / "store")
    assert learn.load_newest(store) is None and learn.versions_of(store) == []
    first = learn.publish_bundle(store, learn.stage_bundle(store, feats, delay, {"threshold": 0.1}))
    staged = learn.stage_bundle(store, feats, delay, {"threshold": 0.2})
    got_feats, got, facts = learn.load_newest(store)
    assert facts == {"threshold": 0.1} and isinstance(got, boosting.BoostedTrees)
    assert got.nodes == delay.nodes and got.base == pytest.approx(delay.base)
    second = learn.publish_bundle(store, staged)
    assert learn.versions_of(store) == [first, second] and learn.load_newest(store)[2] == {"threshold": 0.2}
    a, b = (learn.score(t, f, m, 0.5, keep=["flight_id"]).orderBy("flight_id").collect()
            for f, m in ((feats, delay), (got_feats, got)))
    assert a == b


def test_versions_of_different_columns_in_one_scan(spark, tmp_path):
    base = tmp_path / "a b%20c"
    paths = {v: str(base / v) for v in ("v1", "v10", "v2")}
    spark.createDataFrame([(1, "x")], "id int, note string").write.parquet(paths["v1"])
    spark.createDataFrame([(2,)], "id int").write.parquet(paths["v10"])
    spark.createDataFrame([(3, 0.5)], "id int, extra double").write.parquet(paths["v2"])
    paths["v1/sub"] = str(base / "v1" / "sub=1")
    got = read_versions(spark, {k: paths[k] for k in ("v1", "v10", "v2")})
    assert sorted(map(tuple, got.select("version", "id", "note", "extra").collect())) == [
        ("v1", 1, "x", None), ("v10", 2, None, None), ("v2", 3, None, 0.5)]
    plan = got.filter("version = 'v2'").select("id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_runs_are_logged_once_and_compacted(spark, tmp_path):
    path = str(tmp_path / "runs")
    for _ in range(2):
        lineage.log_run(spark, path, "delay", "r", {"a": 1}, {"f1": 0.5}, run_id="one")
    lineage.log_run(spark, path, "delay", "r", {"a": 2}, {"f1": 0.6})
    assert lineage.read_runs(spark, path).count() == 2
    assert lineage.compact_runs(spark, path) == 2 and lineage.compact_runs(spark, path) == 0
    assert lineage.read_runs(spark, path).count() == 2
    lineage.log_run(spark, path, "delay", "r", {"a": 3}, {"f1": 0.7}, run_id="one")
    got = {r.run_id: r.params["a"] for r in lineage.read_runs(spark, path).collect()}
    assert got["one"] == "3" and len(got) == 2
    lineage.compact_runs(spark, path)
    assert {r.run_id: r.params["a"] for r in lineage.read_runs(spark, path).collect()} == got
    with pytest.raises(ValueError):
        lineage.log_run(spark, path, "delay", "r", {}, {}, run_id="a/b")
