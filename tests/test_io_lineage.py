"""Sources and sinks, versions, fingerprints, run log (S1-S7, R1-R3, D2, D5, D6, G)."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from contrail.operators import dedup, lineage, profile
from contrail.schema import FLIGHTS
from contrail.sources import read_flights, read_versions, source_stats, write_report, write_table


def _tmp():
    return tempfile.mkdtemp(prefix="contrail-test-")


def test_read_flights_bom_na_tokens_and_dates(spark):
    d = _tmp()
    header = ",".join(f.name for f in FLIGHTS)
    row = {f.name: "" for f in FLIGHTS}
    row.update(flight_id="F1", flight_date="2025-11-29", scheduled_departure_local="2025-11-29 08:35",
               distance_km="1769", delay_minutes="20", is_significant_delay="1", delay_reason="weather",
               weather_origin="NA", visibility_origin_km="nan")
    row2 = dict(row, flight_id="F2", delay_reason="none", scheduled_departure_local="bad", distance_km="x")
    with open(os.path.join(d, "f.csv"), "w", encoding="utf-8-sig") as fh:
        fh.write(header + "\n")
        for r in (row, row2):
            fh.write(",".join(r[f.name] for f in FLIGHTS) + "\n")
    df = read_flights(spark, d)
    rows = {r.flight_id: r for r in df.collect()}
    assert set(rows) == {"F1", "F2"}  # BOM stripped from the first header name
    assert rows["F1"].weather_origin is None and rows["F1"].visibility_origin_km is None
    assert rows["F1"].distance_km == 1769.0 and rows["F1"].scheduled_departure_local.hour == 8
    assert rows["F2"].delay_reason == "none"  # lower-case none is a value, not a missing mark
    assert rows["F2"].scheduled_departure_local is None and rows["F2"].distance_km is None


def test_table_sink_versions_and_source_stats(spark):
    base = _tmp()
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    b = spark.createDataFrame([(1, "x"), (3, "z"), (4, "w")], "id int, v string")
    write_table(a, os.path.join(base, "a"))
    write_table(b, os.path.join(base, "b"))
    both = read_versions(spark, {"v0": os.path.join(base, "a"), "v1": os.path.join(base, "b")})
    assert {(r.version, r["count"]) for r in both.groupBy("version").count().collect()} == {("v0", 2), ("v1", 3)}
    st = source_stats(spark, os.path.join(base, "b"), "*.parquet").first()
    files = [f for f in os.listdir(os.path.join(base, "b")) if f.endswith(".parquet")]
    assert st.n_files == len(files)
    assert st.size_bytes == sum(os.path.getsize(os.path.join(base, "b", f)) for f in files)


def test_json_report_is_nested(spark):
    out = os.path.join(_tmp(), "rep")
    df = spark.createDataFrame([(1,)], "x int").select(
        F.struct(F.lit(3).alias("count"), F.lit(0.5).alias("share")).alias("positive_class"),
        F.create_map(F.lit("weather"), F.lit(7)).alias("reason_counts"))
    write_report(df, out)
    text = [f for f in os.listdir(out) if f.endswith(".json")]
    doc = json.loads(open(os.path.join(out, text[0])).read().strip())
    assert doc == {"positive_class": {"count": 3, "share": 0.5}, "reason_counts": {"weather": 7}}


def test_fingerprint_order_free_and_duplicate_sensitive(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    fa = lineage.fingerprint(a, ["id", "v"]).first()
    fb = lineage.fingerprint(a.orderBy(F.desc("id")).repartition(3), ["id", "v"]).first()
    assert fa == fb
    dup = lineage.fingerprint(a.union(a.filter("id = 1")), ["id", "v"]).first()
    assert dup.fingerprint != fa.fingerprint and dup.n_rows == 3
    null_vs_empty = lineage.fingerprint(spark.createDataFrame([(1, None)], "id int, v string"), ["id", "v"]).first()
    empty = lineage.fingerprint(spark.createDataFrame([(1, "")], "id int, v string"), ["id", "v"]).first()
    assert null_vs_empty.fingerprint != empty.fingerprint


def test_duplicates_and_dedup_first(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2), (None, 1), (None, 2)], "k string, o int")
    r = dedup.duplicate_count(df, ["k"]).first()
    assert (r.rows_total, r.distinct_keys, r.duplicate_rows) == (5, 3, 2)
    first = {x.k: x.o for x in dedup.dedup_first(df, ["k"], ["o"]).collect()}
    assert first == {"a": 1, "b": 2, None: 1}


def test_label_violations_all_kinds(spark):
    df = spark.createDataFrame([(20, 0, "none"), (5, 0, "weather"), (30, 1, "none"), (30, 1, "weather")],
                               "delay_minutes int, is_significant_delay int, delay_reason string")
    got = {r.violation: r.n_rows for r in dedup.label_violations(df).collect()}
    assert got == {"flag_mismatch": 1, "reason_without_delay": 1, "delay_without_reason": 1}


def test_run_log_deltas_and_lineage(spark):
    path = os.path.join(_tmp(), "runs")
    lineage.log_run(spark, path, "delay", "r1", {"lr": 0.04}, {"f1": 0.5, "per_class": {"a": 0.1}, "note": "x"},
                    "v0", "123")
    lineage.log_run(spark, path, "delay", "r2", {"lr": 0.04}, {"f1": 0.75}, "v1", None)
    runs = spark.read.parquet(path)
    assert runs.count() == 2
    assert sorted(runs.first().metrics) in (["f1", "per_class.a"], ["f1"])
    d = {(r.metric, r.run_id): r.delta for r in lineage.metric_deltas(
        runs.select("experiment", F.col("run_name").alias("run_id"), "start_time", "metrics")).collect()}
    assert d[("f1", "r1")] is None and d[("f1", "r2")] == 0.25
    fps = spark.createDataFrame([("v0", 10, "123"), ("v1", 11, "456")], "version string, n_rows int, fingerprint string")
    verdict = {r.run_id: r.verdict for r in lineage.lineage_check(
        runs.select(F.col("run_name").alias("run_id"), "data_version", "data_fingerprint"), fps, "v0", "v1").collect()}
    assert verdict == {"r1": "match", "r2": "not recorded"}


def test_compare_versions_reason_union_with_zero(spark):
    rows = [("v0", 20, 1, "weather"), ("v0", 3, 0, "none"), ("v1", 40, 1, "technical"), ("v1", 2, 0, "none")]
    df = spark.createDataFrame(rows, "version string, delay_minutes int, is_significant_delay int, delay_reason string")
    got = {r.measure: (r.old_value, r.new_value, r.delta) for r in profile.compare_versions(df, "v0", "v1").collect()}
    assert got["reason:weather"] == (1.0, 0.0, -1.0) and got["reason:technical"] == (0.0, 1.0, 1.0)
    assert got["mean_delay"] == (20.0, 40.0, 20.0) and got["rows_total"] == (2.0, 2.0, 0.0)


def test_distinct_versions_keeps_earliest(spark):
    st = spark.createDataFrame([("v0", 5, "a"), ("v1", 5, "b"), ("v2", 5, "b")], "version string, n int, fp string")
    assert sorted(r.version for r in dedup.distinct_versions(st, ["n", "fp"]).collect()) == ["v0", "v1"]


# --- fixed values: published reason counts before and after the rule edits --
REASONS_OLD = {"airline_operations": 3404, "airport_congestion": 4567, "late_aircraft": 4079, "none": 98432,
               "other": 1231, "security_or_border_control": 1237, "technical": 2098, "weather": 5312}
REASONS_NEW = {"airline_operations": 3643, "airport_congestion": 6988, "late_aircraft": 7588, "none": 76099,
               "other": 1231, "security_or_border_control": 1237, "technical": 2515, "weather": 21059}


def test_compare_versions_golden_counts(spark):
    rows = [(v, r, n) for v, counts in (("old", REASONS_OLD), ("new", REASONS_NEW)) for r, n in counts.items()]
    df = spark.createDataFrame(rows, "version string, delay_reason string, n int") \
        .withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("n")))) \
        .withColumn("is_significant_delay", (F.col("delay_reason") != "none").cast("int")) \
        .withColumn("delay_minutes", F.when(F.col("is_significant_delay") == 1, 20).otherwise(0)) \
        .drop("_i", "n")
    got = {r.measure: r for r in profile.compare_versions(df, "old", "new").collect()}
    assert got["rows_total"].old_value == 120360 and got["rows_total"].delta == 0
    assert got["positive_count"].old_value == 21928 and got["positive_count"].new_value == 44261
    assert round(got["positive_share"].old_value * 100, 2) == 18.22
    assert round(got["positive_share"].new_value * 100, 2) == 36.77
    for r in REASONS_OLD:
        assert got[f"reason:{r}"].delta == REASONS_NEW[r] - REASONS_OLD[r]


def test_session_keeps_preset_partitions(spark):
    from contrail.session import get_session

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        assert get_session().conf.get("spark.sql.shuffle.partitions") == "2000"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_row_text_is_unambiguous(spark):
    rows = [("x|y", "z"), ("x", "y|z"), ("\\N", "z"), (None, "z"), ("", "z"), ("1:x", None), ("1", ":x"), ("-", "z")]
    df = spark.createDataFrame(rows, "a string, b string")
    prints = {lineage.fingerprint(df.filter(F.monotonically_increasing_id().isNotNull()).limit(0).unionByName(
        spark.createDataFrame([r], df.schema)), ["a", "b"]).first().fingerprint for r in rows}
    assert len(prints) == len(rows)


def test_empty_input_counts_are_zero(spark):
    empty = spark.createDataFrame([], "flight_id string, is_significant_delay int")
    assert profile.dataset_stats(empty).first()[:3] == (0, 0, 0)
    assert tuple(dedup.duplicate_count(empty, ["flight_id"]).first()) == (0, 0, 0)


def test_csv_ints_written_as_decimals(spark):
    d = _tmp()
    with open(os.path.join(d, "f.csv"), "w") as fh:
        fh.write(",".join(f.name for f in FLIGHTS) + "\n")
        for i, minutes in enumerate(("8.0", "20", "1.5", " NA", "1e1", "")):
            fh.write(",".join({"flight_id": f"F{i}", "delay_minutes": minutes, "airline_code": " NA"}.get(f.name, "")
                              for f in FLIGHTS) + "\n")
    got = {r.flight_id: r for r in read_flights(spark, d).collect()}
    assert [got[f"F{i}"].delay_minutes for i in range(6)] == [8, 20, None, None, 10, None]
    assert got["F0"].airline_code == " NA"  # an NA token counts only as the whole value


def test_checkpoint_dir_is_never_local():
    import pytest

    from contrail.session import checkpoint_dir

    class _Conf:
        def get(self, key, default=None):
            return default

        def set(self, key, value):
            raise AssertionError("must not set a local folder on a cluster")

    class _Ctx:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class _Session:
        conf = _Conf()
        sparkContext = _Ctx()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Session())
