"""Queries: profiles, versions, fingerprints, run history (G, D, S4, S6, R)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from contrail.operators import dedup, lineage, profile
from contrail.plans.oracle_views import with_views
from contrail.plans.registry import query
from contrail.session import cut_lineage
from contrail.sources import fixtures as fx

#: Every column of the fixture's versions (all of the row).
FP_COLS = ["flight_id", "scheduled_departure_local", "airline_code", "origin_airport", "destination_airport", "route",
           "aircraft_type", "weather_origin", "precipitation_origin_mm", "visibility_origin_km",
           "wind_speed_origin_mps", "airport_load_index", "airline_load_factor", "previous_flight_delay_min",
           "departure_hour", "technical_check_required", "crew_change_required", "delay_minutes", "reason0",
           "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "is_significant_delay", "delay_reason"]


@query("dataset_stats", ("G1",), sql=with_views("trips_raw") + """
SELECT count(*) AS rows_total, CAST(count(*) - count(DISTINCT flight_id) AS BIGINT) AS duplicate_keys,
  CAST(sum(is_significant_delay) AS BIGINT) AS positive_count,
  round(avg(is_significant_delay), 6) AS positive_share
FROM trips_raw""")
def dataset_stats(spark, d):
    return profile.dataset_stats(fx.trips_raw(spark, d, ["flight_id", "is_significant_delay"]))


@query("duplicate_count", ("D2",), sql=with_views("trips_raw") + """
SELECT count(*) AS rows_total, count(DISTINCT flight_id) AS distinct_keys,
  CAST(count(*) - count(DISTINCT flight_id) AS BIGINT) AS duplicate_rows
FROM trips_raw""")
def duplicate_count(spark, d):
    return dedup.duplicate_count(fx.trips_raw(spark, d, ["flight_id"]), ["flight_id"])


@query("reason_counts", ("G2",), sql=with_views("trips_raw") + """
SELECT delay_reason, count(*) AS n_rows FROM trips_raw WHERE delay_reason IS NOT NULL GROUP BY delay_reason""")
def reason_counts(spark, d):
    return profile.value_counts(fx.trips_raw(spark, d, ["delay_reason"]), "delay_reason")


_SUMMARY_SQL = """avg(delay_minutes) AS mean_delay, max(delay_minutes) AS max_delay,
  quantile_cont(delay_minutes, 0.5) AS median_delay, quantile_cont(delay_minutes, 0.95) AS p95_delay"""


@query("delay_summary", ("G3", "P5"), sql=with_views("trips") + f"""
SELECT {_SUMMARY_SQL} FROM trips WHERE is_significant_delay = 1""")
def delay_summary(spark, d):
    return profile.delay_summary(fx.trips(spark, d, ["is_significant_delay", "delay_minutes"]))


STATS_COLS = ["flight_id", "delay_minutes", "is_significant_delay", "delay_reason", "l_shipdate"]
NULL_COLS = ["flight_id", "scheduled_departure_local", "airline_code", "origin_airport", "destination_airport",
             "route", "aircraft_type", "weather_origin", "precipitation_origin_mm", "visibility_origin_km",
             "wind_speed_origin_mps", "airport_load_index", "airline_load_factor", "previous_flight_delay_min",
             "departure_hour", "technical_check_required", "crew_change_required", "delay_minutes",
             "is_significant_delay", "delay_reason"]


@query("null_profile", ("G4",), sql=with_views("trips_raw") + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM trips_raw"
    for c in NULL_COLS))
def null_profile(spark, d):
    return profile.null_profile(fx.trips_raw(spark, d, NULL_COLS), NULL_COLS)


@query("period_profile", ("G5",), sql=with_views("trips_raw") + """
SELECT CAST(year(scheduled_departure_local) AS INTEGER) AS year, count(*) AS n_rows,
  min(scheduled_departure_local) AS period_start, max(scheduled_departure_local) AS period_end
FROM trips_raw GROUP BY 1""")
def period_profile(spark, d):
    return profile.period_profile(fx.trips_raw(spark, d, ["scheduled_departure_local"]), "scheduled_departure_local")


@query("class_distribution", ("G6",), sql=with_views("class_preds") + """
SELECT coalesce(a.cls, p.cls) AS class, coalesce(a.n, 0) AS actual_count, coalesce(p.n, 0) AS predicted_count
FROM (SELECT actual AS cls, count(*) AS n FROM class_preds WHERE actual IS NOT NULL GROUP BY 1) a
FULL OUTER JOIN (SELECT predicted AS cls, count(*) AS n FROM class_preds WHERE predicted IS NOT NULL GROUP BY 1) p
  ON a.cls = p.cls""")
def class_distribution(spark, d):
    return profile.class_distribution(fx.class_preds(spark, d))


_VERSION_STATS_SQL = f"""
SELECT b.version, rows_total, positive_count, positive_share, mean_delay, max_delay, median_delay, p95_delay
FROM (SELECT version, count(*) AS rows_total, CAST(sum(is_significant_delay) AS BIGINT) AS positive_count,
        avg(is_significant_delay) AS positive_share FROM dataset_versions GROUP BY version) b
LEFT JOIN (SELECT version, {_SUMMARY_SQL} FROM dataset_versions WHERE is_significant_delay = 1 GROUP BY version) s
  ON b.version = s.version"""


@query("version_stats", ("G7",), sql=with_views("dataset_versions") + _VERSION_STATS_SQL)
def version_stats(spark, d):
    return profile.version_stats(fx.dataset_versions(spark, d, STATS_COLS))


@query("compare_versions", ("G8",), sql=with_views("dataset_versions") + f""",
vs AS ({_VERSION_STATS_SQL}),
m AS (
  SELECT version, measure, value FROM (
    SELECT version, CAST(rows_total AS DOUBLE) AS rows_total, CAST(positive_count AS DOUBLE) AS positive_count,
      positive_share, mean_delay, CAST(median_delay AS DOUBLE) AS median_delay, p95_delay FROM vs)
  UNPIVOT INCLUDE NULLS (value FOR measure IN (rows_total, positive_count, positive_share, mean_delay,
    median_delay, p95_delay))
  UNION ALL
  SELECT version, 'reason:' || delay_reason AS measure, CAST(count(*) AS DOUBLE) AS value
  FROM dataset_versions WHERE delay_reason IS NOT NULL GROUP BY version, delay_reason),
o AS (SELECT measure, value AS old_value FROM m WHERE version = 'v0'),
n AS (SELECT measure, value AS new_value FROM m WHERE version = 'v1'),
j AS (SELECT coalesce(o.measure, n.measure) AS measure, old_value, new_value FROM o FULL OUTER JOIN n
      ON o.measure = n.measure)
SELECT measure,
  CASE WHEN measure LIKE 'reason:%' THEN coalesce(old_value, 0) ELSE old_value END AS old_value,
  CASE WHEN measure LIKE 'reason:%' THEN coalesce(new_value, 0) ELSE new_value END AS new_value,
  (CASE WHEN measure LIKE 'reason:%' THEN coalesce(new_value, 0) ELSE new_value END)
  - (CASE WHEN measure LIKE 'reason:%' THEN coalesce(old_value, 0) ELSE old_value END) AS delta
FROM j""")
def compare_versions(spark, d):
    return profile.compare_versions(fx.dataset_versions(spark, d, STATS_COLS), "v0", "v1")


_FP_TEXT = " || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in FP_COLS)
_FP_SQL = f"""
SELECT version, count(*) AS n_rows,
  sum(CAST(('0x' || substr(md5({_FP_TEXT}), 1, 15))::BIGINT AS DECIMAL(38, 0))) AS fingerprint
FROM dataset_versions GROUP BY version"""


@query("dataset_fingerprint", ("S6",), sql=with_views("dataset_versions") + _FP_SQL)
def dataset_fingerprint(spark, d):
    return lineage.fingerprint(fx.dataset_versions(spark, d), FP_COLS, by=["version"])


@query("distinct_versions", ("D5",), sql=with_views("dataset_versions") + f""", fp AS ({_FP_SQL})
SELECT version, n_rows, fingerprint FROM (
  SELECT *, row_number() OVER (PARTITION BY n_rows, fingerprint ORDER BY version) AS rn FROM fp) x
WHERE rn = 1""")
def distinct_versions(spark, d):
    fps = lineage.fingerprint(fx.dataset_versions(spark, d), FP_COLS, by=["version"])
    return dedup.distinct_versions(fps, ["n_rows", "fingerprint"])


@query("lineage_check", ("R3",), sql=with_views("dataset_versions") + f""", fp AS ({_FP_SQL}),
log AS (
  SELECT 'run-' || version AS run_id, version AS data_version,
    CASE WHEN version = 'v2' THEN NULL
         WHEN version = 'v1' THEN (SELECT CAST(fingerprint AS VARCHAR) FROM fp WHERE version = 'v0')
         ELSE CAST(fingerprint AS VARCHAR) END AS data_fingerprint
  FROM fp)
SELECT run_id, data_version,
  CASE WHEN data_fingerprint IS NULL THEN 'not recorded'
       WHEN data_fingerprint = CAST(f.fingerprint AS VARCHAR) THEN 'match' ELSE 'differs' END AS verdict,
  coalesce(f.fingerprint = (SELECT fingerprint FROM fp WHERE version = 'v0'), false) AS same_as_base,
  coalesce(f.fingerprint = (SELECT fingerprint FROM fp WHERE version = 'v2'), false) AS same_as_newest
FROM log LEFT JOIN fp f ON log.data_version = f.version""")
def lineage_check(spark, d):
    from contrail.session import cut_lineage

    # one row per version, read by the run log and by the check: written once
    fps = cut_lineage(lineage.fingerprint(fx.dataset_versions(spark, d), FP_COLS, by=["version"]))
    fp_txt = F.col("fingerprint").cast("string")
    v0 = F.max(F.when(F.col("version") == "v0", fp_txt)).over(Window.partitionBy())  # one row per version
    log = fps.select(
        F.concat(F.lit("run-"), F.col("version")).alias("run_id"),
        F.col("version").alias("data_version"),
        F.when(F.col("version") == "v2", F.lit(None).cast("string"))
        .when(F.col("version") == "v1", v0).otherwise(fp_txt).alias("data_fingerprint"))
    return lineage.lineage_check(log, fps, base="v0", newest="v2")


@query("label_violations", ("D6",), sql=with_views("trips_raw") + """
, chk AS (
  SELECT delay_minutes,
    CASE WHEN delay_minutes >= 15 AND l_partkey % 9 <> 4 THEN 1 ELSE 0 END AS flag,
    CASE WHEN delay_minutes >= 10 THEN reason0 ELSE 'none' END AS reason
  FROM trips_raw)
SELECT 'flag_mismatch' AS violation,
  count(*) FILTER (WHERE flag IS NULL OR flag <> CAST(coalesce(delay_minutes >= 15, false) AS INTEGER)) AS n_rows FROM chk
UNION ALL SELECT 'reason_without_delay',
  count(*) FILTER (WHERE flag = 0 AND (reason IS NULL OR reason <> 'none')) FROM chk
UNION ALL SELECT 'delay_without_reason',
  count(*) FILTER (WHERE flag = 1 AND (reason IS NULL OR reason = 'none')) FROM chk""")
def label_violations(spark, d):
    t = fx.trips_raw(spark, d, ["delay_minutes", "l_partkey", "reason0"]).select(
        "delay_minutes",
        F.when((F.col("delay_minutes") >= 15) & (F.pmod("l_partkey", F.lit(9)) != 4), 1).otherwise(0)
        .alias("is_significant_delay"),
        F.when(F.col("delay_minutes") >= 10, F.col("reason0")).otherwise("none").alias("delay_reason"))
    return dedup.label_violations(t)


@query("top_n_per_group", ("D4",), sql=with_views("runs") + """
SELECT experiment, run_id, start_time, CAST(rn AS INTEGER) AS run_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY start_time DESC, run_id DESC) AS rn FROM runs) x
WHERE rn <= 50""")
def top_n_per_group(spark, d):
    r = fx.runs(spark, d)
    return dedup.top_n_per_group(r, ["experiment"], [F.col("start_time").desc(), F.col("run_id").desc()], 50,
                                 rank_col="run_rank").select("experiment", "run_id", "start_time", "run_rank")


@query("metric_deltas", ("R2",), sql=with_views("runs") + """
, long AS (SELECT experiment, run_id, start_time, metric, value FROM runs
           UNPIVOT (value FOR metric IN (total_price, cust_key)))
SELECT experiment, metric, run_id, start_time, value,
  lag(value) OVER (PARTITION BY experiment, metric ORDER BY start_time, run_id) AS prev_value,
  value - lag(value) OVER (PARTITION BY experiment, metric ORDER BY start_time, run_id) AS delta
FROM long""")
def metric_deltas(spark, d):
    return lineage.metric_deltas(fx.runs(spark, d))


@query("approximate_delays", ("G3", "G7"), sql=with_views("dataset_versions") + """
SELECT version, count(*) AS n_rows, true AS median_in_bound, true AS p95_in_bound
FROM dataset_versions WHERE is_significant_delay = 1 GROUP BY version""")
def approximate_delays(spark, d):
    """Sketches a version and ship year, stored, then merged to versions: the
    exact ranks of each quantile must lie within the stated error."""
    rows = cut_lineage(fx.dataset_versions(spark, d, STATS_COLS).select(
        "version", F.year("l_shipdate").alias("year"), "delay_minutes", "is_significant_delay"))
    stored = cut_lineage(profile.delay_sketches(rows, ["version", "year"]))
    qs = {"median": 0.5, "p95": 0.95}
    found = profile.sketch_quantiles(stored, ["version"], qs)
    late = rows.filter("is_significant_delay = 1").groupBy("version", "delay_minutes").agg(F.count("*").alias("c"))
    error = profile.SKETCH_ERROR
    ranks = late.join(found, "version").groupBy("version", "n_rows").agg(*[
        F.sum(F.when(F.col("delay_minutes") < F.col(n), F.col("c")).otherwise(0)).alias(f"{n}_below") for n in qs], *[
        F.sum(F.when(F.col("delay_minutes") <= F.col(n), F.col("c")).otherwise(0)).alias(f"{n}_upto") for n in qs])
    return ranks.select("version", "n_rows", *[
        ((F.col(f"{n}_below") / F.col("n_rows") <= q + error) & (F.col(f"{n}_upto") / F.col("n_rows") >= q - error)).alias(f"{n}_in_bound")
        for n, q in qs.items()])
