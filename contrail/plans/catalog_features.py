"""Queries over flight features: dedup, flags, calendar, route, history."""

from __future__ import annotations

from pyspark.sql import functions as F

from contrail.functions.calendar import calendar_columns, enrich_features, parse_lenient, route_column
from contrail.functions.flags import add_derived_features
from contrail.operators.features import past_mean, select_features
from contrail.plans.oracle_views import with_views
from contrail.plans.registry import query
from contrail.schema import FLAG_COLS
from contrail.sources import fixtures as fx

_FLAG_SQL = """
  SELECT flight_id,
    CAST(w IN ('fog', 'snow') OR (w = 'rain' AND pr > CAST(5 AS DOUBLE)) AS INTEGER) AS bad_weather_origin,
    CAST(vis < CAST(3 AS DOUBLE) AS INTEGER) AS low_visibility_origin,
    CAST(wind > CAST(12 AS DOUBLE) AS INTEGER) AS wind_strong_origin,
    CAST(pr > CAST(5 AS DOUBLE) AS INTEGER) AS precip_heavy_origin,
    CAST(ap > CAST(0.92 AS DOUBLE) AS INTEGER) AS airport_high_load,
    CAST(al > CAST(0.85 AS DOUBLE) AS INTEGER) AS airline_high_load,
    CAST(ap > CAST(0.92 AS DOUBLE) AND al > CAST(0.85 AS DOUBLE) AS INTEGER) AS combined_high_load,
    CAST(prev > CAST(60 AS DOUBLE) AS INTEGER) AS prev_delay_high,
    CAST(prev > CAST(30 AS DOUBLE) AND prev <= CAST(60 AS DOUBLE) AS INTEGER) AS prev_delay_med,
    CAST(prev > CAST(60 AS DOUBLE) AND ap > CAST(0.92 AS DOUBLE) AND al > CAST(0.85 AS DOUBLE) AS INTEGER)
      AS cascade_risk,
    CAST(hr IN (7, 8, 9, 17, 18, 19, 20) AS INTEGER) AS peak_hour,
    CAST(season = 'winter' AS INTEGER) AS is_winter,
    delay_minutes, is_significant_delay
  FROM (
    SELECT flight_id, delay_minutes, is_significant_delay,
      coalesce(weather_origin, 'unknown') AS w, coalesce(precipitation_origin_mm, 0) AS pr,
      coalesce(visibility_origin_km, 10) AS vis, coalesce(wind_speed_origin_mps, 0) AS wind,
      coalesce(airport_load_index, 0) AS ap, coalesce(airline_load_factor, 0) AS al,
      coalesce(previous_flight_delay_min, 0) AS prev, coalesce(departure_hour, 0) AS hr,
      CASE WHEN month(scheduled_departure_local) IN (12, 1, 2) THEN 'winter'
           WHEN month(scheduled_departure_local) IN (3, 4, 5) THEN 'spring'
           WHEN month(scheduled_departure_local) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season
    FROM trips) filled"""

FLAGS_SQL = f"""flagged AS (
SELECT *, CAST(bad_weather_origin + low_visibility_origin + wind_strong_origin + precip_heavy_origin AS INTEGER)
  AS weather_severity_score
FROM ({_FLAG_SQL}) f)
"""


def featured_trips(spark, d):
    """Cleaned flights with calendar fields (where absent) and all flags."""
    return add_derived_features(enrich_features(fx.trips(spark, d)))


@query("severity_positive_share", ("D1", "F1-F13", "G1"),
       sql=with_views("trips") + ", " + FLAGS_SQL + """
SELECT weather_severity_score, count(*) AS n_flights,
  CAST(sum(is_significant_delay) AS BIGINT) AS n_positive,
  round(avg(is_significant_delay), 6) AS positive_share
FROM flagged GROUP BY weather_severity_score""")
def severity_positive_share(spark, d):
    """Flagship: dedup -> flags -> positive share per weather severity."""
    return featured_trips(spark, d).groupBy("weather_severity_score").agg(
        F.count(F.lit(1)).alias("n_flights"),
        F.sum("is_significant_delay").cast("bigint").alias("n_positive"),
        F.round(F.avg("is_significant_delay"), 6).alias("positive_share"),
    )


@query("dedup_first", ("D1",), sql=with_views("trips") + """
SELECT flight_id, l_shipdate, l_partkey, l_suppkey, l_extendedprice, delay_minutes, delay_reason FROM trips""")
def dedup_first_q(spark, d):
    return fx.trips(spark, d, ["flight_id", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice",
                               "delay_minutes", "delay_reason"])


@query("derived_flags", ("F1-F13", "P3", "F19"), sql=with_views("trips") + ", " + FLAGS_SQL + """
SELECT * EXCLUDE (delay_minutes, is_significant_delay) FROM flagged""")
def derived_flags(spark, d):
    return featured_trips(spark, d).select("flight_id", *FLAG_COLS)


@query("time_features", ("F14", "F15", "F16", "F17", "F20"), sql=with_views("trips") + """
SELECT flight_id,
  CAST(hour(scheduled_departure_local) AS INTEGER) AS departure_hour,
  dayname(scheduled_departure_local) AS day_of_week,
  CAST(month(scheduled_departure_local) AS INTEGER) AS month,
  CASE WHEN month(scheduled_departure_local) IN (12, 1, 2) THEN 'winter'
       WHEN month(scheduled_departure_local) IN (3, 4, 5) THEN 'spring'
       WHEN month(scheduled_departure_local) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season,
  CAST(CASE WHEN isodow(scheduled_departure_local) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
  TRY_CAST(CASE WHEN l_partkey % 11 = 0 THEN 'not a date'
                WHEN l_partkey % 11 = 1 THEN replace(strftime(l_shipdate, '%Y-%m-%d %H:%M:%S'), ' ', 'T')
                ELSE strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP) AS flight_date
FROM trips""")
def time_features(spark, d):
    t = fx.trips(spark, d, ["flight_id", "scheduled_departure_local", "l_shipdate", "l_partkey"])
    ts = F.col("scheduled_departure_local")
    cal = calendar_columns(ts)
    text = F.col("l_shipdate").cast("string")
    flight_date_text = (F.when(F.pmod("l_partkey", F.lit(11)) == 0, F.lit("not a date"))
                        .when(F.pmod("l_partkey", F.lit(11)) == 1, F.regexp_replace(text, " ", "T"))
                        .otherwise(text))
    return t.select(
        "flight_id",
        cal["departure_hour"].cast("int").alias("departure_hour"),
        cal["day_of_week"].alias("day_of_week"),
        cal["month"].cast("int").alias("month"),
        cal["season"].alias("season"),
        cal["is_weekend"].cast("int").alias("is_weekend"),
        parse_lenient(flight_date_text).alias("flight_date"),
    )


@query("route_feature", ("F18",), sql=with_views("trips") + """
SELECT flight_id, concat(origin_airport, '-', destination_airport) AS route_built FROM trips""")
def route_feature(spark, d):
    return fx.trips(spark, d, ["flight_id", "origin_airport", "destination_airport"]).select("flight_id", route_column().alias("route_built"))


@query("route_history_avg", ("H1",), sql=with_views("trips") + """
SELECT flight_id, route,
  avg(delay_minutes) OVER (PARTITION BY route ORDER BY CAST(scheduled_departure_local AS DATE)
    RANGE BETWEEN INTERVAL '100000' DAY PRECEDING AND INTERVAL '1' DAY PRECEDING) AS route_avg_delay_min
FROM trips""")
def route_history_avg(spark, d):
    t = fx.trips_written(spark, d, ["flight_id", "route", "scheduled_departure_local", "delay_minutes"])
    return past_mean(t, "route", "scheduled_departure_local", "delay_minutes", "route_avg_delay_min") \
        .select("flight_id", "route", "route_avg_delay_min")


FEATURE_SUBSET = ["flight_id", "airline_code", "origin_airport", "destination_airport", "route", "aircraft_type",
                  "weather_origin", "departure_hour", "technical_check_required", "crew_change_required",
                  "weather_severity_score", "combined_high_load", "is_significant_delay", "delay_reason",
                  "delay_minutes"]


@query("feature_projection", ("P1",), sql=with_views("trips") + ", " + FLAGS_SQL + """
SELECT t.flight_id, airline_code, origin_airport, destination_airport, route, aircraft_type, weather_origin,
  departure_hour, technical_check_required, crew_change_required, f.weather_severity_score, f.combined_high_load,
  t.is_significant_delay, delay_reason, t.delay_minutes
FROM trips t JOIN flagged f ON t.flight_id = f.flight_id""")
def feature_projection(spark, d):
    return select_features(featured_trips(spark, d), FEATURE_SUBSET)
