"""SQL text (DuckDB dialect) of the fixture views, for the oracle queries.

Each view mirrors a builder in ``contrail.sources.fixtures``.  ``with_views``
returns a ``WITH`` clause holding the requested views and what they need.
Decimal literals are written as DOUBLE casts so both engines compare doubles.
"""

from __future__ import annotations

VIEWS: dict[str, tuple[list[str], str]] = {
    "trips_raw": ([], """
SELECT *,
  CAST(CASE WHEN delay_minutes >= 15 THEN 1 ELSE 0 END AS INTEGER) AS is_significant_delay,
  CASE WHEN delay_minutes < 15 THEN 'none' ELSE reason0 END AS delay_reason
FROM (
  SELECT concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS flight_id,
    o_orderdate AS scheduled_departure_local,
    p_brand AS airline_code, sn.n_name AS origin_airport, cn.n_name AS destination_airport,
    concat(sn.n_name, '-', cn.n_name) AS route, p_type AS aircraft_type,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'fog' WHEN 'MACHINERY' THEN 'snow'
      WHEN 'AUTOMOBILE' THEN 'rain' WHEN 'FURNITURE' THEN 'clear' END AS weather_origin,
    nullif(l_tax * 100, 0) AS precipitation_origin_mm,
    p_size / CAST(5 AS DOUBLE) AS visibility_origin_km,
    l_quantity / CAST(2.5 AS DOUBLE) AS wind_speed_origin_mps,
    l_discount * 10 AS airport_load_index,
    nullif(l_tax * CAST(12.5 AS DOUBLE), 0) AS airline_load_factor,
    CAST(l_partkey % 100 AS DOUBLE) AS previous_flight_delay_min,
    CAST(l_orderkey % 24 AS INTEGER) AS departure_hour,
    CAST(CASE WHEN p_size % 10 = 0 THEN 1 ELSE 0 END AS INTEGER) AS technical_check_required,
    CAST(CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END AS INTEGER) AS crew_change_required,
    CAST(greatest((l_orderkey * 7 + l_linenumber * 11 + CAST(l_quantity AS BIGINT)) % 60 - 25, 0) AS INTEGER)
      AS delay_minutes,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'weather' WHEN '2-HIGH' THEN 'late_aircraft'
      WHEN '3-MEDIUM' THEN 'airport_congestion' WHEN '5-LOW' THEN 'technical' ELSE 'other' END AS reason0,
    l_shipdate, l_partkey, l_suppkey, l_extendedprice
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN nation cn ON c_nationkey = cn.n_nationkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey
    JOIN part ON l_partkey = p_partkey
) base"""),
    "trips": (["trips_raw"], """
SELECT * EXCLUDE (_rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY flight_id ORDER BY l_shipdate NULLS FIRST,
    l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_extendedprice NULLS FIRST,
    wind_speed_origin_mps NULLS FIRST) AS _rn
  FROM trips_raw) d WHERE _rn = 1"""),
    "scores": ([], """
SELECT l_orderkey, l_linenumber, l_quantity / CAST(50 AS DOUBLE) AS p,
  CAST(CASE WHEN l_quantity + 100 * l_tax > 29 THEN 1 ELSE 0 END AS INTEGER) AS y
FROM lineitem"""),
    "class_preds": ([], """
SELECT l_orderkey, l_linenumber, o_orderpriority AS actual,
  CASE WHEN l_linenumber % 3 = 0 THEN '3-MEDIUM' ELSE o_orderpriority END AS predicted
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "class_proba": ([], """
SELECT l_orderkey, l_linenumber, [l_discount, l_tax, l_quantity / CAST(500 AS DOUBLE)] AS proba
FROM lineitem"""),
    "requests": ([], """
SELECT event_id, ts, event_type AS handler,
  CASE WHEN event_type = 'error' THEN '5xx' ELSE '2xx' END AS status,
  value / 1000 AS duration
FROM events"""),
    "dataset_versions": (["trips"], """
SELECT *, 'v0' AS version FROM trips WHERE year(l_shipdate) % 2 = 0
UNION ALL SELECT *, 'v1' AS version FROM trips WHERE year(l_shipdate) % 2 <> 0
UNION ALL SELECT *, 'v2' AS version FROM trips WHERE year(l_shipdate) % 2 <> 0"""),
    "runs": ([], """
SELECT o_orderpriority AS experiment, o_orderkey AS run_id, o_orderdate AS start_time,
  o_totalprice AS total_price, CAST(o_custkey AS DOUBLE) AS cust_key
FROM orders"""),
    "score_requests": (["trips_raw"], """
SELECT flight_id, strftime(scheduled_departure_local, '%Y-%m-%d %H:%M:%S') AS scheduled_departure_local,
  airline_code, origin_airport, destination_airport,
  CASE WHEN l_partkey % 17 <> 0 THEN aircraft_type END AS aircraft_type,
  CASE WHEN l_suppkey % 13 <> 0 THEN l_extendedprice / 10 END AS distance_km,
  l_extendedprice / 100 AS planned_duration_min,
  weather_origin, precipitation_origin_mm, visibility_origin_km, wind_speed_origin_mps,
  airport_load_index, airline_load_factor, previous_flight_delay_min,
  CASE WHEN delay_minutes % 5 <> 0 THEN technical_check_required END AS technical_check_required,
  CASE WHEN delay_minutes % 7 <> 0 THEN crew_change_required END AS crew_change_required
FROM trips_raw"""),
}


def with_views(*names: str) -> str:
    """``WITH`` clause containing ``names`` and their dependencies, in order."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        if n in ordered:
            return
        for dep in VIEWS[n][0]:
            visit(dep)
        ordered.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n][1]}\n)" for n in ordered) + "\n"
