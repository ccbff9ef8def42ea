"""Flight-like views derived from the driver's tables.

The flight data itself is not available, so the operators run on views that
Spark derives from the TPC-H-like tables; the same views are written in SQL
for the DuckDB oracle (``contrail.plans.oracle``).  Every view grows with the
input tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.operators.dedup import dedup_first
from contrail.sources.tables import read_table

# --- fixed values: fixture mapping of TPC-H columns to flight columns -------
SEGMENT_WEATHER = {"BUILDING": "fog", "MACHINERY": "snow", "AUTOMOBILE": "rain", "FURNITURE": "clear"}
PRIORITY_REASON = {"1-URGENT": "weather", "2-HIGH": "late_aircraft", "3-MEDIUM": "airport_congestion",
                   "5-LOW": "technical"}
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
DEDUP_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "wind_speed_origin_mps"]
FLIGHT_KEY = ("l_orderkey", "l_linenumber")
PROBA_CLASSES = ["discount", "tax", "volume"]


def _case(col: str, mapping: dict[str, str], default=None):
    expr = None
    for k, v in mapping.items():
        expr = F.when(F.col(col) == k, v) if expr is None else expr.when(F.col(col) == k, v)
    return expr.otherwise(F.lit(default)) if default is not None else expr


#: What each joined table gives; a view joins only the tables of the columns asked for.
FROM_ORDERS = {"scheduled_departure_local", "reason0", "delay_reason"}
FROM_PART = {"airline_code", "aircraft_type", "visibility_origin_km", "technical_check_required"}
FROM_CUSTOMER = {"weather_origin"}
FROM_CUSTOMER_NATION = {"destination_airport", "route"}
FROM_SUPPLIER = {"origin_airport", "route"}
COLUMNS = ["flight_id", "scheduled_departure_local", "airline_code", "origin_airport", "destination_airport", "route",
           "aircraft_type", "weather_origin", "precipitation_origin_mm", "visibility_origin_km", "wind_speed_origin_mps",
           "airport_load_index", "airline_load_factor", "previous_flight_delay_min", "departure_hour",
           "technical_check_required", "crew_change_required", "delay_minutes", "reason0", "l_shipdate", "l_partkey",
           "l_suppkey", "l_extendedprice", *FLIGHT_KEY, "is_significant_delay", "delay_reason"]


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of lineitem that give all others, and those that dedup orders by."""
    minutes = F.greatest(
        F.pmod(F.col("l_orderkey") * 7 + F.col("l_linenumber") * 11 + F.col("l_quantity").cast("bigint"), F.lit(60))
        - 25, F.lit(0)).cast("int")
    return read_table(spark, sf_dir, "lineitem").select(
        (F.col("l_quantity") / F.lit(2.5)).alias("wind_speed_origin_mps"), minutes.alias("delay_minutes"),
        "l_tax", "l_discount", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", *FLIGHT_KEY)


def _joined(spark: SparkSession, sf_dir: str, lines: DataFrame, cols: list[str] | None) -> DataFrame:
    """``lines`` with the asked columns of the other tables.  Keys are foreign
    keys, so a table that gives no asked column is not joined.  The joins are
    left to the planner: AQE broadcasts a side only when its measured size is
    under spark.sql.autoBroadcastJoinThreshold; nation is hinted, with 25 rows
    at every scale factor.  Orders meet their customers first and what a line
    gives by itself is made last, so that few and short rows are moved."""
    cols = list(cols or COLUMNS)
    asked, j = set(cols), lines
    nation = read_table(spark, sf_dir, "nation")
    customer = asked & (FROM_CUSTOMER | FROM_CUSTOMER_NATION)
    if asked & FROM_ORDERS or customer:
        o = read_table(spark, sf_dir, "orders")
        if customer:
            o = o.join(read_table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        if asked & FROM_CUSTOMER_NATION:
            cn = nation.select(F.col("n_nationkey").alias("cn_key"), F.col("n_name").alias("cn_name"))
            o = o.join(F.broadcast(cn), F.col("c_nationkey") == F.col("cn_key"))
        j = j.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    if asked & FROM_SUPPLIER:
        sn = nation.select(F.col("n_nationkey").alias("sn_key"), F.col("n_name").alias("sn_name"))
        s = read_table(spark, sf_dir, "supplier").join(F.broadcast(sn), F.col("s_nationkey") == F.col("sn_key"))
        j = j.join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    if asked & FROM_PART:
        j = j.join(read_table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    made = {
        "flight_id": lambda: F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")),
        "precipitation_origin_mm": lambda: F.nullif(F.col("l_tax") * 100, F.lit(0.0)),
        "airport_load_index": lambda: F.col("l_discount") * 10,
        "airline_load_factor": lambda: F.nullif(F.col("l_tax") * F.lit(12.5), F.lit(0.0)),
        "previous_flight_delay_min": lambda: F.pmod(F.col("l_partkey"), F.lit(100)).cast("double"),
        "departure_hour": lambda: F.pmod(F.col("l_orderkey"), F.lit(24)).cast("int"),
        "crew_change_required": lambda: F.when(F.col("l_linenumber") == 1, 1).otherwise(0).cast("int"),
        "is_significant_delay": lambda: (F.col("delay_minutes") >= 15).cast("int"),
        "scheduled_departure_local": lambda: F.col("o_orderdate"),
        "airline_code": lambda: F.col("p_brand"),
        "origin_airport": lambda: F.col("sn_name"),
        "destination_airport": lambda: F.col("cn_name"),
        "route": lambda: F.concat(F.col("sn_name"), F.lit("-"), F.col("cn_name")),
        "aircraft_type": lambda: F.col("p_type"),
        "weather_origin": lambda: _case("c_mktsegment", SEGMENT_WEATHER),
        "visibility_origin_km": lambda: F.col("p_size") / F.lit(5.0),
        "technical_check_required": lambda: F.when(F.pmod(F.col("p_size"), F.lit(10)) == 0, 1).otherwise(0).cast("int"),
        "reason0": lambda: _case("o_orderpriority", PRIORITY_REASON, "other"),
        "delay_reason": lambda: F.when(F.col("delay_minutes") < 15, "none").otherwise(
            _case("o_orderpriority", PRIORITY_REASON, "other")),
    }
    return j.select(*[made[c]().alias(c) if c in made else F.col(c) for c in cols])


def trips_raw(spark: SparkSession, sf_dir: str, cols: list[str] | None = None) -> DataFrame:
    """One row per lineitem (keys repeat, as flight ids do in the raw file),
    with labels derived from ``delay_minutes``; only ``cols`` if given."""
    return _joined(spark, sf_dir, _lines(spark, sf_dir), cols)


def trips(spark: SparkSession, sf_dir: str, cols: list[str] | None = None) -> DataFrame:
    """Cleaned flights: first row per ``flight_id`` (D1); only ``cols`` if given.

    ``flight_id`` is the text ``orderkey-linenumber``, a one-to-one image of
    the pair, so grouping on the two numeric columns is the same grouping -
    cheaper to hash and sort than the text.  The order uses lineitem columns
    alone, so duplicates go before the joins."""
    return _joined(spark, sf_dir, dedup_first(_lines(spark, sf_dir), list(FLIGHT_KEY), DEDUP_ORDER), cols)


def trips_written(spark: SparkSession, sf_dir: str, cols: list[str] | None = None) -> DataFrame:
    """``trips`` written once to the checkpoint folder, for queries whose
    operator reads its input in two branches (ranks + bucket totals, fit +
    apply, per-day table + rows).  Column pruning makes the branches differ,
    so Spark cannot reuse the shared join; without this the seven-table join
    and its shuffles would run twice.  Only ``cols`` are written."""
    from contrail.session import cut_lineage

    return cut_lineage(trips(spark, sf_dir, cols))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary scores with many ties: ``p`` has 50 distinct values."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        (F.col("l_quantity") / F.lit(50.0)).alias("p"),
        F.when(F.col("l_quantity") + 100 * F.col("l_tax") > 29, 1).otherwise(0).cast("int").alias("y"),
    )


def class_preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multiclass actual/predicted pairs (order priority as the class)."""
    li = read_table(spark, sf_dir, "lineitem")
    orders = read_table(spark, sf_dir, "orders")
    return li.join(orders, li.l_orderkey == orders.o_orderkey).select(
        "l_orderkey", "l_linenumber",
        F.col("o_orderpriority").alias("actual"),
        F.when(F.pmod(F.col("l_linenumber"), F.lit(3)) == 0, "3-MEDIUM")
        .otherwise(F.col("o_orderpriority")).alias("predicted"),
    )


def class_proba(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-row class probability vectors (with ties) for argmax tests."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.array(F.col("l_discount"), F.col("l_tax"), F.col("l_quantity") / F.lit(500.0)).alias("proba"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request log from ``events``: handler, status class, duration (s)."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        "event_id", "ts",
        F.col("event_type").alias("handler"),
        F.when(F.col("event_type") == "error", "5xx").otherwise("2xx").alias("status"),
        (F.col("value") / 1000).alias("duration"),
    )


def dataset_versions(spark: SparkSession, sf_dir: str, cols: list[str] | None = None) -> DataFrame:
    """Three versions of the cleaned flights: ``v0`` (even ship year),
    ``v1`` (odd ship year) and ``v2``, an exact copy of ``v1``.

    All three derive from one table, so each row is tagged with the
    versions it belongs to and exploded: one pass over ``trips`` instead of
    one per version (versions stored separately are unioned with
    ``sources.union_versions``)."""
    t = trips(spark, sf_dir, cols)  # ``cols`` must include l_shipdate
    even = F.pmod(F.year("l_shipdate"), F.lit(2)) == 0
    tags = F.when(even, F.array(F.lit("v0"))).otherwise(F.array(F.lit("v1"), F.lit("v2")))
    return t.withColumn("version", F.explode(tags))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run log: experiment = order priority, run = order, metrics as a map."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderpriority").alias("experiment"),
        F.col("o_orderkey").alias("run_id"),
        F.col("o_orderdate").alias("start_time"),
        F.create_map(F.lit("total_price"), F.col("o_totalprice"),
                     F.lit("cust_key"), F.col("o_custkey").cast("double")).alias("metrics"),
    )


def score_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring requests built from flights; some required fields are missing."""
    t = trips_raw(spark, sf_dir)
    return t.select(
        "flight_id",
        F.col("scheduled_departure_local").cast("string").alias("scheduled_departure_local"),
        "airline_code", "origin_airport", "destination_airport",
        F.when(F.col("l_partkey") % 17 != 0, F.col("aircraft_type")).alias("aircraft_type"),
        F.when(F.col("l_suppkey") % 13 != 0, F.col("l_extendedprice") / 10).alias("distance_km"),
        (F.col("l_extendedprice") / 100).alias("planned_duration_min"),
        "weather_origin", "precipitation_origin_mm", "visibility_origin_km", "wind_speed_origin_mps",
        "airport_load_index", "airline_load_factor", "previous_flight_delay_min",
        F.when(F.col("delay_minutes") % 5 != 0, F.col("technical_check_required")).alias("technical_check_required"),
        F.when(F.col("delay_minutes") % 7 != 0, F.col("crew_change_required")).alias("crew_change_required"),
    )
