"""Queries: request traffic over sliding windows.

The driver's ``events`` hold ~14 requests an hour at sf0.01, so windows are
1 hour sliding by 15 minutes (the panels use 1 and 5 minutes; both are
parameters of the operators).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from contrail.functions.calendar import epoch_micros
from contrail.operators import traffic
from contrail.operators.ranking import exact_quantiles
from contrail.plans.oracle_views import with_views
from contrail.plans.registry import query
from contrail.sources import fixtures as fx

LENGTH, SLIDE = "1 hour", "15 minutes"

_WIN_SQL = """,
w AS (SELECT r.*, time_bucket(INTERVAL '15 minutes', ts) - to_minutes(CAST(15 * k AS INTEGER)) AS ws
      FROM requests r, range(4) t(k))
"""

_HQ = """CASE WHEN n_requests > 0 THEN
  CASE WHEN le0 >= {q} * n_requests THEN CAST(0 AS DOUBLE) + CAST(0.1 AS DOUBLE) * (({q} * n_requests - 0) / (le0 - 0))
       WHEN le1 >= {q} * n_requests THEN CAST(0.1 AS DOUBLE) + (CAST(0.5 AS DOUBLE) - CAST(0.1 AS DOUBLE))
            * (({q} * n_requests - le0) / (le1 - le0))
       WHEN le2 >= {q} * n_requests THEN CAST(0.5 AS DOUBLE) + (CAST(1.0 AS DOUBLE) - CAST(0.5 AS DOUBLE))
            * (({q} * n_requests - le1) / (le2 - le1))
       ELSE CAST(1.0 AS DOUBLE) END END"""


def _hq(q: float) -> str:
    return _HQ.format(q=f"CAST({q!r} AS DOUBLE)")


_BUCKET_COUNTS = """count(*) AS n_requests,
  count(*) FILTER (WHERE duration <= CAST(0.1 AS DOUBLE)) AS le0,
  count(*) FILTER (WHERE duration <= CAST(0.5 AS DOUBLE)) AS le1,
  count(*) FILTER (WHERE duration <= CAST(1.0 AS DOUBLE)) AS le2"""


@query("request_rate", ("W1",), sql=with_views("requests") + _WIN_SQL + """
SELECT epoch_us(ws) AS window_start, count(*) AS n_requests, count(*) / CAST(3600 AS DOUBLE) AS rate
FROM w GROUP BY ws""")
def request_rate(spark, d):
    return traffic.request_rate(fx.requests(spark, d), LENGTH, SLIDE)


@query("request_rate_by_handler", ("W2",), sql=with_views("requests") + _WIN_SQL + """
SELECT epoch_us(ws) AS window_start, handler, count(*) AS n_requests, count(*) / CAST(3600 AS DOUBLE) AS rate
FROM w GROUP BY ws, handler""")
def request_rate_by_handler(spark, d):
    return traffic.request_rate(fx.requests(spark, d), LENGTH, SLIDE, by=["handler"])


@query("status_rate", ("W3",), sql=with_views("requests") + _WIN_SQL + """
SELECT epoch_us(ws) AS window_start, status, count(*) AS n_requests, count(*) / CAST(3600 AS DOUBLE) AS rate
FROM w GROUP BY ws, status""")
def status_rate(spark, d):
    return traffic.request_rate(fx.requests(spark, d), LENGTH, SLIDE, by=["status"])


@query("error_rate", ("W4",), sql=with_views("requests") + _WIN_SQL + """
SELECT epoch_us(ws) AS window_start, count(*) AS n_requests,
  count(*) FILTER (WHERE status IN ('4xx', '5xx')) AS n_errors,
  (count(*) FILTER (WHERE status IN ('4xx', '5xx')) / CAST(3600 AS DOUBLE))
    / greatest(count(*) / CAST(3600 AS DOUBLE), CAST(0.001 AS DOUBLE)) AS error_share
FROM w GROUP BY ws""")
def error_rate(spark, d):
    return traffic.error_rate(fx.requests(spark, d), LENGTH, SLIDE)


@query("latency_p95", ("W5",), sql=with_views("requests") + _WIN_SQL + f""",
b AS (SELECT ws, {_BUCKET_COUNTS} FROM w GROUP BY ws)
SELECT epoch_us(ws) AS window_start, n_requests, {_hq(0.95)} AS p95 FROM b""")
def latency_p95(spark, d):
    return traffic.latency_quantiles(fx.requests(spark, d), [0.95], LENGTH, SLIDE)


@query("latency_by_handler", ("W6",), sql=with_views("requests") + _WIN_SQL + f""",
b AS (SELECT ws, handler, {_BUCKET_COUNTS} FROM w GROUP BY ws, handler)
SELECT epoch_us(ws) AS window_start, handler, n_requests, {_hq(0.5)} AS p50, {_hq(0.95)} AS p95 FROM b""")
def latency_by_handler(spark, d):
    return traffic.latency_quantiles(fx.requests(spark, d), [0.5, 0.95], LENGTH, SLIDE, by=["handler"])


@query("latency_p95_exact", ("W5",), sql=with_views("requests") + _WIN_SQL + """
SELECT epoch_us(ws) AS window_start, round(quantile_cont(duration, 0.95), 8) AS p95 FROM w GROUP BY ws""")
def latency_p95_exact(spark, d):
    r = fx.requests(spark, d)
    per_window = r.select(F.window("ts", LENGTH, SLIDE).alias("w"), "duration").select(
        epoch_micros(F.col("w.start"), ntz=True).alias("window_start"), "duration")
    # windows grow with the time range: no broadcast of per-window tables
    q = exact_quantiles(per_window, "duration", [0.95], ["window_start"], ["p95"])
    # durations have 5 decimals and the interpolation weight 2, so the exact
    # value has at most 7: rounding at 8 removes only floating-point noise
    return q.select("window_start", F.round("p95", 8).alias("p95"))


@query("metric_bands", ("P8",), sql=with_views("requests") + _WIN_SQL + f""",
b AS (SELECT ws, {_BUCKET_COUNTS}, count(*) FILTER (WHERE status IN ('4xx', '5xx')) AS n_errors FROM w GROUP BY ws),
m AS (SELECT epoch_us(ws) AS window_start, n_requests / CAST(3600 AS DOUBLE) AS rate,
        (n_errors / CAST(3600 AS DOUBLE)) / greatest(n_requests / CAST(3600 AS DOUBLE), CAST(0.001 AS DOUBLE))
          AS error_share, {_hq(0.95)} AS p95 FROM b)
SELECT window_start, rate, error_share, p95,
  CASE WHEN rate IS NULL THEN NULL WHEN rate >= CAST(50 AS DOUBLE) THEN 'red'
       WHEN rate >= CAST(10 AS DOUBLE) THEN 'yellow' ELSE 'green' END AS rate_band,
  CASE WHEN error_share IS NULL THEN NULL WHEN error_share >= CAST(0.05 AS DOUBLE) THEN 'red'
       WHEN error_share >= CAST(0.01 AS DOUBLE) THEN 'yellow' ELSE 'green' END AS error_band,
  CASE WHEN p95 IS NULL THEN NULL WHEN p95 >= CAST(0.5 AS DOUBLE) THEN 'red'
       WHEN p95 >= CAST(0.1 AS DOUBLE) THEN 'yellow' ELSE 'green' END AS latency_band
FROM m""")
def metric_bands(spark, d):
    return traffic.metric_bands(fx.requests(spark, d), LENGTH, SLIDE)
