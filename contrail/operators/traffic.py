"""Request-traffic metrics over sliding event-time windows.

The monitoring panels compute these from scraped counters; here they are
computed straight from a request log ``(ts, handler, status, duration)``, so
counter resets and rate extrapolation do not arise.  Every metric is one
a grouped count over windows - partial aggregation on the map side, no sort -
and works unchanged on a streaming DataFrame
(``contrail.streaming.traffic``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions.calendar import epoch_micros
from contrail.functions.bands import ERROR_SHARE_STEPS, LATENCY_P95_STEPS, REQUEST_RATE_STEPS, band

# --- fixed values: upper bounds (seconds) of the request-duration histogram
# buckets the service exports by default; +Inf is implied.
DURATION_BUCKETS = (0.1, 0.5, 1.0)
ERROR_STATUS = ("4xx", "5xx")
MIN_RATE = 0.001  # denominator clamp of the error share, requests/s


UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def _length_seconds(text: str) -> float:
    n, unit = text.split()
    return float(n) * UNIT_SECONDS[unit.rstrip("s")]


def _windowed(df: DataFrame, ts: str, length: str, slide: str | None, by: Sequence[str],
              **counters: Column) -> DataFrame:
    """(w, by..., counters...) per window; ``counters`` are counts, which add up.

    Sliding windows of whole slides are counted per slide first (one row per
    request reaches one pane), then the panes are summed to windows, so a
    request is not copied once per window that covers it.  A stream, which
    has one state per query here, is counted by window directly."""
    aggs = [c.alias(n) for n, c in counters.items()]
    if not slide:
        return df.groupBy(F.window(F.col(ts), length).alias("w"), *by).agg(*aggs)
    if df.isStreaming or _length_seconds(length) % _length_seconds(slide):
        return df.groupBy(F.window(F.col(ts), length, slide).alias("w"), *by).agg(*aggs)
    panes = df.groupBy(F.window(F.col(ts), slide).alias("p"), *by).agg(*aggs)
    panes = panes.select(F.col("p.start").alias("_at"), *by, *counters)
    return panes.groupBy(F.window(F.col("_at"), length, slide).alias("w"), *by).agg(*[F.sum(n).alias(n) for n in counters])


def _is_ntz(df: DataFrame, ts: str) -> bool:
    return dict(df.dtypes)[ts] == "timestamp_ntz"


def _start_us(ntz: bool) -> Column:
    return epoch_micros(F.col("w.start"), ntz)


def _seconds(ntz: bool) -> Column:
    return (epoch_micros(F.col("w.end"), ntz) - _start_us(ntz)) / F.lit(1e6)


def histogram_quantile(q: float, cum_counts: Sequence[Column], bounds: Sequence[float], total: Column) -> Column:
    """Quantile from cumulative bucket counts, interpolating linearly inside
    the bucket that holds rank ``q * total`` (the first bucket starts at 0);
    past the last finite bound the answer is that bound.  NULL when empty."""
    rank = F.lit(float(q)) * total
    expr = None
    prev_bound, prev_count = 0.0, F.lit(0)
    for b, c in zip(bounds, cum_counts):
        if prev_bound == 0.0 and b <= 0:
            val = F.lit(float(b))
        else:
            val = F.lit(prev_bound) + F.lit(b - prev_bound) * ((rank - prev_count) / (c - prev_count))
        cond = c >= rank
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
        prev_bound, prev_count = float(b), c
    expr = expr.otherwise(F.lit(float(bounds[-1])))
    return F.when(total > 0, expr)


def request_rate(df: DataFrame, length: str = "1 minute", slide: str | None = "15 seconds",
                 by: Sequence[str] = (), ts: str = "ts") -> DataFrame:
    """Requests per second in each sliding window, optionally per key."""
    ntz = _is_ntz(df, ts)
    g = _windowed(df, ts, length, slide, by, n_requests=F.count(F.lit(1)))
    return g.select(_start_us(ntz).alias("window_start"), *by, "n_requests",
                    (F.col("n_requests") / _seconds(ntz)).alias("rate"))


def error_rate(df: DataFrame, length: str = "5 minutes", slide: str | None = "15 seconds",
               status: str = "status", ts: str = "ts") -> DataFrame:
    """Share of 4xx/5xx requests; the denominator rate is clamped to
    0.001 requests/s (W4)."""
    ntz = _is_ntz(df, ts)
    g = _windowed(df, ts, length, slide, [], n_requests=F.count(F.lit(1)),
                  n_errors=F.count_if(F.col(status).isin(*ERROR_STATUS)))
    sec = _seconds(ntz)
    share = (F.col("n_errors") / sec) / F.greatest(F.col("n_requests") / sec, F.lit(MIN_RATE))
    return g.select(_start_us(ntz).alias("window_start"), "n_requests", "n_errors", share.alias("error_share"))


def latency_quantiles(df: DataFrame, qs: Sequence[float] = (0.95,), length: str = "5 minutes",
                      slide: str | None = "15 seconds", by: Sequence[str] = (), duration: str = "duration",
                      ts: str = "ts", bounds: Sequence[float] = DURATION_BUCKETS) -> DataFrame:
    """Latency quantiles per window from histogram buckets.

    One conditional count per bucket bound - the state per window is a
    handful of counters however many requests it holds."""
    counts = {f"_le{i}": F.count_if(F.col(duration) <= F.lit(float(b))) for i, b in enumerate(bounds)}
    g = _windowed(df, ts, length, slide, by, n_requests=F.count(F.lit(1)), **counts)
    cums = [F.col(f"_le{i}") for i in range(len(bounds))]
    outs = [histogram_quantile(q, cums, bounds, F.col("n_requests")).alias(f"p{int(round(q * 100))}") for q in qs]
    return g.select(_start_us(_is_ntz(df, ts)).alias("window_start"), *by, "n_requests", *outs)


def metric_bands(df: DataFrame, length: str = "1 hour", slide: str | None = "15 minutes",
                 ts: str = "ts", status: str = "status", duration: str = "duration") -> DataFrame:
    """Rate, error share and p95 per window with their status bands (P8),
    in one aggregation."""
    counts = {f"_le{i}": F.count_if(F.col(duration) <= F.lit(float(b))) for i, b in enumerate(DURATION_BUCKETS)}
    g = _windowed(df, ts, length, slide, [], n_requests=F.count(F.lit(1)),
                  n_errors=F.count_if(F.col(status).isin(*ERROR_STATUS)), **counts)
    ntz = _is_ntz(df, ts)
    sec = _seconds(ntz)
    rate = F.col("n_requests") / sec
    share = (F.col("n_errors") / sec) / F.greatest(rate, F.lit(MIN_RATE))
    p95 = histogram_quantile(0.95, [F.col(f"_le{i}") for i in range(len(DURATION_BUCKETS))], DURATION_BUCKETS,
                             F.col("n_requests"))
    out = g.select(_start_us(ntz).alias("window_start"), rate.alias("rate"), share.alias("error_share"),
                   p95.alias("p95"))
    return out.withColumns({
        "rate_band": band("rate", *REQUEST_RATE_STEPS),
        "error_band": band("error_share", *ERROR_SHARE_STEPS),
        "latency_band": band("p95", *LATENCY_P95_STEPS),
    })
