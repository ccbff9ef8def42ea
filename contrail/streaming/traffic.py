"""Streaming traffic metrics with a late-data limit.

The batch operators in ``contrail.operators.traffic`` are plain windowed
aggregations, so they run unchanged on a streaming DataFrame once a
watermark is set.  ``withWatermark`` needs a TIMESTAMP column, while parquet
event times read as TIMESTAMP_NTZ: their wall clock is taken as UTC, whatever
the session's time zone.
In append mode a window is emitted once the watermark passes its end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions.calendar import epoch_micros
from contrail.operators import traffic


def with_event_time(stream: DataFrame, ts: str = "ts", watermark: str = "10 minutes") -> DataFrame:
    ntz = dict(stream.dtypes)[ts] == "timestamp_ntz"
    at = F.timestamp_micros(epoch_micros(ts, True)) if ntz else F.col(ts).cast("timestamp")
    return stream.withColumn(ts, at).withWatermark(ts, watermark)


def request_log(events: DataFrame) -> DataFrame:
    """Request-log view of an ``events`` stream (handler, status, duration)."""
    return events.select(
        "ts", F.col("event_type").alias("handler"),
        F.when(F.col("event_type") == "error", "5xx").otherwise("2xx").alias("status"),
        (F.col("value") / 1000).alias("duration"))


def traffic_stream(stream: DataFrame, watermark: str = "10 minutes", length: str = "1 minute",
                   slide: str | None = "15 seconds", kind: str = "rate", by: tuple[str, ...] = ()) -> DataFrame:
    """Streaming form of W1-W6: ``kind`` is rate, errors or latency."""
    s = with_event_time(stream, "ts", watermark)
    if kind == "rate":
        return traffic.request_rate(s, length, slide, by)
    if kind == "errors":
        return traffic.error_rate(s, length, slide)
    if kind == "latency":
        return traffic.latency_quantiles(s, [0.5, 0.95], length, slide, by)
    raise ValueError(f"unknown traffic metric {kind!r}")
