"""Queries: Structured Streaming over files that arrive in two steps, with a
restart from the progress folder in between (W7, M9)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from contrail.functions.calendar import epoch_micros
from contrail.operators import learn
from contrail.operators.learn import FeatureSpec
from contrail.plans.oracle_views import with_views
from contrail.plans.registry import query
from contrail.schema import REQUIRED_REQUEST_COLS
from contrail.session import checkpoint_dir, cut_lineage
from contrail.sources import fixtures as fx
from contrail.streaming import run_scoring, run_traffic, split_requests

#: Events whose id this divides and that are from the first quarter of the time arrive last.
LATE_EVERY = 50

_CLOSED = with_views("requests") + f""",
span AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM requests),
seen AS (SELECT r.* FROM requests r, span WHERE NOT (event_id % {LATE_EVERY} = 0 AND epoch_us(ts) < lo + (hi - lo) // 4)),
w AS (SELECT r.*, epoch_us(time_bucket(INTERVAL '15 minutes', ts)) - 900000000 * k AS ws FROM seen r, range(4) t(k))
SELECT ws AS window_start, count(*) AS n_requests, count(*) / CAST(3600 AS DOUBLE) AS rate FROM w
GROUP BY ws HAVING ws + 3600000000 <= (SELECT max(epoch_us(ts)) // 1000 * 1000 FROM seen) - 3600000000"""


@query("stream_request_rate", ("W7",), sql=_CLOSED)
def stream_request_rate(spark, d):
    """Requests a second in the windows that the watermark (one hour) has
    closed.  The first half of the time arrives first; a second run, which goes on
    from the progress of the first, gets the rest together with events
    from the first quarter that come too late and are dropped."""
    events = fx.read_table(spark, d, "events").select("event_id", "ts", "event_type", "value")
    at = epoch_micros("ts", dict(events.dtypes)["ts"] == "timestamp_ntz")
    lo, hi = events.agg(F.min(at), F.max(at)).first()
    base = os.path.join(checkpoint_dir(spark), f"traffic-{uuid.uuid4().hex}")
    feed, out, progress = (os.path.join(base, n) for n in ("feed", "out", "progress"))
    late = F.coalesce((F.col("event_id") % LATE_EVERY == 0) & (at < lo + (hi - lo) // 4), F.lit(False))
    first = at < lo + (hi - lo) // 2
    for arrived in (events.filter(first & ~late), events.filter(~first | late)):
        arrived.write.mode("append").parquet(feed)
        run_traffic(spark, feed, events.schema, out, progress, watermark="1 hour", length="1 hour", slide="15 minutes")
    return spark.read.parquet(out)


_SPEC = FeatureSpec(numeric=["precipitation_origin_mm", "visibility_origin_km", "wind_speed_origin_mps"],
                    ints=["departure_hour"], categorical=["weather_origin"])
_PARAMS = {"n_estimators": 2, "learning_rate": 0.3, "num_leaves": 4, "max_depth": 2, "min_child_samples": 20,
           "reg_alpha": 0.1, "reg_lambda": 0.2}
_VALID = " AND ".join(f"{c} IS NOT NULL" for c in REQUIRED_REQUEST_COLS)
_KEPT = ["flight_id", "is_significant_delay", "delay_probability", "predicted_reason", "reason_probability"]


def _by_flight(scored, name):
    return scored.groupBy("flight_id").agg(F.count("*").alias(f"n_{name}"), F.sum(
        F.xxhash64(*_KEPT[1:]).cast("decimal(38,0)")).alias(f"_{name}"))


@query("stream_scoring", ("M5", "M6", "M7", "M8", "M9"), sql=with_views("score_requests") + f"""
SELECT flight_id, count(*) FILTER (WHERE {_VALID}) AS n_accepted, count(*) FILTER (WHERE NOT ({_VALID})) AS n_rejected, true AS as_in_batch
FROM score_requests GROUP BY flight_id""")
def stream_scoring(spark, d):
    """Requests that arrive in two steps, scored by a stream with an output for
    accepted and one for rejected ones; the accepted rows are compared with
    the batch form over all requests."""
    requests = cut_lineage(fx.score_requests(spark, d))
    train = fx.trips_written(spark, d, [*_SPEC.all, "scheduled_departure_local", "is_significant_delay", "delay_reason", "route"])
    feats = learn.build_features(train, _SPEC)
    delay = learn.train_delay(train, feats, params=_PARAMS)
    reason, classes = learn.train_reason(train.filter("is_significant_delay = 1"), feats, params=dict(_PARAMS, n_estimators=1))
    base = os.path.join(checkpoint_dir(spark), f"scoring-{uuid.uuid4().hex}")
    feed, out, progress = (os.path.join(base, n) for n in ("feed", "out", "progress"))
    early = F.pmod(F.xxhash64("flight_id"), F.lit(2)) == 0
    for arrived in (requests.filter(early), requests.filter(~early)):
        arrived.write.mode("append").parquet(feed)
        run_scoring(spark, feed, requests.schema, out, progress, feats, delay, 0.5, reason, classes, _SPEC, ["flight_id"])
    ok, _ = split_requests(requests)
    batch = learn.score(learn.prepare(ok, _SPEC), feats, delay, 0.5, reason, classes, ["flight_id"])
    accepted = _by_flight(spark.read.parquet(os.path.join(out, "accepted")), "accepted")
    rejected = spark.read.parquet(os.path.join(out, "rejected")).groupBy("flight_id").agg(F.count("*").alias("n_rejected"))
    both = accepted.join(_by_flight(batch, "batch"), "flight_id", "full").join(rejected, "flight_id", "full")
    return both.select("flight_id", F.coalesce("n_accepted", F.lit(0)).alias("n_accepted"),
                       F.coalesce("n_rejected", F.lit(0)).alias("n_rejected"),
                       (F.col("n_accepted").eqNullSafe(F.col("n_batch")) & F.col("_accepted").eqNullSafe(F.col("_batch"))).alias("as_in_batch"))
