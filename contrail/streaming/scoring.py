"""Streaming scoring of flight requests (M9).

Re-aims the one-request-at-a-time HTTP endpoint: requests arrive as a stream,
are validated against the input contract, enriched with calendar fields and
flags, and scored with the same ``score`` function as batch.  The step is
stateless, so it runs in append mode with no watermark; invalid requests -
a required field missing, or a departure time that can't be read - come back
as a frame of their own, to be written to an output of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions.calendar import parse_lenient
from contrail.operators.encoding import validate_requests
from contrail.operators.learn import FeatureSpec, prepare, score


TIME = "scheduled_departure_local"


def split_requests(stream: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid requests with a parsed departure time, rejected requests with
    ``rejected_for``: the first missing field, or the unreadable time)."""
    checked = validate_requests(stream)
    if dict(checked.dtypes)[TIME] == "string":
        checked = checked.withColumn("_time", parse_lenient(TIME))
    else:
        checked = checked.withColumn("_time", F.col(TIME))
    marks = ["is_valid", "first_missing", "n_missing", "_time"]
    ok = checked.filter(F.col("is_valid") & F.col("_time").isNotNull()).withColumn(TIME, F.col("_time")).drop(*marks)
    bad = checked.filter(~F.col("is_valid") | F.col("_time").isNull()).withColumn(
        "rejected_for", F.coalesce("first_missing", F.lit(TIME))).drop(*marks)
    return ok, bad


def score_stream(stream: DataFrame, features_model: PipelineModel, delay_model: PipelineModel, threshold: float,
                 reason_model: PipelineModel | None = None, classes: Sequence[str] = (),
                 spec: FeatureSpec | None = None,
                 keep: Sequence[str] = ("request_id",)) -> tuple[DataFrame, DataFrame]:
    """(scored valid requests, rejected requests): two streaming DataFrames
    (append mode) over the same source."""
    ok, bad = split_requests(stream)
    keep = [c for c in keep if c in ok.columns]
    return score(prepare(ok, spec or FeatureSpec()), features_model, delay_model, threshold, reason_model,
                 classes, keep), bad
