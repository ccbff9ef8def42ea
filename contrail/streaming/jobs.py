"""Streaming jobs over a folder that files arrive in.

Each job reads what has arrived since its last run (``availableNow``), goes on
from its progress folder and ends; a scheduler calls it again for new files.
Outputs are written so that a batch which is run twice - after a failure, or a lost
driver - leaves its rows once.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from contrail.operators.learn import FeatureSpec, prepare, score
from contrail.streaming.scoring import split_requests
from contrail.streaming.traffic import request_log, traffic_stream


def run_traffic(spark: SparkSession, feed: str, schema: T.StructType, out: str, progress: str, **metric) -> None:
    """Windowed request metrics of the events below ``feed`` (W7): every
    window is appended to ``out`` once, when the watermark has passed its end;
    events of windows that are already out are dropped.  ``metric`` as for
    ``traffic_stream``.  Read the result with ``spark.read.parquet(out)``, which
    goes by the sink's own list of committed files."""
    events = spark.readStream.schema(schema).parquet(feed)
    (traffic_stream(request_log(events), **metric).writeStream.format("parquet").outputMode("append")
     .option("checkpointLocation", progress).trigger(availableNow=True).start(out).awaitTermination())


def write_scored(batch: DataFrame, batch_id: int, out: str, features_model, delay_model, threshold: float,
                 reason_model=None, classes: Sequence[str] = (), spec: FeatureSpec | None = None,
                 keep: Sequence[str] = ("request_id",)) -> None:
    """Both outputs of one batch, each into the folder of its batch, which a
    second run of the batch replaces as a whole."""
    ok, bad = split_requests(batch)
    kept = [c for c in keep if c in ok.columns]
    scored = score(prepare(ok, spec or FeatureSpec()), features_model, delay_model, threshold, reason_model, classes, kept)
    for name, part in (("accepted", scored), ("rejected", bad)):
        part.write.mode("overwrite").parquet(os.path.join(out, name, f"batch_id={batch_id}"))


def run_scoring(spark: SparkSession, feed: str, schema: T.StructType, out: str, progress: str, features_model, delay_model,
                threshold: float, reason_model=None, classes: Sequence[str] = (), spec: FeatureSpec | None = None,
                keep: Sequence[str] = ("request_id",)) -> None:
    """Scores the requests below ``feed`` (M9): accepted ones to
    ``out/accepted``, the others with their reason to ``out/rejected``."""
    requests = spark.readStream.schema(schema).parquet(feed)

    def one(batch: DataFrame, batch_id: int) -> None:
        write_scored(batch, batch_id, out, features_model, delay_model, threshold, reason_model, classes, spec, keep)

    (requests.writeStream.foreachBatch(one).option("checkpointLocation", progress)
     .trigger(availableNow=True).start().awaitTermination())
