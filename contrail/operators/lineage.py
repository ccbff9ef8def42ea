"""Dataset fingerprints, the run log and lineage checks."""

from __future__ import annotations

import datetime as _dt
import os
import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions.calendar import epoch_micros
from contrail.functions.hashing import row_digest
from contrail.operators.ranking import previous_in_order


def fingerprint(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Order-free content fingerprint: row count and the sum of a 60-bit md5
    prefix of each row's canonical text (S6).

    A sum, not XOR, so duplicate rows do not cancel; summed as
    DECIMAL(38,0), which cannot overflow below ~2^66 rows.  Any row change
    changes the sum with probability ~1 - 2^-60; it is a partial aggregate,
    so it costs one pass and no shuffle of rows.
    """
    d = row_digest(*cols).cast("decimal(38,0)")
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.sum(d).alias("fingerprint")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("experiment", T.StringType()),
    T.StructField("run_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("start_time", T.TimestampNTZType()),
    T.StructField("data_version", T.StringType()),
    T.StructField("data_fingerprint", T.StringType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
])


def log_run(spark: SparkSession, path: str, experiment: str, run_name: str,
            params: Mapping[str, object], metrics: Mapping[str, object],
            data_version: str | None = None, data_fingerprint: str | None = None,
            status: str = "FINISHED", run_id: str | None = None) -> DataFrame:
    """Append one run to the run-log table at ``path``.

    A run lies in a folder named by its id, which a repeated call replaces:
    with a given ``run_id`` a retry leaves one row.  Only int/float metrics are
    kept; nested per-class values are flattened as ``name.key``.  Params are stored as text.
    """
    run_id = run_id or uuid.uuid4().hex
    if not re.fullmatch(r"[A-Za-z0-9_-]+", run_id):
        raise ValueError("run_id: letters, digits, - and _ only")
    flat: dict[str, float] = {}
    for k, v in metrics.items():
        if isinstance(v, Mapping):
            for kk, vv in v.items():
                if isinstance(vv, (int, float)) and not isinstance(vv, bool):
                    flat[f"{k}.{kk}"] = float(vv)
        elif isinstance(v, (int, float)) and not isinstance(v, bool):
            flat[k] = float(v)
    row = (run_id, experiment, run_name, status, _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None),
           data_version, data_fingerprint, {k: str(v) for k, v in params.items()}, flat)
    one = spark.createDataFrame([row], RUN_SCHEMA)
    one.write.mode("overwrite").parquet(os.path.join(path, f"part=run-{run_id}"))
    return one


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The run log at ``path``, one row a run.  A run that lies in a compacted
    part as well as in its own folder - a compaction that did not come to its end - counts once."""
    runs = spark.read.schema(T.StructType([*RUN_SCHEMA, T.StructField("part", T.StringType())])).parquet(path)
    # a run's own folder is the later word on it; of compacted parts the larger name
    own = F.startswith("part", F.lit("run-")).cast("int")
    return runs.groupBy("run_id").agg(F.max_by(F.struct(*RUN_SCHEMA.names), F.struct(own, "part")).alias("r")).select("r.*")


def compact_runs(spark: SparkSession, path: str) -> int:
    """Put the folders of single runs together into one part; returns their
    number.  The part is written as a whole before the folders go, so a job that ends in
    between loses and repeats nothing (see ``read_runs``)."""
    sc = spark.sparkContext
    root = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(sc._jsc.hadoopConfiguration())
    old = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith("part=run-")
           and fs.exists(sc._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    if old:
        now = spark.read.schema(RUN_SCHEMA).parquet(*[p.toString() for p in old])
        stamp = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        now.coalesce(1).write.parquet(os.path.join(path, f"part=compact-{stamp}"))
        for p in old:
            fs.delete(p, True)
    return len(old)


def metric_deltas(runs: DataFrame, experiment: str = "experiment", run_id: str = "run_id",
                  start: str = "start_time", metrics: str = "metrics") -> DataFrame:
    """Change of every metric between consecutive runs of an experiment (R2),
    runs ordered by (start time, run id).

    ``lag`` over a window partitioned by experiment would sort a whole
    experiment in one task; ``previous_in_order`` runs it inside ranges of
    (experiment, metric, start time, run id).
    """
    long = runs.select(experiment, run_id, start, F.explode(metrics).alias("metric", "value")) \
        .withColumn("_t", epoch_micros(F.col(start), dict(runs.dtypes)[start] == "timestamp_ntz"))
    prev = previous_in_order(long, [experiment, "metric"], "_t", run_id, ["value"])
    return prev.select(experiment, "metric", run_id, start, "value", F.col("prev_value"),
                       (F.col("value") - F.col("prev_value")).alias("delta"))


def lineage_check(run_log: DataFrame, version_fps: DataFrame, base: str, newest: str,
                  version: str = "version") -> DataFrame:
    """Did each run train on the data its version holds now (R3)?

    verdict: ``match`` / ``differs`` / ``not recorded``; and whether the
    run's version still equals the base and the newest version.
    """
    fp = F.col("fingerprint").cast("string")
    every = Window.partitionBy()  # over the version table: one row per version
    fps = version_fps.select(
        version, fp.alias("_fp"),
        F.max(F.when(F.col(version) == base, fp)).over(every).alias("_base"),
        F.max(F.when(F.col(version) == newest, fp)).over(every).alias("_new"))
    j = run_log.join(fps, run_log["data_version"] == fps[version], "left")
    rec = F.col("data_fingerprint")
    verdict = (F.when(rec.isNull(), "not recorded").when(rec == F.col("_fp"), "match").otherwise("differs"))
    return j.select(
        "run_id", "data_version", verdict.alias("verdict"),
        F.coalesce(F.col("_fp") == F.col("_base"), F.lit(False)).alias("same_as_base"),
        F.coalesce(F.col("_fp") == F.col("_new"), F.lit(False)).alias("same_as_newest"),
    )
