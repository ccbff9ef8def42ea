"""Session construction and cluster-safe checkpoint handling."""

from __future__ import annotations

import gc
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Whether Spark removes the shuffle files of a statement at its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "contrail") -> SparkSession:
    """Build (or reuse) a session with the settings every job here assumes.

    On a cluster the master, resources and shuffle partitions come from
    spark-submit; only the SQL behaviour is pinned: UTC session time zone (the
    oracle compares wall clock values), AQE with partition coalescing and
    skew-join splitting.  ``shuffle_partitions`` is set only where a caller
    passes a number (tests and the bench do).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master and master.startswith("local"):
        builder = builder.config("spark.driver.memory", os.environ.get("CONTRAIL_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    It points at storage that the driver and all executors share; where it is
    not set, the job stops rather than write to one machine's disk.  (Tests
    and the bench set a folder of their own.)
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...)")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialize ``df`` as a Parquet table in the shared checkpoint folder
    and continue from that table.

    Used between dependent steps (sequential relabel rules, a count table
    read twice) so later work - and a lost executor - starts from the
    written table instead of recomputing the chain.  One pass writes it
    (``Dataset.checkpoint`` would compute an unpersisted input twice), and
    the read back is a columnar scan with column pruning.  The shuffle files
    of the pass are removed as soon as the table is written.
    """
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), f"contrail-{uuid.uuid4().hex}")
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.parquet(path)


def release(df: DataFrame) -> None:
    """Delete the table that ``cut_lineage`` wrote and ``df`` reads, once all that is read from it is written."""
    sc = df.sparkSession.sparkContext
    for path in {os.path.dirname(f) for f in df.inputFiles()}:
        if not os.path.basename(path).startswith("contrail-"):
            raise ValueError(f"not a table of cut_lineage: {path}")
        where = sc._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


def release_shuffles(spark: SparkSession) -> None:
    """Have Spark remove the shuffle files of frames that are no longer in use (it looks at them when the driver's
    heap is collected, which on a large heap may be at the end of the job)."""
    gc.collect()  # frames that Python holds in cycles
    spark.sparkContext._jvm.System.gc()
