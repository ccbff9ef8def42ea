"""Small helpers shared by the text operators."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy scan of one stored table."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def body(column: str = "text") -> Column:
    """The text of a row; null counts as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


#: Rows of texts that a Python worker holds at once (Spark bounds the bytes as well).
BATCH_ROWS = 2_000


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batch size to BATCH_ROWS, where it is larger."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def keyed(docs: DataFrame) -> DataFrame:
    """Only what an operator reads: ``doc_id`` (bigint) and ``text`` (never
    null).  Further columns, whatever their names, are left behind."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), body().alias("text"))


def unused(name: str, df: DataFrame) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def all_columns(df: DataFrame) -> list[Column]:
    """The columns of ``df`` by their whole names, dots and all."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]
