"""The corpus pipeline: documents -> quality -> one of each near-duplicate
group -> no benchmark passages -> no personal data -> mixed sources.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``; the last adds each row's place in
the mix.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from contrail.llm import decontaminate, mixing, pii, quality, simhash
from contrail.llm.common import table
from contrail.session import checkpoint_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    return quality.keep_quality(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash group."""
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts."""
    return pii.redact_documents(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Gives every document its place in the mix of sources."""
    return mixing.mix(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("personal_data", pii_stage),
    ("mixing", mixing_stage),
]

#: Fingerprints, edit distances and the classifier are beyond SQL; tests/llm
#: compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    base = os.path.join(checkpoint_dir(spark), f"pipeline-{uuid.uuid4().hex}")
    for name, stage in STAGES:
        path = os.path.join(base, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
