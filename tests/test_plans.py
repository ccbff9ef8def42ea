"""Plan shape of every registered query: JVM-only expressions, no
nested-loop or cartesian joins, partial per-group limits where a top-n
is taken, column pruning at the scan."""

import pytest

import __spark_entry__ as entry
from contrail.plans import catalog

from driver_tables import SF_SMALL

NAMES = sorted(n for n in catalog.queries() if n != "delay_scoring")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_python_no_nested_loops(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"


def test_partial_group_limit_before_shuffle(spark):
    """On an input that is not already grouped by the key, the top-n keeps a
    map-side partial limit before the exchange (a hot key ships n rows per
    map task)."""
    from pyspark.sql import functions as F
    from contrail.operators.dedup import dedup_first, top_n_per_group

    df = spark.range(100000).select((F.col("id") % 7).alias("k"), F.col("id").alias("o")).repartition(8)
    for out in (dedup_first(df, ["k"], ["o"]), top_n_per_group(df, ["k"], [F.col("o").desc()], 50)):
        plan = _plan(out)
        assert "WindowGroupLimit" in plan and "Partial" in plan and "Exchange hashpartitioning(k" in plan
    assert "WindowGroupLimit" in _plan(entry.queries()["top_n_per_group"](spark, SF_SMALL))


def test_scan_reads_only_needed_columns(spark):
    df = entry.queries()["request_rate"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan or "struct<ts:timestamp_ntz>" in plan


