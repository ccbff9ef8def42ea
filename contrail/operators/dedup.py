"""Deduplication, top-n per group and label checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.schema import SIGNIFICANT_DELAY_MIN


def _orders(order_by: Sequence[Column | str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order_by]


def top_n_per_group(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str],
                    n: int, rank_col: str | None = None) -> DataFrame:
    """First ``n`` rows of every key group under ``order_by``.

    ``row_number() <= n`` with a small ``n`` is planned with a partial
    ``WindowGroupLimit`` before the shuffle: each map task keeps at most ``n``
    rows per key, so a hot key (a third of all rows) ships ``n`` rows per task
    instead of all of its rows.  ``order_by`` must be a total order inside a
    group for a deterministic result.
    """
    w = Window.partitionBy(*keys).orderBy(*_orders(order_by))
    tmp = rank_col or "_rn"
    out = df.withColumn(tmp, F.row_number().over(w)).filter(F.col(tmp) <= n)
    return out if rank_col else out.drop(tmp)


def dedup_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """Keep the first row per key under an explicit total order.

    ``dropDuplicates`` keeps an arbitrary row; files have no row order in
    Spark, so "first" needs ``order_by`` from the caller.
    """
    if not order_by:
        raise ValueError("dedup_first needs an explicit order; files have no row order")
    return top_n_per_group(df, keys, order_by, 1)


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """rows, distinct keys and surplus duplicate rows (D2). NULL keys are
    equal to each other, like pandas' ``duplicated``."""
    key = F.struct(*[F.col(k) for k in keys]) if len(keys) > 1 else F.col(keys[0])
    distinct_keys = df.select(key.alias("_k")).groupBy("_k").agg(F.count(F.lit(1)).alias("_n"))
    return distinct_keys.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows_total"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum("_n") - F.count(F.lit(1)), F.lit(0)).cast("bigint").alias("duplicate_rows"),
    )


def distinct_versions(stats: DataFrame, fingerprint_cols: Sequence[str],
                      version_col: str = "version") -> DataFrame:
    """Drop versions whose fingerprint equals an earlier version's."""
    return top_n_per_group(stats, list(fingerprint_cols), [version_col], 1)


def label_violations(df: DataFrame, minutes: str = "delay_minutes",
                     flag: str = "is_significant_delay", reason: str = "delay_reason") -> DataFrame:
    """Counts of rows that break the label invariant.

    Invariant: ``minutes >= 15`` <=> flag = 1; flag = 0 <=> reason 'none'.
    One row per violation kind, zero counts included.
    """
    expected = F.coalesce(F.col(minutes) >= SIGNIFICANT_DELAY_MIN, F.lit(False)).cast("int")
    checks = {
        "flag_mismatch": F.col(flag).isNull() | (F.col(flag) != expected),
        "reason_without_delay": (F.col(flag) == 0) & (F.col(reason).isNull() | (F.col(reason) != "none")),
        "delay_without_reason": (F.col(flag) == 1) & (F.col(reason).isNull() | (F.col(reason) == "none")),
    }
    counts = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in checks.items()])
    stack = "stack({n}, {pairs}) as (violation, n_rows)".format(
        n=len(checks), pairs=", ".join(f"'{k}', {k}" for k in checks))
    return counts.selectExpr(stack)
