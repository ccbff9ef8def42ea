"""Dataset profiles and version comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.operators.ranking import quantiles_from_counts, value_counts_table


def dataset_stats(df: DataFrame, key: str = "flight_id", flag: str = "is_significant_delay",
                  share_digits: int | None = 6) -> DataFrame:
    """rows, surplus duplicate keys, positive count and share (G1), one row
    (zero counts and a NULL share for an empty input).

    The distinct-key count is a two-phase aggregate on the key (partial
    aggregation first), so a hot key costs one row per map task.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.sum(flag).alias("_p"))
    share = F.sum("_p") / F.sum("_n")
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows_total"),
        F.coalesce(F.sum("_n") - F.count(F.lit(1)), F.lit(0)).cast("bigint").alias("duplicate_keys"),
        F.coalesce(F.sum("_p"), F.lit(0)).cast("bigint").alias("positive_count"),
        (F.round(share, share_digits) if share_digits is not None else share).alias("positive_share"),
    )


def value_counts(df: DataFrame, col: str, by: Sequence[str] = (), name: str = "n_rows") -> DataFrame:
    """Frequency of each non-null value."""
    return df.filter(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count(F.lit(1)).alias(name))


def delay_summary(df: DataFrame, flag: str = "is_significant_delay", minutes: str = "delay_minutes",
                  by: Sequence[str] = ()) -> DataFrame:
    """mean / median / p95 / max of ``minutes`` among positive rows.

    One pass over the input: positives are reduced to counts per distinct
    value (per group), checkpointed, and all four measures come from that
    small table - quantiles exact with linear interpolation, never gathering
    a group's values in one buffer.  NULL for a group without positives.
    """
    counts = value_counts_table(df.filter(F.col(flag) == 1), minutes, by)
    extra = {"mean_delay": F.sum(F.col(minutes) * F.col("_c")) / F.sum("_c"), "max_delay": F.max(minutes)}
    return quantiles_from_counts(counts, minutes, [0.5, 0.95], by, ["median_delay", "p95_delay"],
                                 extra_aggs=extra)


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NULL count per column (G4): one aggregate pass, then unpivot."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(cols)])
    stack = "stack({n}, {pairs}) as (column_name, null_count)".format(
        n=len(cols), pairs=", ".join(f"'{c}', c{i}" for i, c in enumerate(cols)))
    return wide.selectExpr(stack)


def period_profile(df: DataFrame, ts: str) -> DataFrame:
    """Rows per calendar year with the first and last timestamp."""
    return df.groupBy(F.year(ts).alias("year")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("period_start"), F.max(ts).alias("period_end"))


def class_distribution(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Counts of each class as truth and as prediction.

    One pass: every row emits (actual, 1, 0) and (predicted, 0, 1), then a
    single grouped sum - no second scan and no outer join."""
    both = df.select(F.explode(F.array(
        F.struct(F.col(actual).alias("cls"), F.lit(1).alias("a"), F.lit(0).alias("p")),
        F.struct(F.col(predicted).alias("cls"), F.lit(0).alias("a"), F.lit(1).alias("p")),
    )).alias("e")).select("e.*")
    return both.filter(F.col("cls").isNotNull()).groupBy("cls").agg(
        F.sum("a").cast("bigint").alias("actual_count"), F.sum("p").cast("bigint").alias("predicted_count")
    ).withColumnRenamed("cls", "class")


def _version_counts(df: DataFrame, version: str, flag: str, minutes: str, extra: Sequence[str] = ()) -> DataFrame:
    """Rows counted per (version, flag, minutes, *extra) - a partial aggregate
    the size of the value domain - written once to the checkpoint folder."""
    from contrail.session import cut_lineage

    return cut_lineage(df.groupBy(version, flag, minutes, *extra).agg(F.count(F.lit(1)).alias("_c")))


def _stats_from_counts(counts: DataFrame, version: str, flag: str, minutes: str) -> DataFrame:
    fc = F.col(flag) * F.col("_c")
    base = counts.groupBy(version).agg(
        F.sum("_c").alias("rows_total"),
        F.sum(fc).cast("bigint").alias("positive_count"),
        (F.sum(fc) / F.sum(F.when(F.col(flag).isNotNull(), F.col("_c")))).alias("positive_share"),
    )
    pos = counts.filter((F.col(flag) == 1) & F.col(minutes).isNotNull()) \
        .groupBy(version, minutes).agg(F.sum("_c").alias("_c"))
    extra = {"mean_delay": F.sum(F.col(minutes) * F.col("_c")) / F.sum("_c"), "max_delay": F.max(minutes)}
    summary = quantiles_from_counts(pos, minutes, [0.5, 0.95], [version], ["median_delay", "p95_delay"],
                                    extra_aggs=extra)
    return base.join(summary, version, "left")


def version_stats(df: DataFrame, version: str = "version", flag: str = "is_significant_delay",
                  minutes: str = "delay_minutes") -> DataFrame:
    """G1 and G3 per dataset version (G7), from one pass over the rows.

    Rows are reduced to counts per (version, flag, minutes) and written once;
    the per-version totals and the exact quantiles of the positives both read
    that table."""
    return _stats_from_counts(_version_counts(df, version, flag, minutes), version, flag, minutes)


MEASURES = ["rows_total", "positive_count", "positive_share", "mean_delay", "median_delay", "p95_delay"]


def compare_versions(df: DataFrame, old: str, new: str, version: str = "version",
                     reason: str = "delay_reason") -> DataFrame:
    """Measure, old value, new value, delta for two versions.

    Profile measures come from ``version_stats``; reason counts are joined
    full outer on the reason so a reason present in one version only counts
    as 0 in the other."""
    two = df.filter(F.col(version).isin(old, new))
    # one pass: the count table also carries the reason, so the profile
    # measures and the reason counts come from the same written table
    counts = _version_counts(two, version, "is_significant_delay", "delay_minutes", [reason])
    stats = _stats_from_counts(counts, version, "is_significant_delay", "delay_minutes")
    stack = "stack({n}, {pairs}) as (measure, value)".format(
        n=len(MEASURES), pairs=", ".join(f"'{m}', CAST({m} AS DOUBLE)" for m in MEASURES))
    long = stats.selectExpr(version, stack)
    reasons = counts.filter(F.col(reason).isNotNull()).groupBy(version, reason).agg(F.sum("_c").alias("n_rows")) \
        .select(version, F.concat(F.lit("reason:"), F.col(reason)).alias("measure"),
                F.col("n_rows").cast("double").alias("value"))
    allm = long.unionByName(reasons)
    o = allm.filter(F.col(version) == old).select("measure", F.col("value").alias("old_value"))
    n = allm.filter(F.col(version) == new).select("measure", F.col("value").alias("new_value"))
    j = o.join(n, "measure", "full_outer")
    is_reason = F.col("measure").startswith("reason:")
    old_v = F.when(is_reason, F.coalesce("old_value", F.lit(0.0))).otherwise(F.col("old_value"))
    new_v = F.when(is_reason, F.coalesce("new_value", F.lit(0.0))).otherwise(F.col("new_value"))
    return j.select("measure", old_v.alias("old_value"), new_v.alias("new_value"),
                    (new_v - old_v).alias("delta"))


def delay_sketches(df: DataFrame, by: Sequence[str], minutes: str = "delay_minutes", flag: str = "is_significant_delay",
                   k: int = 800) -> DataFrame:
    """Quantile sketches (KLL) of the positives' delays, one a group of ``by``,
    to be stored: approximate quantiles (G3, G7) of any union of groups come
    from them by ``sketch_quantiles``, without another pass over the rows."""
    return df.filter((F.col(flag) == 1) & F.col(minutes).isNotNull()).groupBy(*by).agg(
        F.count("*").alias("n_rows"), F.kll_sketch_agg_double(F.col(minutes).cast("double"), F.lit(k)).alias("sketch"))


#: Rank error of a sketch with k = 800 (merged ones too), over 99 % of the time well below this.
SKETCH_ERROR = 0.01


def sketch_quantiles(sketches: DataFrame, by: Sequence[str], qs: Mapping[str, float], k: int = 800) -> DataFrame:
    """Sketches merged within each group of ``by``: rows and one column a quantile."""
    merged = sketches.groupBy(*by).agg(F.sum("n_rows").alias("n_rows"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("_s"))
    return merged.select(*by, "n_rows", *[F.kll_sketch_get_quantile_double("_s", F.lit(float(q))).alias(name) for name, q in qs.items()])
