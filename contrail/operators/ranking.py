"""Exact ranks, running sums and quantiles that stay balanced under skew.

``Window.partitionBy(g).orderBy(x)`` sorts a whole group in one task; with a
group holding a third of all rows that task is the job.  Here the order is
cut into buckets first (a coarse, monotone key), so the work splits in two:

1. per (group, bucket) totals - a small table of at most groups x buckets
   rows - and their exclusive running sums over buckets;
2. the local rank / running sum inside each (group, bucket), which is a
   window over one bucket of one group only.

Rank = bucket offset + local rank.  Both parts are deterministic functions
of the rows (no sampling-dependent partition ids), so a recomputed task
after a lost executor yields the same numbers.

Buckets come either from a uniform hash (``hash_buckets``) or from Spark's
range partitioning of the rows by the order itself (``in_ranges``), whose
number of ranges is the session's number of shuffle partitions and which
orders any sortable type by its whole value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.functions.hashing import hex60
from contrail.session import cut_lineage


def hash_buckets(md5_hex: Column, bits: int = 16) -> Column:
    """Top ``bits`` bits of the 60-bit md5 prefix: ``2**bits`` equal buckets,
    monotone in the md5 text order.  65,536 buckets keep a class holding a
    third of 10^12 rows at ~5 million rows per local sort, while the offset
    table stays at most 65,536 rows per group."""
    return F.shiftright(hex60(md5_hex), 60 - bits)


def in_ranges(df: DataFrame, order_by: Sequence[Column | str]) -> DataFrame:
    """``df`` range-partitioned by ``order_by`` and written once, with the
    range number ``_bkt`` (non-decreasing along the order, nulls first).

    The ranges come from Spark's own sample of the order values, so equal
    sized ranges need no statistics here; their number follows
    ``spark.sql.shuffle.partitions``.  Written, because a second evaluation
    might draw other ranges."""
    return cut_lineage(df.repartitionByRange(*order_by).withColumn("_bkt", F.spark_partition_id()))


def running_totals(df: DataFrame, group_cols: Sequence[str], bucket: Column,
                   order_by: Sequence[Column | str], sum_cols: Sequence[str] = (),
                   rank_col: str = "rank", prefix: str = "cum_", descending: bool = False,
                   group_size_col: str | None = None, total_prefix: str | None = None) -> DataFrame:
    """Exact 1-based ``rank_col`` (row number) and inclusive running sums
    ``prefix + c`` within each group, in the order ``(bucket, *order_by)``.

    ``bucket`` must be non-decreasing along ``order_by`` (non-increasing if
    ``descending``).  ``order_by`` should be a total order for a
    deterministic row number.  The offset table has at most groups x buckets
    rows; how it is joined is left to the planner, which knows its size.
    ``group_size_col`` adds the row count of the whole group and
    ``total_prefix`` the group total of every summed column; both come from
    the small offset table, so no extra join or pass over the data.  NULL
    group values are matched null-safely.
    """
    g = list(group_cols)
    b = df.withColumn("_bkt", bucket)
    totals = b.groupBy(*g, "_bkt").agg(
        F.count(F.lit(1)).alias("_bn"), *[F.sum(c).alias(f"_bs_{c}") for c in sum_cols])
    bo = F.col("_bkt").desc() if descending else F.col("_bkt").asc()
    wo = Window.partitionBy(*g).orderBy(bo).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *g, "_bkt",
        F.coalesce(F.sum("_bn").over(wo), F.lit(0)).alias("_on"),
        *[F.coalesce(F.sum(f"_bs_{c}").over(wo), F.lit(0)).alias(f"_os_{c}") for c in sum_cols],
        *([F.sum("_bn").over(Window.partitionBy(*g)).alias(group_size_col)] if group_size_col else []),
        *([F.sum(f"_bs_{c}").over(Window.partitionBy(*g)).alias(f"{total_prefix}{c}") for c in sum_cols]
          if total_prefix else []))
    orders = [F.col(c) for c in order_by] if order_by and isinstance(order_by[0], str) else list(order_by)
    wl = Window.partitionBy(*g, "_bkt").orderBy(*orders)
    wl_rows = wl.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = b.withColumn("_ln", F.row_number().over(wl))
    if sum_cols:
        local = local.withColumns({f"_ls_{c}": F.sum(c).over(wl_rows) for c in sum_cols})
    off = offsets.select(*[F.col(c).alias(f"_g_{c}") for c in g],
                         *[c for c in offsets.columns if c not in g])
    cond = [local["_bkt"] == off["_bkt"]] + [local[c].eqNullSafe(off[f"_g_{c}"]) for c in g]
    j = local.join(off, cond).drop(off["_bkt"]).drop(*[f"_g_{c}" for c in g])
    out = j.withColumn(rank_col, F.col("_on") + F.col("_ln"))
    if sum_cols:
        out = out.withColumns({f"{prefix}{c}": F.col(f"_os_{c}") + F.col(f"_ls_{c}") for c in sum_cols})
    drop = ["_bkt", "_bn", "_on", "_ln"] + [f"_{k}_{c}" for c in sum_cols for k in ("ls", "os")]
    return out.drop(*[c for c in drop if c in out.columns])


def value_counts_table(df: DataFrame, value: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """(group..., value, _c): rows per distinct value - a partial aggregate
    whose size is the number of distinct values, not rows."""
    return df.filter(F.col(value).isNotNull()).groupBy(*group_cols, value).agg(F.count(F.lit(1)).alias("_c"))


def quantiles_from_counts(counts: DataFrame, value: str, qs: Sequence[float], group_cols: Sequence[str] = (),
                          names: Sequence[str] | None = None, extra_aggs: dict | None = None) -> DataFrame:
    """Exact quantiles (linear interpolation between the two neighbouring
    ranks, as pandas' default and DuckDB's ``quantile_cont``) from a
    ``value_counts_table``.  The value at 0-based rank r is the distinct
    value whose cumulative count range covers r.  ``extra_aggs`` (name ->
    aggregate over the count rows) are computed in the same aggregation."""
    g = list(group_cols)
    names = list(names or [f"q{int(round(q * 100))}" for q in qs])
    ranged = in_ranges(counts, [*g, value])
    # group totals come from the small offset table: no join with a totals row
    j = running_totals(ranged, g, F.col("_bkt"), [value], ["_c"], rank_col="_r", prefix="_cum",
                       total_prefix="_tot").withColumnRenamed("_tot_c", "_N")
    aggs = []
    for q, name in zip(qs, names):
        pos = F.lit(float(q)) * (F.col("_N") - 1)
        for side, r in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            covers = (F.col("_cum_c") - F.col("_c") <= r) & (r <= F.col("_cum_c") - 1)
            aggs.append(F.min(F.when(covers, F.col(value))).alias(f"_{name}_{side}"))
        aggs.append(F.first(pos - F.floor(pos)).alias(f"_{name}_frac"))
    extra_aggs = extra_aggs or {}
    aggs += [c.alias(n) for n, c in extra_aggs.items()]
    agg = j.groupBy(*g).agg(*aggs) if g else j.agg(*aggs)
    outs = [F.col(c) for c in g] + [F.col(n) for n in extra_aggs]
    for name in names:
        lo, hi, fr = (F.col(f"_{name}_lo").cast("double"), F.col(f"_{name}_hi").cast("double"),
                      F.col(f"_{name}_frac"))
        outs.append((lo + (hi - lo) * fr).alias(name))
    return agg.select(*outs)


def exact_quantiles(df: DataFrame, value: str, qs: Sequence[float], group_cols: Sequence[str] = (),
                    names: Sequence[str] | None = None) -> DataFrame:
    """Exact quantiles per group without holding a group's values in one
    buffer: distinct-value counts (partial aggregation), then exact ranks
    with ``running_totals``."""
    return quantiles_from_counts(value_counts_table(df, value, group_cols), value, qs, group_cols, names)


def previous_in_order(df: DataFrame, group_cols: Sequence[str], order_col: str, tie_col: str,
                      value_cols: Sequence[str], prefix: str = "prev_") -> DataFrame:
    """For every row, the values of the row just before it within its group
    in the order ``(order_col, tie_col)`` - a ``lag`` that stays balanced when
    a group, or a single ``order_col`` value inside a group, holds a third of
    all rows.  ``tie_col`` must be unique inside (group, order value).

    The rows are range-partitioned by (group, order, tie); ``lag`` runs inside
    (range, group), and only the first row there takes its predecessor from a
    table of range ends (one row per range and group)."""
    g = list(group_cols)
    ranged = in_ranges(df, [*g, order_col, tie_col])
    here = Window.partitionBy("_bkt", *g).orderBy(order_col, tie_col)
    local = ranged.withColumns({**{f"_l_{c}": F.lag(c).over(here) for c in value_cols},
                                "_n": F.row_number().over(here)})
    ends = ranged.groupBy("_bkt", *g).agg(
        F.max_by(F.struct(*value_cols), F.struct(order_col, tie_col)).alias("_end"))
    carried = ends.select(F.col("_bkt").alias("_b"), *[F.col(c).alias(f"_g_{c}") for c in g],
                          F.lag("_end").over(Window.partitionBy(*g).orderBy("_bkt")).alias("_carry"))
    same = [local["_bkt"] == carried["_b"]] + [local[c].eqNullSafe(carried[f"_g_{c}"]) for c in g]
    return local.join(carried, same).select(
        *df.columns, *[F.when(F.col("_n") == 1, F.col(f"_carry.{c}")).otherwise(F.col(f"_l_{c}")).alias(f"{prefix}{c}")
                       for c in value_cols])
