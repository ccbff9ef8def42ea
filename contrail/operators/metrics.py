"""Evaluation metrics as distributed aggregations.

No metric collects the scored rows.  Curve metrics first reduce the data to
one row per distinct score (partial aggregation), then take exact running
sums over scores with ``running_totals`` instead of a global
``Window.orderBy`` that would pull every row into one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.operators.ranking import in_ranges, running_totals


def _safe_div(num: Column, den: Column) -> Column:
    """num / den, 0 when den is 0 (scikit-learn's ``zero_division=0``)."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def confusion_binary(df: DataFrame, y: str = "y", pred: str = "y_pred") -> DataFrame:
    """tn, fp, fn, tp in one aggregate."""
    yy, pp = F.col(y), F.col(pred)
    return df.agg(
        F.count_if((yy == 0) & (pp == 0)).alias("tn"), F.count_if((yy == 0) & (pp == 1)).alias("fp"),
        F.count_if((yy == 1) & (pp == 0)).alias("fn"), F.count_if((yy == 1) & (pp == 1)).alias("tp"))


def metrics_from_counts(c: DataFrame) -> DataFrame:
    """precision, recall, F1, accuracy from a (tn, fp, fn, tp) row."""
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    return c.select(
        "tn", "fp", "fn", "tp",
        _safe_div(tp, tp + fp).alias("precision"),
        _safe_div(tp, tp + fn).alias("recall"),
        _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"),
        _safe_div(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        (tp + fn).alias("support_positive"),
        (tp + tn + fp + fn).alias("support_total"),
    )


def binary_metrics(df: DataFrame, y: str = "y", pred: str = "y_pred") -> DataFrame:
    return metrics_from_counts(confusion_binary(df, y, pred))


def score_table(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """One row per distinct score with its positive and negative counts (a
    partial aggregate)."""
    return df.filter(F.col(p).isNotNull()).groupBy(p).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))


def roc_auc(df: DataFrame, y: str = "y", p: str = "p", digits: int | None = 12) -> DataFrame:
    """ROC AUC with exact tie handling.

    For each distinct score: every negative wins against the positives above
    it and half of the positives at the same score.  With ascending running
    positives ``cum_pos``: AUC = 1 - sum(neg * (2 cum_pos - pos)) / (2 P N).
    """
    st = score_table(df, y, p)
    r = running_totals(in_ranges(st, [p]), [], F.col("_bkt"), [p], ["pos"])
    s = r.agg(F.sum(F.col("neg").cast("double") * (2 * F.col("cum_pos") - F.col("pos"))).alias("_s"),
              F.sum("pos").alias("_P"), F.sum("neg").alias("_N"))
    auc = F.lit(1.0) - F.col("_s") / (F.lit(2.0) * F.col("_P").cast("double") * F.col("_N").cast("double"))
    auc = F.when((F.col("_P") == 0) | (F.col("_N") == 0), F.lit(None).cast("double")).otherwise(auc)
    return s.select((F.round(auc, digits) if digits is not None else auc).alias("roc_auc"))


def average_precision(df: DataFrame, y: str = "y", p: str = "p", digits: int | None = 12) -> DataFrame:
    """Average precision as the step sum over thresholds (E4), not the
    trapezoid area: sum over distinct scores (descending) of
    (pos / P) * precision at that score."""
    st = score_table(df, y, p)
    r = running_totals(in_ranges(st, [p]), [], F.col("_bkt"), [F.col(p).desc()], ["pos", "neg"], descending=True)
    prec = F.col("cum_pos").cast("double") / (F.col("cum_pos") + F.col("cum_neg"))
    s = r.agg(F.sum(F.col("pos") * prec).alias("_s"), F.sum("pos").alias("_P"))
    ap = F.when(F.col("_P") == 0, F.lit(None).cast("double")).otherwise(F.col("_s") / F.col("_P"))
    return s.select((F.round(ap, digits) if digits is not None else ap).alias("average_precision"))


def grid_value(i: Column, lo: float, step: float) -> Column:
    """i-th grid threshold, computed as ``lo + i * ((lo + step) - lo)``: the
    same doubles as ``numpy.arange(lo, hi, step)``."""
    return F.lit(lo) + i.cast("double") * F.lit((lo + step) - lo)


def threshold_sweep(df: DataFrame, y: str = "y", p: str = "p", lo: float = 0.10, hi: float = 0.90,
                    step: float = 0.01) -> DataFrame:
    """tp, fp, fn, precision, recall and F1 at every grid threshold (E5).

    One pass over the data: each row goes straight to the highest grid
    index its score passes (``p >= t_i``), counts are summed per index, and suffix
    sums over the (at most ~100-row) grid table give the counts at every
    threshold.  No cross join of scores and thresholds.
    """
    spark: SparkSession = df.sparkSession
    n = math.ceil((hi + step / 2 - lo) / step)  # numpy.arange(lo, hi + step/2, step) length
    v = F.col(p)
    i0 = F.floor((v - F.lit(lo)) / F.lit(step)).cast("int")
    idx = (F.when(grid_value(i0 + 1, lo, step) <= v, i0 + 1)
           .when(grid_value(i0, lo, step) <= v, i0)
           .otherwise(i0 - 1))
    idx = F.least(F.greatest(idx, F.lit(-1)), F.lit(n - 1))
    # summed per index before the shuffle: at most n + 1 rows from each task
    per = df.filter(v.isNotNull()).groupBy(idx.alias("i")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))
    grid = spark.range(n).select(F.col("id").cast("int").alias("i"))
    # grid + the "below every threshold" bucket -1: at most n + 1 rows, so the
    # windows below run on a bounded table
    g = grid.join(per, "i", "full_outer").na.fill(0, ["pos", "neg"])
    every = Window.partitionBy()
    suffix = Window.orderBy(F.col("i").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    g = g.withColumns({"tp": F.sum("pos").over(suffix), "fp": F.sum("neg").over(suffix),
                       "_P": F.sum("pos").over(every)}).filter(F.col("i") >= 0)
    tp, fp = F.col("tp"), F.col("fp")
    fn = F.col("_P") - tp
    return g.select(
        F.col("i").alias("step"), grid_value(F.col("i"), lo, step).alias("threshold"),
        tp.cast("bigint").alias("tp"), fp.cast("bigint").alias("fp"), fn.cast("bigint").alias("fn"),
        _safe_div(tp, tp + fp).alias("precision"), _safe_div(tp, F.col("_P")).alias("recall"),
        _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """Highest F1; among equal F1 the lowest threshold wins (a strict ``>``
    scan in ascending order keeps the first).  A top-1 is the feature."""
    return sweep.orderBy(F.col("f1").desc(), F.col("threshold").asc()).limit(1) \
        .select(F.col("threshold").alias("best_threshold"), F.col("f1").alias("best_f1"), "step")


def class_counts(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """(class, support, n_pred, hits) over the classes that occur as truth or
    prediction.  One pass: every row emits its actual and its predicted
    class, then one grouped sum - no joins, partial aggregation first."""
    hit = (F.col(actual) == F.col(predicted)).cast("int")
    e = df.select(F.explode(F.array(
        F.struct(F.col(actual).alias("cls"), F.lit(1).alias("s"), F.lit(0).alias("p"), hit.alias("h")),
        F.struct(F.col(predicted).alias("cls"), F.lit(0).alias("s"), F.lit(1).alias("p"), F.lit(0).alias("h")),
    )).alias("e")).select("e.*").filter(F.col("cls").isNotNull())
    return e.groupBy(F.col("cls").alias("class")).agg(
        F.sum("s").cast("bigint").alias("support"), F.sum("p").cast("bigint").alias("n_pred"),
        F.coalesce(F.sum("h"), F.lit(0)).cast("bigint").alias("hits"))


def _with_prf(c: DataFrame) -> DataFrame:
    s, pr, h = F.col("support"), F.col("n_pred"), F.col("hits")
    return c.withColumns({"precision": _safe_div(h, pr), "recall": _safe_div(h, s),
                          "f1": _safe_div(2 * h, s + pr)})


def class_report(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Per-class precision, recall, F1 and support."""
    return _with_prf(class_counts(df, actual, predicted)).select("class", "precision", "recall", "f1", "support")


def multiclass_summary(df: DataFrame, actual: str = "actual", predicted: str = "predicted",
                       digits: int | None = 12) -> DataFrame:
    """Macro F1 (over classes seen as truth or prediction), support-weighted
    F1 and accuracy (E7).  Aggregates the per-class table: one row per class."""
    r = _with_prf(class_counts(df, actual, predicted))
    out = r.agg(
        F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"),
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        F.sum("support").cast("bigint").alias("support_total"))
    if digits is None:
        return out
    return out.select(*[F.round(c, digits).alias(c) for c in ("macro_f1", "weighted_f1", "accuracy")],
                      "support_total")


def confusion_matrix(df: DataFrame, classes: Sequence[str], actual: str = "actual",
                     predicted: str = "predicted") -> DataFrame:
    """k x k counts in the given class order (E8): rows = actual, one column
    per predicted class.  ``pivot`` with the values given avoids the extra
    job that discovers them; absent classes appear as zero rows."""
    spark = df.sparkSession
    counts = (df.filter(F.col(actual).isin(*classes))
              .groupBy(actual).pivot(predicted, list(classes)).agg(F.count(F.lit(1))))
    # the class list is the caller's parameter (k rows), not data
    labels = spark.createDataFrame([(c,) for c in classes], [actual])
    out = labels.join(counts, actual, "left")
    return out.na.fill(0, list(classes))
