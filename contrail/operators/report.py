"""Combined prediction summary as one nested row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.operators import metrics, profile


def _scalar(df: DataFrame) -> "F.Column":
    """A one-row DataFrame as a struct-valued scalar subquery."""
    return df.select(F.struct(*df.columns)).scalar()


def prediction_summary(delay: DataFrame, reason: DataFrame, classes: Sequence[str],
                       y: str = "y", p: str = "p", pred: str = "y_pred",
                       actual: str = "actual", predicted: str = "predicted",
                       facts: Mapping[str, float] | None = None) -> DataFrame:
    """One row: split and threshold facts, binary metrics with ROC AUC and
    average precision, confusion counts and predicted / actual positives, the
    multiclass summary, per-class report, actual and predicted distributions,
    and the k x k matrix with its rows in the order of ``classes``.  Each part is a small aggregate; the row is assembled from scalar
    subqueries (no joins), and written with ``write_report``."""
    b = metrics.binary_metrics(delay, y, pred)
    auc = metrics.roc_auc(delay, y, p)
    ap = metrics.average_precision(delay, y, p)
    rep = metrics.class_report(reason, actual, predicted)
    per_class = rep.agg(F.sort_array(F.collect_list(F.struct(*rep.columns))).alias("per_class"))
    cm = metrics.confusion_matrix(reason, classes, actual, predicted)
    place = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(actual))
    line = F.struct(place.alias("place"), F.col(actual).alias("actual"),
                    F.array(*[F.col(f"`{c}`") for c in classes]).alias("counts"))
    matrix = cm.agg(F.transform(F.array_sort(F.collect_list(line)), lambda r: F.struct(
        r["actual"].alias("actual"), F.map_from_arrays(F.array(*[F.lit(c) for c in classes]), r["counts"]).alias("counts")))
        .alias("matrix"))
    both = profile.class_distribution(reason, actual, predicted)  # a row per class
    spread = both.agg(F.sort_array(F.collect_list(F.struct(*both.columns))).alias("distribution"))
    summ = metrics.multiclass_summary(reason, actual, predicted)
    delay_part = F.struct(_scalar(b).alias("b"), auc.select("roc_auc").scalar().alias("roc_auc"),
                          ap.select("average_precision").scalar().alias("average_precision"))
    flat = F.struct(*[delay_part.getField("b").getField(c).alias(c) for c in b.columns],
                    (delay_part.getField("b").getField("tp") + delay_part.getField("b").getField("fp"))
                    .alias("predicted_positives"),
                    delay_part.getField("b").getField("support_positive").alias("actual_positives"),
                    delay_part.getField("roc_auc").alias("roc_auc"),
                    delay_part.getField("average_precision").alias("average_precision"))
    spark = delay.sparkSession
    return spark.range(1).select(
        F.struct(*[F.lit(v).alias(k) for k, v in (facts or {"test_fraction": None}).items()]).alias("split"),
        flat.alias("delay"), _scalar(summ).alias("reason"),
        per_class.select("per_class").scalar().alias("per_class"),
        spread.select("distribution").scalar().alias("distribution"),
        matrix.select("matrix").scalar().alias("matrix"))
