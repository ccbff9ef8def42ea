"""Evaluation metrics: golden counts from the published reports, textbook
cases and properties (E1-E9)."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from contrail.operators import metrics
from contrail.operators.report import prediction_summary

# --- fixed values: published confusion counts (binary and 7 x 7) ------------
BINARY = {"tn": 13959, "fp": 1214, "fn": 2637, "tp": 6190}
REASONS = ["airline_operations", "airport_congestion", "late_aircraft", "other", "security_or_border_control",
           "technical", "weather"]
MATRIX = [[162, 159, 126, 14, 23, 60, 183], [158, 739, 139, 30, 13, 79, 236], [138, 185, 913, 19, 24, 48, 186],
          [36, 65, 51, 3, 4, 19, 68], [46, 56, 34, 7, 6, 23, 74], [62, 78, 69, 13, 13, 139, 127],
          [170, 194, 151, 22, 21, 105, 3538]]


def _expand(spark, counts, schema):
    df = spark.createDataFrame(counts, schema + ", n int")
    return df.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("n")))).drop("_i", "n")


def test_binary_golden(spark):
    rows = [(0, 0, BINARY["tn"]), (0, 1, BINARY["fp"]), (1, 0, BINARY["fn"]), (1, 1, BINARY["tp"])]
    df = _expand(spark, rows, "y int, y_pred int")
    r = metrics.binary_metrics(df).first()
    assert (r.tn, r.fp, r.fn, r.tp) == (13959, 1214, 2637, 6190)
    assert round(r.precision, 4) == 0.836 and round(r.recall, 4) == 0.7013
    assert round(r.f1, 4) == 0.7627 and round(r.accuracy, 4) == 0.8395


@pytest.fixture(scope="module")
def reason_rows(spark):
    rows = [(a, p, MATRIX[i][j]) for i, a in enumerate(REASONS) for j, p in enumerate(REASONS) if MATRIX[i][j]]
    return _expand(spark, rows, "actual string, predicted string").cache()


def test_multiclass_golden(reason_rows):
    s = metrics.multiclass_summary(reason_rows).first()
    assert round(s.macro_f1, 3) == 0.357 and round(s.weighted_f1, 4) == 0.6122
    assert round(s.accuracy, 3) == 0.623 and s.support_total == 8828
    rep = {r["class"]: r for r in metrics.class_report(reason_rows).collect()}
    assert round(rep["weather"].f1, 4) == 0.8215 and rep["weather"].support == 4201
    assert round(rep["other"].precision, 4) == 0.0278


def test_confusion_matrix_order_and_zero_rows(reason_rows, spark):
    cm = metrics.confusion_matrix(reason_rows, REASONS + ["none"])
    got = {r.actual: [r[c] for c in REASONS + ["none"]] for r in cm.collect()}
    for i, a in enumerate(REASONS):
        assert got[a] == MATRIX[i] + [0]
    assert got["none"] == [0] * 8
    total = sum(sum(v) for v in got.values())
    assert total == 8828


def test_class_distribution_counts(reason_rows):
    from contrail.operators.profile import class_distribution

    d = {r["class"]: (r.actual_count, r.predicted_count) for r in class_distribution(reason_rows).collect()}
    assert d["weather"] == (4201, 4412) and d["security_or_border_control"] == (246, 104)


def test_average_precision_is_step_sum_not_trapezoid(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1)], "p double, y int")
    assert metrics.average_precision(df).first()[0] == pytest.approx(0.8333333333, abs=1e-9)
    assert metrics.roc_auc(df).first()[0] == pytest.approx(0.75)


def test_auc_ties_and_symmetry(spark):
    rnd = random.Random(3)
    rows = [(round(rnd.random(), 2), int(rnd.random() < 0.4)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "p double, y int")
    a = metrics.roc_auc(df).first()[0]
    b = metrics.roc_auc(df.withColumn("p", -F.col("p"))).first()[0]
    assert a + b == pytest.approx(1.0, abs=1e-12)
    # brute force over all pairs
    pos = np.array([p for p, y in rows if y == 1])
    neg = np.array([p for p, y in rows if y == 0])
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    assert a == pytest.approx(wins / (len(pos) * len(neg)), abs=1e-12)


def test_threshold_sweep_matches_brute_force_and_lowest_tie(spark):
    rnd = random.Random(5)
    rows = [(round(rnd.random(), 3), int(rnd.random() < 0.5)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "p double, y int")
    sweep = {r.step: r for r in metrics.threshold_sweep(df).collect()}
    grid = np.arange(0.1, 0.9 + 0.005, 0.01)
    assert len(sweep) == len(grid) == 81
    for i, t in enumerate(grid):
        tp = sum(1 for p, y in rows if y == 1 and p >= t)
        fp = sum(1 for p, y in rows if y == 0 and p >= t)
        assert sweep[i].threshold == t and (sweep[i].tp, sweep[i].fp) == (tp, fp)
    best = metrics.best_threshold(metrics.threshold_sweep(df)).first()
    top = max(r.f1 for r in sweep.values())
    assert best.best_f1 == top
    assert best.best_threshold == min(r.threshold for r in sweep.values() if r.f1 == top)


def test_zero_division_gives_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, y_pred int")
    r = metrics.binary_metrics(df).first()
    assert r.precision == 0.0 and r.recall == 0.0 and r.f1 == 0.0 and r.accuracy == 1.0


def test_prediction_summary_row(spark, reason_rows):
    delay = spark.createDataFrame([(0.9, 1, 1), (0.2, 0, 0), (0.6, 0, 1)], "p double, y int, y_pred int")
    row = prediction_summary(delay, reason_rows, REASONS).first()
    assert row.delay.tp == 1 and row.delay.fp == 1 and row.reason.support_total == 8828
    assert len(row.per_class) == 7 and len(row.matrix) == 7
