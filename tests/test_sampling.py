"""Ranking helper, exact quantiles, split and relabel properties."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from contrail.functions.hashing import hex60, seeded_md5
from contrail.operators import sampling
from contrail.operators.ranking import exact_quantiles, hash_buckets, in_ranges, previous_in_order, running_totals


@pytest.fixture(scope="module")
def skewed(spark):
    """One class holds ~90 % of rows (a hot key)."""
    rnd = random.Random(11)
    rows = [(f"k{i}", "hot" if rnd.random() < 0.9 else rnd.choice(["a", "b"]), rnd.randint(0, 40))
            for i in range(4000)]
    return spark.createDataFrame(rows, "key string, cls string, v int").cache()


def test_running_totals_equals_window(skewed):
    h = seeded_md5(1, "key")
    got = running_totals(skewed.withColumn("_h", h), ["cls"], hash_buckets(F.col("_h"), bits=4),
                         [hex60(F.col("_h")), F.col("_h"), F.col("key")], ["v"])
    w = Window.partitionBy("cls").orderBy("_h", "key")
    ref = skewed.withColumn("_h", h).select(
        "key", F.row_number().over(w).alias("r"),
        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("c"))
    a = sorted((r.key, r["rank"], r.cum_v) for r in got.collect())
    b = sorted((r.key, r.r, r.c) for r in ref.collect())
    assert a == b


def test_ranges_are_monotone_and_split_text_with_a_long_prefix(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        ids = spark.range(100_000).select(F.format_string("run-2025-experiment-%06d", "id").alias("t"))
        ranges = in_ranges(ids, ["t"]).groupBy("_bkt").agg(F.min("t").alias("lo"), F.max("t").alias("hi"),
                                                          F.count("*").alias("n")).orderBy("_bkt").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(ranges) >= 35 and max(r.n for r in ranges) < 10_000
    assert all(a.hi < b.lo for a, b in zip(ranges, ranges[1:]))


def test_previous_in_order_equals_lag(spark):
    rnd = random.Random(3)
    rows = [("hot" if rnd.random() < 0.8 else rnd.choice(["a", None]), rnd.choice([5, rnd.randint(0, 9)]), f"run-{i:05d}", i)
            for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, t int, id string, v int")
    got = previous_in_order(df, ["g"], "t", "id", ["v"]).collect()
    want = df.withColumn("p", F.lag("v").over(Window.partitionBy("g").orderBy("t", "id"))).collect()
    assert sorted((r.v, r.prev_v) for r in got) == sorted((r.v, r.p) for r in want)


@pytest.mark.parametrize("identical", [True, False])
def test_relabel_with_repeated_keys_takes_the_exact_share(spark, identical):
    """200 rows, 100 keys twice each: 200 rows come back, 120 of them relabelled."""
    rows = [(f"f{i // 2}", 100.0, 3 if identical else 3 + i % 2, 0, "none") for i in range(200)]
    df = spark.createDataFrame(rows, "flight_id string, previous_flight_delay_min double, delay_minutes int, "
                                     "is_significant_delay int, delay_reason string")
    seed, rules = sampling.RULE_SETS["v1"]
    out = sampling.relabel(df, rules, "flight_id", seed)
    assert out.count() == 200 and out.filter("relabel_rule = 'cascade'").count() == 120
    odd = sampling.relabel(df.limit(199), rules, "flight_id", seed)
    assert odd.count() == 199 and odd.filter("relabel_rule is not null").count() == 119
    assert sampling.relabel(df.limit(0), rules, "flight_id", seed).count() == 0


def test_exact_quantiles_match_numpy(skewed):
    got = {r.cls: (r.q50, r.q95) for r in exact_quantiles(skewed, "v", [0.5, 0.95], ["cls"]).collect()}
    data = {}
    for r in skewed.collect():
        data.setdefault(r.cls, []).append(r.v)
    for c, vals in data.items():
        assert got[c][0] == pytest.approx(np.quantile(vals, 0.5), abs=1e-12)
        assert got[c][1] == pytest.approx(np.quantile(vals, 0.95), abs=1e-12)
    whole = exact_quantiles(skewed, "v", [0.5]).first()
    assert whole.q50 == pytest.approx(np.quantile([r.v for r in skewed.collect()], 0.5))


def test_split_exact_disjoint_deterministic(spark, skewed):
    s1 = sampling.stratified_split(skewed, "cls", "key", 0.2, 42)
    s2 = sampling.stratified_split(skewed.repartition(7), "cls", "key", 0.2, 42)
    a = {r.key: r.split for r in s1.collect()}
    b = {r.key: r.split for r in s2.collect()}
    assert a == b and len(a) == skewed.count()  # complete, disjoint, reproducible (T2)
    n = len(a)
    assert sum(1 for v in a.values() if v == "test") == math.ceil(0.2 * n)
    counts = {r.cls: r["count"] for r in skewed.groupBy("cls").count().collect()}
    test_by = {}
    for r in s1.collect():
        test_by[r.cls] = test_by.get(r.cls, 0) + (r.split == "test")
    for c, k in counts.items():
        assert abs(test_by[c] - 0.2 * k) <= 1


def test_balanced_weights(spark, skewed):
    w = {r.cls: r.weight for r in sampling.balanced_weights(skewed, "cls").select("cls", "weight").distinct().collect()}
    counts = {r.cls: r["count"] for r in skewed.groupBy("cls").count().collect()}
    n = sum(counts.values())
    for c, k in counts.items():
        assert w[c] == pytest.approx(n / (len(counts) * k))


def test_relabel_touches_only_candidates_exact_share(spark):
    rnd = random.Random(2)
    rows = [(f"f{i}", rnd.choice(["fog", "rain", "clear", None]), rnd.choice([None, 1.0, 2.5, 8.0]),
             rnd.randint(0, 30), 0, "none") for i in range(3000)]
    df = spark.createDataFrame(rows, "flight_id string, weather_origin string, visibility_origin_km double, "
                                     "delay_minutes int, is_significant_delay int, delay_reason string")
    seed, rules = sampling.RULE_SETS["v1"]
    out = sampling.relabel(df, rules[:1], "flight_id", seed).collect()
    before = {r[0]: r for r in rows}
    cands = [k for k, r in before.items() if r[1] == "fog" and r[2] is not None and r[2] < 3 and r[3] < 15]
    changed = [r for r in out if r.relabel_rule is not None]
    assert len(changed) == math.floor(0.7 * len(cands))
    for r in changed:
        assert r.flight_id in cands and 15 <= r.delay_minutes < 45
        assert r.is_significant_delay == 1 and r.delay_reason == "weather"
    again = sampling.relabel(df.repartition(5), rules[:1], "flight_id", seed).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, again))


def test_relabel_by_the_third_rule(spark):
    df = spark.createDataFrame([(f"f{i}", 100.0, 3, 0, "none") for i in range(50)],
                               "flight_id string, previous_flight_delay_min double, delay_minutes int, "
                               "is_significant_delay int, delay_reason string")
    seed, rules = sampling.RULE_SETS["v1"]
    out = sampling.relabel(df, rules, "flight_id", seed)
    assert out.filter("relabel_rule = 'cascade'").count() == 30


def test_running_totals_null_group_kept(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 5)], "g string, v int")
    got = sorted(((r.g or ""), r.v, r["rank"]) for r in running_totals(df, ["g"], F.lit(0), ["v"]).collect())
    assert got == [("", 1, 1), ("", 2, 2), ("a", 5, 1)]
    split = sampling.stratified_split(df.withColumn("k", F.col("v").cast("string")), "g", "k", 0.5, 1).collect()
    assert len(split) == 3


def test_large_cut_buckets_are_ranked_in_ranges_alike(spark, skewed, monkeypatch):
    """One key in a third of all rows puts them into one bucket; either way of ranking it takes the same rows."""
    rows = [("hot" if i % 3 == 0 else f"f{i}", 100.0, i % 14, 0, "none") for i in range(900)] + [(None, 100.0, 3, 0, "none")] * 3
    df = spark.createDataFrame(rows, "flight_id string, previous_flight_delay_min double, delay_minutes int, "
                                     "is_significant_delay int, delay_reason string")
    seed, rules = sampling.RULE_SETS["v1"]

    def outcome():
        relabelled = sampling.relabel(df, rules, "flight_id", seed, tie=["delay_minutes"]).collect()
        split = sampling.stratified_split(skewed, "cls", "key", 0.2, 42).collect()
        return sorted(map(repr, relabelled)), sorted(map(repr, split))

    small = outcome()
    monkeypatch.setattr(sampling, "CUT_ROWS", 0)
    assert outcome() == small
    assert sum("cascade" in r for r in small[0]) == math.floor(0.6 * 903)
