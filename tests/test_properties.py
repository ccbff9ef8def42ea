"""Property tests: the skew-safe helpers equal their one-task definitions
for arbitrary skew, bucket granularity and ties."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from contrail.operators.ranking import exact_quantiles, running_totals

rows_strategy = st.lists(
    st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b", None]), st.integers(0, 30), st.integers(-5, 5)),
    min_size=1, max_size=120)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, n_buckets=st.sampled_from([1, 3, 8]))
def test_running_totals_equal_plain_window(spark, rows, n_buckets):
    data = [(i, g, o, v) for i, (g, o, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "id int, g string, o int, v int")
    bucket = F.floor(F.col("o") * n_buckets / 31).cast("int")  # monotone in o
    got = running_totals(df, ["g"], bucket, ["o", "id"], ["v"]).select("id", "rank", "cum_v")
    w = Window.partitionBy("g").orderBy("o", "id")
    ref = df.select("id", F.row_number().over(w).alias("rank"),
                    F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum_v"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ref.collect()))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, q=st.sampled_from([0.0, 0.5, 0.95, 1.0]))
def test_exact_quantile_equals_numpy(spark, rows, q):
    df = spark.createDataFrame([(g or "", o) for g, o, _ in rows], "g string, o int")
    got = {r.g: r.q for r in exact_quantiles(df, "o", [q], ["g"], ["q"]).collect()}
    groups = {}
    for g, o, _ in rows:
        groups.setdefault(g or "", []).append(o)
    for g, vals in groups.items():
        assert got[g] == pytest.approx(float(np.quantile(vals, q)), abs=1e-9)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from(["e1", "e1", "e2"]), st.sampled_from([5, 5, 5, 7, 9]),
                               st.integers(-100, 100)), min_size=1, max_size=80),
       text_ids=st.booleans())
def test_previous_in_order_equals_lag(spark, rows, text_ids):
    from contrail.operators.ranking import previous_in_order

    data = [(g, t, (f"r{i:04d}" if text_ids else i), v) for i, (g, t, v) in enumerate(rows)]
    schema = f"g string, t int, rid {'string' if text_ids else 'int'}, v int"
    df = spark.createDataFrame(data, schema)
    got = previous_in_order(df, ["g"], "t", "rid", ["v"]).select("rid", "prev_v")
    ref = df.select("rid", F.lag("v").over(Window.partitionBy("g").orderBy("t", "rid")).alias("prev_v"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ref.collect()))


def _split_brute(rows, fraction, seed):
    """Python reference: ceil(f*N) test rows; train sizes by largest
    remainder over classes (ties: smaller label, NULL first); smallest
    md5(seed:key) per class go to test."""
    import hashlib
    import math

    by = {}
    for k, c in rows:
        by.setdefault(c, []).append(k)
    n = len(rows)
    n_train = n - math.ceil(fraction * n)
    cont = {c: len(v) / n * n_train for c, v in by.items()}
    base = {c: math.floor(x) for c, x in cont.items()}
    need = n_train - sum(base.values())
    order = sorted(by, key=lambda c: (-(cont[c] - base[c]), c is not None, c or ""))
    for c in order[:need]:
        base[c] += 1
    out = {}
    for c, keys in by.items():
        ranked = sorted(keys, key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))
        n_test = len(keys) - base[c]
        for i, k in enumerate(ranked):
            out[k] = "test" if i < n_test else "train"
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(classes=st.lists(st.sampled_from(["a", "a", "a", "b", "c", None]), min_size=1, max_size=150),
       fraction=st.sampled_from([0.1, 0.2, 0.33]), seed=st.integers(0, 99))
def test_stratified_split_equals_brute_force(spark, classes, fraction, seed):
    from contrail.operators import sampling

    rows = [(f"k{i}", c) for i, c in enumerate(classes)]
    df = spark.createDataFrame(rows, "key string, cls string")
    got = {r.key: r.split for r in sampling.stratified_split(df, "cls", "key", fraction, seed).collect()}
    assert got == _split_brute(rows, fraction, seed)


def _relabel_brute(rows, seed):
    """Python reference of rule set v1 on (key, weather, visibility, airport, airline, prev, minutes)."""
    import hashlib
    import math

    def md5(s):
        return hashlib.md5(s.encode()).hexdigest()

    def bad_weather(r):
        w = r[1] or "unknown"
        return w in ("fog", "snow") or (w == "rain" and False)  # no precipitation column: fill 0

    preds = [("weather", lambda r: bad_weather(r) and (r[2] if r[2] is not None else 10) < 3, 0.70, 15, 45),
             ("congestion", lambda r: (r[3] or 0) > 0.92 and (r[4] or 0) > 0.85, 0.50, 15, 35),
             ("cascade", lambda r: (r[5] or 0) > 60, 0.60, 15, 35)]
    minutes = {r[0]: r[6] for r in rows}
    rule_of = {}
    for name, pred, share, lo, hi in preds:
        cand = [r[0] for r in rows if pred(r) and minutes[r[0]] < 15]
        cand.sort(key=lambda k: (md5(f"{seed}:{name}:{k}"), k))
        for k in cand[:math.floor(share * len(cand))]:
            minutes[k] = lo + int(md5(f"{seed}:{name}:{k}:minutes")[:15], 16) % (hi - lo)
            rule_of[k] = name
    return {k: (minutes[k], rule_of.get(k)) for k in minutes}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from(["fog", "snow", "clear", None]), st.sampled_from([None, 1.0, 5.0]),
                               st.sampled_from([0.5, 0.95]), st.sampled_from([None, 0.9]),
                               st.sampled_from([10.0, 70.0, None]), st.integers(0, 30)), min_size=1, max_size=120))
def test_relabel_equals_brute_force(spark, rows):
    from contrail.operators import sampling

    data = [(f"f{i}", *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "flight_id string, weather_origin string, visibility_origin_km double, "
                                     "airport_load_index double, airline_load_factor double, "
                                     "previous_flight_delay_min double, delay_minutes int") \
        .withColumn("is_significant_delay", (F.col("delay_minutes") >= 15).cast("int")) \
        .withColumn("delay_reason", F.when(F.col("delay_minutes") >= 15, "other").otherwise("none"))
    seed, rules = sampling.RULE_SETS["v1"]
    got = {r.flight_id: (r.delay_minutes, r.relabel_rule)
           for r in sampling.relabel(df, rules, "flight_id", seed).collect()}
    assert got == _relabel_brute(data, seed)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from([0.1, 0.2, 0.2, 0.5, 0.7, 0.9]), st.sampled_from([0, 1])),
                     min_size=2, max_size=100))
def test_average_precision_equals_step_sum(spark, rows):
    from contrail.operators import metrics

    pos_total = sum(y for _, y in rows)
    df = spark.createDataFrame(rows, "p double, y int")
    got = metrics.average_precision(df, digits=None).first()[0]
    if pos_total == 0:
        assert got is None
        return
    ap, cp, cn = 0.0, 0, 0
    for t in sorted({p for p, _ in rows}, reverse=True):
        pos = sum(1 for p, y in rows if p == t and y == 1)
        cp += pos
        cn += sum(1 for p, y in rows if p == t and y == 0)
        ap += pos / pos_total * (cp / (cp + cn))
    assert got == pytest.approx(ap, abs=1e-12)
