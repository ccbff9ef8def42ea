"""Queries: split, weights, relabelling, evaluation, model-input tables (T, A, E, M, P4, P6, P7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from contrail.operators import encoding, features, metrics, sampling
from contrail.plans.oracle_views import with_views
from contrail.session import cut_lineage, release
from contrail.plans.registry import query
from contrail.sources import fixtures as fx

THRESHOLD = 0.52
PRIORITY_CLASSES = fx.PRIORITIES


def _dbl(x) -> str:
    return f"CAST({x!r} AS DOUBLE)"


# ---------------------------------------------------------------- T1, T3 ---
_SPLIT_SQL = """
cc AS (SELECT is_significant_delay AS cls, count(*) AS n_c FROM trips GROUP BY 1),
cc2 AS (SELECT cls, n_c, sum(n_c) OVER () AS big_n FROM cc),
cc3 AS (SELECT *, big_n - CAST(ceil(CAST(0.2 AS DOUBLE) * big_n) AS BIGINT) AS n_train FROM cc2),
cc4 AS (SELECT *, CAST(n_c AS DOUBLE) / big_n * n_train AS cont FROM cc3),
cc5 AS (SELECT *, floor(cont) AS base, cont - floor(cont) AS frac FROM cc4),
cc6 AS (SELECT *, n_train - sum(base) OVER () AS need,
          row_number() OVER (ORDER BY frac DESC, cls NULLS FIRST) AS rr FROM cc5),
alloc AS (SELECT cls, n_c - CAST(base + CASE WHEN rr <= need THEN 1 ELSE 0 END AS BIGINT) AS test_c FROM cc6),
ranked AS (SELECT t.*, row_number() OVER (PARTITION BY is_significant_delay
             ORDER BY md5('42:' || flight_id), flight_id) AS rk FROM trips t),
split AS (SELECT ranked.*, CASE WHEN rk <= test_c THEN 'test' ELSE 'train' END AS split
          FROM ranked JOIN alloc ON ranked.is_significant_delay = alloc.cls)
"""


@query("stratified_split", ("T1", "T2"), sql=with_views("trips") + "," + _SPLIT_SQL + """
SELECT flight_id, is_significant_delay, split FROM split""")
def stratified_split(spark, d):
    t = fx.trips_written(spark, d, ["flight_id", "is_significant_delay"])
    return sampling.stratified_split(t, "is_significant_delay", "flight_id", 0.2, 42) \
        .select("flight_id", "is_significant_delay", "split")


@query("class_weights", ("T3",), sql=with_views("trips") + """,
cc AS (SELECT is_significant_delay AS cls, count(*) AS n_c FROM trips GROUP BY 1),
w AS (SELECT cls, sum(n_c) OVER () / (count(*) OVER () * n_c) AS weight FROM cc)
SELECT flight_id, is_significant_delay, weight FROM trips t LEFT JOIN w ON t.is_significant_delay = w.cls""")
def class_weights(spark, d):
    return sampling.balanced_weights(fx.trips_written(spark, d, ["flight_id", "is_significant_delay"]),
                                     "is_significant_delay") \
        .select("flight_id", "is_significant_delay", "weight")


# -------------------------------------------------------------------- A1 ---
def _relabel_sql(seed: int, rules: list[tuple[str, str, float, int, int, str]], view: str = "trips",
                 tie: str = "") -> str:
    ctes = [f"r0 AS (SELECT *, CAST(NULL AS VARCHAR) AS relabel_rule FROM {view})"]
    for i, (name, pred, share, lo, hi, reason) in enumerate(rules, 1):
        h = f"md5('{seed}:{name}:' || flight_id)"
        draw = (f"CAST({lo} + (('0x' || substr(md5('{seed}:{name}:' || flight_id || ':minutes'), 1, 15))::BIGINT"
                f" % {hi - lo}) AS INTEGER)")
        chosen = f"(_cand AND _rk <= floor({_dbl(share)} * _n))"
        ctes.append(f"c{i} AS (SELECT *, coalesce(({pred}) AND delay_minutes < 15, false) AS _cand, {h} AS _h "
                    f"FROM r{i - 1})")
        ctes.append(f"k{i} AS (SELECT *, row_number() OVER (PARTITION BY _cand ORDER BY _h, flight_id{tie}) AS _rk, "
                    f"count(*) FILTER (WHERE _cand) OVER () AS _n FROM c{i})")
        ctes.append(
            f"r{i} AS (SELECT * EXCLUDE (_cand, _h, _rk, _n) REPLACE ("
            f"CASE WHEN {chosen} THEN {draw} ELSE delay_minutes END AS delay_minutes, "
            f"CAST(CASE WHEN {chosen} THEN 1 ELSE is_significant_delay END AS INTEGER) AS is_significant_delay, "
            f"CASE WHEN {chosen} THEN '{reason}' ELSE delay_reason END AS delay_reason, "
            f"CASE WHEN {chosen} THEN '{name}' ELSE relabel_rule END AS relabel_rule) FROM k{i})")
    last = f"r{len(rules)}"
    return (with_views(view) + ", " + ",\n".join(ctes) +
            f"\nSELECT flight_id, delay_minutes, is_significant_delay, delay_reason, relabel_rule FROM {last}")


_BAD_WEATHER_SQL = ("(coalesce(weather_origin, 'unknown') IN ('fog', 'snow') OR (coalesce(weather_origin, 'unknown')"
                    " = 'rain' AND coalesce(precipitation_origin_mm, 0) > CAST(5 AS DOUBLE)))")
_V1_SQL_RULES = [
    ("weather", _BAD_WEATHER_SQL + " AND coalesce(visibility_origin_km, 10) < CAST(3 AS DOUBLE)", 0.70, 15, 45,
     "weather"),
    ("congestion", "coalesce(airport_load_index, 0) > CAST(0.92 AS DOUBLE) AND coalesce(airline_load_factor, 0) > "
     "CAST(0.85 AS DOUBLE)", 0.50, 15, 35, "airport_congestion"),
    ("cascade", "coalesce(previous_flight_delay_min, 0) > CAST(60 AS DOUBLE)", 0.60, 15, 35, "late_aircraft"),
]
_LOW_VIS_SQL = " AND coalesce(visibility_origin_km, 10) < CAST(3 AS DOUBLE)"
_LOAD_SQL = ("coalesce(airport_load_index, 0) > CAST(0.92 AS DOUBLE) AND coalesce(airline_load_factor, 0) > "
             "CAST(0.85 AS DOUBLE)")
_CASCADE_SQL = "coalesce(previous_flight_delay_min, 0) > CAST(60 AS DOUBLE)"
_V2_SQL_RULES = [
    ("weather", _BAD_WEATHER_SQL + _LOW_VIS_SQL, 0.85, 15, 50, "weather"),
    ("congestion", _LOAD_SQL, 0.70, 15, 40, "airport_congestion"),
    ("cascade", _CASCADE_SQL, 0.80, 15, 40, "late_aircraft"),
]
_V3_SQL_RULES = [
    ("weather", _BAD_WEATHER_SQL + _LOW_VIS_SQL, 0.85, 15, 50, "weather"),
    ("congestion", _LOAD_SQL, 0.80, 15, 40, "airport_congestion"),
    ("cascade", _CASCADE_SQL, 0.85, 15, 40, "late_aircraft"),
]
_V4_SQL_RULES = [
    ("weather", _BAD_WEATHER_SQL, 0.65, 15, 45, "weather"),
    ("technical", "coalesce(technical_check_required, 0) = 1 AND weather_origin IN ('fog', 'snow', 'rain')", 0.70,
     15, 35, "technical"),
    ("crew", "coalesce(crew_change_required, 0) = 1 AND (departure_hour < 6 OR departure_hour > 22)", 0.65, 15, 35,
     "airline_operations"),
]


RELABEL_COLS = ["flight_id", "delay_minutes", "is_significant_delay", "delay_reason", "weather_origin",
                "precipitation_origin_mm", "visibility_origin_km", "airport_load_index", "airline_load_factor",
                "previous_flight_delay_min", "technical_check_required", "crew_change_required", "departure_hour"]


def _relabel_input(spark, d):
    # read for each cut and for the output: written once, pruned to the used columns
    return fx.trips_written(spark, d, RELABEL_COLS)


@query("relabel_rules", ("A1",), sql=_relabel_sql(42, _V1_SQL_RULES))
def relabel_rules(spark, d):
    seed, rules = sampling.RULE_SETS["v1"]
    return sampling.relabel(_relabel_input(spark, d), rules, "flight_id", seed) \
        .select("flight_id", "delay_minutes", "is_significant_delay", "delay_reason", "relabel_rule")


@query("relabel_rules_v2", ("A1",), sql=_relabel_sql(7, _V2_SQL_RULES))
def relabel_rules_v2(spark, d):
    seed, rules = sampling.RULE_SETS["v2"]
    return sampling.relabel(_relabel_input(spark, d), rules, "flight_id", seed) \
        .select("flight_id", "delay_minutes", "is_significant_delay", "delay_reason", "relabel_rule")


@query("relabel_rules_v3", ("A1",), sql=_relabel_sql(13, _V3_SQL_RULES))
def relabel_rules_v3(spark, d):
    seed, rules = sampling.RULE_SETS["v3"]
    return sampling.relabel(_relabel_input(spark, d), rules, "flight_id", seed) \
        .select("flight_id", "delay_minutes", "is_significant_delay", "delay_reason", "relabel_rule")


@query("relabel_rules_v4", ("A1",), sql=_relabel_sql(19, _V4_SQL_RULES))
def relabel_rules_v4(spark, d):
    seed, rules = sampling.RULE_SETS["v4"]
    return sampling.relabel(_relabel_input(spark, d), rules, "flight_id", seed) \
        .select("flight_id", "delay_minutes", "is_significant_delay", "delay_reason", "relabel_rule")


@query("relabel_raw", ("A1",), sql=_relabel_sql(42, _V1_SQL_RULES, "trips_raw", "".join(
    f", {c} NULLS FIRST" for c in fx.DEDUP_ORDER)))
def relabel_raw(spark, d):
    """The v1 rules on the raw file, whose keys repeat."""
    seed, rules = sampling.RULE_SETS["v1"]
    raw = cut_lineage(fx.trips_raw(spark, d, list(dict.fromkeys([*RELABEL_COLS, *fx.DEDUP_ORDER]))))
    return sampling.relabel(raw, rules, "flight_id", seed, tie=fx.DEDUP_ORDER) \
        .select("flight_id", "delay_minutes", "is_significant_delay", "delay_reason", "relabel_rule")


# ------------------------------------------------------------- P4, P6, P7 ---
@query("reason_subset", ("P4",), sql=with_views("trips") + """
SELECT flight_id, coalesce(delay_reason, 'nan') AS delay_reason FROM trips
WHERE is_significant_delay = 1 AND (delay_reason IS NULL OR delay_reason <> 'none')""")
def reason_subset(spark, d):
    return features.reason_subset(fx.trips(spark, d, ["flight_id", "is_significant_delay", "delay_reason"])).select("flight_id", "delay_reason")


@query("threshold_decision", ("P6",), sql=with_views("scores") + f"""
SELECT l_orderkey, l_linenumber, p, CAST(p >= {_dbl(THRESHOLD)} AS INTEGER) AS y_pred FROM scores""")
def threshold_decision(spark, d):
    s = fx.scores(spark, d)
    return s.select("l_orderkey", "l_linenumber", "p", features.decide("p", THRESHOLD).alias("y_pred"))


@query("prediction_report", ("P7",), sql=with_views("scores") + f"""
SELECT l_orderkey, l_linenumber, y AS y_true, CAST(p >= {_dbl(THRESHOLD)} AS INTEGER) AS y_pred,
  CAST((CAST(p >= {_dbl(THRESHOLD)} AS INTEGER)) = y AS INTEGER) AS correct, round_even(p, 4) AS probability
FROM scores""")
def prediction_report(spark, d):
    return features.prediction_report(fx.scores(spark, d), ["l_orderkey", "l_linenumber"], "y", "p", THRESHOLD)


# ------------------------------------------------------------------ E1-E8 ---
def _scored(spark, d):
    s = fx.scores(spark, d)
    return s.withColumn("y_pred", features.decide("p", THRESHOLD))


_CONF_SQL = f"""
SELECT count(*) FILTER (WHERE y = 0 AND p < {_dbl(THRESHOLD)}) AS tn,
  count(*) FILTER (WHERE y = 0 AND p >= {_dbl(THRESHOLD)}) AS fp,
  count(*) FILTER (WHERE y = 1 AND p < {_dbl(THRESHOLD)}) AS fn,
  count(*) FILTER (WHERE y = 1 AND p >= {_dbl(THRESHOLD)}) AS tp
FROM scores"""


@query("confusion_binary", ("E1",), sql=with_views("scores") + _CONF_SQL)
def confusion_binary(spark, d):
    return metrics.confusion_binary(_scored(spark, d))


@query("binary_metrics", ("E2",), sql=with_views("scores") + f", c AS ({_CONF_SQL})" + """
SELECT tn, fp, fn, tp,
  CASE WHEN tp + fp = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
  CASE WHEN tp + fn = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall,
  CASE WHEN 2 * tp + fp + fn = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END AS f1,
  CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) AS accuracy,
  tp + fn AS support_positive, tp + tn + fp + fn AS support_total
FROM c""")
def binary_metrics(spark, d):
    return metrics.binary_metrics(_scored(spark, d))


_SCORE_TABLE_SQL = """st AS (SELECT p, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y <> 1) AS neg
  FROM scores WHERE p IS NOT NULL GROUP BY p)"""


@query("roc_auc", ("E3",), sql=with_views("scores") + ", " + _SCORE_TABLE_SQL + """,
r AS (SELECT *, sum(pos) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos FROM st)
SELECT round(CAST(1 AS DOUBLE) - sum(CAST(neg AS DOUBLE) * (2 * cum_pos - pos))
  / (CAST(2 AS DOUBLE) * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)), 12) AS roc_auc FROM r""")
def roc_auc(spark, d):
    return metrics.roc_auc(fx.scores(spark, d))


@query("average_precision", ("E4",), sql=with_views("scores") + ", " + _SCORE_TABLE_SQL + """,
r AS (SELECT *, sum(pos) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cp,
        sum(neg) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn FROM st)
SELECT round(sum(pos * (CAST(cp AS DOUBLE) / (cp + cn))) / sum(pos), 12) AS average_precision FROM r""")
def average_precision(spark, d):
    return metrics.average_precision(fx.scores(spark, d))


_SWEEP_SQL = """
g AS (SELECT CAST(i AS INTEGER) AS i,
        CAST(0.1 AS DOUBLE) + i * ((CAST(0.1 AS DOUBLE) + CAST(0.01 AS DOUBLE)) - CAST(0.1 AS DOUBLE)) AS t
      FROM range(81) r(i)),
c AS (SELECT g.i, g.t, count(*) FILTER (WHERE s.y = 1 AND s.p >= g.t) AS tp,
        count(*) FILTER (WHERE s.y <> 1 AND s.p >= g.t) AS fp, count(*) FILTER (WHERE s.y = 1) AS pp
      FROM g, scores s WHERE s.p IS NOT NULL GROUP BY g.i, g.t),
sweep AS (SELECT i AS step, t AS threshold, tp, fp, pp - tp AS fn,
  CASE WHEN tp + fp = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
  CASE WHEN pp = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(tp AS DOUBLE) / pp END AS recall,
  CASE WHEN 2 * tp + fp + (pp - tp) = 0 THEN CAST(0 AS DOUBLE)
       ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + (pp - tp)) END AS f1
  FROM c)
"""


@query("threshold_sweep", ("E5",), sql=with_views("scores") + "," + _SWEEP_SQL + "SELECT * FROM sweep")
def threshold_sweep(spark, d):
    return metrics.threshold_sweep(fx.scores(spark, d))


@query("best_threshold", ("E5",), sql=with_views("scores") + "," + _SWEEP_SQL + """
SELECT threshold AS best_threshold, f1 AS best_f1, step FROM sweep ORDER BY f1 DESC, threshold ASC LIMIT 1""")
def best_threshold(spark, d):
    return metrics.best_threshold(metrics.threshold_sweep(fx.scores(spark, d)))


_CLASS_COUNTS_SQL = """
a AS (SELECT actual AS class, count(*) AS support, count(*) FILTER (WHERE actual = predicted) AS hits
      FROM class_preds WHERE actual IS NOT NULL GROUP BY 1),
pr AS (SELECT predicted AS class, count(*) AS n_pred FROM class_preds WHERE predicted IS NOT NULL GROUP BY 1),
cc AS (SELECT coalesce(a.class, pr.class) AS class, coalesce(support, 0) AS support, coalesce(n_pred, 0) AS n_pred,
         coalesce(hits, 0) AS hits FROM a FULL OUTER JOIN pr ON a.class = pr.class),
rep AS (SELECT class, support, hits,
  CASE WHEN n_pred = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(hits AS DOUBLE) / n_pred END AS precision,
  CASE WHEN support = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(hits AS DOUBLE) / support END AS recall,
  CASE WHEN support + n_pred = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(2 * hits AS DOUBLE) / (support + n_pred) END AS f1
  FROM cc)
"""


@query("class_report", ("E6",), sql=with_views("class_preds") + "," + _CLASS_COUNTS_SQL + """
SELECT class, precision, recall, f1, support FROM rep""")
def class_report(spark, d):
    return metrics.class_report(fx.class_preds(spark, d))


@query("multiclass_summary", ("E7",), sql=with_views("class_preds") + "," + _CLASS_COUNTS_SQL + """
SELECT round(avg(f1), 12) AS macro_f1, round(sum(f1 * support) / sum(support), 12) AS weighted_f1,
  round(sum(hits) / sum(support), 12) AS accuracy, CAST(sum(support) AS BIGINT) AS support_total FROM rep""")
def multiclass_summary(spark, d):
    return metrics.multiclass_summary(fx.class_preds(spark, d))


@query("confusion_matrix", ("E8",), sql=with_views("class_preds") + """,
labels AS (SELECT * FROM (VALUES ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'), ('5-LOW')) v(actual))
SELECT labels.actual, """ + ", ".join(
    f"count(cp.actual) FILTER (WHERE cp.predicted = '{c}') AS \"{c}\"" for c in PRIORITY_CLASSES) + """
FROM labels LEFT JOIN class_preds cp ON labels.actual = cp.actual GROUP BY labels.actual""")
def confusion_matrix(spark, d):
    return metrics.confusion_matrix(fx.class_preds(spark, d), PRIORITY_CLASSES)


# --------------------------------------------------------- M1, M3, M10, M11 ---
IMPUTE_COLS = ["precipitation_origin_mm", "airline_load_factor", "visibility_origin_km",
               "previous_flight_delay_min"]
ENCODE_COLS = ["airline_code", "route", "weather_origin"]
_FIT_FILTER = "year(l_shipdate) % 2 = 0"


@query("impute_median", ("M1",), sql=with_views("trips") + """,
med AS (SELECT """ + ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in IMPUTE_COLS)
       + f" FROM trips WHERE {_FIT_FILTER})\nSELECT flight_id, "
       + ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in IMPUTE_COLS) + " FROM trips, med")
def impute_median(spark, d):
    t = fx.trips_written(spark, d, ["flight_id", "l_shipdate", *IMPUTE_COLS])
    fit = t.filter(F.pmod(F.year("l_shipdate"), F.lit(2)) == 0)
    meds = encoding.fit_medians(fit, IMPUTE_COLS)
    return encoding.impute_median(t, meds).select("flight_id", *IMPUTE_COLS)


@query("ordinal_encode", ("M2", "M3"), sql=with_views("trips") + ", fit AS (SELECT * FROM trips WHERE "
       + _FIT_FILTER + "),\n" + ",\n".join(
           f"d_{c} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM "
           f"(SELECT DISTINCT coalesce({c}, 'unknown') AS v FROM fit) x)" for c in ENCODE_COLS)
       + "\nSELECT t.flight_id, " + ", ".join(f"coalesce(d_{c}.code, -1) AS {c}_code" for c in ENCODE_COLS)
       + " FROM trips t " + " ".join(
           f"LEFT JOIN d_{c} ON coalesce(t.{c}, 'unknown') = d_{c}.v" for c in ENCODE_COLS))
def ordinal_encode(spark, d):
    t = fx.trips_written(spark, d, ["flight_id", "l_shipdate", *ENCODE_COLS])
    fit = t.filter(F.pmod(F.year("l_shipdate"), F.lit(2)) == 0)
    dictionary = encoding.fit_ordinal(fit, ENCODE_COLS)
    return encoding.apply_ordinal(t, dictionary, ENCODE_COLS).select(
        "flight_id", *[f"{c}_code" for c in ENCODE_COLS])


@query("argmax_class", ("M10",), sql=with_views("class_proba") + """
SELECT l_orderkey, l_linenumber,
  ['discount', 'tax', 'volume'][list_position(proba, list_max(proba))] AS predicted_class,
  list_max(proba) AS class_probability
FROM class_proba""")
def argmax_class(spark, d):
    return encoding.argmax_class(fx.class_proba(spark, d), "proba", fx.PROBA_CLASSES) \
        .select("l_orderkey", "l_linenumber", "predicted_class", "class_probability")


_REQ = ["scheduled_departure_local", "airline_code", "origin_airport", "destination_airport", "aircraft_type",
        "distance_km", "planned_duration_min"]


@query("validate_requests", ("M11",), sql=with_views("score_requests") + """
SELECT flight_id, (""" + " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in _REQ) + """) = 0 AS is_valid,
  coalesce(""" + ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in _REQ) + """) AS first_missing,
  CAST(""" + " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in _REQ) + """ AS INTEGER) AS n_missing,
  CAST(coalesce(technical_check_required, 0) AS INTEGER) AS technical_check_required,
  CAST(coalesce(crew_change_required, 0) AS INTEGER) AS crew_change_required
FROM score_requests""")
def validate_requests(spark, d):
    return encoding.validate_requests(fx.score_requests(spark, d)).select(
        "flight_id", "is_valid", "first_missing", "n_missing", "technical_check_required", "crew_change_required")


# ------------------------------------------------------------------ M4-M8 ---
#: Trees and depth of the registered scoring query.  The reference fits 600 trees of
#: depth 8 (``learn.DELAY_PARAMS``, the jobs' default); rows are not limited.
SCORING_PARAMS = {"n_estimators": 10, "max_depth": 5, "min_child_samples": 20, "seed": 42}


def scored_test_rows(spark, d, params):
    """Fit the input pipeline and both models on the train split of the v1
    relabelled flights, then score the test split.  The prepared rows and the
    split are written once, with the used columns, and read by every fit; each table goes when the next one is written."""
    from contrail.operators import learn

    seed, rules = sampling.RULE_SETS["v1"]
    spec = learn.FeatureSpec()
    trips = fx.trips_written(spark, d)
    used = dict.fromkeys(["flight_id", "is_significant_delay", "delay_reason", *spec.all])
    data = cut_lineage(learn.prepare(sampling.relabel(trips, rules, "flight_id", seed), spec).select(*used))
    release(trips)
    split = cut_lineage(sampling.stratified_split(data, "is_significant_delay", "flight_id", 0.2, 42))
    release(data)
    train, test = split.filter("split = 'train'"), split.filter("split = 'test'")
    feats = learn.build_features(train, spec)
    delay = learn.train_delay(train, feats, params=dict(params, learning_rate=0.1))
    reason, classes = learn.train_reason(features.reason_subset(train), feats, params=params)
    return learn.score(test, feats, delay, 0.5, reason, classes, keep=["flight_id"])


@query("delay_scoring", ("M4", "M5", "M6", "M7", "M8"))
def delay_scoring(spark, d):
    """Scored test rows.  Iterative (boosting), so there is no SQL form: the
    driver checks rows only; ``scoring_contract`` checks what SQL can say of
    the same rows."""
    return scored_test_rows(spark, d, SCORING_PARAMS)
