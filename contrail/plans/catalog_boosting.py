"""Queries: boosted trees on a fixed grid of bins, checked split by split
(M6), class by class (M7) and by feature (D3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from contrail.operators import boosting
from contrail.plans.registry import query
from contrail.sources import fixtures as fx
from contrail.session import cut_lineage

#: Thresholds of the three features; a row's bin is how many of them are at most its value.
GRID = {"l_quantity": [10.0, 20.0, 30.0, 40.0], "l_discount": [0.02, 0.04, 0.06, 0.08], "l_tax": [0.02, 0.04, 0.06]}
#: Two rounds of trees of depth 2 with three of four possible leaves, so that the leaf limit cuts one split.
TREES = boosting.BoostParams(rounds=2, learning_rate=0.3, max_leaves=3, max_depth=2, min_rows=20, l1=0.1, l2=0.2)
STUMPS = boosting.BoostParams(rounds=2, learning_rate=0.3, max_leaves=2, max_depth=1, min_rows=20, l1=0.1, l2=0.2)
FLAGS = ["A", "N", "R"]


def _d(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


_BINS = "[" + ", ".join(" + ".join(f"CAST({c} >= {_d(e)} AS INTEGER)" for e in edges) for c, edges in GRID.items()) + "]"


def _shrunk(g: str, p: boosting.BoostParams) -> str:
    return f"(sign({g}) * greatest(abs({g}) - {_d(p.l1)}, 0))"


def _splits_sql(source: str, node: str, p: boosting.BoostParams, keys: str = "") -> str:
    """Best split of every node of ``source`` (b, g, h and the node expression)."""
    k = keys + ", " if keys else ""

    def score(g: str, h: str) -> str:
        return f"pow({_shrunk(g, p)}, 2) / ({h} + {_d(p.l2)})"

    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {k}node ORDER BY gain DESC, feature, bin) AS place FROM (
  SELECT *, CASE WHEN nl >= {p.min_rows} AND tn - nl >= {p.min_rows} AND hl >= {_d(p.min_hessian)} AND th - hl >= {_d(p.min_hessian)}
    THEN greatest({score("gl", "hl")} + {score("(tg - gl)", "(th - hl)")} - {score("tg", "th")}, 0) ELSE 0 END AS gain FROM (
  SELECT {k}node, feature, bin, sum(g) OVER w AS tg, sum(h) OVER w AS th, sum(n) OVER w AS tn,
    coalesce(sum(g) OVER v, 0) AS gl, coalesce(sum(h) OVER v, 0) AS hl, coalesce(sum(n) OVER v, 0) AS nl FROM (
  SELECT {k}node, feature, b[feature + 1] AS bin, sum(g) AS g, sum(h) AS h, count(*) AS n
  FROM (SELECT *, {node} AS node, unnest(range({len(GRID)})) AS feature FROM {source}) GROUP BY ALL)
  WINDOW w AS (PARTITION BY {k}node, feature), v AS (PARTITION BY {k}node, feature ORDER BY bin
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))) WHERE place = 1"""


def _value(g: str, h: str, p: boosting.BoostParams) -> str:
    return f"(0 - {_d(p.learning_rate)} * {_shrunk(g, p)} / ({h} + {_d(p.l2)}))"


def _trees_sql() -> str:
    """CTEs ``nodes0``, ``nodes1``: the nodes of both rounds."""
    p = TREES
    out = [f"""WITH f0 AS (SELECT {_BINS} AS b, CASE WHEN l_quantity + 100 * l_tax > 29 THEN 1 ELSE 0 END AS y,
  (SELECT ln(avg(yy) / (1 - avg(yy))) FROM (SELECT CAST(CASE WHEN l_quantity + 100 * l_tax > 29 THEN 1 ELSE 0 END AS DOUBLE) AS yy
    FROM lineitem)) AS f FROM lineitem)"""]
    for r in range(p.rounds):
        out.append(f"""
d{r} AS (SELECT *, q - y AS g, q * (1 - q) AS h FROM (SELECT *, 1 / (1 + exp(-f)) AS q FROM f{r})),
top{r} AS MATERIALIZED ({_splits_sql(f"d{r}", "1", p)}),
in{r} AS (SELECT d.*, 2 + CAST(d.b[t.feature + 1] >= t.bin AS INTEGER) AS side FROM d{r} d, top{r} t),
low{r} AS MATERIALIZED ({_splits_sql(f"in{r}", "side", p)}),
cut{r} AS (SELECT * FROM low{r} WHERE gain > 0 ORDER BY gain DESC, node LIMIT 1),
nodes{r} AS MATERIALIZED (
  SELECT 1 AS node, feature, bin, gain, {_value("tg", "th", p)} AS value, tn AS n_rows FROM top{r}
  UNION ALL SELECT l.node, CASE WHEN c.node IS NULL THEN -1 ELSE l.feature END, CASE WHEN c.node IS NULL THEN 0 ELSE l.bin END,
    CASE WHEN c.node IS NULL THEN 0 ELSE l.gain END, {_value("l.tg", "l.th", p)}, l.tn FROM low{r} l LEFT JOIN cut{r} c ON c.node = l.node
  UNION ALL SELECT 2 * node, -1, 0, 0, {_value("gl", "hl", p)}, nl FROM cut{r}
  UNION ALL SELECT 2 * node + 1, -1, 0, 0, {_value("(tg - gl)", "(th - hl)", p)}, tn - nl FROM cut{r}),
f{r + 1} AS (SELECT i.b, i.y, i.f + n.value AS f FROM in{r} i, cut{r} c JOIN nodes{r} n
  ON n.node = CASE WHEN i.side = c.node THEN 2 * i.side + CAST(i.b[c.feature + 1] >= c.bin AS INTEGER) ELSE i.side END)""")
    return ",".join(out)


_ALL_NODES = " UNION ALL ".join(f"SELECT {r} AS round, * FROM nodes{r}" for r in range(TREES.rounds))


def _fitted(spark, d) -> boosting.BoostedTrees:
    rows = fx.read_table(spark, d, "lineitem").select(
        *GRID, F.when(F.col("l_quantity") + 100 * F.col("l_tax") > 29, 1).otherwise(0).alias("y"))
    return boosting.fit(rows, list(GRID), "y", [0, 1], params=TREES, edges=list(GRID.values()))


@query("boosted_trees", ("M6",), sql=_trees_sql() + f"""
SELECT CAST(round AS INTEGER) AS round, CAST(node AS INTEGER) AS node, CAST(feature AS INTEGER) AS feature, CAST(bin AS INTEGER) AS bin,
  round(gain, 4) AS gain, round(value, 8) AS value, CAST(n_rows AS BIGINT) AS n_rows FROM ({_ALL_NODES})""")
def boosted_trees(spark, d):
    """Every node of the first two trees: split, gain, value and rows."""
    return _fitted(spark, d).node_table(spark).select(
        "round", "node", "feature", "bin", F.round("gain", 4).alias("gain"), F.round("value", 8).alias("value"),
        F.col("rows").alias("n_rows"))


@query("feature_importances", ("D3",), sql=_trees_sql() + f""",
g AS (SELECT feature, sum(gain) AS gain, count(*) AS n FROM ({_ALL_NODES}) WHERE feature >= 0 GROUP BY feature)
SELECT t.name AS feature, round(coalesce(gain / (SELECT sum(gain) FROM g), 0), 8) AS importance, coalesce(n, 0) AS n_splits
FROM (SELECT unnest({list(GRID)}) AS name, unnest(range({len(GRID)})) AS feature) t LEFT JOIN g USING (feature)""")
def feature_importances(spark, d):
    """Share of each feature in the gains of the fitted node table."""
    top = boosting.importances(_fitted(spark, d).node_table(spark), list(GRID))
    return top.withColumn("importance", F.round("importance", 8))


def _classes_sql() -> str:
    p, k = STUMPS, len(FLAGS)
    out = [f"""WITH s0 AS (SELECT l_orderkey, l_linenumber, {_BINS} AS b, list_position({FLAGS}, l_returnflag) - 1 AS y,
  (SELECT [ln(count(*) FILTER (WHERE l_returnflag = 'A') / count(*)), ln(count(*) FILTER (WHERE l_returnflag = 'N') / count(*)),
     ln(count(*) FILTER (WHERE l_returnflag = 'R') / count(*))] FROM lineitem) AS f FROM lineitem)"""]
    for r in range(p.rounds):
        out.append(f"""
e{r} AS (SELECT *, list_transform(f, lambda v: exp(v - list_max(f))) AS e FROM s{r}),
p{r} AS (SELECT *, list_transform(e, lambda v: v / list_sum(e)) AS q FROM e{r}),
c{r} AS (SELECT b, k, q[k + 1] - CASE WHEN y = k THEN 1 ELSE 0 END AS g, q[k + 1] * (1 - q[k + 1]) * {_d(k / (k - 1))} AS h
  FROM (SELECT *, unnest(range({k})) AS k FROM p{r})),
t{r} AS MATERIALIZED ({_splits_sql(f"c{r}", "1", p, "k")}),
v{r} AS MATERIALIZED (SELECT list(CASE WHEN gain > 0 THEN feature ELSE 0 END ORDER BY k) AS feature,
  list(CASE WHEN gain > 0 THEN bin ELSE 0 END ORDER BY k) AS bin,
  list(CASE WHEN gain > 0 THEN {_value("gl", "hl", p)} ELSE {_value("tg", "th", p)} END ORDER BY k) AS lo,
  list(CASE WHEN gain > 0 THEN {_value("(tg - gl)", "(th - hl)", p)} ELSE {_value("tg", "th", p)} END ORDER BY k) AS hi FROM t{r}),
s{r + 1} AS (SELECT l_orderkey, l_linenumber, b, y, list_transform(range(1, {k + 1}),
  lambda i: f[i] + CASE WHEN b[feature[i] + 1] >= bin[i] THEN hi[i] ELSE lo[i] END) AS f FROM s{r}, v{r})""")
    r = p.rounds
    out.append(f"""
e{r} AS (SELECT *, list_transform(f, lambda v: exp(v - list_max(f))) AS e FROM s{r})
SELECT l_orderkey, l_linenumber, """ + ", ".join(
        f"round(e[{i + 1}] / list_sum(e), 9) AS p_{c.lower()}" for i, c in enumerate(FLAGS)) + f" FROM e{r}")
    return ",".join(out)


@query("boosted_classes", ("M5", "M7"), sql=_classes_sql())
def boosted_classes(spark, d):
    """Class probabilities after two rounds of one stump a class."""
    rows = cut_lineage(fx.read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", *GRID))
    model = boosting.fit(rows, list(GRID), "l_returnflag", FLAGS, params=STUMPS, edges=list(GRID.values()))
    return rows.withColumn("q", model.probabilities()).select(
        "l_orderkey", "l_linenumber", *[F.round(F.col("q")[i], 9).alias(f"p_{c.lower()}") for i, c in enumerate(FLAGS)])
