"""DuckDB SQL of the text queries that SQL can express (see ``queries.ORACLE_SQL``)."""

from __future__ import annotations

from contrail.llm import manifest, spelling, urls

#: CRC-32 for a DuckDB without one: ``tab`` holds the remainder of every byte value.
CRC_TABLE = """crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8),
    lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i)) AS tab)"""


def crc32(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of the SQL text ``text``; ``tab`` must be in scope."""
    return f"""xor(list_reduce(list_transform(range(1, octet_length(encode({text})) + 1),
      lambda b: ('0x' || substr(hex(encode({text})), 2 * b - 1, 2))::BIGINT),
      lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1]), 4294967295::BIGINT), 4294967295)"""


def _leaf(n_chars: str) -> str:
    parts = [n_chars if c == "n_chars" else c for c in manifest.COLUMNS]
    return "sha256(" + " || ".join(
        f"coalesce(octet_length(encode(({c})::VARCHAR)) || ':' || ({c})::VARCHAR, '-')" for c in parts) + ")"


MERKLE_PROOFS = f"""
WITH RECURSIVE {CRC_TABLE},
leaf AS (SELECT doc_id, {_leaf("n_chars")} AS leaf, coalesce('=' || lang, '') AS g,
    CASE WHEN {crc32("doc_id::VARCHAR")} % 7 = 0 THEN {_leaf("n_chars::HUGEINT + 1")} END AS bad
  FROM documents, crc_table),
numbered AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
    count(*) OVER (PARTITION BY g) AS n FROM leaf),
node AS (SELECT 0 AS level, g, place, n, leaf AS h FROM numbered
  UNION ALL SELECT level + 1, g, place // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY place)) FROM node
  WHERE n > 1 GROUP BY level, g, place // 2),
sub AS (SELECT g, h, row_number() OVER (ORDER BY encode(g)) - 1 AS place, count(*) OVER () AS n FROM node WHERE n = 1),
top AS (SELECT 0 AS level, place, n, h FROM sub
  UNION ALL SELECT level + 1, place // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY place)) FROM top
  WHERE n > 1 GROUP BY level, place // 2),
walk AS (SELECT doc_id, n.g, n.place, 0 AS level, '' AS sib, coalesce(bad, leaf) AS f, leaf FROM numbered n
  UNION ALL
  SELECT w.doc_id, w.g, w.place // 2, w.level + 1, sib || coalesce(s.h, ''),
    sha256(CASE WHEN s.h IS NULL THEN f WHEN w.place % 2 = 1 THEN s.h || f ELSE f || s.h END), leaf
  FROM walk w JOIN node a ON a.g = w.g AND a.level = w.level AND a.place = w.place AND a.n > 1
    LEFT JOIN node s ON s.g = w.g AND s.level = w.level AND s.place = xor(w.place, 1)),
climb AS (SELECT doc_id, leaf, sub.h AS subroot, sub.place, 0 AS level, sib, f FROM walk w JOIN sub USING (g)
    JOIN node e ON e.g = w.g AND e.level = w.level AND e.n = 1
  UNION ALL
  SELECT doc_id, leaf, subroot, c.place // 2, c.level + 1, sib || coalesce(s.h, ''),
    sha256(CASE WHEN s.h IS NULL THEN f WHEN c.place % 2 = 1 THEN s.h || f ELSE f || s.h END)
  FROM climb c JOIN top a ON a.level = c.level AND a.place = c.place AND a.n > 1
    LEFT JOIN top s ON s.level = c.level AND s.place = xor(c.place, 1))
SELECT doc_id, leaf, subroot, r.h AS root, sha256(sib) AS proof_sha256, f AS folded_root, f = r.h AS verified
FROM climb c JOIN top r ON r.level = c.level AND r.n = 1
"""


def _cut(source: str) -> str:
    """``source`` (a table with url) with host and path, as CTEs ``rest_<source>`` and ``cut_<source>``."""
    return f"""rest_{source} AS (SELECT *, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest FROM {source}),
cut_{source} AS (SELECT *,
  coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), '{urls.CAPITALS}', '{urls.SMALL_LETTERS}'), '') AS host,
  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM rest_{source})"""


def _features() -> str:
    def grams(column: str, mark: str, n: int) -> str:
        text = f"('^' || {column} || '$')"
        return f"list_transform(range(1, length({text}) - {n - 2}), lambda i: '{mark}' || substr({text}, i, {n}))"
    every = [grams(c, mark, n) for c, mark in (("host", "h"), ("path", "p")) for n in urls.GRAMS]
    return ("list_sort(list_distinct(list_transform(" + " || ".join(every)
            + ", lambda g: ('0x' || substr(md5(g), 1, 4))::INTEGER)))")


def _rule(what: int) -> str:
    whens = []
    for kind, rule in sorted(urls.RULES, key=lambda r: -len(r[1])):
        name, slash, start = rule.partition("/")
        whens.append(f"WHEN (host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{slash + start}') "
                     f"THEN '{(rule, kind)[what]}'")
    return f"CASE {' '.join(whens)} END"


_LABELLED = ", ".join(f"('{u}', {y})" for u, y in urls.LABELLED)

URL_VERDICTS = f"""
WITH RECURSIVE labelled AS (SELECT url, max(y)::DOUBLE AS y FROM (VALUES {_LABELLED}) t(url, y) GROUP BY url),
{_cut("labelled")},
seen AS (SELECT list(y ORDER BY url) AS y, list({_features()} ORDER BY url) AS xs, count(*) AS n FROM cut_labelled),
products AS MATERIALIZED (SELECT y, xs, n, list_transform(xs, lambda p: list_transform(xs, lambda q:
    length(list_intersect(p, q)) / sqrt(length(p) * length(q)) + {urls.CONSTANT ** 2}::DOUBLE)) AS m FROM seen),
fit AS (SELECT 0 AS t, list_transform(y, lambda v: 0::DOUBLE) AS a FROM products
  UNION ALL SELECT t + 1, list_transform(m, lambda p, i: a[i] * {1 - urls.RATE * urls.RIDGE}::DOUBLE + {urls.RATE}::DOUBLE / n
    * (y[i] - 1 / (1 + exp(-list_dot_product(p, a)))))
  FROM fit, products WHERE t < {urls.STEPS}),
share AS (SELECT unnest(list_transform(range(1, n + 1), lambda i: {{'x': xs[i], 'a': a[i]}})) AS r
  FROM fit, products WHERE t = {urls.STEPS}),
weight AS (SELECT b, sum(w) AS w FROM (SELECT unnest(r.x) AS b, r.a / sqrt(length(r.x)) AS w FROM share) GROUP BY b),
constant AS (SELECT sum(r.a) * {urls.CONSTANT ** 2}::DOUBLE AS c FROM share),
page AS (SELECT page_id, url, row_number() OVER () AS r FROM pages),
{_cut("page")},
judged AS (SELECT r, any_value(length(x)) AS n, sum(weight.w) AS s
  FROM (SELECT r, x, unnest(x) AS b FROM (SELECT r, {_features()} AS x FROM cut_page)) LEFT JOIN weight USING (b) GROUP BY r),
scored AS (SELECT page_id, host, path, {_rule(0)} AS rule, {_rule(1)} AS ruled,
  round(1 / (1 + exp(-(coalesce(s, 0) / sqrt(greatest(coalesce(n, 0), 1)) + c))), 6) AS score
  FROM cut_page LEFT JOIN judged USING (r), constant)
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN score >= 0.5 THEN 'block' ELSE 'allow' END) AS verdict, score
FROM scored
"""

SPELLING_VARIANTS = f"""
WITH RECURSIVE {CRC_TABLE},
run AS (SELECT id, run, count(*) AS c FROM (SELECT doc_id::VARCHAR AS id,
    unnest(regexp_extract_all(translate(text, '{urls.CAPITALS}', '{urls.SMALL_LETTERS}'), '[a-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents)
  GROUP BY ALL),
drawn AS (SELECT run, c, {crc32("coalesce(id, '') || ':' || run")} AS h FROM run, crc_table),
slipped AS (SELECT CASE WHEN h % {spelling.SLIP} = 0
    THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, c FROM drawn),
word AS (SELECT word, sum(c)::BIGINT AS n FROM slipped WHERE length(word) >= {spelling.SHORTEST} GROUP BY word HAVING sum(c) >= {spelling.RAREST}),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM word)),
near AS (SELECT DISTINCT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN word b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN word b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, min((-n, other)) AS m FROM near GROUP BY word),
led AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN -m[1] >= {spelling.FACTOR} * w.n THEN m[2] END AS form, CASE WHEN -m[1] >= {spelling.FACTOR} * w.n THEN -m[1] END AS form_n
  FROM word w LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root FROM led WHERE form IS NULL
  UNION ALL SELECT l.word, c.root FROM led l JOIN chain c ON l.form = c.word)
SELECT word, form, root, n, n_near, form_n FROM led JOIN chain USING (word)
"""
