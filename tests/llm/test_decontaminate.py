import random

from hypothesis import given, settings
from hypothesis import strategies as st

from contrail.llm import decontaminate
from contrail.llm.common import table

from helpers import EDGE, SF_SMALL, clashing, docs, stored

ITEMS = "item_id bigint, text string"


def infix_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        above, row = row, [i]
        for j, c in enumerate(text, 1):
            row.append(min(above[j] + 1, row[j - 1] + 1, above[j - 1] + (p != c)))
    return min(row)


def brute(items, rows, rate=decontaminate.RATE):
    out = []
    for i, text in rows:
        for item_id, item in items:
            folded = decontaminate.fold(item or "").strip()
            if folded:
                d = infix_distance(folded, decontaminate.fold(text or ""))
                if d <= min(int(rate * len(folded)), len(folded) - 1):
                    out.append((i, item_id, d))
    return sorted(out, key=str)


def edited(text, n, seed):
    rng, chars = random.Random(seed), list(text)
    for _ in range(n):
        k = rng.randrange(len(chars))
        chars[k:k + 1] = rng.choice([["z"], [], [chars[k], "q"]])
    return "".join(chars)


def test_planted_edits_equal_brute_force(spark):
    items = [(r[0], r[1]) for r in stored("benchmark")[:6]] + [(90, None), (91, "  "), (92, "short"), (93, "short")]
    filler = stored("documents")[1][1][:300]
    rows = [(n * 10 + k, filler + edited(items[n][1], 3 * k, k) + filler) for n in range(6) for k in range(8)]
    rows += [(1000, items[0][1].upper().replace(" ", "\n")), (1001, "a short one")]
    got = decontaminate.contaminations(docs(spark, rows), spark.createDataFrame(items, ITEMS)).collect()
    assert sorted(((r["doc_id"], r["item_id"], r["distance"]) for r in got), key=str) == brute(items, rows)
    text, item = dict(rows), dict(items)
    for r in got:
        span = decontaminate.fold(text[r["doc_id"]][r["span_start"]:r["span_end"]])
        assert infix_distance(decontaminate.fold(item[r["item_id"]]).strip(), span) == r["distance"]


def test_whole_tables_hold_every_exact_item(spark):
    items, rows = stored("benchmark"), stored("documents")
    got = decontaminate.contaminations(table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "benchmark")).collect()
    exact = {(r[0], i) for r in rows for i, t in items if t in r[1]}
    assert exact == {(r["doc_id"], r["item_id"]) for r in got if r["distance"] == 0}


def test_edge_rows_and_blocks(spark, monkeypatch):
    items = spark.createDataFrame([(1, "a b c d e f"), (2, None), (None, "null id"), (4, "x" * 40)], ITEMS)
    want = [(5, 1), (5, 1), (7, 4), (None, None)]
    for block in (decontaminate.BLOCK_CHARS, 5):
        monkeypatch.setattr(decontaminate, "BLOCK_CHARS", block)
        got = decontaminate.contaminations(clashing(docs(spark, EDGE)), items)
        assert sorted(((r["doc_id"], r["item_id"]) for r in got.collect()), key=str) == want
        clean = decontaminate.keep_clean(clashing(docs(spark, EDGE)), items)
        assert clean.columns == clashing(docs(spark, EDGE)).columns and clean.count() == len(EDGE) - 4
    none = spark.createDataFrame([], ITEMS)
    assert decontaminate.contaminations(docs(spark, EDGE), none).count() == 0
    assert decontaminate.keep_clean(docs(spark, EDGE), none).count() == len(EDGE)
    assert decontaminate.contaminations(docs(spark, []), items).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab", min_size=1, max_size=12), st.text(alphabet="ab", max_size=30))
def test_bit_parallel_distance(pattern, text):
    best, _ = decontaminate.scan(decontaminate.bits(pattern), len(pattern), text, len(pattern))
    assert min(best, len(pattern)) == infix_distance(pattern, text)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abc ", min_size=8, max_size=20), st.text(alphabet="abc ", max_size=60))
def test_pigeonhole_finds_all(item, text):
    if item.strip():
        found = decontaminate.Matcher([(1, item)], 0.25).find(text)
        assert [(1, r[1]) for r in found] == [(i, d) for _, i, d in brute([(1, item)], [(0, text)], 0.25)]
