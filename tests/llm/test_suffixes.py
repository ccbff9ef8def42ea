import hashlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from contrail.llm import suffixes
from contrail.llm.common import table

from helpers import EDGE, SF_SMALL, clashing, docs, stored


def brute(rows, span):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k:k + span] for _, b in data for k in range(len(b) - span + 1))
    out = []
    for i, b in data:
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - span + 1):
            if seen[b[k:k + span]] > 1:
                gone[k:k + span] = True
        gone[-1] = False
        rest = bytes(c for c, g in zip(b, gone) if not g)
        runs = int((gone[1:] & ~gone[:-1]).sum()) + int(gone[0])
        out.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark):
    got = suffixes.remove_repeats(table(spark, SF_SMALL, "documents")).collect()
    want = brute([(r[0], r[1]) for r in stored("documents")], suffixes.SPAN)
    assert sorted(map(tuple, got), key=str) == want
    assert sum(w[2] for w in want) > 0


@pytest.mark.parametrize("span", [4, 9, 16])
def test_short_spans(spark, span):
    rng = np.random.default_rng(span)
    rows = []
    for i in range(150):
        text = "".join(rng.choice(list("ab é"), int(rng.integers(0, 40))))
        if i % 3 == 0 and rows:
            other = rows[int(rng.integers(len(rows)))][1]
            at = int(rng.integers(0, len(other) + 1))
            text = text[:10] + other[at:at + 25] + text[10:]
        rows.append((i, text))
    rows += [(500, "abab" * 30), (501, rows[3][1]), (501, rows[3][1]), (None, rows[4][1])]
    got = suffixes.remove_repeats(docs(spark, rows), span).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, span)


def test_edge_rows(spark):
    for frame in (docs(spark, EDGE), clashing(docs(spark, EDGE))):
        got = suffixes.remove_repeats(frame).collect()
        assert sorted(map(tuple, got), key=str) == brute(EDGE, suffixes.SPAN)
    assert suffixes.remove_repeats(docs(spark, [])).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=60), st.integers(2, 12))
def test_anchor_runs_cover_every_start_once(data, span):
    lo, hi, a, whole, right, left, check = suffixes.anchors(np.frombuffer(data, np.uint8), span)
    starts = [k for x, y in zip(lo, hi) for k in range(x, y + 1)]
    assert starts == list(range(max(0, len(data) - span + 1)))
    assert all(x <= p <= y + span for x, y, p in zip(lo, hi, a))


def test_segments_of_a_long_text(monkeypatch):
    monkeypatch.setattr(suffixes, "SEGMENT", 64)
    monkeypatch.setattr(suffixes, "LOW", np.uint64(63))
    data = np.random.default_rng(1).integers(0, 3, 1000).astype(np.uint8)
    lo, hi, *_ = suffixes.anchors(data, 10)
    assert [k for x, y in zip(lo, hi) for k in range(x, y + 1)] == list(range(991))


def test_many_equal_rows_and_copies(spark):
    """Equal rows, copies under other ids, a text that shares a part with them, and short copies."""
    rng = np.random.default_rng(5)
    long = "".join(rng.choice(list("abcdefgh "), 9600))
    other = "".join(rng.choice(list("abcdefgh "), 900))
    rows = [(1, long)] * 300 + [(i, long) for i in range(2, 150)] + [(500, other + long[4000:4700]), (501, "short")] + [
        (502, "short")] * 3 + [(600, other)]
    got = suffixes.remove_repeats(docs(spark, rows).repartition(8)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, suffixes.SPAN)


def test_keys_that_collide_are_drawn_again(spark):
    from pyspark.sql import functions as F
    rows = docs(spark, [(1, "a"), (2, "b"), (3, "b")]).select("doc_id", "text")
    keyed, copies = suffixes.text_keys(rows, lambda seed: F.lit(7).cast("bigint") if seed < 3 else F.xxhash64(F.lit(seed), "text"))
    assert keyed.select("row").distinct().count() == 2
    assert [r.row for r in copies.collect()] == [r.row for r in keyed.filter("doc_id = 2").collect()]


def test_second_hash_tells_strings_apart():
    one, two = (suffixes.anchors(np.random.default_rng(i).integers(97, 100, 80).astype(np.uint8), 10) for i in (1, 2))
    same = suffixes.anchors(np.random.default_rng(1).integers(97, 100, 80).astype(np.uint8), 10)
    assert one[6].tolist() == same[6].tolist() and not set(one[6].tolist()) & set(two[6].tolist())


@settings(max_examples=300, deadline=None)
@given(st.integers(4, 60), st.integers(0, 100), st.data())
def test_cells_hold_every_start_once_and_common_bytes(span, at, data):
    most = span - max(1, span // 4)
    a = at + most
    lo = data.draw(st.integers(a - most, a))
    hi = data.draw(st.integers(lo, a))
    got = list(suffixes.cells(lo, hi, a, span))
    assert sorted(i for x, y, _, _ in got for i in range(x, y + 1)) == list(range(lo, hi + 1))
    width = most // 8 + 1
    for x, y, start, end in got:
        p = a - start
        assert p % width == 0 and all(i <= start and end <= i + span and (a - i) // width == p // width for i in range(x, y + 1))
        assert end - start >= span - width + 1


@pytest.mark.parametrize("cores", [True, False])
def test_texts_hashed_together_have_the_anchors_of_each(cores, monkeypatch):
    monkeypatch.setattr(suffixes, "BLOCK", 300)
    rng = np.random.default_rng(6)
    texts = ["".join(rng.choice(list("ab é"), int(n))) for n in rng.integers(0, 200, 60)] + ["ab" * 400, "a" * 16, "a" * 15]
    frame = pd.DataFrame({"row": np.arange(len(texts)), "text": texts})
    got = pd.concat(list(suffixes._anchor_rows(16, cores)(iter([frame]))))
    want = []
    for row, text in enumerate(texts):
        lo, hi, a, *names, check = suffixes.anchors(np.frombuffer(text.encode(), np.uint8), 16, cores)
        want += zip([row] * len(lo), lo.tolist(), hi.tolist(), a.tolist(), *(n.view(np.int64).tolist() for n in names), check.tolist())
    assert list(map(tuple, got.to_numpy().tolist())) == want


def test_planted_passages_go_from_span_bytes_on(spark):
    """Passages of over 50 words in two documents each: what counts is their bytes, and ``n_bytes`` stays the size of the text."""
    rng = np.random.default_rng(7)

    def words(n):
        return " ".join("".join(rng.choice(list("abcdefghij"), int(k))) for k in rng.integers(3, 8, n))

    rows, sizes = [], []
    for size in [330, 399, 400, 401, 700]:
        passage = words(size // 2)[:size]
        assert len(passage.split()) > 50
        for mark in "<>":  # no byte beside the passage is the same
            rows.append((len(rows), words(80) + mark + passage + mark + words(80)))
            sizes.append(size)
    rows += [(100 + i, words(200)) for i in range(5)]
    got = {r.doc_id: r for r in suffixes.remove_repeats(docs(spark, rows)).collect()}
    assert [got[i].n_removed for i in range(len(sizes))] == [size if size >= suffixes.SPAN else 0 for size in sizes]
    assert all(got[100 + i].n_removed == 0 for i in range(5))
    assert all(got[i].n_bytes == len(text) for i, text in rows)
