import random
import re
import zlib
from collections import Counter

import pytest
from helpers import EDGE, SF_SMALL, clashing, docs, stored
from hypothesis import given, settings
from hypothesis import strategies as st

from contrail.llm import spelling


def near(a, b):
    """One insertion, deletion or replacement apart, by trying all of them."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def counts(rows, every=97, shortest=5, rarest=3):
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= shortest and n >= rarest}


def brute(rows, **options):
    words = counts(rows, **options)
    cuts = {}
    for w in words:
        for i in range(len(w)):
            cuts.setdefault(w[:i] + w[i + 1:], set()).add(w)
    by = {w: {v for i in range(len(w)) for v in cuts.get(w[:i] + w[i + 1:], ())} | cuts.get(w, set())
          | {w[:i] + w[i + 1:] for i in range(len(w)) if w[:i] + w[i + 1:] in words} for w in words}
    form, out = {}, []
    for w, n in words.items():
        by[w] = {v for v in by[w] if near(w, v)}
        best = min(by[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(by[w]), words.get(form[w])))
    return sorted(out)


def run(frame, **options):
    return sorted(tuple(r) for r in spelling.variants(frame, **options).collect())


def test_whole_table_equals_brute_force(spark):
    rows = [r[:2] for r in stored("documents")]
    got = run(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    assert got == brute(rows)
    assert any(r[1] for r in got) and any(r[1] != r[2] for r in got if r[1])


def vocabulary(seed, n=300, letters="abé"):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(5, 8))) for _ in range(n)]


@pytest.mark.parametrize("block", [1, 4, 512])
def test_dense_vocabulary_in_blocks_of_any_size(spark, block):
    """Few letters, so that buckets are large and split into many blocks."""
    rng = random.Random(block)
    rows = [(i, " ".join(rng.choices(vocabulary(3), k=80))) for i in range(60)]
    assert run(docs(spark, rows), block=block) == brute(rows)


def test_counts_pass_on_when_many_are_held(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 10)
    rows = [(i, " ".join(vocabulary(i, 40))) for i in range(50)]
    assert run(docs(spark, rows)) == brute(rows)


def test_edge_rows_ties_and_further_columns(spark):
    rows = EDGE + [(i, "Träume TRÄUME träume Traume traume traumE; höhe×÷ÿ Ωmega_under9score") for i in range(6)] + [
        (20, "aaaaab aaaaac aaaaad " * 5), (None, "slips slips slips slipz " * 40), (21, "ß" * 70_000 + " " + "ß" * 70_001)] + [
        (22, ("ß" * 70_000 + " ") * 3)] * 3 + [(23, ("ß" * 70_001 + "\n") * 4)]
    frame = docs(spark, rows)
    assert run(frame) == brute(rows) == run(clashing(frame).selectExpr("*", "1 AS word", "2 AS form", "3 AS bucket"))


def test_long_chains_reach_their_root(spark):
    words = ["a" * i + "b" * (20 - i) for i in range(12)]
    rows = [(0, " ".join(w for k, w in enumerate(words) for _ in range(3 * 2 ** k)))]
    got = run(docs(spark, rows), every=10 ** 9)
    assert got == brute(rows, every=10 ** 9)
    assert {r[2] for r in got} == {words[-1]}


def test_empty_table(spark):
    frame = docs(spark, [])
    assert run(frame) == []
    assert spelling.variants(frame).columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_slip():
    hit = next(i for i in range(1000) if zlib.crc32(f"{i}:banana".encode()) % 97 == 0)
    assert len(spelling.slip(str(hit), "banana", 97)) == 5
    assert spelling.slip(str(hit + 1), "banana", 97) == "banana"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abé", min_size=4, max_size=9), min_size=2, max_size=12, unique=True))
def test_matrix_pairs_are_exactly_the_near_ones(words):
    for l in range(4, 10):
        here = [w for w in words if len(w) in (l, l + 1)]
        if not here:
            continue
        got = [(here[i], here[j]) for first in (True, False) for i, j in zip(*spelling.near_pairs(here, here, l, first))]
        want = [(a, b) for a in here for b in here if near(a, b) and min(len(a), len(b)) == l]
        assert sorted(got) == sorted(want)
