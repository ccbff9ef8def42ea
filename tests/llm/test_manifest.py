import zlib
from hashlib import sha256

import pytest
from helpers import DOCS, EDGE, clashing, docs
from pyspark.sql import functions as F

from contrail.llm import manifest


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def written(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, more=0):
    doc_id, text, lang, source, n = row
    return h(*map(written, (doc_id, source, lang, None if n is None else n + more, text)))


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def path(levels, i):
    for level in levels[:-1]:
        yield (level[i ^ 1] if i ^ 1 < len(level) else None), i & 1
        i >>= 1


def brute(rows, every=7):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf_of(r), r))
    order = sorted(by_lang, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {lang: tree([x[2] for x in sorted(by_lang[lang], key=lambda x: x[:3])]) for lang in order}
    top = tree([trees[lang][-1][0] for lang in order])
    out = []
    for k, lang in enumerate(order):
        for i, (_, _, leaf, r) in enumerate(sorted(by_lang[lang], key=lambda x: x[:3])):
            steps = [*path(trees[lang], i), *path(top, k)]
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % every == 0
            f = leaf_of(r, 1) if hit and r[4] is not None else leaf
            for s, right in steps:
                f = h(f) if s is None else h(s, f) if right else h(f, s)
            out.append((r[0], leaf, trees[lang][-1][0], top[-1][0], h(*[s for s, _ in steps if s]), f, f == top[-1][0]))
    return sorted(out, key=str)


def run(frame, **options):
    return sorted(map(tuple, manifest.proofs(frame, manifest.tamperings(), **options).collect()), key=str)


ROWS = [(i * 3 - 20, f"text {i} ü", ("en", "de", "ß", None)[0 if i % 5 else i % 4], f"s{i % 3}" if i % 6 else None,
         i if i % 8 else None) for i in range(700)]


@pytest.mark.parametrize("small", [0, manifest.SMALL])  # every join by a shuffle, and by broadcast
def test_proofs_equal_brute_force(spark, small):
    frame = spark.createDataFrame(ROWS, DOCS)
    got = run(frame.repartition(7), small=small)
    assert got == brute(ROWS)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 3, 5, 256, 257, 513])
def test_sizes_around_a_run(spark, n):
    rows = [(i, "x", "en", "s", i) for i in range(n)]
    assert run(spark.createDataFrame(rows, DOCS)) == brute(rows)


def test_one_row_per_language(spark):
    rows = [(i, "x", f"l{i}", "s", i) for i in range(300)]
    assert run(spark.createDataFrame(rows, DOCS)) == brute(rows)


def test_nulls_repeated_rows_long_texts_and_further_columns(spark):
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in EDGE] + [(None,) * 5] * 4 + [
        (9, "a", "de", "s", 2 ** 63 - 1), (14, "a", "de", "s", 2 ** 63 - 1), (17, "-", "-", "-", -1)]
    frame = spark.createDataFrame(rows, DOCS)
    assert run(frame) == brute(rows) == run(clashing(frame))


def test_copies_of_one_row(spark):
    rows = [(5, "same", "en", "s", 4)] * 600 + [(i, "t", "en", "s", 1) for i in range(40)]
    assert run(spark.createDataFrame(rows, DOCS)) == brute(rows)


def test_empty_table(spark):
    frame = docs(spark, [])
    assert run(frame) == []
    assert manifest.proofs(frame).columns == [
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_untampered_rows_all_verify(spark):
    got = manifest.proofs(spark.createDataFrame(ROWS, DOCS)).agg(F.every("verified"), F.count("*")).first()
    assert tuple(got) == (True, len(ROWS))


def test_a_wrong_sibling_or_leaf_does_not_verify():
    a, b = sha256(b"a").digest(), sha256(b"b").digest()
    top = manifest.node(a, b)
    end = manifest.GROUP + top + manifest.TOP + top
    assert manifest.check(a, None, manifest.RIGHT + b + end)[-1]
    assert manifest.check(b, None, manifest.LEFT + a + end)[-1]
    assert not manifest.check(a, b, manifest.RIGHT + b + end)[-1]
    assert not manifest.check(a, None, manifest.LEFT + b + end)[-1]
