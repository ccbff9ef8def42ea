import re

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from contrail.llm import simhash
from contrail.llm.common import table
from contrail.llm.components import components

from helpers import EDGE, SF_SMALL, clashing, docs, stored


def brute_print(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(prints, distance=4):
    nodes = sorted(set(prints))
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if (a ^ b).bit_count() <= distance:
                root[find(b)] = find(a)
    return {n: find(n) for n in nodes}


def brute(rows, distance=4):
    prints = [(i, brute_print(t)) for i, t in rows]
    root = brute_roots([p for _, p in prints], distance)
    least = {}
    for i, p in prints:
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    return sorted(((i, f"{p:016x}", least.get(root[p])) for i, p in prints), key=str)


def test_query_equals_brute_force(spark):
    rows = [(r[0], r[1]) for r in stored("documents")]
    got = simhash.near_classes(table(spark, SF_SMALL, "documents")).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_edge_rows(spark):
    for frame in (docs(spark, EDGE), clashing(docs(spark, EDGE))):
        assert sorted(map(tuple, simhash.near_classes(frame).collect()), key=str) == brute(EDGE)
    assert simhash.near_classes(docs(spark, [])).count() == 0


def test_links_at_every_distance(spark):
    base = [0, -1, 0x123456789ABCDEF0, 5 << 40]
    flips = [0, 1, 3, 7, 15, 31, 1 << 63, 1 << 63 | 1 << 31 | 1 << 7 | 1, 0x8888, 0x88888, 0x8001000100010001]
    nodes = sorted({(b ^ f) & (1 << 64) - 1 for b in base for f in flips})
    frame = spark.createDataFrame([(simhash._signed(n),) for n in nodes], "fp bigint")
    for distance in (0, 1, 4, 6):
        got = {(r["u"], r["v"]) for r in simhash.links(frame, distance).collect()}
        signed = sorted(map(simhash._signed, nodes))
        want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= distance}
        assert got == want
        assert simhash.links(frame, distance).count() == len(want)


def test_cells_are_not_broadcast(spark, tmp_path):
    """A stored table under the broadcast threshold has 35 cells for each of its rows."""
    spark.range(5000).select(F.xxhash64("id").alias("fp")).write.parquet(str(tmp_path / "n"))
    found = simhash.links(spark.read.parquet(str(tmp_path / "n")))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_keep_one(spark, tmp_path):
    rows = EDGE + [(8, "one two three four five six seven"), (9, "one two three four five six seven")]
    clashing(docs(spark, rows)).write.parquet(str(tmp_path / "d"))
    frame = spark.read.parquet(str(tmp_path / "d"))
    got = simhash.keep_one(frame)
    assert got.columns == frame.columns
    kept = sorted((r["doc_id"] for r in got.collect()), key=str)
    groups = {c for _, _, c in brute(rows)}
    assert len(kept) == len(set(brute_roots([brute_print(t) for _, t in rows]).values()))
    assert [k for k in kept if k is not None] == sorted(g for g in groups if g is not None)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aAbÉ \n\t0", max_size=60))
def test_fingerprint_property(text):
    assert simhash.fingerprint(text) == brute_print(text)
