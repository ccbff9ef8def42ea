import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from contrail.llm import edit_embedding as ee
from contrail.llm.common import table

from helpers import EDGE, SF_SMALL, clashing, docs, stored


def brute_print(text):
    """The written string step by step, then its samples."""
    written = []
    for code in ee.kinds(text):
        for _ in range(ee.STAY[code + len(written) % ee.CYCLE]):
            written.append(code // ee.CYCLE)
    return "".join(chr(ee.DIGITS[written[s], k]) for k, s in enumerate(ee.STEPS) if s < len(written))


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for k, (i, t) in enumerate(rows):
        t, following = t or "", rows[(k + 1) % len(rows)][1] or ""
        edited = t[:len(t) - len(t) // 2] + following[:len(t) // 2]
        a, b, c = map(brute_print, (t, edited, following))
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), a, b, ee.likeness(a, b), ee.likeness(a, c)))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark, monkeypatch):
    rows = [(r[0], r[1]) for r in stored("documents")]
    want = brute(rows)
    for size in (500, 7):
        monkeypatch.setattr(ee, "RANGE_ROWS", size)
        assert sorted(map(tuple, ee.fingerprints(table(spark, SF_SMALL, "documents")).collect()), key=str) == want
    near = [w[5] for w in want if w[1] > 200]
    other = [w[6] for w in want if w[1] > 200]
    assert sum(near) / len(near) > 0.4 > 0.25 > sum(other) / len(other)


def test_edge_rows(spark, monkeypatch):
    for size in (500, 2):
        monkeypatch.setattr(ee, "RANGE_ROWS", size)
        got = ee.fingerprints(clashing(docs(spark, EDGE))).collect()
        assert sorted(map(tuple, got), key=str) == brute(EDGE)
    assert ee.fingerprints(docs(spark, [])).count() == 0
    assert ee.fingerprints(docs(spark, [(3, "one")])).first()["near_next"] == 1.0


def test_likeness_follows_edits():
    rng = random.Random(4)
    text = "".join(rng.choice("abcdefghij ") for _ in range(4000))

    def after(n):
        chars = list(text)
        for _ in range(n):
            k = rng.randrange(len(chars))
            chars[k:k + 1] = rng.choice([["z"], [], [chars[k], "q"]])
        return ee.likeness(ee.fingerprint(text), ee.fingerprint("".join(chars)))
    few, many = sum(after(4) for _ in range(8)) / 8, sum(after(400) for _ in range(8)) / 8
    assert ee.likeness(ee.fingerprint(text), ee.fingerprint(text)) == 1 and few > 0.85 > many


def test_near_classes(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdefghij ") for _ in range(3000)) for _ in range(6)]
    rows = [(10 * k + j, t[:2900] + "xyz"[:j] + t[2900:]) for k, t in enumerate(base) for j in range(4)] + [(90, ""), (91, None)]
    prints = ee.fingerprints(docs(spark, rows)).select("doc_id", "fingerprint")
    got = {r["doc_id"]: r["class_id"] for r in prints.join(ee.near_classes(prints), "fingerprint").collect()}
    assert got == {**{i: i // 10 * 10 for i, _ in rows[:-2]}, 90: 90, 91: 90}
    assert ee.near_classes(prints.limit(0)).count() == 0


def test_near_classes_in_frequent_buckets(spark):
    """Unlike texts that end alike share their buckets; near copies among them are found by other hubs.
    Queries: ids divisible by 20, against all rows; links that hold by brute force."""
    rng = random.Random(8)
    rows = []
    for k in range(60):  # the first half is a text's own, the second is one of three endings in part
        own = "".join(rng.choice("abcdefghij ") for _ in range(1500))
        ending = "".join(random.Random(k % 3).choice("klmnopqrst ") for _ in range(1500))
        for j in range(5):
            chars = list(own + ending)
            for _ in range(j):
                at = rng.randrange(1, len(chars))
                chars[at:at + 1] = rng.choice([["z"], [], [chars[at], "q"]])
            rows.append((5 * k + j, "".join(chars)))
    printed = [(i, ee.fingerprint(t)) for i, t in rows]
    prints = spark.createDataFrame(printed, "doc_id long, fingerprint string")
    got = {r["doc_id"]: r["class_id"] for r in prints.join(ee.near_classes(prints), "fingerprint").collect()}
    links = [(i, j) for i, a in printed if i % 20 == 0 for j, b in printed if j != i and ee.likeness(a, b) >= 0.8]
    assert len(links) > 40
    assert sum(got[i] == got[j] for i, j in links) >= 0.9 * len(links)
    # a class is a set of rows that links hold together, nothing more
    near = {i: {j for j, b in printed if ee.likeness(a, b) >= 0.8} for i, a in printed}
    for i, c in got.items():
        reached, new = {c}, {c}
        while new:
            new = set().union(*(near[j] for j in new)) - reached
            reached |= new
        assert i in reached
    print("links", len(links), "recall", sum(got[i] == got[j] for i, j in links) / len(links))


def test_unlike_members_of_one_bucket_part(spark):
    """All fingerprints share every band of one octave, no two are alike: no links, and the rounds end."""
    rng = random.Random(9)
    first = "".join(rng.choice("0123456789abcdef") for _ in range(64))
    shared = "".join(rng.choice("0123456789abcdef") for _ in range(64))
    printed = [(i, first[:32] + "".join(rng.choice("0123456789abcdef") for _ in range(96)) + shared[:16]
                + "".join(rng.choice("0123456789abcdef") for _ in range(48))) for i in range(50)]
    prints = spark.createDataFrame(printed, "doc_id long, fingerprint string")
    assert {r["class_id"] for r in ee.near_classes(prints).collect()} == set(range(50))


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abé😀 \n", max_size=300))
def test_fingerprint_property(text):
    assert ee.fingerprint(text) == brute_print(text)
