from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from contrail.llm import mixing
from contrail.llm.common import table

from helpers import EDGE, SF_SMALL, clashing, docs, stored


def simulate(slots, blocks):
    """Slot by slot: the released block with the earliest deadline; idle if its source is out of blocks."""
    period, served, out = sum(slots.values()), Counter(), {}
    for t in range(10 ** 6):
        ready = [(-(-(served[s] + 1) * period // n), k, s) for k, (s, n) in enumerate(slots.items())
                 if served[s] * period // n <= t]
        _, _, s = min(ready)
        if served[s] < blocks[s]:
            out[s, served[s]] = t
        served[s] += 1
        if all(served[s] >= blocks[s] for s in slots):
            return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=8))
def test_schedule_is_within_one_block(counts):
    slots = {str(k): n for k, n in enumerate(counts)}
    plan = mixing.earliest_deadline_first(slots)
    period, served = sum(counts), Counter()
    assert sorted(t for *_, t in plan) == list(range(period))
    for s, j, t in sorted(plan, key=lambda x: x[2]):
        assert j == served[s] and j * period // slots[s] <= t < -(-(j + 1) * period // slots[s])
        served[s] += 1
        assert all(abs(served[x] - slots[x] * (t + 1) / period) < 1 for x in slots)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.floats(0.001, 1000), min_size=1, max_size=20), st.integers(20, 400))
def test_quotas(values, period):
    weights = {str(k): v for k, v in enumerate(values)}
    got = mixing.quotas(weights, max(period, 4 * len(weights)))
    assert sum(got.values()) == max(period, 4 * len(weights)) and min(got.values()) >= 1


def test_query_equals_simulation(spark):
    rows = stored("documents")
    got = mixing.schedule(table(spark, SF_SMALL, "documents"), block=2).collect()
    assert sorted(r["doc_id"] for r in got) == [r[0] for r in rows]
    size = Counter(r[3] for r in rows)
    source = {r[0]: r[3] for r in rows}
    slots = mixing.quotas({s: n ** 0.5 for s, n in size.items()}, 1000)
    want = simulate(slots, {s: -(-n // 2) for s, n in size.items()})
    assert all(r["mix_source"] == source[r["doc_id"]] for r in got)
    assert {(r["mix_source"], r["mix_block"]): r["mix_slot"] for r in got} == want
    places = Counter((r["mix_source"], r["mix_block"], r["mix_rank"]) for r in got)
    assert set(places.values()) == {1} and {r["mix_rank"] for r in got} == {0, 1}
    assert all(r["mix_release"] <= r["mix_slot"] < r["mix_deadline"] for r in got)


def test_ranges_do_not_change_ranks(spark, monkeypatch):
    frame = docs(spark, [(i, f"t{i}", "hot" if i % 3 else "cold") for i in range(300)])
    monkeypatch.setattr(mixing, "RANGE_ROWS", 7)
    got = mixing.schedule(frame, weights={"hot": 3, "cold": 1}, block=4, period=4).collect()
    for s, n in (("hot", 200), ("cold", 100)):
        mine = sorted(r["mix_block"] * 4 + r["mix_rank"] for r in got if r["mix_source"] == s)
        assert mine == list(range(n))
    prefix = Counter(r["mix_source"] for r in got if r["mix_slot"] < 40)
    assert prefix == {"hot": 120, "cold": 40}


def test_edge_rows(spark):
    rows = [(i, t, None if k % 2 else "a") for k, (i, t) in enumerate(EDGE)]
    frame = clashing(docs(spark, rows))
    got = mixing.mix(frame)
    assert set(frame.columns) <= set(got.columns)
    assert sorted(((r["doc_id"], r["text"], r["source"]) for r in got.collect()), key=str) == sorted(rows, key=str)
    assert {r["mix_source"] for r in got.collect()} == {"a", None}
    assert mixing.mix(docs(spark, [])).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs(spark, EDGE), weights={"other": 1})


def test_long_schedule_keeps_to_the_unrounded_weights(spark):
    weights = {"a": 0.00012, "b": 2 ** 0.5, "c": 3 ** 0.5, "d": 0.1}
    size = {"a": 2, "b": 5200, "c": 6400, "d": 360}
    rows = [(i, "t", s) for i, s in enumerate(s for s, n in size.items() for _ in range(n))]
    got = mixing.schedule(docs(spark, rows), weights=weights, block=1).collect()
    at = {s: sorted(r["mix_slot"] for r in got if r["mix_source"] == s) for s in size}
    total = sum(weights.values())
    assert len({r["mix_slot"] for r in got}) == len(rows)
    for s, slots in at.items():
        assert len(slots) == size[s]
        for j, t in enumerate(slots):  # j served before slot t, j + 1 after it
            assert abs(j - weights[s] / total * t) < 1 and abs(j + 1 - weights[s] / total * (t + 1)) < 1
