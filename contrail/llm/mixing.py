"""Mixing sources to target weights by Pfair scheduling.

The documents of each source, in a seeded random order, form blocks of
``block`` documents.  With weight w, block j = 0, 1, ... of a source has
release time floor(j / w) and deadline ceil((j + 1) / w); one block is served
per time slot, the released one with the earliest deadline.  Weights are taken as they
are, in whole-number arithmetic, and the schedule is worked out block by block on the driver: a few
numbers for every ``block`` documents.
After any number of slots each source has been served within less than one
block of its target, as long as it has blocks; a slot in which no block is released
stays empty, and no row is dropped or repeated.

The rank of a document in its source is a count over hash ranges plus a rank
inside one range, so no source is ordered in one task, however large.

Target weights are given per source, or default to the square root of the
source's document count (over all rows).  Only the table of sources, not
documents, reaches the driver (which makes the table of blocks); more than ``MAX_SOURCES`` of them is an error.

Defined cases: a null source is a source of its own; null ids and texts are
carried; repeated rows each get a place; no rows give no rows; a given weight
of a source without rows is ignored, a source without a given weight is an error.
Columns of the input named like the added ones are replaced.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping
from fractions import Fraction
from math import lcm

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import all_columns
from contrail.session import cut_lineage

MAX_SOURCES = 10_000
#: Rows of one source that one rank window holds, on average.
RANGE_ROWS = 1_000
ADDED = ("mix_source", "mix_block", "mix_release", "mix_deadline", "mix_slot", "mix_rank")


def quotas(weights: Mapping, period: int) -> dict:
    """Slots of each source in a period: largest remainders, one at least."""
    total = sum(weights.values())
    if not weights or total <= 0 or min(weights.values()) < 0:
        raise ValueError("weights: not negative, and not all zero")
    order = sorted(weights, key=lambda s: (s is None, s or ""))
    exact = {s: weights[s] * period / total for s in order}
    out = {s: max(1, int(exact[s])) for s in order}
    by_rest = sorted(order, key=lambda s: exact[s] - out[s])
    while sum(out.values()) > period:  # the one-at-least rule took too many
        out[max(order, key=lambda s: out[s] - exact[s] if out[s] > 1 else -period)] -= 1
    for s in reversed(by_rest):
        if sum(out.values()) == period:
            break
        out[s] += 1
    out[by_rest[-1]] += period - sum(out.values())
    return out


def serve(weights: Mapping, blocks: Mapping) -> pd.DataFrame:
    """k (source, in the order of ``weights``), j (block), slot, release and deadline of every
    block; sources have ``blocks`` blocks and exactly the shares of ``weights``."""
    exact = [Fraction(w) for w in weights.values()]
    unit = lcm(*(w.denominator for w in exact))
    share, left = [int(w * unit) for w in exact], [blocks[s] for s in weights]
    total = sum(share)
    out = np.empty((5, sum(left)), np.int64)
    waiting = [(0, k, 0) for k, n in enumerate(left) if n]
    ready, t = [], 0
    for place in range(out.shape[1]):
        if not ready and waiting[0][0] > t:
            t = waiting[0][0]
        while waiting and waiting[0][0] <= t:
            release, k, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * total // share[k]), k, j, release))
        deadline, k, j, release = heapq.heappop(ready)
        assert t < deadline
        out[:, place] = k, j, t, release, deadline
        if j + 1 < left[k]:
            heapq.heappush(waiting, ((j + 1) * total // share[k], k, j + 1))
        t += 1
    return pd.DataFrame(dict(zip(("k", "j", "slot", "release", "deadline"), out)))


def earliest_deadline_first(slots: Mapping) -> list[tuple]:
    """(source, block in the period, slot) of one period; the values of
    ``slots`` add up to the period's length."""
    order, plan = list(slots), serve(slots, slots)
    return [(order[k], j, t) for k, j, t in zip(plan["k"], plan["j"], plan["slot"])]


def mix(docs: DataFrame, weights: Mapping | None = None, block: int = 16, period: int = 1000,
        seed: int = 42) -> DataFrame:
    """``docs`` with mix_source, mix_block, mix_release, mix_deadline,
    mix_slot and mix_rank (place in the block): the mix is the rows ordered by
    (mix_slot, mix_rank).  Whole rows move once.  ``period`` no longer matters: weights aren't rounded."""
    spark = docs.sparkSession
    docs = docs.drop(*ADDED)
    draw = F.xxhash64(F.lit(seed), F.col("doc_id").cast("bigint"), F.coalesce(F.col("text"), F.lit("")))
    rows = docs.select(F.col("source").cast("string").alias("__s"), draw.alias("__h"), F.struct(*all_columns(docs)).alias("__row"))

    total = docs.count()
    ranges = max(1, -(-total // RANGE_ROWS))
    part = F.pmod(F.col("__h"), F.lit(ranges)).alias("__p")
    # the same hash from a narrow scan: counts per source and hash range
    counts = cut_lineage(docs.select(F.col("source").cast("string").alias("__s"), draw.alias("__h"))
                         .groupBy("__s", part).agg(F.count("*").alias("n")))
    sizes = {r["__s"]: r["n"] for r in counts.groupBy("__s").agg(F.sum("n").alias("n")).limit(MAX_SOURCES + 1).collect()}
    if len(sizes) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    if weights is None:
        weights = {s: n ** 0.5 for s, n in sizes.items()} or {"": 1.0}
    if missing := [s for s in sizes if not weights.get(s)]:
        raise ValueError(f"no weight for {missing[:5]}")
    weights = {s: w for s, w in weights.items() if s in sizes} or {"": 1.0}
    if min(weights.values()) < 0:
        raise ValueError("weights: not negative")
    weights = {s: weights[s] for s in sorted(weights, key=lambda s: (s is None, s or ""))}
    served = serve(weights, {s: -(-sizes.get(s, 0) // block) for s in weights})
    # written, so that the planner knows its size
    plan = cut_lineage(spark.createDataFrame(served, "__k bigint, __j bigint, __t bigint, __rel bigint, __due bigint"))

    before = Window.partitionBy("__s").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__s", "__p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__o"))
    ranked = (rows.withColumn("__p", part)
              .withColumn("__r", F.row_number().over(Window.partitionBy("__s", "__p").orderBy("__h")) - 1))
    same = ranked["__s"].eqNullSafe(offsets["__s"]) & (ranked["__p"] == offsets["__p"])
    placed = (ranked.join(offsets, same).select(ranked["__s"], "__row", (F.col("__r") + F.col("__o")).alias("__r"))
              .withColumn("__b", F.floor(F.col("__r") / block)))
    share = spark.createDataFrame([(s, k) for k, s in enumerate(weights)], "__s string, __k bigint")
    sized = placed.join(F.broadcast(share), placed["__s"].eqNullSafe(share["__s"])).select(
        placed["__s"], "__row", "__r", "__b", "__k")
    return sized.join(plan, (sized["__k"] == plan["__k"]) & (sized["__b"] == plan["__j"])).select(
        "__row.*", sized["__s"].alias("mix_source"), F.col("__b").alias("mix_block"),
        F.col("__rel").alias("mix_release"), F.col("__due").alias("mix_deadline"),
        F.col("__t").alias("mix_slot"), (F.col("__r") % block).alias("mix_rank"))


def schedule(docs: DataFrame, **options) -> DataFrame:
    """doc_id with its place in the mix, without the texts."""
    return mix(docs, **options).select("doc_id", *ADDED)
