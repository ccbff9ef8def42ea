"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters has an error budget e = floor(rate * m).  Cut into
e + 1 pieces, at least one piece of an occurrence with at most e edits is
untouched.  One Aho-Corasick automaton over all pieces finds the exact piece
hits of a text; the window that a hit allows is then verified with Myers'
bit-parallel distance (any start, any end).  Letter case A-Z and the kind of
white space don't count as edits.

The test set is taken in blocks of bounded size (``BLOCK_CHARS`` characters):
each block's automaton goes to the executors, so what is sent has a bound
however large the benchmark is; the documents are scanned once per block.

Defined cases: null or blank items match nothing; an item of fewer characters
than 1/rate needs an exact hit; null text is empty; equal items are reported
each under its own id; repeated document rows are matched one by one.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.llm.common import body, keyed

#: Characters of test items in one automaton (about 100 bytes of it each).
BLOCK_CHARS = 1_000_000
RATE = 0.08
FOLD = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"} | dict.fromkeys(map(ord, "\t\n\v\f\r "), " ")
MATCH = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("distance", T.IntegerType()),
                                  T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def fold(text: str) -> str:
    """Same length, so positions in it are positions in the text."""
    return text.translate(FOLD)


def cut(item: str, rate: float) -> tuple[int, list[tuple[int, str]]]:
    """The error budget and (offset, piece) of its budget + 1 pieces."""
    m = len(item)
    budget = min(int(rate * m), m - 1)
    at = [k * m // (budget + 1) for k in range(budget + 2)]
    return budget, [(a, item[a:b]) for a, b in zip(at, at[1:])]


def scan(pattern_bits: dict[str, int], m: int, text, most: int) -> tuple[int, int]:
    """(least distance, last position + 1 of its first occurrence) of a
    pattern in ``text`` with any start and end; distance over ``most``: none."""
    full, high = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, where = most + 1, -1
    for j, c in enumerate(text):
        eq = pattern_bits.get(c, 0)
        vert = eq | down
        hor = (((eq & up) + up) ^ up) | eq
        plus, minus = down | (full & ~(hor | up)), up & hor
        if plus & high:
            score += 1
        elif minus & high:
            score -= 1
        plus, minus = plus << 1, minus << 1
        up, down = (minus | ~(vert | plus)) & full, plus & vert & full
        if score < best:
            best, where = score, j + 1
    return best, where


def bits(pattern: str) -> dict[str, int]:
    out: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        out[c] |= 1 << i
    return dict(out)


class Matcher:
    """The automaton and patterns of one block of test items."""

    def __init__(self, items: list[tuple[int, str]], rate: float = RATE):
        self.items, pieces = [], defaultdict(list)
        for item_id, text in items:
            folded = fold(text or "").strip()
            if folded:
                budget, cuts = cut(folded, rate)
                for offset, piece in cuts:
                    pieces[piece].append((len(self.items), offset))
                self.items.append((item_id, folded, budget, bits(folded), bits(folded[::-1])))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in pieces.items():
            self.automaton.add_word(piece, (len(piece), owners))
        self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, start, end) of the best occurrence of each
        item within its budget; positions in code points, end exclusive."""
        if not self.items or not text:
            return []
        folded, windows = fold(text), defaultdict(list)
        for last, (size, owners) in self.automaton.iter(folded):
            for k, offset in owners:
                windows[k].append(last + 1 - size - offset)
        found = []
        for k, starts in windows.items():
            item_id, item, budget, forward, backward = self.items[k]
            m, best, reach = len(item), None, -1
            for start in sorted(set(starts)):
                if best and not best[0]:
                    break
                low, high = max(0, start - budget), min(len(folded), start + m + budget)
                if high <= reach:
                    continue
                reach = high
                distance, end = scan(forward, m, folded[low:high], budget)
                if distance <= budget and (best is None or distance < best[0]):
                    end += low
                    begin = max(0, end - m - distance)
                    _, back = scan(backward, m, folded[begin:end][::-1], distance)
                    best = (distance, end - back, end)
            if best:
                found.append((item_id, *best))
        return sorted(found)


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The test items in blocks; each is collected alone and bounded."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), body().alias("text")).filter(
        F.trim("text") != "")
    total = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    n = -(-total // BLOCK_CHARS)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(n, 1)))
    for k in range(n):
        yield [(r["item_id"], r["text"]) for r in items.filter(block == k).orderBy("item_id", "text").collect()]


def matching(matcher: Matcher):
    names = MATCH.elementType.names

    @F.pandas_udf(MATCH)
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [dict(zip(names, x)) for x in matcher.find(t)])
    return run


def contaminations(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """doc_id, item_id, distance, span_start, span_end: the best occurrence
    of every test item in every document that has one."""
    texts, out = keyed(docs), None
    for items in _blocks(benchmark):
        part = texts.select("doc_id", F.inline(matching(Matcher(items, rate))("text")))
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = texts.limit(0).select("doc_id", *[F.lit(0).cast(t).alias(n) for n, t in (
            ("item_id", "bigint"), ("distance", "int"), ("start", "int"), ("end", "int"))])
    return out.withColumnsRenamed({"start": "span_start", "end": "span_end"})


def keep_clean(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows of ``docs`` without any occurrence, all columns unchanged."""
    for items in _blocks(benchmark):
        docs = docs.filter(F.size(matching(Matcher(items, rate))(body())) == 0)
    return docs
