"""Document fingerprints by randomised edit embedding.

A walk reads a text character by character; at every step one shared random
bit of (character, step) says whether it moves on, so each character is
written for a random number of steps.  Texts a few edits apart fall back into
step after an edit, so edit distance becomes Hamming distance between the
written strings.  The fingerprint samples the written string at fixed steps,
``SAMPLES`` in each octave of steps (all of the first), as one hex digit
of (step, character) each; its length follows the text's.  The likeness of two
fingerprints is one less the share of differing samples, each weighted by the
steps it stands for; steps that only one text has differ.

``near_classes`` goes on to near copies: fingerprints are banded by
sampled digits, each bucket is joined to one member (never pair by pair), links
are verified by likeness, and members unlike that one meet others.

Defined cases: null text is empty; the empty text's fingerprint is empty, and
two empty ones are fully alike; documents are ordered by (doc_id, text) with
null ids first, so rows repeated with one id follow each other; a single
document is its own successor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.llm.common import keyed
from contrail.llm.components import components
from contrail.session import cut_lineage

SAMPLES = 64
CYCLE = 1024  # the random bits repeat after so many steps
MORE_DIGITS = 2  # samples by which a key grows for what is unlike its hub
KINDS = 256  # characters share bits modulo a hash
#: Documents of one id range, on average, and the most ranges.
RANGE_ROWS, MOST_RANGES = 500, 20_000


def _walk_table() -> list[int]:
    """Steps that a character stays, by (kind, step modulo CYCLE)."""
    moves = np.random.default_rng(5).integers(0, 2, (KINDS, CYCLE), dtype=np.int64)
    moves[:, -1] = 1
    stay = np.ones((KINDS, CYCLE), np.int64)
    for j in range(CYCLE - 2, -1, -1):
        stay[:, j] = np.where(moves[:, j] == 1, 1, stay[:, j + 1] + 1)
    return stay.ravel().tolist()


STAY = _walk_table()


def _sample_steps(octaves: int = 48) -> tuple[np.ndarray, np.ndarray]:
    """The sampled steps in order and how many steps each stands for."""
    rng, first = np.random.default_rng(6), SAMPLES.bit_length() - 1
    steps, weights = list(range(SAMPLES)), [1.0] * SAMPLES
    for k in range(first, first + octaves - 6):
        steps += sorted(int(x) for x in (1 << k) + rng.integers(0, 1 << k, SAMPLES))
        weights += [(1 << k) / SAMPLES] * SAMPLES
    return np.array(steps), np.array(weights)


STEPS, WEIGHTS = _sample_steps()
#: The hex digit (as ASCII) of each kind at each sampled step.
DIGITS = np.frombuffer(b"0123456789abcdef", np.uint8)[np.random.default_rng(7).integers(0, 16, (KINDS, len(STEPS)))]


def kinds(text: str) -> np.ndarray:
    """Offset of each character's row in the walk table."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    return (codes * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(56)).astype(np.int64) * CYCLE


def walk(codes: list[int], step: int = 0) -> list[int]:
    """The step after each character."""
    stay, mask = STAY, CYCLE - 1
    return [step := step + stay[c + (step & mask)] for c in codes]


def sampled(codes: np.ndarray, ends: list[int], first: int = 0) -> str:
    """The digits of the samples from ``first`` on that these characters hold."""
    if not ends:
        return ""
    last = int(np.searchsorted(STEPS, ends[-1]))
    at = np.searchsorted(np.array(ends), STEPS[first:last], side="right")
    return DIGITS[codes[at] // CYCLE, np.arange(first, last)].tobytes().decode()


def fingerprint(text: str) -> str:
    codes = kinds(text)
    return sampled(codes, walk(codes.tolist()))


def likeness(a: str, b: str) -> float:
    """0 to 1; 1 for equal fingerprints."""
    m, n = sorted((len(a), len(b)))
    if not n:
        return 1.0
    x, y = (np.frombuffer(s[:m].encode(), np.uint8) for s in (a, b))
    return float(WEIGHTS[:m] @ (x == y) / WEIGHTS[:n].sum())


class _Document:
    """A document with its walk, until its successor is known."""

    def __init__(self, doc_id, text: str):
        self.doc_id, self.text, self.codes = doc_id, text, kinds(text)
        self.ends = walk(self.codes.tolist())
        self.print = sampled(self.codes, self.ends)

    def row(self, following: "_Document") -> tuple:
        """The edited text is walked on from where its kept part ends."""
        n = len(self.text)
        kept, half = n - n // 2, n // 2
        more = following.codes[:half]
        step = self.ends[kept - 1] if kept else 0
        first = int(np.searchsorted(STEPS, step))
        edited = self.print[:first] + sampled(more, walk(more.tolist(), step), first)
        digest = hashlib.sha256((self.text[:kept] + following.text[:half]).encode("utf-8", "surrogatepass")).hexdigest()
        return (self.doc_id, n, digest, self.print, edited, likeness(self.print, edited),
                likeness(self.print, following.print))


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _follow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come by range, then order; a range's last row is the next range's
    first (``tail``), which only ends the one before."""
    last, part = None, None
    for batch in batches:
        out = []
        for key, tail, doc_id, text in zip(batch["part"], batch["tail"], batch["doc_id"], batch["text"]):
            if key != part:
                last, part = None, key
            if tail and last is None:
                continue  # further rows of the next range's first id
            now = _Document(doc_id, text)
            if last is not None:
                out.append(last.row(now))
            last = None if tail else now
        yield pd.DataFrame(out, columns=COLUMNS).astype({"doc_id": "Int64"})


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every text and of its edited text (its last half taken
    from its successor by id), with their likenesses.

    Texts move once, to the range of their id; the first document of each
    range also goes to the range before.  Ranges hold about RANGE_ROWS rows
    by the quantiles of the ids and are read in order, row by row."""
    spark = docs.sparkSession
    rows = keyed(docs).withColumn("key", F.coalesce("doc_id", F.lit(-(1 << 63))))
    n = rows.count()
    ranges = min(MOST_RANGES, max(1, -(-n // RANGE_ROWS)))
    cuts = np.zeros(0, np.int64)
    if ranges > 1:
        shares = [k / ranges for k in range(1, ranges)]
        cuts = np.unique(rows.agg(F.percentile_approx("key", F.array(*map(F.lit, shares)), 4 * ranges)).first()[0])

    @F.pandas_udf(T.LongType())
    def part(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, keys.to_numpy(), side="right"))

    placed = rows.withColumn("part", part("key"))
    firsts = sorted(map(tuple, placed.groupBy("part").agg(F.min("key").alias("key")).collect()))  # a row per range
    before = spark.createDataFrame([(key, firsts[k - 1][0]) for k, (_, key) in enumerate(firsts)],
                                   "key long, before long")
    targets = F.array(F.struct("part", F.lit(0).alias("tail")),
                      F.struct(F.col("before").alias("part"), F.lit(1).alias("tail")))
    sent = (placed.join(F.broadcast(before), "key", "left").select("key", "doc_id", "text", F.inline(targets))
            .filter("part is not null"))
    return (sent.repartition("part").sortWithinPartitions("part", "tail", "key", "text")
            .select("part", "tail", "doc_id", "text")
            .mapInPandas(_follow, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                  "edited_fingerprint string, near_edited double, near_next double"))


def near_classes(prints: DataFrame, least: float = 0.8, digits: int = 8) -> DataFrame:
    """(fingerprint, class_id) for ``prints`` (doc_id, fingerprint): near
    copies by banding and verification; class_id is the smallest id linked.

    Bands of ``digits`` samples from the two largest octaves that a text reaches
    are the keys.  Each distinct fingerprint is joined to one of its bucket,
    drawn by a hash of both, so that every band has a hub of its own; links of
    likeness ``least`` or more stay.  What is unlike its hub goes on with a
    key longer by ``MORE_DIGITS`` samples and is compared with another hub, round by
    round until no bucket holds two: a bucket loses its hub in each round, and a
    frequent one falls apart, so pairs do not grow with the square of its size."""
    width = SAMPLES // digits

    def top(p: str) -> int:
        return max(0, (len(p) - 1) // SAMPLES * SAMPLES - SAMPLES)  # the two largest octaves that it reaches

    @F.pandas_udf("array<struct<at:int,band:string>>")
    def bands(values: pd.Series) -> pd.Series:
        return values.map(lambda p: [{"at": k, "band": f"{k}:{p[k:k + digits]}"}
                                     for k in range(top(p), len(p), digits)][:2 * width])

    @F.pandas_udf(T.StringType())
    def further(values: pd.Series, ats: pd.Series, rounds: pd.Series) -> pd.Series:
        """The samples that follow a band, in a circle through its octaves; none once all are in the key."""
        def after(p: str, at: int, done: int) -> str:
            window = p[top(p):]
            k = digits + MORE_DIGITS * done
            return (window[at - top(p):] + window[:at - top(p)])[k:k + MORE_DIGITS]
        return pd.Series([after(*r) for r in zip(values, ats, rounds)], dtype=object)

    @F.pandas_udf(T.DoubleType())
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([likeness(x, y) for x, y in zip(a, b)], dtype=float)

    nodes = cut_lineage(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
                        .withColumn("node", F.xxhash64("fingerprint")))
    a = nodes.select("node", F.col("fingerprint").alias("a"))
    b = nodes.select(F.col("node").alias("hub"), F.col("fingerprint").alias("b"))
    placed = cut_lineage(nodes.select("node", F.inline(bands("fingerprint"))).select(
        "node", "at", F.xxhash64("band").alias("key")))
    edges, done = None, 0
    while True:
        hubs = placed.groupBy("key").agg(F.min_by("node", F.xxhash64("node", "key")).alias("hub"),
                                         F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
        met = cut_lineage(placed.join(hubs, "key").filter("node != hub"))
        if met.isEmpty():
            break
        judged = cut_lineage(met.select("node", "hub").distinct().join(a, "node").join(b, "hub").select(
            "node", "hub", (alike("a", "b") >= least).alias("near")))
        found = judged.filter("near").select(F.col("node").alias("u"), F.col("hub").alias("v"))
        edges = found if edges is None else edges.unionByName(found)
        unlike = met.join(judged.filter("not near"), ["node", "hub"]).join(a, "node")
        placed = cut_lineage(unlike.select("node", "at", F.xxhash64("key", further("a", "at", F.lit(done))).alias("key")))
        done += 1
    if edges is None:
        return nodes.select("fingerprint", F.col("least").alias("class_id"))
    roots = components(edges)
    rooted = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("class_id"))
    return rooted.join(ids, "root").select("fingerprint", "class_id")
