"""Exact repeated-substring removal by distributed prefix doubling.

A byte is removed when it lies in a string of ``span`` bytes that also starts
anywhere else.  Strings are ranked at growing lengths, and positions whose
string has become unique leave:

* Ranks are Karp-Rabin names (64 bits): equal strings have equal names, and
  the name of a longer string follows from the names of its parts, so a
  (rank, rank at an offset) pair needs no lookup.  Spark shuffles and groups
  the names; a group of one is unique.
* The first rounds run on anchors only.  The anchor of a string of ``span``
  bytes is the start of the leftmost of its ``span / 4``-byte pieces with the
  least hash, so equal strings have equal anchors at equal offsets, and an
  anchor stands for a run of string starts (about span * 3/8 of them).
* Round 1 ranks the whole stretch that the starts of an anchor cover.  One
  representative of each rank goes on; where the rank occurs at two places, all
  its strings are repeats.
* Round 2 ranks anchors at 5/8 of the length: the piece with what follows
  (strings that reach far to the right of it), and with what comes before
  (the others).  A rank held by one representative is unique and leaves; one
  whose representatives are all repeats already is settled.
* Round 3 ranks what remains at 9/10 of the length, by the same rule: an anchor's starts in
  eight cells by their distance from it, each named by the bytes that all its strings share.
* Round 4 ranks the remaining starts at the full length.

No position's text is compared in a group, and no group is gathered: every
round is a count by name and a join back.  Names that decide about a byte
(rounds 1 and 4) go with a second, independent hash of the same string, 96 bits together;
those of rounds 2 and 3 only choose what round 4 looks at.

Copies come first: a text of ``span`` bytes and more that occurs twice is
removed as a whole, in each of its rows, whatever the rounds find, and only one of its ids takes part in
rounds 3 and 4; its runs are gathered as a set.  So time grows with the rows, however many are equal.

Defined cases: null text is empty; a text shorter than ``span`` keeps all its
bytes; matches never cross rows, and a repeated row is another place, so both
lose the repeat; null ids are carried.  A text's key is a 64-bit hash, the same in
every pass; that no two texts share one is checked by their MD5, and where two do, the next seed is taken.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.llm.common import keyed
from contrail.session import cut_lineage

SPAN = 400
#: Bytes of a text that are hashed at once.
SEGMENT = 1 << 20
#: Bytes of short texts that are hashed together.
BLOCK = 1 << 15
LOW = np.uint64(SEGMENT - 1)
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd
#: For the second hash.
OTHER = np.uint64(0xC2B2AE3D27D4EB4F)
BYTES = np.random.default_rng(42).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MORE_BYTES = np.random.default_rng(43).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def powers(n: int, base: np.uint64 = BASE) -> tuple[np.ndarray, np.ndarray]:
    """base ** 0..n and the inverses."""
    size = 1 << max(12, n.bit_length())
    if (size, int(base)) not in _powers:
        _powers[size, int(base)] = tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, b))])
                                         for b in (base, np.uint64(pow(int(base), -1, 1 << 64))))
    return _powers[size, int(base)]


class Names:
    """Karp-Rabin names of the substrings of one segment of bytes, or of 64-bit names."""

    def __init__(self, data: np.ndarray, base: np.uint64 = BASE, values: np.ndarray = BYTES):
        up, self.down = powers(len(data), base)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((values[data] if data.dtype == np.uint8 else data) * up[:len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        value = (self.sums[end] - self.sums[start]) * self.down[start]
        return _mix(value + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def all_of(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return _mix((self.sums[length:] - self.sums[:n]) * self.down[:n])


def checks(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """32 bits of the second hash of the strings from ``start`` to ``end``."""
    return (Names(data, OTHER, MORE_BYTES).of(start, end) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def window_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours (two running minima over blocks)."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def segments(data: np.ndarray, span: int) -> Iterator[tuple[int, np.ndarray]]:
    """Stretches so that every string of ``span`` bytes lies in exactly one."""
    step = SEGMENT - span
    for at in range(0, len(data) - span + 1, step):
        yield at, data[at:at + step + span - 1]


def anchors(data: np.ndarray, span: int, cores: bool = True, starts: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Runs of string starts with one anchor: lo, hi (both inclusive), names
    of the whole stretch, of the right and the left core (0: no such start), second hash of the stretch.
    Without ``cores`` the cores are 0.  ``starts``: where the strings of several texts, one
    after the other in one segment, start; otherwise ``data`` is one text."""
    piece = max(1, span // 4)
    half = (span - piece) // 2
    out = []
    for at, part in segments(data, span):
        names = Names(part)
        order = (names.all_of(piece) & ~LOW) | np.arange(len(part) - piece + 1, dtype=np.uint64)
        where = (window_least(order, span - piece + 1) & LOW).astype(np.int64)
        if starts is not None:
            where = where[starts]  # an anchor lies in the text of its strings, so no run goes on in the next
        lo = np.flatnonzero(np.r_[True, where[1:] != where[:-1]])
        hi = np.r_[lo[1:], len(where)] - 1
        a = where[lo]
        if starts is not None:
            lo, hi = starts[lo], starts[hi]
        right, left = hi >= a - half, lo < a - half
        r, x = np.zeros(len(a), np.uint64), np.zeros(len(a), np.uint64)
        if cores:
            r[right] = names.of(a[right], a[right] + span - half)
            x[left] = names.of(a[left] - half - 1, a[left] + piece)
        out.append((lo + at, hi + at, a + at, names.of(lo, hi + span), r, x, checks(part, lo, hi + span)))
    return tuple(map(np.concatenate, zip(*out))) if out else (
        (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 3 + (np.zeros(0, np.int32),))


@F.pandas_udf(T.BinaryType())
def _packed(texts: pd.Series) -> pd.Series:
    """Texts compressed for the shuffles of the two joins that move them."""
    pack = zstandard.ZstdCompressor(level=4).compress
    return texts.map(lambda t: pack(t.encode("utf-8", "surrogatepass")))


def _blocks(texts: list[bytes]) -> Iterator[list[int]]:
    """Indices of texts that are hashed together: short ones up to BLOCK bytes, a long one alone."""
    held, size = [], 0
    for k, text in enumerate(texts):
        if held and size + len(text) > BLOCK:
            yield held
            held, size = [], 0
        held.append(k)
        size += len(text)
    if held:
        yield held


def _anchor_rows(span: int, cores: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [text.encode("utf-8", "surrogatepass") for text in batch["text"]]
            long = [k for k, text in enumerate(texts) if len(text) >= span]
            texts, rows, parts = [texts[k] for k in long], batch["row"].to_numpy()[long], []
            for block in _blocks(texts):
                data = np.frombuffer(b"".join([texts[k] for k in block]), np.uint8)
                ends = np.cumsum([len(texts[k]) for k in block])
                begins = np.r_[0, ends[:-1]]
                if len(block) == 1:
                    found = anchors(data, span, cores)
                else:
                    found = anchors(data, span, cores, np.concatenate([np.arange(a, b - span + 1) for a, b in zip(begins, ends)]))
                text = np.searchsorted(ends, found[0], side="right")
                parts.append((rows[block][text], *(c - begins[text] for c in found[:3]), *found[3:]))
            if parts:
                columns = [np.concatenate(c) for c in zip(*parts)]
                names = [c.view(np.int64) for c in columns[4:7]]
                yield pd.DataFrame({"row": columns[0], "lo": columns[1], "hi": columns[2], "a": columns[3],
                                    "whole": names[0], "right": names[1], "left": names[2], "check": columns[7]})
    return run


def cells(lo: int, hi: int, a: int, span: int) -> Iterator[tuple[int, int, int, int]]:
    """The starts ``lo`` to ``hi`` of anchor ``a`` by their distance from it, in cells of an
    eighth of all distances: first and last start, and where the bytes that
    all strings of the whole cell share begin and end."""
    most = span - max(1, span // 4)
    width = most // 8 + 1
    for p in range((a - hi) // width * width, a - lo + 1, width):
        q = min(p + width - 1, most)
        yield max(lo, a - q), min(hi, a - p), a - p, a - q + span


def _many(parts: list[tuple]) -> bool:
    """Whether the rows of several texts are enough for a frame."""
    return len(parts) >= 64 or bool(parts) and len(parts[-1][0]) > BLOCK


def _frame(parts: list[tuple], columns: list[str]) -> pd.DataFrame:
    return pd.DataFrame(dict(zip(columns, map(np.concatenate, zip(*parts)))))


def _cell_rows(span: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            unpack, out = zstandard.ZstdDecompressor().decompress, []
            for row, packed, runs in zip(batch["row"], batch["packed"], batch["runs"]):
                data = np.frombuffer(unpack(packed), np.uint8)
                found = np.array(sorted({(*c, r["n"]) for r in runs for c in cells(r["lo"], r["hi"], r["a"], span)}), np.int64)
                lo = found[:, 0]
                for at, part in segments(data, span):  # the first string of a cell holds the common bytes
                    mine = found[(lo >= at) & (lo <= at + len(part) - span)]
                    if len(mine):
                        names = Names(part).of(mine[:, 2] - at, mine[:, 3] - at).view(np.int64)
                        out.append((np.full(len(mine), row), mine[:, 0], mine[:, 1], mine[:, 4], names))
                if _many(out):
                    yield _frame(out, ["row", "lo", "hi", "n", "name"])
                    out = []
            if out:
                yield _frame(out, ["row", "lo", "hi", "n", "name"])
    return run


def _start_rows(span: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            unpack, out = zstandard.ZstdDecompressor().decompress, []
            for row, packed, runs in zip(batch["row"], batch["packed"], batch["runs"]):
                data = np.frombuffer(unpack(packed), np.uint8)
                wanted = np.unique(np.concatenate([np.arange(r["lo"], r["hi"] + 1) for r in runs]))
                for at, part in segments(data, span):
                    mine = wanted[(wanted >= at) & (wanted <= at + len(part) - span)] - at
                    if len(mine):
                        out.append((np.full(len(mine), row), mine + at, Names(part).of(mine, mine + span).view(np.int64),
                                    checks(part, mine, mine + span)))
                if _many(out):
                    yield _frame(out, ["row", "i", "name", "check"])
                    out = []
            if out:
                yield _frame(out, ["row", "i", "name", "check"])
    return run


def remove(data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[int, int, bytes]:
    """Bytes removed, maximal removed runs, and what is left."""
    if not len(starts):
        return 0, 0, data
    edge = np.bincount(starts, minlength=len(data) + 1) - np.bincount(ends, minlength=len(data) + 1)
    gone = np.cumsum(edge)[:len(data)] > 0
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return int(gone.sum()), spans, np.frombuffer(data, np.uint8)[~gone].tobytes()


def _result_rows(span: int):
    nothing = hashlib.sha256().hexdigest()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            unpack = zstandard.ZstdDecompressor().decompress
            for doc, size, packed, runs in zip(*(batch[c] for c in ("doc_id", "n_bytes", "packed", "runs"))):
                runs = [] if runs is None else list(runs)
                if any(r["lo"] < 0 for r in runs):
                    if size >= span:
                        out.append((doc, size, size, 1, nothing))
                        continue
                    runs = []
                starts = np.array([r["lo"] for r in runs], np.int64)
                gone, spans, rest = remove(unpack(packed), starts, np.array([r["hi"] for r in runs], np.int64) + span)
                out.append((doc, size, gone, spans, hashlib.sha256(rest).hexdigest()))
            frame = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
            yield frame.astype({"doc_id": "Int64"})
    return run


def repeated_starts(texts: DataFrame, copies: DataFrame, span: int = SPAN) -> DataFrame:
    """(row, lo, hi): runs of the starts of strings that also start elsewhere;
    a run may come repeatedly.  ``texts``: row (equal only where the texts are, too),
    doc_id, text; ``copies``: row and one doc_id of the texts that occur twice.

    A count counts each copy, so in a text with copies all strings are repeats, as they are."""
    def found(cores: bool) -> DataFrame:
        return texts.select("row", "text").mapInPandas(
            _anchor_rows(span, cores), "row long, lo long, hi long, a long, whole long, `right` long, `left` long, check int")

    # round 1: the whole stretch of an anchor
    wholes = cut_lineage(found(True).groupBy("whole", "check").agg(
        F.count("*").alias("n"), F.min(F.struct("row", "lo", "hi", "a", "right", "left")).alias("first")))
    twice = wholes.filter("n > 1").select("whole", "check")
    settled = found(False).select("row", "lo", "hi", "whole", "check").join(twice, ["whole", "check"]).select("row", "lo", "hi")
    # round 2: 5/8 of the length, one representative of each stretch
    half = (span - max(1, span // 4)) // 2
    sides = wholes.select("n", "first.*").select("n", "row", "lo", "hi", "a", F.inline(F.array(
        F.struct(F.lit(1).alias("side"), F.col("right").alias("name")),
        F.struct(F.lit(0).alias("side"), F.col("left").alias("name"))))).filter("name != 0")
    open_names = sides.groupBy("side", "name").agg(F.count("*").alias("c"), F.min("n").alias("least")).filter(
        "c > 1 and least = 1").select("side", "name")
    split = F.col("a") - half
    rest = sides.join(open_names, ["side", "name"]).select(
        "row", "a", "n", F.when(F.col("side") == 1, F.greatest("lo", split)).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("side") == 1, F.col("hi")).otherwise(F.least("hi", split - 1)).alias("hi"))
    # round 3: cells of an eighth of the starts of an anchor, at 9/10 of the length; in one row of each text
    packed = texts.select("row", "doc_id", _packed("text").alias("packed"))
    one = copies.withColumnRenamed("doc_id", "one")

    def read(runs: DataFrame) -> DataFrame:
        wanted = runs.groupBy("row").agg(F.collect_list("run").alias("runs")).join(one, "row", "left")  # of one text
        return packed.join(wanted, "row").filter("one is null or doc_id is null or doc_id = one").select("row", "packed", "runs")

    parts = cut_lineage(read(rest.select("row", F.struct("lo", "hi", "a", F.least("n", F.lit(2)).alias("n")).alias("run")))
                        .mapInPandas(_cell_rows(span), "row long, lo long, hi long, n long, name long"))
    open_parts = parts.groupBy("name").agg(F.count("*").alias("c"), F.min("n").alias("least")).filter("c > 1 and least = 1")
    left = parts.join(open_parts.select("name"), "name").select("row", F.struct("lo", "hi").alias("run"))
    # round 4: the remaining starts at the full length
    starts = cut_lineage(read(left).mapInPandas(_start_rows(span), "row long, i long, name long, check int"))
    again = starts.groupBy("name", "check").agg(F.count("*").alias("n")).filter("n > 1").select("name", "check")
    return settled.unionByName(starts.join(again, ["name", "check"]).select("row", F.col("i").alias("lo"), F.col("i").alias("hi")))


def text_keys(docs: DataFrame, key=lambda seed: F.xxhash64(F.lit(seed), "text")) -> tuple[DataFrame, DataFrame]:
    """``docs`` with ``row``, a key that two texts never share, and (row, least doc_id) of the texts that occur twice."""
    for seed in range(100):
        rows = docs.withColumn("row", key(seed))
        seen = cut_lineage(rows.groupBy("row").agg(
            F.count("*").alias("n"), F.min("doc_id").alias("doc_id"), F.min(F.md5("text")).alias("one"), F.max(F.md5("text")).alias("two")).filter("n > 1"))
        if seen.filter("one != two").isEmpty():
            return rows, seen.select("row", "doc_id")
    raise RuntimeError("text_keys: texts that differ share their keys under every seed")


def remove_repeats(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row."""
    rows, copies = text_keys(keyed(docs))
    whole = F.lit(-1).cast("bigint")  # marks the texts that go as a whole
    runs = (repeated_starts(rows, copies, span)
            .unionByName(copies.select("row", whole.alias("lo"), whole.alias("hi")))
            .groupBy("row").agg(F.collect_set(F.struct("lo", "hi")).alias("runs")))  # of one text
    packed = rows.select("doc_id", "row", F.octet_length("text").cast("bigint").alias("n_bytes"), _packed("text").alias("packed"))
    return packed.join(runs, "row", "left").mapInPandas(
        _result_rows(span), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
