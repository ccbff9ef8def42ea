"""SimHash near-duplicates by a segment-popcount embedding.

1. Each text's word shingles are hashed with XXH64; a fingerprint bit is set
   when it is set in over half of the hashes.
2. A fingerprint is embedded as the bit counts of its 32 two-bit segments,
   stored in unary (0 -> 00, 1 -> 01, 2 -> 11), so that the Manhattan
   distance of two vectors is ``bit_count(a xor b)``.  One flipped
   fingerprint bit moves one count by one, so that distance is a lower bound
   of the Hamming distance.
3. Grid: the segments are dealt to ``distance + 3`` groups.  Vectors within
   Manhattan distance ``distance`` differ in at most ``distance`` groups, so
   they agree on three whole groups at least.  Every choice of three groups
   is one grid, and a vector falls in one cell of each.
4. Distinct fingerprints are joined on (grid, cell); a pair is kept only in
   the first grid it shares, if the Manhattan bound holds, and after the
   exact distance check.  Copies with equal fingerprints are one node.

Defined cases: null text is empty; no word gives fingerprint zero, linked like
any other; null ids are kept (they count last when the smallest id is taken; null if
there is no other); repeated rows are returned as often as they come.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import all_columns, body, keyed, unused
from contrail.llm.components import components
from contrail.session import cut_lineage

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SEED = 42
CHUNK = 1 << 16


def fingerprint(text: str, shingle: int = 4) -> int:
    """64-bit SimHash of the word shingles, unsigned."""
    words = WORD.findall(text.translate(LOWER).encode("utf-8", "surrogatepass"))
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    pairs = zip(starts[:n].tolist(), ends[len(words) - n:].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in pairs], dtype=">u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, CHUNK):
        part = hashes[at:at + CHUNK]
        ones += np.unpackbits(part.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(shingle: int):
    @F.pandas_udf("bigint")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))
    return run


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def embedding(fp: Column) -> Column:
    """Unary bit counts of the 32 two-bit segments of a fingerprint."""
    low = F.lit(0x5555555555555555)
    high = F.shiftrightunsigned(fp, 1)
    return fp.bitwiseOR(high).bitwiseAND(low).bitwiseOR(F.shiftleft(fp.bitwiseAND(high).bitwiseAND(low), 1))


def _groups(distance: int) -> list[int]:
    """Masks over the 32 segments, dealt to distance + 3 groups."""
    n = min(32, distance + 3)
    return [sum(3 << 2 * s for s in range(32) if s * n // 32 == g) for g in range(n)]


def links(nodes: DataFrame, distance: int = 4) -> DataFrame:
    """(u, v) of all distinct fingerprints ``fp`` at most ``distance`` bits
    apart, u < v, each pair once."""
    if not 0 <= distance <= 29:
        raise ValueError("distance: 0 to 29")
    masks = _groups(distance)
    grids = list(combinations(range(len(masks)), 3))
    cells = F.array(*[F.struct(F.lit(k).cast("smallint").alias("grid"), F.lit(max(g)).cast("smallint").alias("last"),
                               F.col("t").bitwiseAND(F.lit(_signed(sum(masks[i] for i in g)))).alias("cell"))
                      for k, g in enumerate(grids)])
    placed = (nodes.select("fp", embedding(F.col("fp")).alias("t"))
              .select("fp", F.inline(cells)).select("grid", "last", "cell", "fp"))
    a, b = placed.alias("a"), placed.alias("b")
    moved = embedding(F.col("a.fp")).bitwiseXOR(embedding(F.col("b.fp")))
    same = sum(((F.col("a.last") >= g) & (moved.bitwiseAND(F.lit(_signed(m))) == 0)).cast("int")
               for g, m in enumerate(masks))
    # the planner takes the cells of all grids for as many bytes as the stored fingerprints, and would broadcast them
    return (a.join(b.hint("merge"), (F.col("a.grid") == F.col("b.grid")) & (F.col("a.cell") == F.col("b.cell"))
                   & (F.col("a.fp") < F.col("b.fp"))
                   & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= distance)
                   & (F.bit_count(moved) <= distance) & (same == 3))
            .select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v")))


def classes(prints: DataFrame, distance: int = 4) -> DataFrame:
    """(fp, root, component_id): for every distinct ``fp`` of ``prints``
    (doc_id, fp) its component and the smallest id in it."""
    nodes = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(nodes, distance))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def near_classes(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row."""
    prints = cut_lineage(keyed(docs).select("doc_id", fingerprints(shingle)("text").alias("fp")))
    return prints.join(classes(prints, distance), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """One row of each near-duplicate group, all columns unchanged: the one
    with the smallest id (of rows repeated with that id, the first stored).

    The rows are numbered once, in a written copy that both passes read.
    Groups are found on ids, row numbers and fingerprints alone; whole rows move once, in the
    last join."""
    row = unused("row", docs)
    numbered = cut_lineage(docs.withColumn(row, F.monotonically_increasing_id()))
    prints = cut_lineage(numbered.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(row).alias("row"),
                                         fingerprints(shingle)(body()).alias("fp")))
    first = prints.groupBy("fp").agg(F.min(F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("i"),
                                                    "row")).alias("first"))
    owned = classes(prints, distance).join(first, "fp")
    kept = owned.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias(row))
    return numbered.join(kept, row, "left_semi").select(*all_columns(docs))
