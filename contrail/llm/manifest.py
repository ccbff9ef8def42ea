"""Merkle manifest of a dataset, with a membership proof for every row.

Every row is a leaf: the SHA-256 of its columns, each written as its UTF-8
length, a colon and its value (``-`` for null).  The leaves of one language,
in ascending ``doc_id``, are the bottom of a binary tree; the language
subroots, in the bytewise order of the languages (null first), are the bottom
of one more tree, whose top is the root.  A node is the SHA-256 of the hex
digests of the two below it, or of the one left over at the end of a level.

Proofs come from pointer jumping.  At first every node holds the segment of
one level: its sibling.  A round joins the node table with itself, so that
every node takes over the segment of the ancestor at which its own ends: the
distance doubles with each round, until the segments reach the root.  A round
keeps the nodes that the next ones ask for (levels that are multiples of the
new distance), so the table soon consists of little more than the leaves.  A
leaf's last segment is its whole proof, and each row is verified from it alone.

Sizes: the leaves are numbered by ranges (no language in one task), levels
are folded in aligned runs of ``RUN`` nodes, and an ancestor table is broadcast
up to ``SMALL`` rows only; beyond that each ancestor has few of all the rows
below it, so the shuffled join is even.  No digest reaches the driver: only
the largest count of a language, which gives the number of rounds.

Defined cases: null values as stated; null ids come first; rows of one id
are ordered by their digests, equal rows stand side by side, each a leaf of its own;
a null id is never tampered with; an empty table gives no rows; further columns don't count.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import small_batches
from contrail.operators.ranking import in_ranges, running_totals
from contrail.session import cut_lineage

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Nodes folded in one go (a power of two), and the levels that takes.
LEVELS = 8
RUN = 1 << LEVELS
#: Ancestors that are broadcast; more are joined by a shuffle.
SMALL = 20_000

#: One entry of a segment: a mark, then 32 bytes (none after ALONE).  LEFT and
#: RIGHT say where the sibling stands, GROUP and TOP which node is reached.
LEFT, RIGHT, ALONE, GROUP, TOP = b"L", b"R", b"N", b"S", b"T"

NODES = ("g string, level int, at bigint, n bigint, depth int, digest binary, segment binary, "
         "doc_id bigint, tampered binary")
PROOFS = ("doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, "
          "folded_root string, verified boolean")


def node(*below: bytes) -> bytes:
    """The digest over one node or two, as hex text."""
    return sha256("".join(d.hex() for d in below).encode()).digest()


def depth_of(n: int) -> int:
    """Levels above ``n`` leaves."""
    return max(n - 1, 0).bit_length()


def _batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 4_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


def fold_run(run: list[tuple], level: int) -> Iterator[tuple]:
    """Rows of NODES from one aligned run of a level: each node below the run's
    top with the segment of its own level, then the top with none."""
    g, first, n = run[0][0], run[0][1], run[0][2]
    depth, now = depth_of(n), [r[3] for r in run]
    up = min(LEVELS, depth - level)
    if not up:  # a lone leaf is its own top
        yield g, level, first, n, depth, now[0], b"", run[0][4], run[0][5]
    for k in range(up):
        for i, digest in enumerate(now):
            at = (first >> k) + i
            entry = ALONE if i ^ 1 >= len(now) else (LEFT if i & 1 else RIGHT) + now[i ^ 1]
            yield (g, level, at, n, depth, digest, entry, run[i][4], run[i][5]) if level + k == 0 else (
                g, level + k, at, n, depth, None, entry, None, None)
        now = [node(*now[i:i + 2]) for i in range(0, len(now), 2)]
    yield g, level + up, first >> up, n, depth, now[0], None, None, None


def _folder(level: int):
    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            run, key = [], None
            for b in batches:
                for r in zip(*(c.to_pylist() for c in b.columns)):
                    if (r[0], r[1] >> LEVELS) != key:
                        if run:
                            yield from fold_run(run, level)
                        run, key = [], (r[0], r[1] >> LEVELS)
                    run.append(r)
            if run:
                yield from fold_run(run, level)
        yield from _batches(rows(), _arrow(NODES))
    return fold


def levels(leaves: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """From leaves (g, at, n, digest, doc_id, tampered): every node with the
    segment of its level, the top of every g, and the number of levels."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    now, level, steps = leaves, 0, []
    while True:
        run = F.shiftright("at", LEVELS)
        steps.append(cut_lineage(
            now.select("g", "at", "n", "digest", "doc_id", "tampered").repartition("g", run)
            .sortWithinPartitions("g", "at").mapInArrow(_folder(level), NODES)))
        level += LEVELS
        if level >= depth_of(most):
            break
        now = steps[-1].filter("segment IS NULL AND level < depth")
    whole = steps[0]
    for s in steps[1:]:
        whole = whole.unionByName(s)
    return (whole.filter("segment IS NOT NULL"),
            whole.filter("segment IS NULL AND level = depth").select("g", "digest"), depth_of(most))


def jump(nodes: DataFrame, depth: int, small: int = SMALL) -> DataFrame:
    """The leaves of ``nodes`` with segments up to the top: each round doubles the distance."""
    reach = 1
    while reach < depth:
        asked = F.pmod("level", F.lit(2 * reach))
        above = nodes.filter(asked == reach).select(
            "g", (F.col("level") - reach).alias("level"), F.col("at").alias("over"), F.col("segment").alias("more"))
        if above.count() <= small:
            above = F.broadcast(above)
        nodes = cut_lineage(
            nodes.filter(asked == 0).withColumn("over", F.shiftright("at", reach))
            .join(above, ["g", "level", "over"], "left")
            .withColumn("segment", F.concat("segment", F.coalesce("more", F.lit(b"")))).drop("over", "more"))
        reach *= 2
    return nodes.filter("level = 0")


def check(leaf: bytes, tampered: bytes | None, proof: bytes) -> tuple:
    """(subroot, root, digest of the siblings, root folded from the tampered
    or else the original leaf, whether it is the root) of one proof."""
    h, i, siblings, reached = (tampered or leaf).hex(), 0, [], {}
    while i < len(proof):
        mark, i = proof[i:i + 1], i + 1
        if mark == ALONE:
            h = sha256(h.encode()).hexdigest()
            continue
        other, i = proof[i:i + 32].hex(), i + 32
        if mark in (GROUP, TOP):
            reached[mark] = other
            continue
        siblings.append(other)
        h = sha256((other + h if mark == LEFT else h + other).encode()).hexdigest()
    return (reached[GROUP], reached[TOP], sha256("".join(siblings).encode()).hexdigest(), h, h == reached[TOP])


def _verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for b in batches:
            for doc_id, leaf, tampered, proof in zip(*(c.to_pylist() for c in b.columns)):
                yield doc_id, leaf.hex(), *check(leaf, tampered, proof)
    yield from _batches(rows(), _arrow(PROOFS))


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 length, a colon and the value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(**values: Column) -> Column:
    """32 bytes; the columns of ``COLUMNS``, each from ``values`` or by its name."""
    return F.unhex(F.sha2(F.concat(*[field(values.get(c, F.col(c))) for c in COLUMNS]), 256))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``at`` (place from 0 in its g) and ``n`` (rows of its g)."""
    ranged = in_ranges(rows, ["g", *order])
    return running_totals(ranged, ["g"], F.col("_bkt"), order, rank_col="_rank", group_size_col="n") \
        .withColumn("at", F.col("_rank") - 1)


def tamperings(every: int = 7) -> Column:
    """The digest of the row after an attack (one more in n_chars) where
    ``every`` divides the id's CRC-32, else null."""
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("decimal(20,0)")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    return F.when(hit, leaf_digest(n_chars=more))


def proofs(docs: DataFrame, tampered: Column | None = None, small: int = SMALL) -> DataFrame:
    """PROOFS, a row for every row of ``docs``.  ``tampered`` gives the digest
    to check in place of the leaf where it isn't null (none by default)."""
    small_batches(docs.sparkSession)
    tampered = F.lit(None).cast("binary") if tampered is None else tampered
    # `tie` tells equal rows apart; written here, so that every later pass sees the same number
    leaves = cut_lineage(docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("g"),
        F.col("doc_id").cast("bigint").alias("doc_id"), leaf_digest().alias("digest"),
        tampered.alias("tampered"), F.monotonically_increasing_id().alias("tie")))
    nodes, subroots, depth = levels(numbered(leaves, ["doc_id", "digest", "tie"]))

    none = [F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("binary").alias("tampered")]
    groups = numbered(subroots.select(F.lit("").alias("g"), F.col("g").alias("lang"), "digest"), ["lang"])
    groups = cut_lineage(groups)
    top_nodes, root, top_depth = levels(groups.select("g", "at", "n", "digest", *none))
    end = root.select("g", F.concat(F.lit(TOP), F.col("digest")).alias("end"))
    last = F.col("level") >= F.greatest(F.col("depth") - 1, F.lit(0))

    def reaching(nodes: DataFrame, ends: DataFrame) -> DataFrame:
        """The segments that reach a top (two to each g) take in what lies beyond it."""
        beyond = nodes.filter(last).join(ends, "g").withColumn("segment", F.concat("segment", "end")).drop("end")
        return nodes.filter(~last).unionByName(beyond)

    paths = jump(reaching(top_nodes, end), top_depth, small)
    ends = groups.join(paths.select("at", F.col("segment").alias("path")), "at").select(
        F.col("lang").alias("g"), F.concat(F.lit(GROUP), F.col("digest"), F.col("path")).alias("end"))
    whole = jump(reaching(nodes, cut_lineage(ends)), depth, small)
    return whole.select("doc_id", "digest", "tampered", "segment").mapInArrow(_verify, PROOFS)
