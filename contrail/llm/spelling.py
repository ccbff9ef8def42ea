"""Groups spelling variants: words that one inserted, deleted or replaced code
point turns into each other, each word led to its most frequent neighbour.

Words are the maximal runs of ``LETTERS`` in whole texts, with A-Z in lower
case; where ``every`` divides the CRC-32 of ``<doc_id>:<run>``, one code point of
the run is taken out (a planted slip, see ``slip``).  Counts are added up inside each
task before they are shuffled.

Dense prefix-suffix tiling finds the neighbours.  Words lie as rows of
padded code-point matrices, one aligned left and one aligned right.  Two blocks of rows are compared as a whole:
column by column from the left gives the common prefix of every pair, from
the right the common suffix.  A pair is near where the two lengths together reach
the longer length minus one.

Only blocks that can hold neighbours meet.  With l the length of the shorter
word, two near words share their first or last floor(l / 2) code points, so every word goes to the
buckets of these pieces for l = its length and for l = its length - 1.  A
bucket of more than ``BLOCK`` rows is dealt into blocks by a hash, and each pair of its
blocks is a tile, a task's unit of work: however frequent a piece, no task holds more than two blocks at a
time.  Small buckets of one l share a matrix.  A pair counts in one tile only: by its
first piece where it shares that, else by its last one.

Following forms to the last word is pointer jumping: rows whose target has a
form take over the target's own target, the others are done.  Forms have at least
twice the count, so chains end, and the rounds grow with the logarithm of their length.

Defined cases: null texts have no words; the slip of a null id is drawn with an empty id;
repeated rows count each; an empty table gives no rows; a word may be of any length (blocks hold
``CELLS`` code points at most, one row at least).  Further columns don't count.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import keyed
from contrail.session import cut_lineage

#: The letters of words; all of them are single bytes in Latin-1.
LETTERS = "A-Za-zÀ-ÿ"
SHORTEST, RAREST, FACTOR, SLIP = 5, 3, 2, 97
#: Rows, and code points, of one block.
BLOCK, CELLS = 512, 1 << 22
#: Distinct words that a task counts before it passes its counts on.
HELD_WORDS = 300_000

COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])
NEAR = pa.schema([("word", pa.string()), ("other", pa.string()), ("other_n", pa.int64())])


def slip(doc_id: str, word: str, every: int) -> str:
    """``word``, without one code point where ``every`` divides the draw."""
    draw = zlib.crc32(f"{doc_id}:{word}".encode())
    if draw % every:
        return word
    at = draw % len(word)
    return word[:at] + word[at + 1:]


def _counter(every: int, shortest: int):
    runs = re.compile(f"[{LETTERS}]+").findall

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> Iterator[pa.RecordBatch]:
            if held:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], schema=COUNTS)
            held.clear()

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                # bytes.lower() changes A-Z alone
                here = Counter(runs(text.encode().lower().decode()))
                seed = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
                for word, n in here.items():
                    draw = zlib.crc32(word.encode(), seed)
                    if not draw % every:  # as in slip()
                        at = draw % len(word)
                        word = word[:at] + word[at + 1:]
                    if len(word) >= shortest:
                        held[word] += n
                if len(held) > HELD_WORDS:
                    yield from out()
        yield from out()
    return count


def word_counts(docs: DataFrame, every: int = SLIP, shortest: int = SHORTEST, rarest: int = RAREST) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    return (keyed(docs).mapInArrow(_counter(every, shortest), "word string, n bigint")
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= rarest))


def matrix(words: list[str], width: int, right: bool) -> np.ndarray:
    """Code points, a row a word, padded with 0 (no word holds it)."""
    fill = bytes.rjust if right else bytes.ljust
    whole = b"".join([fill(w.encode("latin-1"), width, b"\0") for w in words])
    return np.frombuffer(whole, np.uint8).reshape(len(words), width)


def common(a: np.ndarray, b: np.ndarray, columns: Iterable[int], kind: type) -> np.ndarray:
    """For every row of ``a`` and ``b``: how many of ``columns``, in their order, agree before the first that doesn't."""
    alive = np.ones((len(a), len(b)), bool)
    length = np.zeros(alive.shape, kind)
    for c in columns:
        np.logical_and(alive, a[:, c, None] == b[None, :, c], out=alive)
        length += alive
    return length


def near_pairs(left: list[str], right: list[str], l: int, first: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places (in ``left``, in ``right``) of the near pairs whose shorter word has ``l``
    code points (no word has more than l + 1); of those that share the first
    floor(l / 2) (``first``), or the last ones but not the first."""
    kind = np.uint8 if l < 120 else np.int32  # holds 2 * l
    pre = common(matrix(left, l + 1, False), matrix(right, l + 1, False), range(l), kind)
    suf = common(matrix(left, l + 1, True), matrix(right, l + 1, True), range(l, 0, -1), kind)
    one, two = (np.array([len(w) > l for w in words]) for words in (left, right))
    longer = l + (one[:, None] | two[None, :]).astype(kind)
    near = (pre + suf >= longer - 1) & ~(one[:, None] & two[None, :])
    near &= (pre < l) | (longer > l)  # a word isn't near itself
    near &= (pre >= l // 2) if first else ((suf >= l // 2) & (pre < l // 2))
    return np.nonzero(near)


class _Tiles:
    """Takes tiles in the order of l and side; gathers small diagonal ones of one l and side for a common matrix."""

    def __init__(self) -> None:
        self.key, self.words, self.tile, self.tiles = None, [], [], 0

    def add(self, l: int, first: bool, rows: list[tuple[str, int, int]]) -> Iterator[tuple]:
        """``rows``: word, n, part (0 the one block, 1 the other, 2 the only one)."""
        if rows[0][2] != 2:
            left, right = ([r for r in rows if r[2] == p] for p in (0, 1))
            if left and right:
                i, j = near_pairs([r[0] for r in left], [r[0] for r in right], l, first)
                yield from self._both(left, right, i, j)
            return
        if self.key != (l, first) or len(self.words) + len(rows) > max(1, min(BLOCK, CELLS // l)):
            yield from self.flush()
            self.key = (l, first)
        self.words += rows
        self.tile += [self.tiles] * len(rows)
        self.tiles += 1

    def flush(self) -> Iterator[tuple]:
        if len(self.words) > 1:
            rows = self.words
            names, tile = [r[0] for r in rows], np.array(self.tile)
            i, j = near_pairs(names, names, *self.key)
            keep = (i < j) & (tile[i] == tile[j])
            yield from self._both(rows, rows, i[keep], j[keep])
        self.key, self.words, self.tile, self.tiles = None, [], [], 0

    @staticmethod
    def _both(left, right, i, j) -> Iterator[tuple]:
        for a, b in zip(i.tolist(), j.tolist()):
            (u, m, _), (v, n, _) = left[a], right[b]
            yield u, v, n
            yield v, u, m


def _compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows l, first, bucket, i, j, word, n, part, sorted by the first five -> NEAR."""
    def found() -> Iterator[tuple]:
        tiles, key, rows = _Tiles(), None, []
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                if r[:5] != key:
                    if len(rows) > 1:
                        yield from tiles.add(key[0], key[1], rows)
                    key, rows = r[:5], []
                rows.append(r[5:])
        if len(rows) > 1:
            yield from tiles.add(key[0], key[1], rows)
        yield from tiles.flush()

    def out(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), NEAR)], schema=NEAR)

    held: list[tuple] = []
    for pair in found():
        held.append(pair)
        if len(held) == 20_000:
            yield out(held)
            held = []
    if held:
        yield out(held)


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, other, other_n): both directions of every near pair of ``words`` (word, n; a stored table)."""
    length, k = F.char_length("word"), F.shiftright("l", 1)
    piece = F.when(F.col("first"), F.substring(F.col("word"), F.lit(1), k)).otherwise(F.substring(F.col("word"), -k, k))
    rows = (words.select("word", "n", F.explode(F.array(length, length - 1)).alias("l"))
            .select("*", F.explode(F.array(F.lit(True), F.lit(False))).alias("first"))
            .select("word", "n", "l", "first", F.xxhash64("l", "first", piece).alias("bucket")))
    most = F.greatest(F.lit(1), F.least(F.lit(block), F.floor(F.lit(CELLS) / F.col("l")).cast("int")))
    # buckets of several blocks: written, so that the planner knows how few they are
    large = cut_lineage(rows.groupBy("bucket").agg(F.count("*").alias("size"), F.max("l").alias("l"))
                        .filter(F.col("size") > most)
                        .select("bucket", F.ceil(F.col("size") / most).cast("int").alias("blocks")))
    dealt = (rows.join(large, "bucket", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
             .withColumn("own", F.pmod(F.xxhash64(F.lit(1), "word"), F.col("blocks")).cast("int")))
    tiles = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("met")).select(
        "l", "first", "bucket", F.least("own", "met").alias("i"), F.greatest("own", "met").alias("j"), "word", "n",
        F.when(F.col("own") == F.col("met"), 2).when(F.col("own") < F.col("met"), 0).otherwise(1).alias("part"))
    return (tiles.repartition("bucket", "i", "j").sortWithinPartitions("l", "first", "bucket", "i", "j")
            .mapInArrow(_compare, "word string, other string, other_n bigint"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, form; a stored table without cycles) -> (word, root): the last word of each chain.

    Rows move on while their target isn't a root, so that no row is joined by a
    root, which may have very many words."""
    target = forms.select(F.col("word").alias("to"), F.col("form").alias("next"))
    now = cut_lineage(forms.withColumnRenamed("form", "to").join(target, "to", "left").select(
        "word", "to", F.col("next").isNull().alias("done")))
    while not (open_rows := now.filter(~F.col("done"))).isEmpty():
        hop = now.select(F.col("word").alias("to"), F.col("to").alias("next"), F.col("done").alias("end"))
        moved = open_rows.select("word", "to").join(hop, "to").select("word", F.col("next").alias("to"), F.col("end").alias("done"))
        now = cut_lineage(now.filter("done").unionByName(moved))
    return now.select("word", F.col("to").alias("root"))


def variants(docs: DataFrame, block: int = BLOCK, factor: int = FACTOR, **options) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word; ``options`` as for ``word_counts``."""
    words = cut_lineage(word_counts(docs, **options))
    per = near_words(words, block).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), "other")).alias("best"))
    leads = F.col("best")["m"] <= -factor * F.col("n")
    out = cut_lineage(words.join(per, "word", "left").select(
        "word", F.when(leads, F.col("best")["other"]).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(leads, -F.col("best")["m"]).alias("form_n")))
    last = roots(out.filter("form IS NOT NULL").select("word", "form"))
    return out.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
