"""Byte fingerprints of stored files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.session import cut_lineage

BOM = bytearray(b"\xef\xbb\xbf")


def file_fingerprints(spark: SparkSession, path: str, chunk: int = 1 << 20, fan: int = 1024) -> DataFrame:
    """file, n_bytes, n_chunks and digest of every file below ``path``.

    A file is cut into chunks of ``chunk`` bytes, each with its SHA-256 in hex;
    ``fan`` consecutive digests, joined, give the digest above them, until one is left (a lone one
    stays as it is).  Equal files have equal digests.  Files without a byte have no row: Spark's
    readers don't list them.

    Files are read by splits as byte lines that end with a line feed alone, so many tasks
    share a long file and none holds one whole; a line's place is the sum of
    what comes before it.  Splits move once, then only the chunks that lie in two of them.
    The line reader leaves out a leading byte order mark: where a file's lines fall
    short of its size by one, it is put back.  Any other difference is an
    error: names like ``.gz``, which the reader unpacks, can't be read as bytes.
    A stretch without a line feed is one value, so it must be shorter than 2 GB.
    """
    if chunk < 1 or fan < 2:
        raise ValueError("chunk: at least 1, fan: at least 2")
    everything = spark.read.option("recursiveFileLookup", "true")
    meta = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("n_bytes")]
    files = cut_lineage(everything.format("binaryFile").load(path).select(*meta))  # contents aren't read
    line = F.col("value").cast("binary")
    lines = cut_lineage(everything.option("lineSep", "\n").text(path).select(
        meta[0], F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("id"),
        line.alias("line"), (F.octet_length(line) + F.lit(1).cast("bigint")).alias("length")))

    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = (lines.groupBy("file", "split").agg(F.sum("length").alias("held"))  # a row for each split
              .withColumn("before", F.coalesce(F.sum("held").over(earlier), F.lit(0)))
              .withColumn("total", F.sum("held").over(Window.partitionBy("file"))))
    facts = files.join(splits, "file", "left")
    missing = F.col("n_bytes") - F.coalesce("total", F.lit(0))
    marked = missing.isin(2, 3)  # a byte order mark; less one where the last line has no line feed
    facts = facts.withColumn("mark", F.when(missing.isin(-1, 0) | marked, F.when(marked, 3).otherwise(0)).otherwise(
        F.raise_error(F.concat(F.lit("not read as bytes: "), "file")).cast("int")))

    inside = Window.partitionBy("file", "split").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    placed = (lines.withColumn("inside", F.coalesce(F.sum("length").over(inside), F.lit(0)))
              .join(facts, ["file", "split"])
              .withColumn("at", F.col("before") + F.col("inside") + F.col("mark")))
    ended = F.when(F.col("at") + F.col("length") > F.col("n_bytes"), F.col("line")).otherwise(
        F.concat("line", F.lit(bytearray(b"\n"))))
    first = F.col("at") == F.col("mark")
    placed = placed.select("file", "split", "n_bytes", F.when(first & (F.col("mark") > 0), F.concat(F.lit(BOM), ended))
                           .otherwise(ended).alias("data"), F.when(first, 0).otherwise(F.col("at")).alias("at"))
    alone = facts.filter("split is null and n_bytes = 3").select(  # nothing but the mark: no line
        "file", F.lit(0).cast("bigint").alias("split"), "n_bytes", F.lit(BOM).alias("data"), F.lit(0).cast("bigint").alias("at"))

    end = F.col("at") + F.octet_length("data") - 1
    span = F.sequence(F.floor(F.col("at") / chunk), F.floor(end / chunk))
    start = F.greatest(F.col("chunk") * chunk - F.col("at"), F.lit(0))
    pieces = placed.unionByName(alone).withColumn("chunk", F.explode(span)).select(
        "file", "split", "n_bytes", "chunk", (F.col("at") + start).alias("at"),
        F.substring("data", (start + 1).cast("int"), F.least(
            F.lit(chunk), (F.col("chunk") + 1) * chunk - F.col("at") - start).cast("int")).alias("data"))

    def joined(parts):
        """The bytes of an array of (at, data), in order."""
        return F.array_join(F.transform(F.array_sort(parts), lambda p: F.hex(p["data"])), "")

    def sized(parts):
        return F.aggregate(parts, F.lit(0).cast("bigint"), lambda n, p: n + F.octet_length(p["data"]))

    whole = F.least(F.lit(chunk), F.col("n_bytes") - F.col("chunk") * chunk)
    parts = F.collect_list(F.struct("at", "data"))
    per_split = pieces.groupBy("file", "split", "n_bytes", "chunk").agg(parts.alias("parts")).select(
        "file", "n_bytes", "chunk", (sized(F.col("parts")) == whole).alias("whole"),
        F.array_min(F.transform("parts", lambda p: p["at"])).alias("at"),
        F.unhex(joined(F.col("parts"))).alias("data"))
    done = per_split.select("file", "n_bytes", "chunk", F.when(F.col("whole"), F.sha2("data", 256)).alias("digest"),
                            F.when(~F.col("whole"), F.struct("at", "data")).alias("part"))
    nodes = done.groupBy("file", "n_bytes", "chunk").agg(
        F.max("digest").alias("digest"), F.collect_list("part").alias("parts")).select(
        "file", "n_bytes", "chunk", F.coalesce("digest", F.sha2(F.unhex(joined(F.col("parts"))), 256)).alias("digest"))
    nodes = cut_lineage(nodes)

    longest = files.agg(F.max("n_bytes")).first()[0] or 0
    left, width = -(-longest // chunk), chunk
    while left > 1:
        lone = F.ceil(F.col("n_bytes") / width) == 1
        ordered = F.transform(F.array_sort(F.collect_list(F.struct("chunk", "digest"))), lambda p: p["digest"])
        nodes = nodes.groupBy("file", "n_bytes", F.floor(F.col("chunk") / fan).alias("chunk")).agg(
            ordered.alias("below")).select("file", "n_bytes", "chunk", F.when(lone, F.col("below")[0]).otherwise(
                F.sha2(F.array_join("below", ""), 256)).alias("digest"))
        left, width = -(-left // fan), width * fan
    return nodes.select("file", "n_bytes", F.ceil(F.col("n_bytes") / chunk).alias("n_chunks"), "digest")
