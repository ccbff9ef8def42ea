"""Flight CSV scan, table and JSON sinks, dataset versions, file stats."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions.calendar import parse_lenient
from contrail.schema import DATE_COLS, FLIGHTS, NA_TOKENS


def read_flights(spark: SparkSession, path: str, schema: T.StructType = FLIGHTS,
                 parse_dates: bool = True) -> DataFrame:
    """CSV with header (a UTF-8 BOM is stripped by the reader), fixed schema.

    Text columns are read as text; the NA tokens pandas treats as missing
    become NULL (matched whole, blanks included, as pandas does), then numeric
    columns are cast with ``try_cast`` so bad text gives NULL instead of
    failing the job, and dates are parsed leniently.  Integer columns go
    through double, as a column with missing values is written ``1.0``; a
    number that is not whole gives NULL.
    """
    text_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    raw = (spark.read.option("header", True).option("mode", "PERMISSIVE")
           .option("encoding", "UTF-8").schema(text_schema).csv(path))
    na = F.array(*[F.lit(t) for t in NA_TOKENS])
    cols = []
    for f in schema:
        c = F.when(F.array_contains(na, F.col(f.name)), F.lit(None)).otherwise(F.col(f.name))
        if isinstance(f.dataType, T.StringType):
            if parse_dates and f.name in DATE_COLS:
                c = parse_lenient(c)
        elif isinstance(f.dataType, T.IntegralType):
            number = F.trim(c).try_cast("double")
            c = F.when(number == F.floor(number), number).try_cast(f.dataType)
        else:
            c = F.trim(c).try_cast(f.dataType)
        cols.append(c.alias(f.name))
    return raw.select(*cols)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
                partition_by: Sequence[str] | None = None) -> None:
    """Table sink between steps (S2). Parquet by default; CSV keeps a header."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_report(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Nested JSON report sink (S3): struct/map columns become JSON objects.
    Reports are one or a few rows, so one output file."""
    report.coalesce(1).write.mode(mode).json(path)


def union_versions(versions: Mapping[str, DataFrame], version_col: str = "version") -> DataFrame:
    """Tag each DataFrame with its version name and union by column name."""
    tagged = [df.withColumn(version_col, F.lit(v)) for v, df in versions.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def read_versions(spark: SparkSession, paths: Mapping[str, str], version_col: str = "version") -> DataFrame:
    """Stored Parquet versions of one dataset in one scan.

    The schemas are merged by column name (a column that a version lacks is
    NULL there), and every row's version comes from the file it was read
    from, so pruning and pushed filters reach all versions alike."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    folders = {}
    for version, path in paths.items():
        where = jvm.org.apache.hadoop.fs.Path(path)
        folders[version] = where.getFileSystem(conf).makeQualified(where).toUri().toString().rstrip("/") + "/"
    file, tag = F.col("_metadata.file_path"), F.lit(None).cast("string")
    # as URIs: file:/x and file:///x name one folder; a nested folder wins over the one above it
    plain = F.regexp_replace(file, "^([a-z0-9+.-]+):/+", "$1:/")
    for version, folder in sorted(folders.items(), key=lambda f: len(f[1])):
        tag = F.when(F.startswith(plain, F.lit(re.sub("^([a-z0-9+.-]+):/+", r"\1:/", folder))), version).otherwise(tag)
    return spark.read.option("mergeSchema", "true").parquet(*paths.values()).withColumn(version_col, tag)


def source_stats(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Number of files under ``path`` and their total size in bytes.

    A ``binaryFile`` listing with only ``path`` and ``length`` selected: the
    file contents are pruned away, so nothing is read, and files without
    rows still count (row-level ``_metadata`` would miss them)."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        r = r.option("pathGlobFilter", pattern)
    files = r.load(path).select("path", "length")
    return files.agg(F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("size_bytes"))
