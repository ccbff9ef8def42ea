"""Small tables and driver files for the text operators' tests."""
import duckdb

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, rows, extra=""):
    """rows: (doc_id, text[, source]); written nowhere, columns of documents."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOCS)


def stored(name, sf_dir=SF_SMALL):
    """The rows of a driver table, read without Spark."""
    return duckdb.sql(f"SELECT * FROM '{sf_dir}/{name}.parquet' ORDER BY 1").fetchall()


def clashing(df):
    """``df`` with extra columns named like columns that operators make."""
    from pyspark.sql import functions as F
    names = ["score", "predicted", "fingerprint", "component_id", "label", "fp", "u", "v", "root", "item_id",
             "span_start", "spans", "mix_slot", "__row", "n", "page_id2", "start", "end", "x", "a.b", "c`d"]
    return df.withColumns({n: F.lit("kept") for n in names})


EDGE = [(1, None), (2, ""), (3, " \n\t "), (None, "null id"), (5, "a b c d e f"), (5, "a b c d e f"),
        (6, "word " * 30000), (7, "x" * 50000), (None, None)]
