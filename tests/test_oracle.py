"""Every registered query against its DuckDB oracle on the smallest tables.

The driver runs the same comparison at sf0.01 (``tools/oracle_check.py``
does it locally)."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.oracle_check import rows_of
from contrail.plans import catalog
from contrail.sources.tables import DRIVER_TABLES, table_path

from driver_tables import SF_SMALL

NAMES = sorted(catalog.queries())
SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
                 "decimal(38,0)": "DECIMAL(38,0)"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        if os.path.exists(table_path(SF_SMALL, t)):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return c


def test_every_query_has_oracle_or_is_listed():
    no_sql = set(catalog.queries()) - set(entry.oracle_sql())
    assert no_sql <= {"delay_scoring"}, no_sql


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "positive_share" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sql = entry.oracle_sql().get(name)
    if sql is None:
        pytest.skip("no SQL form")
    df = entry.queries()[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    o_cols = [c[0] for c in cur.description]
    o_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    assert rows_of(df.columns, s_rows) == rows_of(o_cols, o_rows)
    o_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    for col, t in df.dtypes:
        assert SPARK_TO_DUCK.get(t, t) == o_types[col], (col, t, o_types[col])
