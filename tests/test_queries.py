"""Every registered query against its SQL, over whole tables at the smallest size."""

import pytest

from check_oracle import rows_of

import __spark_entry__ as entry
from checks.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def sql():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sql, name):
    df = QUERIES[name](spark, SF_DIR)
    cur = sql.execute(ORACLES[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cur.fetchall())


def test_flagship_runs(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_without_sql_is_known():
    assert set(QUERIES) - set(ORACLES) == {"text_normalize_documents"}


def test_entry_lists_every_query():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
