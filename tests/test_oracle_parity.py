"""Every registered query equals its DuckDB oracle on the sf0.001 testdata."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as E
from tidemark.oracle import ORACLE_SQL as SQL
from tidemark.queries import QUERIES
from tools.check_oracle import TABLES, digest, type_diffs


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_small) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, sf_small, name):
    df = QUERIES[name](spark, sf_small)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    rel = duck.sql(SQL[name])
    d_cols, d_types, d_rows = rel.columns, rel.types, rel.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert type_diffs(df.schema, d_cols, d_types) == []
    assert len(s_rows) == len(d_rows)
    assert digest(s_cols, s_rows)[0] == digest(d_cols, d_rows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "supplier_tier" in df.columns


@pytest.mark.parametrize("name", ["merge_upsert", "write_append", "incremental_filter", "customer_360", "material_consumption"])
def test_results_do_not_depend_on_session_time_zone(spark, duck, sf_small, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = QUERIES[name](spark, sf_small)
        s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    res = duck.execute(SQL[name])
    d_cols, d_rows = [d[0] for d in res.description], res.fetchall()
    assert digest(s_cols, s_rows)[0] == digest(d_cols, d_rows)[0]
