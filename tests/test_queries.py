"""Every registered query against its oracle SQL (DuckDB) at sf0.001, and
the driver's entry point."""

import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "metadata_observed_at" in df.columns


def test_every_query_has_oracle_or_is_rows_only():
    # the panel's own queries; those that the entry module adds are tested beside their code
    from pitpanel.plans.registry import QUERIES
    assert set(QUERIES) <= set(E.oracle_sql())
    assert set(QUERIES) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    o_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(o_cols)
    assert _rows(df.columns, s_rows) == _rows(o_cols, res.fetchall())
