"""Every query against its SQL; those without SQL against properties or brute force in the other test modules."""

import math

import duckdb
import pytest

from loomspan.plans.catalog import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(medium):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{medium}/{t}.parquet'")
    return con


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 5)
    return x


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, duck, medium, name):
    df = QUERIES[name](spark, medium)
    found = duck.execute(ORACLE_SQL[name])
    columns = [c[0] for c in found.description]
    want = rows_of(columns, found.fetchall())
    assert sorted(df.columns) == sorted(columns)
    got = rows_of(df.columns, df.collect())
    assert len(got) == len(want)
    assert got == want
    assert want, "an empty result shows nothing"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_without_sql_runs(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0
