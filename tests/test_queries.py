"""Every query of the smallest tables against its DuckDB form."""

import math
import os

import duckdb
import pytest

from tessera.plans import oracles, queries

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DIR):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DIR}/{f}'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    plain = lambda v: None if v is None or isinstance(v, float) and math.isnan(v) else float(v) if isinstance(v, (int, float)) else str(v)
    return sorted(repr(tuple(plain(r[k]) for k in order)) for r in rows)


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_same_rows(spark, duck, name):
    df = queries.queries()[name](spark, DIR)
    other = duck.sql(oracles.oracle_sql()[name])
    assert sorted(df.columns) == sorted(other.columns)
    assert canonical(df.columns, df.collect()) == canonical(other.columns, other.fetchall())


def test_every_query_is_known():
    assert set(oracles.oracle_sql()) <= set(queries.queries())
    assert set(queries.queries()) - set(oracles.oracle_sql()) == {"features_fuzzy", "gbt_train_metrics", "gbt_scores"}
