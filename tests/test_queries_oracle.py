"""Every registered query against its DuckDB oracle on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as se
from tests.conftest import SF_SMALL

SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return c


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan" if math.isnan(v) else repr(v))
    if hasattr(v, "isoformat"):
        return (2, v.isoformat())
    return (3, str(v))


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(se.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = se.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(se.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    otypes = {r[0]: r[1] for r in con.execute(f"DESCRIBE {se.oracle_sql()[name]}").fetchall()}
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == otypes
    assert _rows(df.columns, rows) == _rows(ocols, orows)


def test_queries_without_oracle_produce_rows(spark):
    for name in set(se.queries()) - set(se.oracle_sql()):
        assert se.queries()[name](spark, SF_SMALL).count() > 0, name
