"""Every corpus query that has SQL, against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from catalogspark.llm.queries import ORACLE_SQL, QUERIES

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def plain(value):
    return round(value, 6) if isinstance(value, float) else None if value is None else str(value)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, DATA)
    columns = sorted(frame.columns)
    found = sorted((tuple(plain(r[c]) for c in columns) for r in frame.collect()), key=str)
    answer = duck.execute(ORACLE_SQL[name])
    at = [[d[0] for d in answer.description].index(c) for c in columns]
    assert len(answer.description) == len(columns)
    assert found == sorted((tuple(plain(r[i]) for i in at) for r in answer.fetchall()), key=str)
