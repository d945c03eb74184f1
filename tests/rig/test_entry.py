"""Every registered rig query equals its SQL on the smallest tables."""

import duckdb
import pytest

from rigprep.plans import more  # noqa: F401
from rigprep.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("supplier", "lineitem", "embeddings")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 6) + 0.0
    return v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    rel = duck.sql(ORACLES[name])
    assert sorted(rel.columns) == cols
    want = sorted((tuple(plain(v) for v in row) for row in rel.select(*cols).fetchall()), key=repr)
    assert got == want
