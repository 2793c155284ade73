"""Every registered query against its SQL, on the smallest tables."""

import math

import pytest

from chronoweave.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(small):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"create view {t} as select * from '{small}/{t}.parquet'")
    return connection


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if type(v).__name__ in ("float", "Decimal"):
        return f"{float(v):.9g}"
    return str(v)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(name, spark, small, duck):
    df = registry.QUERIES[name](spark, small)
    columns = sorted(df.columns)
    rows = sorted(tuple(map(plain, r)) for r in df.select(*columns).collect())
    if name not in registry.ORACLE_SQL:
        assert rows
        return
    expected = duck.sql(registry.ORACLE_SQL[name])
    assert columns == sorted(expected.columns)
    assert rows == sorted(tuple(map(plain, r)) for r in expected.project(", ".join(f'"{c}"' for c in columns)).fetchall())
