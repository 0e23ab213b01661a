"""Every registered query of the library against its SQL in DuckDB, over all rows."""

import math

import duckdb
import pytest

from lodestrata.plans import registry
from tests.conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None or isinstance(v, str | bool):
        return str(v)
    if isinstance(v, list | tuple):
        return str([plain(x) for x in v])
    try:
        return "None" if math.isnan(v) else repr(round(float(v), 6) + 0.0)
    except TypeError:
        return str(v)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name not in registry.ORACLES:
        return
    res = duck.execute(registry.ORACLES[name])
    names = [c[0] for c in res.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in res.fetchall())
