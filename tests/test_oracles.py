"""Every query of the library's own operators against its SQL, on the smallest tables."""

import math
import os

import duckdb
import pytest

from isarithm.plans.catalog import oracle_sql, queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    return v


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the test tables")
@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, sf, name):
    df = queries()[name](spark, sf)
    got = sorted(repr(plain(tuple(row[c] for c in sorted(df.columns)))) for row in df.collect())
    if name not in oracle_sql():
        assert df.columns
        return
    rel = duck.execute(oracle_sql()[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == sorted(df.columns)
    at = [names.index(c) for c in sorted(names)]
    assert got == sorted(repr(plain(tuple(row[i] for i in at))) for row in rel.fetchall())
