"""Every query of the engine against its SQL on the smallest tables."""

import duckdb
import pytest

from tidemark.plans.catalogue import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    got = QUERIES[name](spark, SF)
    rows = sorted(map(repr, (tuple(r[c] for c in sorted(got.columns)) for r in got.collect())))
    if name in ORACLES:
        found = oracle.execute(ORACLES[name])
        columns = [c[0] for c in found.description]
        assert sorted(columns) == sorted(got.columns)
        assert rows == sorted(repr(tuple(dict(zip(columns, r))[c] for c in sorted(columns))) for r in found.fetchall())
    else:
        assert rows


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
