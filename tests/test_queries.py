"""Every registered query of the library against its DuckDB SQL, on the smallest tables."""

import os

import duckdb
import pytest

from vidpipe import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def _rows(rows, cols, order):
    at = [cols.index(c) for c in order]
    return sorted(tuple("~" if r[i] is None else f"{r[i]:.6g}" if isinstance(r[i], float) else str(r[i]) for i in at) for r in rows)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    found = duck.execute(registry.ORACLE_SQL[name])
    cols = [x[0] for x in found.description]
    assert sorted(df.columns) == sorted(cols)
    assert _rows([tuple(r) for r in df.collect()], df.columns, sorted(cols)) == _rows(found.fetchall(), cols, sorted(cols))


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLE_SQL)
