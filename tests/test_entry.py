import os

import duckdb
import pytest

import __spark_entry__ as entry
from stopwise import queries as core

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    norm = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")
@pytest.mark.parametrize("name", sorted(core.QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = core.QUERIES[name](spark, SF)
    result = duck.execute(core.ORACLE_SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    assert _rows(df.columns, df.collect()) == _rows(names, result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(core.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
