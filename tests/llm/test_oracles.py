"""Operators that SQL can state: the registered query against its SQL on the smallest tables."""

import duckdb
import pytest

from tools.oracle_check import TABLES, digest
from wordgraph.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    found = QUERIES[name](spark, SF)
    got = [tuple(r) for r in found.collect()]
    res = con.execute(ORACLE_SQL[name])
    cols = [d[0] for d in res.description]
    assert sorted(found.columns) == sorted(cols)
    assert digest(found.columns, got)[0] == digest(cols, res.fetchall())[0]
