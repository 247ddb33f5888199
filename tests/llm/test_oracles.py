"""The queries that SQL can express against their SQL, over the smallest tables."""

import duckdb
import pytest

from conftest import SF
from test_text_operators import counted
from tickframe.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = con.execute(ORACLES[name])
    columns = [d[0] for d in found.description]
    df = QUERIES[name](spark, SF)
    assert sorted(columns) == sorted(df.columns)
    assert counted(df.select(columns).collect()) == counted(found.fetchall())
