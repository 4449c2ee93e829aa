"""The queries that SQL can express, against DuckDB."""

import duckdb
import pytest

from strata.llm.queries import ORACLE_SQL, QUERIES
from strata.sources.tables import TABLES, table_path
from tools.check_oracle import digest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF, t)}')")
    df = QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(columns) and len(got) == len(want)
    assert digest(df.columns, got)[0] == digest(columns, want)[0]
