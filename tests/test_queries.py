"""Every registered query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from strata.plans.registry import load_all
from strata.sources.tables import TABLES, table_path
from tools.check_oracle import digest

NAMES = sorted(load_all())  # the warehouse; tests/llm has the others
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_small, t)}')")
    return c


def test_every_query_has_an_oracle():
    missing = [n for n in NAMES if n not in SQL]
    assert missing == []


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["stt", "edt", "cur_date"]
    assert df.count() > 0


TYPE_NAMES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, sf_small, name):
    df = entry.queries()[name](spark, sf_small)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    dtypes = {r[0]: r[1] for r in con.execute(f"DESCRIBE {SQL[name]}").fetchall()}
    stypes = {f.name: TYPE_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
              for f in df.schema.fields}
    assert stypes == dtypes
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]
