"""Every query of the subpackage that has SQL, held against DuckDB on the smallest tables."""

import duckdb
import pytest
from harrow.llm import queries

SQL = queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = queries.queries()[name](spark, sf)
    cols = sorted(df.columns)
    cur = con.execute(f"SELECT {', '.join(chr(34) + c + chr(34) for c in cols)} FROM ({SQL[name]})")
    assert sorted(map(repr, (tuple(r[c] for c in cols) for r in df.collect()))) == sorted(map(repr, cur.fetchall()))
