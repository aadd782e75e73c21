"""Every query that has SQL, held against DuckDB on the smallest tables."""

import duckdb
import pytest
from harrow.plans import job_queries, lead_queries, queries

MODULES = (queries, lead_queries, job_queries)
QUERIES, SQL = {k: v for m in MODULES for k, v in m.QUERIES.items()}, {k: v for m in MODULES for k, v in m.SQL.items()}

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def rows(values):
    flat = lambda x: round(x, 9) if isinstance(x, float) else x
    return sorted((tuple(map(flat, r)) for r in values), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = rows(tuple(r[c] for c in cols) for r in df.collect())
    cur = con.execute(f"SELECT {', '.join(chr(34) + c + chr(34) for c in cols)} FROM ({SQL[name]})")
    assert got == rows(cur.fetchall())
