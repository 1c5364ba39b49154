"""Every registered query with SQL against DuckDB on the smallest tables; the rest must give rows."""

import math

import pytest

from fringeflow.plans.registry import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def _plain(v):
    if v is None or v != v:
        return (0, "")
    if isinstance(v, bool):
        return (2, str(v))
    return (1, round(float(v), 9)) if isinstance(v, (int, float)) or hasattr(v, "dtype") else (2, str(v))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    rows = got.collect()
    if name not in ORACLE_SQL:
        assert rows or name == "wide_phase_linking"  # ten suppliers: no centre has 48 neighbours
        return
    want = duck.sql(ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    order = sorted(got.columns)
    at = [want.columns.index(c) for c in order]
    a = sorted(tuple(_plain(r[c]) for c in order) for r in rows)
    b = sorted(tuple(_plain(r[i]) for i in at) for r in want.fetchall())
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert all(p == q or p[0] == q[0] == 1 and math.isclose(p[1], q[1], abs_tol=2e-5) for p, q in zip(x, y)), (x, y)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 7
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
