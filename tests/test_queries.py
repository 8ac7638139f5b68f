"""Each registered query against its SQL on the smallest tables; those without SQL must give rows."""

import decimal
import os

import pytest

duckdb = pytest.importorskip("duckdb")
from wardline.plans import registry  # noqa: E402

DATA = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), registry.oracle_sql()


def plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(v)
    return str(v) if hasattr(v, "isoformat") else v


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(DATA):
        pytest.skip("no test tables")
    c = duckdb.connect()
    for f in os.listdir(DATA):
        path = f"{DATA}/{f}"
        c.sql(f"create view {f.split('.')[0]} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, DATA)
    columns, rows = sorted(df.columns), df.collect()
    if name not in SQL:
        assert rows
        return
    want = con.sql(SQL[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    got = sorted((tuple(plain(r[c]) for c in columns) for r in rows), key=repr)
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)
