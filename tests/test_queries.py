"""Every registered query of the core library against its SQL on the smallest tables."""

import duckdb
import pytest

from spliceloom.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents"]


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, db, name):
    got = catalog.QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    rows = sorted(map(str, (tuple(r) for r in got.select(*cols).collect())))
    if name in catalog.SQL:
        want = db.sql(catalog.SQL[name])
        assert sorted(want.columns) == cols
        assert rows == sorted(map(str, want.select(*(f'"{c}"' for c in cols)).fetchall()))
    else:
        assert rows
