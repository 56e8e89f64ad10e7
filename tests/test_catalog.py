"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from factweave.plans import catalog
from factweave.plans.relations import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    if hasattr(value, "isoformat"):
        return value.replace(tzinfo=None).isoformat()
    if type(value).__name__ == "Decimal":
        return f"{float(value):.9g}" if value % 1 else str(int(value))
    return str(value)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    stamps = [c for c, t in df.dtypes if t.startswith("timestamp")]
    df = df.withColumns({c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss") for c in stamps})
    names = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in names) for r in df.collect())
    if name in catalog.ORACLES:
        cur = duck.execute(catalog.ORACLES[name])
        cols = [d[0] for d in cur.description]
        assert sorted(cols) == names
        at = [cols.index(c) for c in names]
        want = sorted(tuple(plain(r[k]) for k in at) for r in cur.fetchall())
        assert got == want
    assert got or name in ("doc_phones_valid", "doc_emails", "link_discovery")
