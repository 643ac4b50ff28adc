"""Each registered query against its SQL, on the smallest tables. SILTSTONE_SF names another size."""

import datetime
import decimal
import os
from pathlib import Path

import duckdb
import pytest

from siltstone import catalog

DATA = Path(os.environ.get("SILTSTONE_SF", "/root/testdata/sf0.001"))


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def plain(v):
    if isinstance(v, float | decimal.Decimal):
        return repr(round(float(v), 9) + 0.0)
    return v.replace(tzinfo=None).isoformat() if isinstance(v, datetime.datetime) else repr(v)


def rows(values, names):
    at = [names.index(n) for n in sorted(names)]
    return sorted(tuple(plain(r[i]) for i in at) for r in values)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, sql, name):
    df = catalog.QUERIES[name](spark, str(DATA))
    got = rows(df.collect(), df.columns)
    if name not in catalog.ORACLE_SQL:
        assert got
        return
    found = sql.execute(catalog.ORACLE_SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    assert got == rows(found.fetchall(), names)
