"""Every core query with SQL against DuckDB on the smallest test data, where it is present."""

import math
import os

import pytest

DATA = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")

from folioflow.plans.oracles import ORACLES  # noqa: E402
from folioflow.plans.queries import QUERIES  # noqa: E402


def plain(v):
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return str(v)[:19] if hasattr(v, "tzinfo") else v


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for f in os.listdir(DATA):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{DATA}/{f}')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    q = duck.execute(ORACLES[name])
    names = [x[0] for x in q.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in q.fetchall()), key=repr)


#: What the smallest tables may hold none of.
SCARCE = ("provision_classes", "version_mates")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_without_sql(spark, name):
    """What SQL doesn't state gives rows on the test tables, each once."""
    rows = [str(r) for r in QUERIES[name](spark, DATA).collect()]
    assert len(set(rows)) == len(rows) and (rows or name in SCARCE)
