"""Every query with SQL gives the rows that DuckDB gives, on the smallest tables."""

import math
import os

import duckdb
import pytest

from vitals.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data here")


def plain(x):
    if hasattr(x, "item"):
        x = x.item()
    return None if isinstance(x, float) and math.isnan(x) else round(x, 6) if isinstance(x, float) else x


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = registry.QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    cur = con.execute(registry.ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    order = lambda rows: sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))
    want = order(tuple(plain(r[names.index(c)]) for c in cols) for r in cur.fetchall())
    assert order(tuple(plain(r[c]) for c in cols) for r in got.collect()) == want
