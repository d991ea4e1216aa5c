"""Every query with an SQL twin gives the same rows in DuckDB."""

import decimal
import math

import duckdb
import pytest

from wayfold.plans import catalog
from wayfold.sources.fixtures import TABLES


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return f"{v:f}"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return tuple(plain(x) for x in v) if isinstance(v, (list, tuple)) else None if v is None else str(v)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_same_rows(spark, duck, sf, name):
    df = catalog.QUERIES[name](spark, sf)
    names = sorted(df.columns)
    found = duck.execute(catalog.ORACLES[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == names
    at = [columns.index(c) for c in names]
    want = sorted((tuple(plain(r[i]) for i in at) for r in found.fetchall()), key=repr)
    assert sorted((tuple(plain(v) for v in r) for r in df.select(*names).collect()), key=repr) == want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_runs(spark, sf, name):
    assert catalog.QUERIES[name](spark, sf).count() > 0


@pytest.mark.parametrize("name, whole", [("src14_resolve", "customer"), ("src7_elements", "part"), ("set1_union", "lineitem")])
def test_whole_tables(spark, sf, name, whole):
    """One row for each of the table's, none filtered away."""
    assert catalog.QUERIES[name](spark, sf).count() == spark.read.parquet(f"{sf}/{whole}.parquet").count()
