"""Queries of this subpackage against their SQL twins on whole small tables."""

import duckdb
import pytest

from wayfold.llm import queries
from wayfold.sources.fixtures import TABLES


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows(spark, name, sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = queries.QUERIES[name](spark, sf)
    found = con.execute(queries.ORACLES[name])
    names = sorted(df.columns)
    columns = [c[0] for c in found.description]
    assert sorted(columns) == names
    at = [columns.index(c) for c in names]
    assert sorted(tuple(map(str, r)) for r in df.select(*names).collect()) == sorted(tuple(str(r[i]) for i in at) for r in found.fetchall())
