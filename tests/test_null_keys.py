"""Queries over line items without a part or a supplier, so that there are vertices without a place."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.test_shared_keys import same
from wayfold.functions import geometry as G
from wayfold.plans import catalog


@pytest.fixture(scope="module")
def nulls(sf, tmp_path_factory):
    """lineitem and nation, in which some rows have no part, no supplier or neither."""
    folder = str(tmp_path_factory.mktemp("nulls"))
    con = duckdb.connect()
    con.execute(f"COPY (SELECT * REPLACE (CASE WHEN l_orderkey % 5 > 0 THEN l_partkey END AS l_partkey, CASE WHEN l_orderkey % 7 > 0 THEN l_suppkey END AS l_suppkey) FROM '{sf}/lineitem.parquet') TO '{folder}/lineitem.parquet'")
    con.execute(f"COPY (SELECT * FROM '{sf}/nation.parquet') TO '{folder}/nation.parquet'")
    return folder


@pytest.mark.parametrize("name", ["geo1_wkt", "geo1b_wkt_trimmed"])
def test_same_rows(spark, nulls, name):
    same(spark, nulls, name, catalog.ORACLES[name])


LINES = [([(1.0, 2.0), (None, 3.0), (0.0, -4.5)], "1.0000000 2.0000000, 0.0000000 -4.5000000", "1 2, 0 -4.5"), ([(None, 1.0), (1.0, None)], None, None), ([], None, None), (None, None, None)]


def test_line_text(spark):
    """A vertex without both numbers is left out, a line without vertices has no text."""
    df = spark.createDataFrame([(i, p) for i, (p, _, _) in enumerate(LINES)], "i int, p array<struct<x: double, y: double>>").orderBy("i")
    texts = lambda at: [t and f"LINESTRING ({t})" for t in (r[at] for r in LINES)]
    assert [r[0] for r in df.select(G.wkt_line(F.col("p"))).collect()] == texts(1)
    flat = F.flatten(F.transform("p", lambda v: F.array(v["x"], v["y"])))
    assert [r[0] for r in df.select(G.wkt_trimmed(flat)).collect()] == texts(2)


def test_pbf_without_null_ways(spark, nulls):
    """A way without a number cannot be written, and the SQL has none."""
    same(spark, nulls, "src5_pbf", catalog.ORACLES["src5_pbf"])
