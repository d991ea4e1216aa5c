import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wayfold.functions import geometry as G
from wayfold.operators import coverage, spatial


def km(spark, *wkt):
    df = spark.createDataFrame([(i, w) for i, w in enumerate(wkt)], "i int, w string")
    rows = df.orderBy("i").select(G.line_km("w"), G.line_length_km("w")).collect()
    return [r[0] for r in rows], [r[1] for r in rows]


def test_lengths(spark):
    fast, exact = km(spark, "LINESTRING (0 0, 1 0)", "LINESTRING (0 0, 0 1)", "LINESTRING (179.9 10, -179.9 10)", "LINESTRING (5 5, 5 5)")
    assert exact[0] == pytest.approx(111.3194908, abs=1e-6) and exact[1] == pytest.approx(110.5743886, abs=1e-6)
    assert fast[1] == pytest.approx(110.5743604, abs=1e-6) and fast[2] == pytest.approx(21.928, abs=1e-2) and fast[3] == exact[3] == 0.0


def test_bad_geometry(spark):
    fast, exact = km(spark, "POINT (1 2)", "LINESTRING (1 2)", "LINESTRING EMPTY", None, "garbage", "LINESTRING (0 0, 200 0)", "LINESTRING (0 0, x 1)")
    assert fast == [None] * 7 and exact == [None] * 7


def test_parts():
    line, twice, mixed = G.exact_km(pd.Series(["LINESTRING (0 0, 1 0)", "MULTILINESTRING ((0 0, 1 0), (5 0, 6 0))", "GEOMETRYCOLLECTION (POINT (1 1), LINESTRING (0 0, 1 0))"]))
    assert twice == pytest.approx(2 * line) and mixed == line


def test_reversal_and_split():
    rng = np.random.default_rng(1)
    p = np.column_stack((rng.uniform(-170, 170, 20), rng.uniform(-70, 70, 20))) * 0.01
    text = lambda q: "LINESTRING (" + ", ".join(f"{x:.9f} {y:.9f}" for x, y in q) + ")"
    whole, back, a, b = G.exact_km(pd.Series([text(p), text(p[::-1]), text(p[:8]), text(p[7:])]))
    assert whole == pytest.approx(back) and whole == pytest.approx(a + b)


SQUARE = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0)]
HOLE = [(4.0, 4.0), (6.0, 4.0), (6.0, 6.0), (4.0, 6.0), (4.0, 4.0)]


def edges(spark, unit, *rings):
    rows = [(unit, *a, *b) for r in rings for a, b in zip(r[:-1], r[1:], strict=True)]
    return spark.createDataFrame(rows, "unit long, x1 double, y1 double, x2 double, y2 double")


def test_point_in_polygon_with_hole(spark):
    points = spark.createDataFrame([(1, 5.0, 5.0), (2, 2.0, 2.0), (3, 20.0, 5.0), (4, 4.5, 5.9)], "pid long, x double, y double")
    assert [tuple(r) for r in spatial.inside(points, edges(spark, 7, SQUARE, HOLE), res=2).collect()] == [(2, 7)]


def test_clip_join_equals_udf(spark):
    rng = np.random.default_rng(4)
    lines = {i: np.cumsum(np.vstack((rng.uniform(-3, 13, 2), rng.normal(0, 1.0, (4, 2)))), axis=0) for i in range(60)}
    lines[99] = np.array([[10.001, 2.0], [12.0, 2.0]])
    lines[98] = np.array([[10.01, 2.0], [12.0, 2.0]])
    e = edges(spark, 1, SQUARE)
    plain = np.array([[*a, *b] for a, b in zip(SQUARE[:-1], SQUARE[1:], strict=True)])
    want = {i for i, p in lines.items() if G.near_area([p], plain, 0.002)}
    rows = [(i, 1, k, float(x), float(y)) for i, p in lines.items() for k, (x, y) in enumerate(p)]
    got = spatial.touching(spark.createDataFrame(rows, "id long, unit long, i int, x double, y double"), e, 0.002)
    assert {r.id for r in got.collect()} == want and 99 in want and 98 not in want
    texts = spark.createDataFrame([(i, "LINESTRING (" + ", ".join(f"{x!r} {y!r}" for x, y in p.tolist()) + ")") for i, p in lines.items()], "i long, w string")
    assert {r.i for r in texts.where(G.touches_udf(plain)("w")).collect()} == want


def test_nearest_and_unassigned(spark):
    v = spark.createDataFrame([(1, i, 10.005 + i, 5.0) for i in range(1)] + [(2, 0, 5.0, 1.0), (3, 0, 50.0, 50.0)], "way long, i int, x double, y double")
    got = {r.way: (r.unit, r.boundary_match) for r in spatial.road_countries(v, edges(spark, 7, SQUARE), 2.0).collect()}
    assert got == {1: (7, "nearest"), 2: (7, "inside"), 3: (None, None)}


def test_geojson_boundaries(spark):
    ring = [list(p) for p in SQUARE]
    text = [("A", f'{{"type":"Polygon","coordinates":[{ring}]}}'), ("B", f'{{"type":"Feature","geometry":{{"type":"MultiPolygon","coordinates":[[{ring}]]}}}}'), ("C", None)]
    out = spatial.geojson_edges(spark.createDataFrame(text, "iso_a3 string, geometry_json string"))
    assert {(r.code, r.n) for r in out.groupBy(F.col("unit.code").alias("code")).agg(F.count("*").alias("n")).collect()} == {("A", 4), ("B", 4)}


def test_tile_plan(spark):
    tiles = spatial.tiles(spark.createDataFrame([("k", 0.0, 0.0, 10.0, 10.0)], "key string, s double, w double, n double, e double"), 5.0)
    prior = spark.createDataFrame([("k", "g5_0_0", "done"), ("k", "g5_0_1", "split"), ("k", "g5_0_1.2", "done")], "key string, tile string, status string")
    assert sorted(r.tile for r in spatial.plan(tiles, prior).collect()) == ["g5_0_1.0", "g5_0_1.1", "g5_0_1.3", "g5_1_0", "g5_1_1"]


def test_coverage_total_and_checks(spark):
    roads = spark.createDataFrame([(1, "A", "primary", "LINESTRING (0 0, 1 0)"), (2, "A", None, "LINESTRING (0 0, 0 1)"), (3, "B", "x", None)], "osm_id long, country string, kind string, geometry string")
    wide = coverage.wide(coverage.by_kind(coverage.long_by_spelling(roads)), spark.createDataFrame([("A",), ("B",), ("C",)], "country string"))
    assert wide.columns[:4] == ["country", "total_coverage_km", "primary_km", "secondary_km"]
    coverage.require(coverage.checks(wide), "coverage")
    assert {r.country: float(r.total_coverage_km) for r in wide.collect()} == {"A": 221.894, "B": 0.0, "C": 0.0}


def test_lines_equal_the_plain_grammar():
    """The batch parser gives what the grammar gives, a text at a time."""
    texts = ["LINESTRING (0 0, 1 0)", "linestring z (0 0 5,\n1 1e1 6 , 2 2 7)", "LINESTRING (0 0, 1)", "LINESTRING (0 0, 1-2 3)", "LINESTRING EMPTY", None, "", "POINT (1 2)", "LINESTRING (1 2)", "LINESTRING (0 0, .5 -.5)",
             "MULTILINESTRING ((0 0, 1 0), (5 0, 6 0, 7 1))", "GEOMETRYCOLLECTION (POINT (1 1), LINESTRING (0 0, 1 0))", "LINESTRING (0 0,, 1 1)", "LINESTRING (0  0,1   1)"]
    for some in (texts, [t for t in texts if t != "LINESTRING (0 0, 1-2 3)"], []):
        lines = G.parse_lines(pa.array(some, pa.string()))
        for i, t in enumerate(some):
            want = G.line_parts(t)
            got = [lines.xy[a:b].tolist() for a, b, o in zip(lines.first[:-1], lines.first[1:], lines.owner, strict=True) if o == i]
            assert lines.good[i] == (want is not None) and got == [p.tolist() for p in want or []], t


def test_segments(spark):
    df = spark.createDataFrame([(1, "MULTILINESTRING ((0 0, 1 0), (5 0, 6 0, 7 1))"), (2, "x"), (3, None), (4, "LINESTRING (1 2, 3 4)")], "k int, w string")
    got = {r.k: None if r.v is None else [tuple(v) for v in r.v] for r in df.select("k", G.line_segments("w").alias("v")).collect()}
    assert got == {1: [(0, 0, 1, 0, True), (5, 0, 6, 0, False), (6, 0, 7, 1, True)], 2: None, 3: None, 4: [(1, 2, 3, 4, True)]}


def test_inside_does_not_depend_on_slabs(spark):
    rng = np.random.default_rng(2)
    angle = np.sort(rng.uniform(0, 2 * np.pi, 400))
    star = [(float(x), float(y)) for x, y in zip(3 + 40 * np.cos(angle) * rng.uniform(0.3, 1, 400), 5 + 30 * np.sin(angle) * rng.uniform(0.3, 1, 400), strict=True)]
    e = edges(spark, 1, [*star, star[0]])
    p = rng.uniform((-45, -30), (50, 40), (500, 2))
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(p)], "pid long, x double, y double")
    plain = np.array([[*a, *b] for a, b in zip([*star], [*star[1:], star[0]], strict=True)])
    want = {i for i, (x, y) in enumerate(p) if (((plain[:, 1] > y) != (plain[:, 3] > y)) & (x < plain[:, 0] + (y - plain[:, 1]) * (plain[:, 2] - plain[:, 0]) / (plain[:, 3] - plain[:, 1]))).sum() % 2}
    for res in (None, 1, 7):
        assert {r.pid for r in spatial.inside(points, e, res).collect()} == want
    assert spatial.resolution(e) >= 1


def test_nearest_against_brute_force(spark):
    rng = np.random.default_rng(6)
    e = rng.uniform(-20, 20, (40, 4))
    table = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(e)], "unit long, x1 double, y1 double, x2 double, y2 double")
    p = rng.uniform(-25, 25, (300, 2))
    want = {}
    for i, (x, y) in enumerate(p):
        k = np.cos(np.radians(y))
        dx, dy, px, py = (e[:, 2] - e[:, 0]) * k, e[:, 3] - e[:, 1], (x - e[:, 0]) * k, y - e[:, 1]
        t = np.clip((px * dx + py * dy) / (dx * dx + dy * dy), 0, 1)
        d = np.hypot(px - t * dx, py - t * dy) * 111.195
        if d.min() <= 60:
            want[i] = int(d.argmin())
    got = {r.pid: r.unit for r in spatial.nearest(spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(p)], "pid long, x double, y double"), table, 60.0).collect()}
    assert got == want and len(want) > 50


def test_overlapping_rows_are_united(spark):
    """Two rows of a code that overlap do not cancel; a hole does; collections nested too deep are an error."""
    ring = lambda *p: [list(x) for x in p]
    outer, hole = ring(*SQUARE), ring(*HOLE)
    rows = [("A", f'{{"type":"Polygon","coordinates":[{outer}]}}'), ("A", f'{{"type":"Feature","geometry":{{"type":"Polygon","coordinates":[{[[x + 5, y, 9] for x, y in outer]}]}}}}'), ("B", f'{{"type":"Polygon","coordinates":[{outer}, {hole}]}}')]
    b = spark.createDataFrame(rows, "iso_a3 string, geometry_json string")
    points = spark.createDataFrame([(1, 7.0, 5.5), (2, 5.0, 5.0), (3, 12.0, 1.0)], "pid long, x double, y double")
    assert {(r.pid, r.code) for r in spatial.codes_of(points, b).collect()} == {(1, "A"), (2, "A"), (3, "A"), (1, "B")}
    deep = rows[0][1]
    for _ in range(spatial.COLLECTION_DEPTH):
        deep = f'{{"type":"GeometryCollection","geometries":[{deep}]}}'
    one = lambda t: spark.createDataFrame([("A", t)], "iso_a3 string, geometry_json string")
    assert spatial.geojson_edges(one(deep)).count() == 4
    with pytest.raises(Exception, match="too deep"):
        spatial.geojson_edges(one(f'{{"type":"GeometryCollection","geometries":[{deep}]}}')).count()


def test_clip_keeps_rows(spark):
    """Whole rows, repeated ones too; no line, no boundary or another code's area means out."""
    b = spark.createDataFrame([("A", f'{{"type":"Polygon","coordinates":[{[list(p) for p in SQUARE]}]}}'), ("N", None)], "iso_a3 string, geometry_json string")
    rows = [(1, "A", "LINESTRING (-5 5, 15 5)"), (1, "A", "LINESTRING (-5 5, 15 5)"), (2, "A", "LINESTRING (10.001 2, 12 2)"), (3, "A", "LINESTRING (10.01 2, 12 2)"), (4, "N", "LINESTRING (1 1, 2 2)"), (5, "A", None), (6, "A", "junk"),
            (7, None, "LINESTRING (1 1, 2 2)"), (8, "A", "MULTILINESTRING ((50 50, 51 51), (1 1, 2 2))")]
    roads = spark.createDataFrame(rows, "osm_id long, code string, geometry string").withColumns({"id": F.lit(1), "i": F.lit(2), "unit": F.lit(3)})
    kept = spatial.clip(roads, b, 0.002)
    assert kept.columns == roads.columns and sorted(r.osm_id for r in kept.collect()) == [1, 1, 2, 8]


def test_coverage_errors_and_policies(spark):
    raw = spark.createDataFrame([("A", "Ab", 1.0), ("A", "aB", 2.0)], "country string, kind string, km double")
    with pytest.raises(ValueError):
        coverage.kind_columns(raw)
    with pytest.raises(ValueError):
        coverage.kind_columns(raw.where("kind = 'Ab'").union(spark.createDataFrame([("A", "c", 1.0)], raw.schema)), most=1)
    short = coverage.wide(raw.where("kind = 'Ab'"), raw.select("country").distinct(), kinds=["primary"])
    assert not coverage.checks(short).first().passed  # a kind is missing from the columns: the total says so
    with pytest.raises(RuntimeError):
        coverage.require(coverage.checks(short), "coverage")
    assert coverage.not_empty(0, "zero", "x") and not coverage.not_empty(0, "skip", "x") and coverage.not_empty(5, "fail", "x")
    with pytest.raises(RuntimeError):
        coverage.not_empty(0, "fail", "x")
    assert not coverage.timestamps_present(spark.createDataFrame([(0,), (None,), (5,)], "osm_ts long")).first().passed
