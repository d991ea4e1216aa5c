"""Spatial joins by grid keys: point in polygon, roads to countries, nearest polygon, clipping, tiles. Plain equi-joins with a residual predicate.

A point is tested only against edges of its own y-slab, and there only against those of polygons that begin west of its x-block's end and edges that reach to it; slabs
are as thin as the number of edges asks for, so that work grows with the edges near a point. Adaptive execution splits a crowded slab.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfold.functions.geometry import line_segments

WORLD = 180.0
BLOCK_DEG, EDGES_A_SLAB, THINNEST = 15.0, 256, 1000


def usable_edges(edges: DataFrame) -> DataFrame:
    """Edges that do not run around the back of the world."""
    return edges.where(F.abs(F.col("x2") - F.col("x1")) <= WORLD)


def slab(y: Column, res: int) -> Column:
    return F.floor((y + 90.0) * res).cast("int")


def resolution(edges: DataFrame) -> int:
    """Slabs a degree that leave about EDGES_A_SLAB edges in each; boundaries are counted once, and are of dimension size."""
    row = edges.agg(F.count("*").alias("n"), (F.max(F.greatest("y1", "y2")) - F.min(F.least("y1", "y2"))).alias("span")).first()
    return max(1, min(THINNEST, int(row.n / (max(row.span or 0.0, 1.0) * EDGES_A_SLAB))))


def inside(points: DataFrame, edges: DataFrame, res: int | None = None, on: tuple[str, ...] = ()) -> DataFrame:
    """(pid, unit) for each polygon that holds the point, by counting the edges that a ray to the east crosses (even-odd, holes included). on: columns of both that must be
    equal, where a point asks for some polygons only."""
    res = resolution(edges) if res is None else res
    block = lambda x: F.floor(x / F.lit(BLOCK_DEG)).cast("int")
    used = usable_edges(edges)
    west = used.groupBy("unit").agg(F.min(F.least("x1", "x2")).alias("west"))
    cut = used.where("y1 <> y2").join(west, "unit").withColumn("slab", F.explode(F.sequence(slab(F.least("y1", "y2"), res), slab(F.greatest("y1", "y2"), res))))
    cut = cut.withColumn("block", F.explode(F.sequence(block(F.col("west")), block(F.greatest("x1", "x2"))))).drop("west")
    met = points.withColumn("slab", slab(F.col("y"), res)).withColumn("block", block(F.col("x"))).join(cut, ["slab", "block", *on])
    crosses = ((F.col("y1") > F.col("y")) != (F.col("y2") > F.col("y"))) & (F.col("x") < F.col("x1") + (F.col("y") - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1")))
    return met.where(crosses).groupBy("pid", "unit").agg(F.count("*").alias("n")).where("n % 2 = 1").select("pid", "unit")


def walked(segments: DataFrame, ends: tuple[str, str, str, str], size: float, pad_y: float, pad_x: Column) -> DataFrame:
    """Adds cy and cx: the cells of a grid that a segment widened by pad_x and pad_y degrees may touch, followed row by row along the segment."""
    x1, y1, x2, y2 = (F.col(c) for c in ends)
    cell = lambda v: F.floor(v / F.lit(size)).cast("long")
    low, high = F.least(y1, y2), F.greatest(y1, y2)
    rows = segments.withColumn("cy", F.explode(F.sequence(cell(low - pad_y), cell(high + pad_y))))
    at = lambda y: F.when(y1 == y2, x1).otherwise(x1 + (F.greatest(low, F.least(high, y)) - y1) * (x2 - x1) / (y2 - y1))
    a, b = at(F.col("cy") * size - pad_y), F.when(y1 == y2, x2).otherwise(at((F.col("cy") + 1) * size + pad_y))
    return rows.withColumn("cx", F.explode(F.sequence(cell(F.least(a, b) - pad_x), cell(F.greatest(a, b) + pad_x))))


def nearest(points: DataFrame, edges: DataFrame, max_km: float = 2.0) -> DataFrame:
    """(pid, unit, km) of the polygon with the closest edge within `max_km`, by cells a few times as wide; ties go to the smaller unit."""
    deg = max_km / 110.0
    wide = deg * 4
    pad = F.lit(deg) / F.greatest(F.cos(F.radians(F.least(F.lit(90.0), F.greatest(F.abs("y1"), F.abs("y2")) + deg))), F.lit(0.01))
    e = walked(usable_edges(edges), ("x1", "y1", "x2", "y2"), wide, deg, pad)
    p = points.withColumn("cy", F.floor(F.col("y") / wide).cast("long")).withColumn("cx", F.floor(F.col("x") / wide).cast("long"))
    k = F.cos(F.radians("y"))
    dx, dy = (F.col("x2") - F.col("x1")) * k, F.col("y2") - F.col("y1")
    px, py = (F.col("x") - F.col("x1")) * k, F.col("y") - F.col("y1")
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (px * dx + py * dy) / F.greatest(dx * dx + dy * dy, F.lit(1e-300))))
    km = F.sqrt((px - t * dx) ** 2 + (py - t * dy) ** 2) * F.lit(111.195)
    met = p.join(e, ["cy", "cx"]).withColumn("km", km).where(F.col("km") <= max_km)
    best = met.groupBy("pid").agg(F.min(F.struct("km", "unit")).alias("b"))
    return best.select("pid", F.col("b.unit").alias("unit"), F.col("b.km").alias("km"))


def road_units(vertices: DataFrame, edges: DataFrame, res: int | None = None) -> DataFrame:
    """way, unit, at: a row for each polygon that holds a vertex of the way; `at` is the inside vertex closest to the middle, ties to the lower. The middle is of the vertices'
    numbers (i, from 0), so that a number which is there twice does not move it."""
    pid = F.struct("way", "i")
    hits = inside(vertices.select(pid.alias("pid"), "x", "y"), edges, res).select("pid.way", "pid.i", "unit")
    middle = vertices.groupBy("way").agg(F.floor((F.max("i") + 1) / 2).cast("int").alias("mid"))
    return hits.join(middle, "way").groupBy("way", "unit").agg(F.min_by("i", F.struct(F.abs(F.col("i") - F.col("mid")), F.col("i"))).alias("at"))


def road_countries(vertices: DataFrame, edges: DataFrame, max_km: float = 2.0, res: int | None = None) -> DataFrame:
    """way, unit, at, boundary_match ('inside', 'nearest' or null): ways without a hit take the nearest polygon at their middle vertex."""
    hit = road_units(vertices, edges, res).withColumn("boundary_match", F.lit("inside"))
    lost = vertices.join(hit.select("way").distinct(), "way", "left_anti")
    middle = lost.groupBy("way").agg(F.floor(F.count("*") / 2).cast("int").alias("i")).join(lost, ["way", "i"])
    near = nearest(middle.select(F.col("way").alias("pid"), "x", "y"), edges, max_km).select(F.col("pid").alias("way"), "unit")
    match = F.when(F.col("unit").isNotNull(), "nearest")
    rest = middle.join(near, "way", "left").select("way", "unit", F.col("i").alias("at"), match.alias("boundary_match"))
    return hit.unionByName(rest)


def admin_of(points: DataFrame, edges: DataFrame, owners: DataFrame, res: int | None = None, max_km: float | None = None) -> DataFrame:
    """pid, unit: the lowest unit that holds the point (pid, x, y, iso) or else, with `max_km`, the nearest within it; dropped if its country (owners: unit,
    unit_iso) is another; nulls agree."""
    found = inside(points, edges, res).groupBy("pid").agg(F.min("unit").alias("unit"))
    if max_km is not None:
        lost = points.join(found, "pid", "left_anti")
        found = found.unionByName(nearest(lost, edges, max_km).select("pid", "unit"))
    out = points.join(found.join(owners, "unit", "left"), "pid", "left")
    clash = (F.col("iso") != F.col("unit_iso")) & F.col("iso").isNotNull() & F.col("unit_iso").isNotNull()
    return out.select("pid", F.when(~F.coalesce(clash, F.lit(False)), F.col("unit")).alias("unit"))


def admin_levels(points: DataFrame, levels: list[tuple[DataFrame, DataFrame]], max_km: float | None = None) -> DataFrame:
    """pid and a column admin1, admin2, ... for each (edges, owners) given. The first level has a row a point; points that share a pid are one place to `admin_of`, and meet by
    pid at each further level, as rows of a join do."""
    out = None
    for k, (edges, owners) in enumerate(levels, 1):
        found = admin_of(points, edges, owners, max_km=max_km).withColumnRenamed("unit", f"admin{k}")
        out = found if out is None else out.join(found, "pid", "left")
    return points.select("pid") if out is None else out


def merged_units(edges: DataFrame, keys: DataFrame) -> DataFrame:
    """Edges whose units (keys: unit, key) are one unit a key, the smallest of them; units without a key stay as they are."""
    one = keys.where("key IS NOT NULL").groupBy("key").agg(F.min("unit").alias("merged"))
    named = keys.join(one, "key").select("unit", "merged")
    return edges.join(named, "unit", "left").withColumn("unit", F.coalesce("merged", "unit")).select(edges.columns)


def _segments_near(segs: DataFrame, edges: DataFrame, distance: float, cell: float, on: tuple[str, ...] = ()) -> DataFrame:
    """(id, unit) of segments (id, ax, ay, bx, by) that cross an edge or come within `distance` degrees of it."""
    met = walked(segs, ("ax", "ay", "bx", "by"), cell, distance, F.lit(distance)).join(walked(usable_edges(edges), ("x1", "y1", "x2", "y2"), cell, 0.0, F.lit(0.0)), ["cy", "cx", *on])
    side = lambda ax, ay, bx, by, cx, cy: (F.col(bx) - F.col(ax)) * (F.col(cy) - F.col(ay)) - (F.col(by) - F.col(ay)) * (F.col(cx) - F.col(ax))

    def away(px: str, py: str, x1: str, y1: str, x2: str, y2: str) -> Column:
        dx, dy = F.col(x2) - F.col(x1), F.col(y2) - F.col(y1)
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((F.col(px) - F.col(x1)) * dx + (F.col(py) - F.col(y1)) * dy) / F.greatest(dx * dx + dy * dy, F.lit(1e-300))))
        return F.sqrt(F.pow(F.col(px) - F.col(x1) - t * dx, F.lit(2.0)) + F.pow(F.col(py) - F.col(y1) - t * dy, F.lit(2.0)))

    crossing = (side("ax", "ay", "bx", "by", "x1", "y1") * side("ax", "ay", "bx", "by", "x2", "y2") < 0) & (side("x1", "y1", "x2", "y2", "ax", "ay") * side("x1", "y1", "x2", "y2", "bx", "by") < 0)
    gap = F.least(away("ax", "ay", "x1", "y1", "x2", "y2"), away("bx", "by", "x1", "y1", "x2", "y2"), away("x1", "y1", "ax", "ay", "bx", "by"), away("x2", "y2", "ax", "ay", "bx", "by"))
    return met.where(crossing | (gap <= distance)).select("id", "unit")


def touching(lines: DataFrame, edges: DataFrame, distance: float, cell: float = 1.0) -> DataFrame:
    """Lines (id, unit, i, x, y vertices) that touch the polygon of their own unit widened by `distance` degrees, as (id, unit): an inside vertex, or a segment close enough
    to an edge."""
    own = lines.select("id", "i", "x", "y").distinct()
    held = inside(own.select(F.struct("id", "i").alias("pid"), "x", "y"), edges).select("pid.id", "unit")
    nxt = Window.partitionBy("id").orderBy("i")
    segs = own.select("id", F.col("x").alias("ax"), F.col("y").alias("ay"), F.lead("x").over(nxt).alias("bx"), F.lead("y").over(nxt).alias("by")).where("bx IS NOT NULL")
    found = held.union(_segments_near(segs, edges, distance, cell)).distinct()
    return found.join(lines.select("id", "unit").distinct(), ["id", "unit"])


def clip(roads: DataFrame, boundaries: DataFrame, distance: float, code: str = "code", geometry: str = "geometry", cell: float = 1.0) -> DataFrame:
    """The roads, whole, that touch the boundary of their own code (column `code`) widened by `distance` degrees. boundaries: iso_a3, geometry_json, several rows a
    code, which are united: a road stays if any row's polygons take it. Roads without a usable line or whose code has no boundary go. Roads are told apart by code and line
    (128 bits of both), so that rows which repeat them stay or go together."""
    name = F.struct(F.xxhash64(code, geometry).alias("a"), F.xxhash64(F.lit("second"), code, geometry).alias("b"))
    texts = roads.where(F.col(code).isNotNull() & F.col(geometry).isNotNull()).select(name.alias("id"), F.col(code).alias("code_"), F.col(geometry).alias("text_")).dropDuplicates(["id"])
    edges = geojson_edges(boundaries.join(roads.select(F.col(code).alias("iso_a3")).distinct(), "iso_a3", "left_semi")).withColumn("code_", F.col("unit.code"))
    segs = texts.select("id", "code_", F.posexplode(line_segments("text_")).alias("at", "s")).select("id", "code_", "at", "s.*")
    ends = F.array(*[F.struct(F.col(f"{e}x").alias("x"), F.col(f"{e}y").alias("y")) for e in "ab"])
    points = segs.select("id", "code_", "at", F.posexplode(F.when(F.col("last"), ends).otherwise(F.slice(ends, 1, 1))).alias("end", "p"))
    held = inside(points.select("code_", F.struct("id", "at", "end").alias("pid"), "p.x", "p.y"), edges, on=("code_",)).select("pid.id")
    near = _segments_near(segs.select("id", "code_", "ax", "ay", "bx", "by"), edges, distance, cell, on=("code_",)).select("id")
    return roads.join(held.union(near).distinct().withColumnRenamed("id", "kept_"), name == F.col("kept_"), "left_semi")


def ring_clean(points: Column, grid: float | None) -> Column:
    """A ring rounded to a grid, repeated vertices dropped, closed; null with fewer than four points. points: array of (x, y)."""
    snapped = points if not grid else F.transform(points, lambda p: F.struct((F.round(p["x"] / grid) * grid).alias("x"), (F.round(p["y"] / grid) * grid).alias("y")))
    kept = F.filter(snapped, lambda p, i: (i == 0) | (p != F.element_at(snapped, F.greatest(i, F.lit(1)))))
    closed = F.when(F.element_at(kept, 1) == F.element_at(kept, -1), kept).otherwise(F.concat(kept, F.slice(kept, 1, 1)))
    return F.when(F.size(closed) >= 4, closed)


_RING = "array<array<array<double>>>"
COLLECTION_DEPTH = 4


def _leaves(geometry: Column, depth: int) -> Column:
    """The geometries of a GeoJSON text, collections taken apart."""
    deeper = F.raise_error(F.lit("geometry collections are nested too deep")).cast("array<string>")
    members = F.from_json(F.get_json_object(geometry, "$.geometries"), "array<string>")
    inner = F.flatten(F.transform(members, lambda g: _leaves(g, depth - 1))) if depth else deeper
    return F.when(F.get_json_object(geometry, "$.type") == "GeometryCollection", inner).otherwise(F.array(geometry))


def geojson_edges(boundaries: DataFrame, code: str = "iso_a3", text: str = "geometry_json") -> DataFrame:
    """unit, x1, y1, x2, y2 of GeoJSON Polygons and MultiPolygons, bare, in a Feature or in collections (up to COLLECTION_DEPTH deep, beyond it an error); other
    geometries have no area. Heights are dropped, rings with fewer than three points go. The unit is the struct (code, row, part, piece): each row of a code and each of its
    polygons is judged by itself, and whoever asks for the code takes any (`clip`, `codes_of`)."""
    geometry = F.coalesce(F.get_json_object(text, "$.geometry"), F.col(text))
    rows = boundaries.where(F.col(text).isNotNull()).select(F.col(code).alias("code"), F.xxhash64(text).alias("row"), F.posexplode(_leaves(geometry, COLLECTION_DEPTH)).alias("part", "leaf"))
    kind, body = F.get_json_object("leaf", "$.type"), F.get_json_object("leaf", "$.coordinates")
    polygons = F.when(kind == "Polygon", F.array(F.from_json(body, _RING))).when(kind == "MultiPolygon", F.from_json(body, f"array<{_RING}>"))
    pieces = rows.select("code", "row", "part", F.posexplode(polygons).alias("piece", "rings"))
    rings = pieces.select(F.struct("code", "row", "part", "piece").alias("unit"), F.explode("rings").alias("ring")).where(F.size("ring") >= 3)
    pairs = F.arrays_zip(F.slice("ring", 1, F.size("ring") - 1), F.slice("ring", 2, F.size("ring") - 1))
    steps = rings.select("unit", F.explode(pairs).alias("p")).select("unit", F.col("p.0").alias("a"), F.col("p.1").alias("b"))
    closing = rings.where(F.element_at("ring", 1) != F.element_at("ring", -1)).select("unit", F.element_at("ring", -1).alias("a"), F.element_at("ring", 1).alias("b"))
    return steps.union(closing).select("unit", F.get("a", F.lit(0)).alias("x1"), F.get("a", F.lit(1)).alias("y1"), F.get("b", F.lit(0)).alias("x2"), F.get("b", F.lit(1)).alias("y2"))


def codes_of(points: DataFrame, boundaries: DataFrame) -> DataFrame:
    """(pid, code): the codes any of whose rows holds the point. Rows and polygons are united, never cancelled."""
    return inside(points, geojson_edges(boundaries)).select("pid", F.col("unit.code").alias("code")).distinct()


def edges_array(edges: DataFrame, most: int = 100_000) -> np.ndarray:
    """x1, y1, x2, y2 of one boundary's edges for `touches_udf`; a boundary of more than `most` edges is an error, and a case for `clip`."""
    rows = usable_edges(edges).select("x1", "y1", "x2", "y2").take(most + 1)
    if len(rows) > most:
        raise ValueError(f"more than {most} edges")
    return np.array([tuple(r) for r in rows], float).reshape(-1, 4)


def normal_box(s: Column, w: Column, n: Column, e: Column) -> list[Column]:
    """Corners clamped to the world and ordered; degenerate sides are widened by a hundredth of a degree."""
    s2, n2 = F.greatest(F.lit(-90.0), F.least(s, n)), F.least(F.lit(90.0), F.greatest(s, n))
    w2, e2 = F.greatest(F.lit(-180.0), F.least(w, e)), F.least(F.lit(180.0), F.greatest(w, e))
    thin_y, thin_x = n2 - s2 < 1e-3, e2 - w2 < 1e-3
    grow = lambda c, d, thin: F.when(thin, c + d).otherwise(c)
    return [grow(s2, -0.01, thin_y).alias("s"), grow(w2, -0.01, thin_x).alias("w"), grow(n2, 0.01, thin_y).alias("n"), grow(e2, 0.01, thin_x).alias("e")]


def tiles(boxes: DataFrame, deg: float) -> DataFrame:
    """Cells of a world-wide lattice, clipped to each box (key, s, w, n, e); ids are stable between runs."""
    steps = lambda low, high: F.sequence(F.floor(F.col(low) / deg).cast("int"), F.ceil(F.col(high) / deg).cast("int") - 1)
    grid = boxes.withColumn("i", F.explode(steps("s", "n"))).withColumn("j", F.explode(steps("w", "e")))
    out = grid.select(
        "key", F.format_string(f"g{deg:g}_%d_%d", "i", "j").alias("tile"),
        F.greatest(F.col("s"), F.col("i") * F.lit(deg)).alias("s"), F.greatest(F.col("w"), F.col("j") * F.lit(deg)).alias("w"),
        F.least(F.col("n"), (F.col("i") + 1) * F.lit(deg)).alias("n"), F.least(F.col("e"), (F.col("j") + 1) * F.lit(deg)).alias("e"),
    )
    return out.where((F.col("n") - F.col("s") > 1e-9) & (F.col("e") - F.col("w") > 1e-9)).withColumn("depth", F.lit(0))


def split(tiles_: DataFrame) -> DataFrame:
    """Each tile's four quarters: south-west, south-east, north-west, north-east."""
    ms, mw = (F.col("s") + F.col("n")) / 2.0, (F.col("w") + F.col("e")) / 2.0
    box = lambda k, s, w, n, e: F.struct(F.lit(k).alias("k"), s.alias("s"), w.alias("w"), n.alias("n"), e.alias("e"))
    s, w, n, e = (F.col(c) for c in "swne")
    quarters = F.explode(F.array(box(0, s, w, ms, mw), box(1, s, mw, ms, e), box(2, ms, w, n, mw), box(3, ms, mw, n, e))).alias("q")
    out = tiles_.select("key", "tile", "depth", quarters)
    return out.select("key", F.concat_ws(".", "tile", "q.k").alias("tile"), *[F.col(f"q.{c}").alias(c) for c in "swne"], (F.col("depth") + 1).alias("depth"))


def prune(tiles_: DataFrame, outline: DataFrame, margin: float = 0.25, least: int = 12) -> DataFrame:
    """Tiles near the outline's boxes (key, os, ow, on_, oe); keys with at most `least` tiles, or whose tiles would all go, keep theirs."""
    sizes = tiles_.groupBy("key").agg(F.count("*").alias("n_tiles"))
    near = tiles_.join(outline, "key").where((F.col("w") - margin <= F.col("oe")) & (F.col("e") + margin >= F.col("ow")) & (F.col("s") - margin <= F.col("on_")) & (F.col("n") + margin >= F.col("os")))
    near = near.select("key", "tile").distinct().withColumn("near", F.lit(True))
    some = near.select("key").distinct().withColumn("some", F.lit(True))
    out = tiles_.join(sizes, "key").join(near, ["key", "tile"], "left").join(some, "key", "left")
    return out.where((F.col("n_tiles") <= least) | F.col("some").isNull() | F.col("near")).select(tiles_.columns)


def plan(tiles_: DataFrame, prior: DataFrame, max_depth: int = 6) -> DataFrame:
    """Tiles still to do: done ones are skipped, split ones give way to their quarters, down to `max_depth`. prior: key, tile, status."""
    todo, level = None, tiles_
    for _ in range(max_depth + 1):
        known = level.join(prior, ["key", "tile"], "left")
        divided = (F.col("status") == "split") & (F.col("depth") < max_depth)
        mine = known.where(F.col("status").isNull() | ((F.col("status") != "done") & ~divided)).select(tiles_.columns)
        todo = mine if todo is None else todo.unionByName(mine)
        level = split(known.where(divided).select(tiles_.columns))
    return todo
