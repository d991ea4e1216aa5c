"""WKT and lengths. Column expressions for single lines; an Arrow UDF for the whole grammar with exact geodesics."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfold.functions import values as V

_E2 = V.FLATTENING * (2 - V.FLATTENING)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seven_decimals(v: Column) -> Column:
    """Number text with seven decimals. By way of a decimal, which is far cheaper than a formatter; what a decimal would write with an exponent, or cannot hold, is left to one. NULL for no number."""
    return F.coalesce(F.when(F.abs(v) >= 1e-5, v.try_cast("decimal(18,7)").cast("string")), F.when(v.isNotNull(), F.format_string("%.7f", v)))


def wkt_line(points: Column | str) -> Column:
    """LINESTRING text of an array of (x, y) structs, seven decimals. Vertices without both numbers are left out; NULL if none has them."""
    c = _col(points)
    text = F.concat(F.lit("LINESTRING ("), F.array_join(F.transform(c, lambda p: F.concat(seven_decimals(p["x"]), F.lit(" "), seven_decimals(p["y"]))), ", "), F.lit(")"))
    return F.when(F.exists(c, lambda p: p["x"].isNotNull() & p["y"].isNotNull()), text)


def wkt_trimmed(flat: Column | str) -> Column:
    """LINESTRING text of a flat array x0, y0, x1, y1, ...; seven decimals, zeros at the end trimmed. Vertices without both numbers are left out; NULL if none has them."""
    short = lambda v: F.rtrim(F.rtrim(seven_decimals(v), F.lit("0")), F.lit("."))

    def body(c: Column) -> Column:
        at = F.sequence(F.lit(0), (F.size(c) / 2).cast("int") - 1)
        pairs = F.transform(at, lambda i: F.concat(short(F.get(c, 2 * i)), F.lit(" "), short(F.get(c, 2 * i + 1))))
        whole = F.exists(at, lambda i: F.get(c, 2 * i).isNotNull() & F.get(c, 2 * i + 1).isNotNull())
        return F.when(whole, F.concat(F.lit("LINESTRING ("), F.array_join(pairs, ", "), F.lit(")")))

    return bound(_col(flat), body)


def bound(value: Column, body) -> Column:
    """`body(value)` with the value computed once: a lambda over an array of one."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def line_points(wkt: Column | str) -> Column:
    """Array of (x, y) of a LINESTRING with one space inside vertices; NULL for anything else. Components that are no numbers are NULL."""
    number = lambda s, i: F.substring_index(F.substring_index(s, " ", i), " ", -1).try_cast("double")
    vertex = lambda s: F.struct(number(s, 1).alias("x"), number(s, 2).alias("y"))
    body = F.regexp_extract(_col(wkt), r"^\s*LINESTRING\s*\(([^()]*)\)\s*$", 1)
    return bound(body, lambda t: F.when(t != "", F.transform(F.split(t, ","), lambda s: bound(F.trim(s), vertex))))


def valid_points(points: Column | str) -> Column:
    """Vertices with finite coordinates in range."""
    return F.filter(_col(points), lambda p: p["x"].between(-180.0, 180.0) & p["y"].between(-90.0, 90.0))


def segment_m(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Metres between two points by the radii of curvature at the middle latitude; the longitude difference is wrapped. Steps follow each other as in the SQL twin, so that both
    round alike: in another order the last bits differ, and with them the third decimal of some segment in some hundred thousand."""
    mid = F.radians((y1 + y2) / 2)
    w = 1 - _E2 * (F.sin(mid) * F.sin(mid))
    east = F.radians(((x2 - x1 + 180.0) % 360.0 + 360.0) % 360.0 - 180.0) * V.EQUATOR_M / F.sqrt(w) * F.cos(mid)
    north = F.radians(y2 - y1) * V.EQUATOR_M * (1 - _E2) / (w * F.sqrt(w))
    return F.sqrt(east * east + north * north)


def line_m(points: Column | str) -> Column:
    """Metres along an array of points; NULL with fewer than two, or with a vertex that is missing or out of range."""

    def body(p: Column) -> Column:
        steps = F.zip_with(F.slice(p, 1, F.size(p) - 1), F.slice(p, 2, F.size(p) - 1), lambda a, b: segment_m(a["x"], a["y"], b["x"], b["y"]))
        good = F.forall(p, lambda v: F.coalesce(v["x"].between(-180.0, 180.0) & v["y"].between(-90.0, 90.0), F.lit(False)))
        return F.when((F.size(p) >= 2) & good, F.aggregate(steps, F.lit(0.0), lambda s, x: s + x))

    return bound(_col(points), body)


def line_km(wkt: Column | str) -> Column:
    """Kilometres of a LINESTRING; NULL if it has no usable geometry, never NaN."""
    return F.nanvl(line_m(line_points(wkt)) / 1000.0, F.lit(None).cast("double"))


def vincenty_m(lon1: np.ndarray, lat1: np.ndarray, lon2: np.ndarray, lat2: np.ndarray) -> np.ndarray:
    """Geodesic metres on the ellipsoid (Vincenty's inverse formula); NaN where it does not converge."""
    a, f = V.EQUATOR_M, V.FLATTENING
    b = a * (1 - f)
    with np.errstate(all="ignore"):
        u1, u2 = np.arctan((1 - f) * np.tan(np.radians(lat1))), np.arctan((1 - f) * np.tan(np.radians(lat2)))
        span = np.radians((lon2 - lon1 + 180.0) % 360.0 - 180.0)
        s1, c1, s2, c2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
        lam, done = span.copy(), np.zeros(len(span), bool)
        for _ in range(100):
            sl, cl = np.sin(lam), np.cos(lam)
            ss = np.hypot(c2 * sl, c1 * s2 - s1 * c2 * cl)
            cs = s1 * s2 + c1 * c2 * cl
            sigma = np.arctan2(ss, cs)
            sa = np.where(ss > 0, c1 * c2 * sl / np.where(ss > 0, ss, 1), 0.0)
            ca2 = 1 - sa * sa
            cm = np.where(ca2 > 1e-15, cs - 2 * s1 * s2 / np.where(ca2 > 1e-15, ca2, 1), 0.0)
            c = f / 16 * ca2 * (4 + f * (4 - 3 * ca2))
            new = span + (1 - c) * f * sa * (sigma + c * ss * (cm + c * cs * (2 * cm * cm - 1)))
            done = np.abs(new - lam) < 1e-13
            lam = new
            if done.all():
                break
        k = ca2 * (a * a - b * b) / (b * b)
        big = 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k)))
        small = k / 1024 * (256 + k * (-128 + k * (74 - 47 * k)))
        turn = small * ss * (cm + small / 4 * (cs * (2 * cm * cm - 1) - small / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3)))
        return np.where(done, b * big * (sigma - turn), np.nan)


_NUMBER = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"
_LINE = re.compile(r"^\s*LINESTRING\s*(?:Z|M|ZM)?\s*\(([^()]*)\)\s*$", re.I)
_MULTI = re.compile(r"^\s*MULTILINESTRING\s*(?:Z|M|ZM)?\s*\((.*)\)\s*$", re.I | re.S)
_COLLECTION = re.compile(r"^\s*GEOMETRYCOLLECTION\s*(?:Z|M|ZM)?\s*\((.*)\)\s*$", re.I | re.S)


def _members(body: str) -> list[str]:
    """Parts of a list at bracket depth 0."""
    out, depth, start = [], 0, 0
    for i, ch in enumerate(body):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            out.append(body[start:i])
            start = i + 1
    return [*out, body[start:]]


def line_parts(wkt: str | None) -> list[np.ndarray] | None:
    """Vertex arrays of the line parts, one level deep; None if the text is no geometry with a line of two points or more. The whole grammar, a text at a time."""
    if not wkt:
        return None

    def vertices(body: str) -> np.ndarray | None:
        rows = []
        for p in body.split(","):
            found = re.fullmatch(rf"\s*({_NUMBER})\s+({_NUMBER})(?:\s+{_NUMBER})*\s*", p)
            if not found:
                return None
            rows.append((float(found[1]), float(found[2])))
        return np.array(rows) if len(rows) >= 2 else None

    if m := _LINE.match(wkt):
        bodies = [m[1]]
    elif m := _MULTI.match(wkt):
        bodies = [p.strip()[1:-1] for p in _members(m[1]) if p.strip().startswith("(")]
    elif m := _COLLECTION.match(wkt):
        bodies = [x[1] for p in _members(m[1]) if (x := _LINE.match(p))]
    else:
        return None
    parts = [vertices(b) for b in bodies]
    return None if not parts or any(p is None for p in parts) else parts


_PLAIN_LINE = r"(?is)^\s*LINESTRING\s*(?:Z|M|ZM)?\s*\((?P<body>[-+0-9.eE,\s]+)\)\s*$"


class Lines(NamedTuple):
    """Line parts of a batch of texts: vertices one after the other, parts by their first vertex, and the text of each part."""

    xy: np.ndarray  # vertices x 2
    first: np.ndarray  # of each part, one more at the end
    owner: np.ndarray  # of each part
    good: np.ndarray  # of each text: whether it has usable lines

    def segments(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the segments, and the text of each."""
        inner = np.ones(len(self.xy), bool)
        inner[self.first[1:] - 1] = False
        at = np.flatnonzero(inner)
        return self.xy[at], self.xy[at + 1], np.repeat(self.owner, np.diff(self.first) - 1)


def parse_lines(texts: pa.Array) -> Lines:
    """Plain LINESTRING texts are taken apart by Arrow kernels, a batch at a time; all others, and those whose numbers do not parse, by `line_parts`."""
    body = pc.struct_field(pc.extract_regex(texts, _PLAIN_LINE), "body")
    plain = np.flatnonzero(np.asarray(pc.is_valid(body)))
    vertices = pc.split_pattern(body.take(pa.array(plain)), ",")
    count = np.asarray(pc.list_value_length(vertices), np.int64)
    tokens = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(vertices.flatten()))
    words = np.asarray(pc.list_value_length(tokens), np.int64)
    start, flat = np.cumsum(words) - words, tokens.flatten()
    last = np.cumsum(count)
    sound = (count >= 2) & (np.minimum.reduceat(words, last - count) >= 2) if len(count) else np.zeros(0, bool)
    xy = np.zeros((len(words), 2))
    try:
        numbers = np.asarray(pc.cast(flat, pa.float64()))
        usable = np.repeat(sound, count)
        xy[usable] = numbers[start[usable][:, None] + np.arange(2)]
    except pa.ArrowInvalid:  # some token is no number
        sound[:] = False
    keep = np.repeat(sound, count)
    xy, sizes, owner = xy[keep], count[sound], plain[sound]
    good = np.zeros(len(texts), bool)
    good[owner] = True
    more_xy, more_sizes, more_owner = [xy], [sizes], [owner]
    for i in np.flatnonzero(~good & np.asarray(pc.is_valid(texts))).tolist():
        parts = line_parts(texts[i].as_py())
        if parts is not None:
            good[i] = True
            more_xy += parts
            more_sizes.append(np.array([len(p) for p in parts]))
            more_owner.append(np.full(len(parts), i))
    xy, sizes, owner = np.concatenate(more_xy), np.concatenate(more_sizes).astype(np.int64), np.concatenate(more_owner).astype(np.int64)
    return Lines(xy, np.concatenate(([0], np.cumsum(sizes))), owner, good)


def _kilometres(texts: pa.Array, metres) -> pa.Array:
    """Sums of `metres` over the segments of each text; null without a usable line or with a vertex out of range."""
    lines = parse_lines(texts)
    a, b, owner = lines.segments()
    m = metres(a[:, 0], a[:, 1], b[:, 0], b[:, 1])
    m[(np.abs(a) > (180, 90)).any(axis=1) | (np.abs(b) > (180, 90)).any(axis=1)] = np.nan
    km = np.bincount(owner, m, minlength=len(texts)) / 1000.0
    return pa.array(km, mask=~lines.good | np.isnan(km))


def middle_m(lon1: np.ndarray, lat1: np.ndarray, lon2: np.ndarray, lat2: np.ndarray) -> np.ndarray:
    """As `segment_m`, for arrays."""
    mid = np.radians((lat1 + lat2) / 2)
    w = 1 - _E2 * np.sin(mid) * np.sin(mid)
    east = np.radians((lon2 - lon1 + 180.0) % 360.0 - 180.0) * (V.EQUATOR_M / np.sqrt(w)) * np.cos(mid)
    north = np.radians(lat2 - lat1) * (V.EQUATOR_M * (1 - _E2) / (w * np.sqrt(w)))
    return np.sqrt(east * east + north * north)


def _batches(parts: Iterator[pa.Array], metres) -> Iterator[pa.Array]:
    for texts in parts:
        yield _kilometres(texts.cast(pa.string()), metres)


@F.arrow_udf(T.DoubleType())
def line_length_km(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Exact geodesic kilometres of a WKT line, multi-line or collection."""
    yield from _batches(batches, vincenty_m)


@F.arrow_udf(T.DoubleType())
def line_length_mid_km(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Kilometres by the middle-latitude formula, same grammar; `line_km` is its form as an expression."""
    yield from _batches(batches, middle_m)


_SEGMENT = T.StructType([T.StructField(n, T.DoubleType()) for n in ("ax", "ay", "bx", "by")] + [T.StructField("last", T.BooleanType())])


@F.arrow_udf(T.ArrayType(_SEGMENT))
def line_segments(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Segments of WKT lines; `last` marks the end of a part. Null without a usable line."""
    for texts in batches:
        lines = parse_lines(texts.cast(pa.string()))
        a, b, owner = lines.segments()
        last = np.zeros(len(a), bool)
        last[np.cumsum(np.diff(lines.first) - 1) - 1] = True
        order = np.argsort(owner, kind="stable")
        cells = pa.StructArray.from_arrays([pa.array(v[order]) for v in (a[:, 0], a[:, 1], b[:, 0], b[:, 1], last)], ["ax", "ay", "bx", "by", "last"])
        cuts = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(texts))))).astype(np.int32)
        yield pa.ListArray.from_arrays(pa.array(cuts, mask=np.append(~lines.good, False)), cells)


def exact_km(texts: pd.Series) -> pd.Series:
    """Geodesic kilometres of WKT texts; NaN without a usable line or with a vertex out of range. Parts are not joined."""
    return _kilometres(pa.array(texts, pa.string(), from_pandas=True), vincenty_m).to_pandas()


def near_area(lines: list[np.ndarray], edges: np.ndarray, distance: float) -> bool:
    """Whether any line has a point inside the polygon (even-odd over its edges) or within `distance` of an edge."""
    for line in lines:
        for x, y in line:
            crosses = ((edges[:, 1] > y) != (edges[:, 3] > y)) & (x < edges[:, 0] + (y - edges[:, 1]) * (edges[:, 2] - edges[:, 0]) / np.where(edges[:, 3] == edges[:, 1], 1, edges[:, 3] - edges[:, 1]))
            if crosses.sum() % 2:
                return True
        for p, q in zip(line[:-1], line[1:], strict=True):
            if _segment_distance(p, q, edges).min(initial=np.inf) <= distance:
                return True
    return False


def _point_segments(px, py, x1, y1, x2, y2) -> np.ndarray:
    dx, dy = x2 - x1, y2 - y1
    t = np.clip(((px - x1) * dx + (py - y1) * dy) / np.maximum(dx * dx + dy * dy, 1e-300), 0, 1)
    return np.hypot(px - x1 - t * dx, py - y1 - t * dy)


def _segment_distance(p: np.ndarray, q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Distances of the segment pq to each edge; 0 where they cross."""
    x1, y1, x2, y2 = e.T
    side = lambda ax, ay, bx, by, cx, cy: (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)
    cross = (side(p[0], p[1], q[0], q[1], x1, y1) * side(p[0], p[1], q[0], q[1], x2, y2) < 0) & (side(x1, y1, x2, y2, p[0], p[1]) * side(x1, y1, x2, y2, q[0], q[1]) < 0)
    ends = np.minimum(_point_segments(p[0], p[1], x1, y1, x2, y2), _point_segments(q[0], q[1], x1, y1, x2, y2))
    ends = np.minimum(ends, np.minimum(_point_segments(x1, y1, *p, *q), _point_segments(x2, y2, *p, *q)))
    return np.where(cross, 0.0, ends)


def touching_texts(lines: Lines, edges: np.ndarray, distance: float, cells: int = 1 << 20) -> np.ndarray:
    """Of each text whether its lines touch the area, as `near_area` tells: all vertices and segments against all edges, some `cells` pairs at a time."""
    out = np.zeros(len(lines.good), bool)
    if not len(edges):
        return out
    step = max(1, cells // len(edges))
    x1, y1, x2, y2 = edges.T
    rise = np.where(y2 == y1, 1, y2 - y1)
    owner = np.repeat(lines.owner, np.diff(lines.first))
    for k in range(0, len(lines.xy), step):
        x, y = lines.xy[k : k + step, :1], lines.xy[k : k + step, 1:]
        crosses = ((y1 > y) != (y2 > y)) & (x < x1 + (y - y1) * (x2 - x1) / rise)
        out[owner[k : k + step][crosses.sum(axis=1) % 2 == 1]] = True
    a, b, owner = lines.segments()
    left = np.flatnonzero(~out[owner])
    for k in range(0, len(left), step):
        mine = left[k : k + step]
        (ax, ay), (bx, by) = a[mine].T[:, :, None], b[mine].T[:, :, None]
        side = lambda ox, oy, px, py, qx, qy: (px - ox) * (qy - oy) - (py - oy) * (qx - ox)
        cross = (side(ax, ay, bx, by, x1, y1) * side(ax, ay, bx, by, x2, y2) < 0) & (side(x1, y1, x2, y2, ax, ay) * side(x1, y1, x2, y2, bx, by) < 0)
        gap = np.minimum(_point_segments(ax, ay, x1, y1, x2, y2), _point_segments(bx, by, x1, y1, x2, y2))
        gap = np.minimum(gap, np.minimum(_point_segments(x1, y1, ax, ay, bx, by), _point_segments(x2, y2, ax, ay, bx, by)))
        out[owner[mine][(cross | (gap <= distance)).any(axis=1)]] = True
    return out


def touches_udf(edges: np.ndarray, distance: float = V.BUFFER_DEG):
    """An Arrow UDF: whether WKT lines touch the area with these edges (x1, y1, x2, y2), widened by `distance` degrees. False without a usable line."""

    @F.arrow_udf(T.BooleanType())
    def touches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(touching_texts(parse_lines(texts.cast(pa.string())), edges, distance))

    return touches
