"""The engine's queries over reference-shaped inputs, each with its SQL twin."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfold.functions import geometry as G
from wayfold.functions import tags as N
from wayfold.functions import values as V
from wayfold.operators import coverage, dedup, spatial
from wayfold.plans.registry import ORACLES, QUERIES, query  # noqa: F401  ORACLES and QUERIES are read from here
from wayfold.sources import readers
from wayfold.sources.fixtures import table, view
from wayfold.streaming import ingest

def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


# --- lengths -------------------------------------------------------------------------------------------------------------------

_E2 = f"CAST({V.FLATTENING * (2 - V.FLATTENING)!r} AS DOUBLE)"


def _segment(x1: str, y1: str, x2: str, y2: str) -> str:
    w = f"(1 - {_E2}*pow(sin(radians(({y1}+{y2})/2)),2))"
    east = f"radians(((({x2}-{x1}+180.0)%360.0+360.0)%360.0)-180.0)*{V.EQUATOR_M}/sqrt({w})*cos(radians(({y1}+{y2})/2))"
    north = f"radians({y2}-{y1})*{V.EQUATOR_M}*(1-{_E2})/({w}*sqrt({w}))"
    return f"sqrt(pow({east},2)+pow({north},2))"


_POINTS = r"""CASE WHEN regexp_matches(geometry, '^\s*LINESTRING\s*\([^()]+\)\s*$') THEN list_transform(string_split(regexp_extract(geometry, '^\s*LINESTRING\s*\(([^()]*)\)\s*$', 1), ','),
 lambda s: {'x': TRY_CAST(string_split_regex(trim(s), ' +')[1] AS DOUBLE), 'y': TRY_CAST(string_split_regex(trim(s), ' +')[2] AS DOUBLE)}) END"""
_KM = "CASE WHEN len(p) >= 2 THEN list_sum(list_transform(range(1, len(p)), lambda i: " + _segment("p[i].x", "p[i].y", "p[i+1].x", "p[i+1].y") + "))/1000.0 END"
_MEASURED = f"WITH+ parsed AS (SELECT *, {_POINTS} AS p FROM roads), measured AS (SELECT *, {_KM} AS km FROM parsed)"
_KIND = r"coalesce(nullif(regexp_replace(regexp_replace(lower(trim(KIND)), '[^\p{L}\p{N}]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'unknown')"
_LONG = _MEASURED + ", long_raw AS (SELECT country, kind AS kind_raw, coalesce(sum(km), 0.0) AS km, count(*) AS segments, CAST(sum(CASE WHEN km IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS bad_geometry FROM measured GROUP BY ALL)"
_BYKIND = _LONG + f", long_ AS (SELECT country, {_KIND.replace('KIND', 'kind_raw')} AS kind, sum(km) AS km, CAST(sum(segments) AS BIGINT) AS segments, CAST(sum(bad_geometry) AS BIGINT) AS bad_geometry FROM long_raw GROUP BY ALL)"


def _long(spark: SparkSession, d: str) -> DataFrame:
    return coverage.long_by_spelling(view(spark, d, "roads"))


@query("coverage", _BYKIND + " SELECT country, kind, CAST(km AS DECIMAL(20,3)) AS km, segments, bad_geometry FROM long_", "roads")
def coverage_by_kind(spark, d):
    return coverage.by_kind(_long(spark, d)).withColumn("km", N.decimal_km("km"))


@query("agg1_long_by_spelling", _LONG + " SELECT country, kind_raw, CAST(km AS DECIMAL(20,3)) AS km, segments, bad_geometry FROM long_raw", "roads")
def long_by_spelling(spark, d):
    return _long(spark, d).withColumn("km", N.decimal_km("km"))


_WIDE = [f"CAST(coalesce(sum(CASE WHEN kind = '{k}' THEN km ELSE 0.0 END), 0.0) AS DECIMAL(20,3)) AS {k}_km" for k in ("primary", "secondary", "tertiary", "tertiary_link", "track", "unknown")]
_WIDE_SQL = _BYKIND + ", w AS (SELECT n_name AS country, CAST(coalesce(sum(km), 0.0) AS DECIMAL(20,3)) AS total_coverage_km, " + ", ".join(_WIDE) + " FROM nation LEFT JOIN long_ ON n_name = country GROUP BY n_name)"


def _wide(spark, d):
    return coverage.wide(coverage.small(coverage.by_kind(_long(spark, d))), table(spark, d, "nation").select(F.col("n_name").alias("country")))


@query("agg5_wide_coverage", _WIDE_SQL + " SELECT * FROM w", "roads")
def wide_coverage(spark, d):
    return _wide(spark, d)


@query("agg4_spellings", _LONG + f", v AS (SELECT *, {_KIND.replace('KIND', 'kind_raw')} AS kind FROM long_raw) SELECT kind, count(DISTINCT country) AS countries, CAST(round(sum(km), 1) AS DECIMAL(20,1)) AS total_km, list_sort(list(DISTINCT coalesce(kind_raw, '<NULL>'))) AS spellings_in_source FROM v GROUP BY kind", "roads")
def spellings(spark, d):
    return coverage.spellings(_long(spark, d)).withColumn("total_km", F.col("total_km").cast("decimal(20,1)"))


_KMS = [w.rpartition(" AS ")[2] for w in _WIDE]
_GAP = f"abs(total_coverage_km - ({' + '.join(_KMS)}))"
_NULLS = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in ("country", "total_coverage_km", *_KMS))


@query("agg7_chk2_chk3_coverage", _WIDE_SQL + f" SELECT count(*) AS rows, count(DISTINCT country) AS countries, CAST({_NULLS} AS BIGINT) AS nulls, CAST(max({_GAP}) AS DECIMAL(20,3)) AS gap, count(*) = count(DISTINCT country) AND {_NULLS} = 0 AND max({_GAP}) <= 0.01 AS passed FROM w", "roads")
def coverage_checks(spark, d):
    return coverage.checks(_wide(spark, d)).withColumn("gap", F.col("gap").cast("decimal(20,3)"))


@query("chk6_timestamps", "SELECT count(*) AS rows, count(*) FILTER (WHERE coalesce(osm_ts, 0) <= 0) AS missing, count(*) = 0 OR count(*) FILTER (WHERE coalesce(osm_ts, 0) <= 0) < 0.5 * count(*) AS passed FROM road_tags", "road_tags")
def timestamps(spark, d):
    return coverage.timestamps_present(view(spark, d, "road_tags"))


@query("flt8_bad_geometry", _MEASURED + " SELECT osm_id, country, kind, geometry FROM measured WHERE km IS NULL", "roads")
def bad_geometry(spark, d):
    return view(spark, d, "roads").where(G.line_km("geometry").isNull())


@query("geo2_line_km", _MEASURED + " SELECT osm_id, CAST(km AS DECIMAL(20,6)) AS km FROM measured", "roads")
def line_km(spark, d):
    return view(spark, d, "roads").select("osm_id", G.line_km("geometry").cast("decimal(20,6)").alias("km"))


@query("geo2_exact_km")
def exact_km(spark, d):
    return view(spark, d, "roads").select("osm_id", F.round(G.line_length_km("geometry"), 6).alias("km"))


@query("geo4_segment_m", f"SELECT way, i, CAST({_segment('x', 'y', 'x2', 'y2')} AS DECIMAL(20,3)) AS m FROM (SELECT *, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM vertices WINDOW w AS (PARTITION BY way ORDER BY i)) WHERE x2 IS NOT NULL", "vertices")
def segment_m(spark, d):
    w = Window.partitionBy("way").orderBy("i", "x", "y")  # numbers that are there twice follow each other in one order, run after run
    v = view(spark, d, "vertices").withColumns({"x2": F.lead("x").over(w), "y2": F.lead("y").over(w)}).where("x2 IS NOT NULL")
    return v.select("way", "i", G.segment_m(F.col("x"), F.col("y"), F.col("x2"), F.col("y2")).cast("decimal(20,3)").alias("m"))


@query("geo5_lengths", _MEASURED + " SELECT osm_id, round(km*1000.0, 2) AS length_m, CAST(CAST(CAST(round(km*1000.0, 2)/1000 AS VARCHAR) AS DECIMAL(20,4)) AS DOUBLE) AS length_km FROM measured", "roads")
def lengths(spark, d):
    m = view(spark, d, "roads").select("osm_id", F.round(G.line_m(G.line_points("geometry")), 2).alias("length_m"))
    return m.withColumn("length_km", F.round(F.col("length_m") / 1000, 4))


@query("geo6_vertices", _MEASURED + " SELECT osm_id, CAST(len(p) AS INT) AS n, CAST(len(p) // 2 AS INT) AS mid, p[len(p) // 2 + 1].x AS mid_x FROM measured WHERE p IS NOT NULL", "roads")
def vertex_facts(spark, d):
    p = view(spark, d, "roads").select("osm_id", G.line_points("geometry").alias("p")).where("p IS NOT NULL")
    mid = F.floor(F.size("p") / 2).cast("int")
    return p.select("osm_id", F.size("p").alias("n"), mid.alias("mid"), F.get("p", mid)["x"].alias("mid_x"))


@query("flt2_two_vertices", _MEASURED + " SELECT osm_id FROM measured WHERE len(list_filter(p, lambda v: v.x BETWEEN -180.0 AND 180.0 AND v.y BETWEEN -90.0 AND 90.0)) >= 2", "roads")
def two_vertices(spark, d):
    return view(spark, d, "roads").where(F.size(G.valid_points(G.line_points("geometry"))) >= 2).select("osm_id")


_WAYS = "SELECT way, string_agg(printf('%.7f %.7f', x, y), ', ' ORDER BY i) AS body FROM vertices GROUP BY way"


@query("geo1_wkt", f"SELECT way, 'LINESTRING (' || body || ')' AS geometry FROM ({_WAYS})", "vertices")
def wkt(spark, d):
    ways = view(spark, d, "vertices").groupBy("way").agg(F.sort_array(F.collect_list(F.struct("i", "x", "y"))).alias("p"))
    return ways.select("way", G.wkt_line("p").alias("geometry"))


@query("geo1b_wkt_trimmed", r"SELECT way, 'LINESTRING (' || string_agg(regexp_replace(printf('%.7f', x), '\.?0+$', '') || ' ' || regexp_replace(printf('%.7f', y), '\.?0+$', ''), ', ' ORDER BY i) || ')' AS geometry FROM vertices GROUP BY way", "vertices")
def wkt_trimmed(spark, d):
    ways = view(spark, d, "vertices").groupBy("way").agg(F.sort_array(F.collect_list(F.struct("i", "x", "y"))).alias("p"))
    return ways.select("way", G.wkt_trimmed(F.flatten(F.transform("p", lambda v: F.array(v["x"], v["y"])))).alias("geometry"))


# --- attributes ----------------------------------------------------------------------------------------------------------------

_SPEED = r"""CASE WHEN regexp_matches(trim(maxspeed), '(?i)^[0-9.]+\s*mph$') THEN round(TRY_CAST(regexp_extract(trim(maxspeed), '^([0-9.]+)', 1) AS DOUBLE)*1.60934, 1)
 WHEN regexp_matches(trim(maxspeed), '(?i)^[0-9.]+\s*knots?$') THEN round(TRY_CAST(regexp_extract(trim(maxspeed), '^([0-9.]+)', 1) AS DOUBLE)*1.852, 1)
 WHEN regexp_matches(trim(maxspeed), '(?i)^[0-9.]+\s*(km/h|kmh|kph)?$') THEN TRY_CAST(regexp_extract(trim(maxspeed), '^([0-9.]+)', 1) AS DOUBLE) END"""
_SURFACE = f"""CASE WHEN lower(trim(surface)) IN ({_list(V.PAVED)}) THEN 'paved' WHEN lower(trim(surface)) IN ({_list(V.UNPAVED)}) THEN 'unpaved'
 WHEN lower(trim(highway)) IN ({_list(V.INFERRED_PAVED)}) THEN 'paved' WHEN lower(trim(highway)) IN ({_list(V.INFERRED_UNPAVED)}) THEN 'unpaved' ELSE 'unknown' END"""
_CLASS = "CASE lower(trim(highway)) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in V.HIGHWAY_CLASS.items()) + " ELSE 'other' END"
_SHAPED = f"""WITH+ shaped AS (SELECT osm_id, osm_version, country, highway, {_CLASS} AS highway_class, {_SURFACE} AS surface_type, name AS road_name,
 CASE WHEN regexp_matches(trim(lanes), '^[0-9]+$') THEN CAST(trim(lanes) AS INT) END AS lanes, {_SPEED} AS maxspeed_kmh, coalesce(oneway, 'no') AS oneway,
 CASE WHEN bridge IS NULL THEN false ELSE lower(trim(bridge)) NOT IN ('no', 'false', '0', '') END AS bridge,
 CASE WHEN osm_ts > 0 THEN osm_ts END AS edited, length_m, round(length_m/1000.0, 4) AS length_km FROM road_tags)"""


def shaped(spark: SparkSession, d: str) -> DataFrame:
    r = view(spark, d, "road_tags")
    return r.select(
        "osm_id", "osm_version", "country", "highway", N.highway_class("highway").alias("highway_class"), N.surface_type("surface", "highway").alias("surface_type"),
        F.col("name").alias("road_name"), N.lanes("lanes").alias("lanes"), N.parse_speed_kmh("maxspeed").alias("maxspeed_kmh"), F.coalesce("oneway", F.lit("no")).alias("oneway"),
        N.flag("bridge").alias("bridge"), F.unix_timestamp(N.epoch_timestamp("osm_ts")).alias("edited"), "length_m", F.round(F.col("length_m") / 1000.0, 4).alias("length_km"),
    )


@query("prj1_attributes", _SHAPED + " SELECT * FROM shaped", "road_tags")
def attributes(spark, d):
    return shaped(spark, d)


@query("fn3_speed", _SHAPED + " SELECT maxspeed_kmh, count(*) AS n FROM shaped GROUP BY 1", "road_tags")
def speeds(spark, d):
    return shaped(spark, d).groupBy("maxspeed_kmh").agg(F.count("*").alias("n"))


@query("fn4_surface_fn5_class", _SHAPED + " SELECT highway_class, surface_type, count(*) AS n FROM shaped GROUP BY 1, 2", "road_tags")
def classes(spark, d):
    return shaped(spark, d).groupBy("highway_class", "surface_type").agg(F.count("*").alias("n"))


@query("fn1_clean_kind", f"SELECT DISTINCT kind AS raw, {_KIND.replace('KIND', 'kind')} AS kind FROM roads", "roads")
def clean_kinds(spark, d):
    return view(spark, d, "roads").select(F.col("kind").alias("raw"), N.clean_kind("kind").alias("kind")).distinct()


@query("fn2_one_line", r"SELECT doc_id, regexp_replace(text, '[\r\n]+', ' ', 'g') AS text, lang, source FROM documents")
def one_line(spark, d):
    return N.one_line(table(spark, d, "documents").select("doc_id", "text", "lang", "source"))


@query("fn10_text_timestamp", "SELECT event_id, epoch_us(TRY_CAST(CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN 'soon' END AS TIMESTAMP)) // 1000000 AS at FROM events")
def text_timestamps(spark, d):
    e = table(spark, d, "events")
    raw = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).when(F.col("event_id") % 3 == 1, "soon")
    return e.select("event_id", F.unix_timestamp(N.text_timestamp(raw)).alias("at"))


@query("fn11_decimal_km", "SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(20,3)) AS km FROM orders")
def decimals(spark, d):
    return table(spark, d, "orders").select("o_orderkey", N.decimal_km("o_totalprice").alias("km"))


@query("fn13_slug", "SELECT p_partkey, regexp_replace(regexp_replace(lower(regexp_replace(strip_accents('Ñandú ' || p_name || ' / Åre–' || p_type), '[^\\x00-\\x7F]', '', 'g')), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug FROM part")
def slugs(spark, d):
    return table(spark, d, "part").select("p_partkey", N.slug(F.concat(F.lit("Ñandú "), "p_name", F.lit(" / Åre–"), "p_type")).alias("slug"))


@query("fn14_readable_name", "SELECT n_name, CASE n_nationkey % 3 WHEN 0 THEN 'Democratic Republic of the ' || n_name ELSE n_name END AS readable FROM nation")
def readable(spark, d):
    n = table(spark, d, "nation")
    raw = F.when(F.col("n_nationkey") % 3 == 0, F.concat("n_name", F.lit(", The Democratic Republic of the"))).when(F.col("n_nationkey") % 3 == 1, F.concat("n_name", F.lit(" (Old State)"))).otherwise(F.col("n_name"))
    return n.select("n_name", N.readable_name(raw).alias("readable"))


@query("fn15_clean_code", "SELECT s_suppkey, CASE WHEN s_suppkey % 4 IN (0, 1, 2) THEN NULL ELSE 'C' || CAST(s_suppkey AS VARCHAR) END AS code FROM supplier")
def codes(spark, d):
    k = F.col("s_suppkey")
    raw = F.when(k % 4 == 0, " -99 ").when(k % 4 == 1, "n/a").when(k % 4 == 2, "").otherwise(F.concat(F.lit(" C"), k.cast("string")))
    return table(spark, d, "supplier").select("s_suppkey", N.clean_code(raw).alias("code"))


@query("fn16_first_present", "SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END, o_orderpriority) AS code FROM orders")
def first_present(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).alias("ISO_Code"), F.col("o_orderpriority").alias("code_alt"))
    return o.select("o_orderkey", N.first_present(o, "missing", "iso_code", "CODE_ALT").alias("code"))


@query("fn17_table_names", "SELECT p_partkey, CASE WHEN count(*) OVER (PARTITION BY p_brand) > 1 THEN lower(p_brand) || '_' || CAST(p_partkey AS VARCHAR) ELSE lower(p_brand) END AS name FROM part")
def unique_names(spark, d):
    base = F.lower("p_brand")
    twice = F.count("*").over(Window.partitionBy("p_brand")) > 1
    return table(spark, d, "part").select("p_partkey", F.when(twice, F.concat_ws("_", base, F.col("p_partkey").cast("string"))).otherwise(base).alias("name"))


@query("fn20_json", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, '{\"id\":' || CAST(event_id AS VARCHAR) || ',\"kind\":\"' || event_type || '\"}' AS packed, sha1(event_type) AS sig FROM events")
def json_fields(spark, d):
    e = table(spark, d, "events")
    packed = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind")))
    return e.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), packed.alias("packed"), F.sha1("event_type").alias("sig"))


@query("fn19_hash_bucket")
def hash_buckets(spark, d):
    return view(spark, d, "roads").select("osm_id", N.hash_bucket("osm_id", 16).alias("bucket"))


@query("fn24_part_counts", "SELECT country, count(*) AS n, greatest(1, CAST(ceil(count(*)/500.0) AS BIGINT)) AS parts FROM roads GROUP BY country", "roads")
def part_counts(spark, d):
    n = view(spark, d, "roads").groupBy("country").agg(F.count("*").alias("n"))
    return n.withColumn("parts", N.part_count("n", 500))


@query("fn25_notes", "SELECT country, 'holds all ' || format('{:,}', count(*)) || ' road segments' AS note FROM roads GROUP BY country", "roads")
def notes(spark, d):
    n = view(spark, d, "roads").groupBy("country").agg(F.count("*").alias("n"))
    return n.select("country", F.concat(F.lit("holds all "), F.format_number("n", 0), F.lit(" road segments")).alias("note"))


@query("fn26_without_scheme", "SELECT page_id, regexp_replace(CASE WHEN page_id % 2 = 0 THEN 'dbfs:/v/' || CAST(page_id AS VARCHAR) ELSE '/v/dbfs:' || CAST(page_id AS VARCHAR) END, '^dbfs:', '') AS path FROM pages")
def schemes(spark, d):
    raw = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("dbfs:/v/"), F.col("page_id").cast("string"))).otherwise(F.concat(F.lit("/v/dbfs:"), F.col("page_id").cast("string")))
    return table(spark, d, "pages").select("page_id", N.without_scheme(raw).alias("path"))


@query("snk13_flat_text", "SELECT event_id, '{\"a\":' || CAST(user_id AS VARCHAR) || ',\"b\":\"' || event_type || '\"}' AS s, '[' || CAST(user_id AS VARCHAR) || ',' || CAST(event_id AS VARCHAR) || ']' AS a, to_base64(encode(event_type)) AS b FROM events")
def flat(spark, d):
    e = table(spark, d, "events")
    return N.flat_text(e.select("event_id", F.struct(F.col("user_id").alias("a"), F.col("event_type").alias("b")).alias("s"), F.array("user_id", "event_id").alias("a"), F.encode("event_type", "UTF-8").alias("b")))


# --- filters -------------------------------------------------------------------------------------------------------------------

@query("flt1_road_kinds", f"SELECT osm_id, highway FROM road_tags WHERE highway IN ({_list(V.ROAD_KINDS)})", "road_tags")
def road_kinds(spark, d):
    return view(spark, d, "road_tags").where(F.col("highway").isin(*V.ROAD_KINDS)).select("osm_id", "highway")


@query("flt3_network_kinds", f"SELECT osm_id, highway FROM road_tags WHERE highway IN ({_list(V.NETWORK_KINDS)})", "road_tags")
def network_kinds(spark, d):
    return view(spark, d, "road_tags").where(F.col("highway").isin(*V.NETWORK_KINDS)).select("osm_id", "highway")


@query("flt4_edited_since", "SELECT osm_id, osm_ts FROM road_tags WHERE osm_ts >= 1700100000", "road_tags")
def edited_since(spark, d):
    return view(spark, d, "road_tags").where(F.col("osm_ts") >= 1700100000).select("osm_id", "osm_ts")


@query("flt5_countries", "SELECT osm_id, country FROM road_tags WHERE country IN ('NATION_3', 'NATION_7', 'NATION_11')", "road_tags")
def chosen_countries(spark, d):
    k = F.col("n_nationkey").cast("string")
    dimension = table(spark, d, "nation").select(F.concat(F.lit("N"), k).alias("iso2"), F.concat(F.lit("NA"), F.lpad(k, 2, "0")).alias("iso3"), "n_name")
    chosen, _ = dedup.chosen_codes(dimension, ["n3 ", "NA07", "NA11", "N11"], "iso2", "iso3")
    return view(spark, d, "road_tags").join(chosen.select(F.col("n_name").alias("country")), "country", "left_semi").select("osm_id", "country")


@query("fn27_run_columns", "SELECT n_nationkey, CAST(2024 AS BIGINT) AS source_year, 'run-7' AS run_id FROM nation")
def run_columns(spark, d):
    return table(spark, d, "nation").select("n_nationkey").withColumns(N.run_columns("run-7", 2024))


@query("flt6_nulls", "SELECT count(*) FILTER (WHERE surface IS NULL) AS without, count(*) FILTER (WHERE surface IS NOT NULL) AS with_ FROM road_tags", "road_tags")
def nulls(spark, d):
    return view(spark, d, "road_tags").agg(F.count_if(F.col("surface").isNull()).alias("without"), F.count_if(F.col("surface").isNotNull()).alias("with_"))


@query("flt7_src2_discover", "SELECT upper(right(name, 2)) AS code, name FROM (SELECT DISTINCT CASE l_suppkey % 4 WHEN 0 THEN 'road_' || chr(CAST(97 + l_partkey % 26 AS INT)) || chr(CAST(97 + l_suppkey % 26 AS INT)) WHEN 1 THEN 'road_log' WHEN 2 THEN 'road_AB' ELSE 'tmp_de' END AS name FROM lineitem) WHERE regexp_full_match(name, 'road_[a-z]{2}')")
def discover(spark, d):
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    letter = lambda k: F.char((97 + k % 26).cast("long"))
    name = F.when(s % 4 == 0, F.concat(F.lit("road_"), letter(p), letter(s))).when(s % 4 == 1, "road_log").when(s % 4 == 2, "road_AB").otherwise("tmp_de")
    return readers.table_names(table(spark, d, "lineitem").select(name.alias("name")).distinct(), "road_")


_WORK = """WITH+ work AS (SELECT CAST(c_custkey AS BIGINT) AS iso2, CAST(c_custkey % 7 AS BIGINT) AS fingerprint, CASE WHEN c_custkey % 5 = 0 THEN 'b' ELSE 'a' END AS settings, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(c_custkey % 3 AS BIGINT) END AS file_size FROM customer),
 manifest AS (SELECT CAST(c_custkey AS BIGINT) AS iso2, CASE WHEN c_custkey % 13 = 0 THEN CAST(99 AS BIGINT) ELSE CAST(c_custkey % 7 AS BIGINT) END AS fingerprint, 'a' AS settings, CAST(c_custkey % 3 AS BIGINT) AS size FROM customer WHERE c_custkey % 2 = 0)"""


def _work(spark, d):
    k = F.col("c_custkey")
    c = table(spark, d, "customer")
    work = c.select(k.cast("long").alias("iso2"), (k % 7).alias("fingerprint"), F.when(k % 5 == 0, "b").otherwise("a").alias("settings"), F.when(k % 11 != 0, k % 3).alias("file_size"))
    manifest = c.where(k % 2 == 0).select(k.cast("long").alias("iso2"), F.when(k % 13 == 0, F.lit(99).cast("long")).otherwise(k % 7).alias("fingerprint"), F.lit("a").alias("settings"), (k % 3).alias("size"))
    return work, manifest


@query("flt10_inc3_to_build", _WORK + " SELECT w.* FROM work w LEFT JOIN manifest m USING (iso2) WHERE NOT (w.fingerprint IS NOT DISTINCT FROM m.fingerprint AND w.settings IS NOT DISTINCT FROM m.settings AND w.file_size IS NOT NULL AND w.file_size IS NOT DISTINCT FROM m.size)")
def to_build(spark, d):
    return dedup.to_build(*_work(spark, d))


@query("flt9_jn7_with_file", _WORK + " SELECT m.* FROM manifest m WHERE EXISTS (SELECT 1 FROM work w WHERE w.iso2 = m.iso2 AND w.file_size IS NOT NULL)")
def with_file(spark, d):
    work, manifest = _work(spark, d)
    return manifest.join(work.where("file_size IS NOT NULL"), "iso2", "left_semi")


@query("jn8_inc11_missing", _WORK + " SELECT w.iso2 FROM work w WHERE NOT EXISTS (SELECT 1 FROM manifest m WHERE m.iso2 = w.iso2)")
def missing(spark, d):
    work, manifest = _work(spark, d)
    return work.join(manifest, "iso2", "left_anti").select("iso2")


# --- joins, dedup, windows, sets -----------------------------------------------------------------------------------------------

@query("jn1_dimension", "SELECT osm_id, country, r_name AS region FROM roads LEFT JOIN (SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 2 = 0) ON country = n_name", "roads")
def dimension(spark, d):
    n = table(spark, d, "nation").where("n_nationkey % 2 = 0").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    dim = n.select(F.col("n_name").alias("country"), F.col("r_name").alias("region"))
    return view(spark, d, "roads").select("osm_id", "country").join(dim, "country", "left").select("osm_id", "country", "region")


@query("jn5_reconcile", "SELECT o_custkey, count(*) AS a, max(c_acctbal) AS b FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1")
def reconcile(spark, d):
    o = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("a"))
    return o.join(table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_acctbal").alias("b")), "o_custkey", "left")


_BEST = "WITH+ dup AS (SELECT osm_id, arg_max(extract, row(osm_version, n_points, extract)) AS best FROM copies GROUP BY osm_id HAVING min(extract) <> max(extract))"


@query("agg8_best_copy", _BEST + " SELECT * FROM dup", "copies")
def best_copy(spark, d):
    return dedup.repeated(view(spark, d, "copies"))


@query("jn2_without_repeats", _BEST + " SELECT c.osm_id, c.extract, c.osm_version, c.n_points FROM copies c LEFT JOIN dup USING (osm_id) WHERE best IS NULL OR best = extract", "copies")
def without_repeats(spark, d):
    return dedup.without_repeats(view(spark, d, "copies"))


@query("agg9_one_per_id", "SELECT osm_id, extract, osm_version, n_points FROM (SELECT *, row_number() OVER (PARTITION BY osm_id ORDER BY osm_version DESC, n_points DESC, extract DESC) AS rn FROM copies) WHERE rn = 1", "copies")
def one_per_id(spark, d):
    return dedup.one_per_key(view(spark, d, "copies"), "osm_id", ["osm_version", "n_points", "extract"])


@query("agg10_duplicates", "SELECT count(*) AS rows, count(DISTINCT osm_id) AS ids FROM copies", "copies")
def duplicates(spark, d):
    return view(spark, d, "copies").agg(F.count("*").alias("rows"), F.countDistinct("osm_id").alias("ids"))


@query("agg11_country_totals", _SHAPED + " SELECT country, count(*) AS roads, CAST(sum(CAST(length_km AS DECIMAL(20,4))) AS DECIMAL(20,1)) AS km FROM shaped GROUP BY country", "road_tags")
def country_totals(spark, d):
    return shaped(spark, d).groupBy("country").agg(F.count("*").alias("roads"), F.sum(F.col("length_km").cast("decimal(20,4)")).cast("decimal(20,1)").alias("km"))


_PCT = "CAST(round(100.0*avg(CASE WHEN {} THEN 1 ELSE 0 END), 1) AS DECIMAL(6,1))"


@query("agg12_summary_class", _SHAPED + f" SELECT country, highway_class, surface_type, count(*) AS road_count, CAST(sum(CAST(length_km AS DECIMAL(20,4))) AS DECIMAL(20,2)) AS total_km, CAST(avg(length_km) AS DECIMAL(20,4)) AS avg_km, {_PCT.format('road_name IS NOT NULL')} AS pct_named, {_PCT.format('maxspeed_kmh IS NOT NULL')} AS pct_with_speed FROM shaped GROUP BY 1, 2, 3", "road_tags")
def summary_class(spark, d):
    share = lambda c: F.round(F.lit(100.0) * F.avg(F.when(c, 1).otherwise(0)), 1).cast("decimal(6,1)")
    return shaped(spark, d).groupBy("country", "highway_class", "surface_type").agg(
        F.count("*").alias("road_count"), F.sum(F.col("length_km").cast("decimal(20,4)")).cast("decimal(20,2)").alias("total_km"), F.avg("length_km").cast("decimal(20,4)").alias("avg_km"),
        share(F.col("road_name").isNotNull()).alias("pct_named"), share(F.col("maxspeed_kmh").isNotNull()).alias("pct_with_speed"),
    )


@query("agg13_summary_surface", _SHAPED + " SELECT country, " + ", ".join(f"count(*) FILTER (WHERE surface_type = '{s}') AS segments_{s}, CAST(coalesce(sum(CAST(length_km AS DECIMAL(20,4))) FILTER (WHERE surface_type = '{s}'), 0) AS DECIMAL(20,2)) AS km_{s}" for s in ("paved", "unpaved", "unknown")) + f", count(*) AS total_segments, {_PCT.format(chr(39).join(['surface_type = ', 'paved', '']))} AS pct_paved FROM shaped GROUP BY country", "road_tags")
def summary_surface(spark, d):
    aggs = []
    for s in ("paved", "unpaved", "unknown"):
        mine = F.col("surface_type") == s
        aggs += [F.count_if(mine).alias(f"segments_{s}"), F.coalesce(F.sum(F.when(mine, F.col("length_km").cast("decimal(20,4)"))), F.lit(0)).cast("decimal(20,2)").alias(f"km_{s}")]
    pct = F.round(F.lit(100.0) * F.avg(F.when(F.col("surface_type") == "paved", 1).otherwise(0)), 1).cast("decimal(6,1)")
    return shaped(spark, d).groupBy("country").agg(*aggs, F.count("*").alias("total_segments"), pct.alias("pct_paved"))


@query("agg14_quick_check", _SHAPED + " SELECT country, highway_class, count(*) AS roads, CAST(avg(CASE WHEN lanes IS NOT NULL THEN 1.0 ELSE 0.0 END) AS DECIMAL(8,4)) AS share_with_lanes FROM shaped GROUP BY ALL", "road_tags")
def quick_check(spark, d):
    shaped(spark, d).createOrReplaceTempView("wayfold_shaped")
    return spark.sql("SELECT country, highway_class, count(*) AS roads, CAST(avg(CASE WHEN lanes IS NOT NULL THEN 1.0D ELSE 0.0D END) AS DECIMAL(8,4)) AS share_with_lanes FROM wayfold_shaped GROUP BY ALL")


@query("agg16_status_counts", "SELECT status, count(*) AS n FROM run_log GROUP BY status", "run_log")
def status_counts(spark, d):
    return view(spark, d, "run_log").groupBy("status").agg(F.count("*").alias("n"))


_LATEST = "SELECT iso2, event_id, status FROM (SELECT *, row_number() OVER (PARTITION BY iso2 ORDER BY run_ts DESC, event_id DESC) AS rn FROM run_log {where}) WHERE rn = 1"


@query("win1_latest", _LATEST.format(where=""), "run_log")
def latest(spark, d):
    return dedup.latest(view(spark, d, "run_log"), ["iso2"], [F.desc("run_ts"), F.desc("event_id")]).select("iso2", "event_id", "status")


@query("win2_flt11_finished", f"SELECT * FROM ({_LATEST.format(where=chr(39).join(['WHERE since_date = ', '2024-01-01', '']))}) WHERE status IN ('SUCCESS', 'EMPTY')", "run_log")
def finished(spark, d):
    return dedup.finished(view(spark, d, "run_log"), "2024-01-01").select("iso2", "event_id", "status")


@query("win3_inc6_tile_state", "WITH+ t AS (SELECT *, event_id % 4 AS tile, CASE WHEN event_id % 97 = 0 THEN 'old' ELSE 'new' END AS job_key FROM run_log) SELECT iso2, tile, status, other_job FROM (SELECT iso2, tile, arg_max(status, row(run_ts, event_id)) AS status FROM t GROUP BY 1, 2) JOIN (SELECT iso2, bool_or(job_key <> 'new') AS other_job FROM t GROUP BY 1) USING (iso2)", "run_log")
def tile_state(spark, d):
    t = view(spark, d, "run_log").withColumns({"tile": F.col("event_id") % 4, "job_key": F.when(F.col("event_id") % 97 == 0, "old").otherwise("new")})
    return dedup.tile_state(t, "new").select("iso2", "tile", "status", "other_job")


@query("inc6_own_job", "WITH+ t AS (SELECT *, CASE WHEN event_id % 97 = 0 THEN 'old' ELSE 'new' END AS job_key FROM run_log) SELECT iso2, event_id FROM t WHERE iso2 NOT IN (SELECT iso2 FROM t WHERE job_key <> 'new')", "run_log")
def own_job(spark, d):
    t = view(spark, d, "run_log").withColumn("job_key", F.when(F.col("event_id") % 97 == 0, "old").otherwise("new"))
    return ingest.of_job(t, t, "new").select("iso2", "event_id")


@query("inc4_markers", "SELECT 'f' || CAST(c_custkey AS VARCHAR) AS name FROM customer WHERE NOT (c_custkey % 3 = 0 AND c_custkey % 5 <> 0 AND c_custkey % 7 <> 0)")
def markers(spark, d):
    """Files whose marker is of the same size, time and boundary are done; a third have a marker, some of those of another size or boundary."""
    k = F.col("c_custkey")
    named = table(spark, d, "customer").select(k, F.concat(F.lit("f"), k.cast("string")).alias("name"), F.concat(F.lit("/in/"), k.cast("string")).alias("path"), (k * 10).alias("bytes"), F.timestamp_seconds(k).alias("modified"))
    found = named.drop("c_custkey")
    done = ingest.markers(named.where(k % 3 == 0).withColumn("bytes", F.when(k % 5 == 0, F.lit(1)).otherwise(F.col("bytes"))), "b1").withColumn("boundary", F.when(k % 7 == 0, "b0").otherwise(F.col("boundary"))).drop("c_custkey")
    return ingest.unprocessed(found, done, "b1").select("name")


@query("inc8_retry", "SELECT iso2, event_id FROM (" + _LATEST.format(where="") + ") WHERE status = 'FAILED'", "run_log")
def retry(spark, d):
    last = dedup.latest(view(spark, d, "run_log"), ["iso2"], [F.desc("run_ts"), F.desc("event_id")])
    return last.where("status = 'FAILED'").select("iso2", "event_id")


@query("srt2_priority", "SELECT n_name, row_number() OVER (ORDER BY CASE n_name WHEN 'NATION_9' THEN 0 WHEN 'NATION_2' THEN 1 ELSE 2 END, n_name) AS place FROM nation")
def priority(spark, d):
    first = F.when(F.col("n_name") == "NATION_9", 0).when(F.col("n_name") == "NATION_2", 1).otherwise(2)
    return table(spark, d, "nation").select("n_name", F.row_number().over(Window.orderBy(first, "n_name")).cast("long").alias("place"))


@query("lim2_best_relation", "SELECT o_custkey, arg_min(o_orderkey, row(CASE o_orderstatus WHEN 'F' THEN 0 ELSE 1 END, o_orderpriority, o_orderkey)) AS best FROM orders GROUP BY o_custkey")
def best_relation(spark, d):
    rank = F.struct(F.when(F.col("o_orderstatus") == "F", 0).otherwise(1).alias("a"), F.col("o_orderpriority"), F.col("o_orderkey"))
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.min_by("o_orderkey", rank).alias("best"))


@query("set1_union", "SELECT country, osm_id FROM roads", "roads")
def union(spark, d):
    """All countries' tables as one: a union over the published tables."""
    r = view(spark, d, "roads").select("country", "osm_id")
    names = [x.n_name for x in table(spark, d, "nation").select("n_name").distinct().orderBy("n_name").collect()]
    return reduce(DataFrame.unionByName, [r.where(F.col("country") == name) for name in names])


@query("set2_distinct", "SELECT DISTINCT country, kind FROM roads", "roads")
def distinct(spark, d):
    return view(spark, d, "roads").select("country", "kind").distinct()


@query("set3_except_intersect", "SELECT * FROM (SELECT c_nationkey AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_suppkey % 2 = 0) UNION ALL SELECT 1000 + k FROM (SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier WHERE s_suppkey % 2 = 0)")
def set_difference(spark, d):
    c, s = table(spark, d, "customer").select(F.col("c_nationkey").alias("k")), table(spark, d, "supplier").where("s_suppkey % 2 = 0").select(F.col("s_nationkey").alias("k"))
    return c.subtract(s).union(c.intersect(s).select((F.col("k") + 1000).alias("k")))


@query("set4_parity", "SELECT user_id, event_type FROM events GROUP BY 1, 2 HAVING count(*) % 2 = 1")
def parity(spark, d):
    return table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n")).where("n % 2 = 1").drop("n")


# --- spatial -------------------------------------------------------------------------------------------------------------------

_CROSS = "(y1 > y) <> (y2 > y) AND x < x1 + (y-y1)*(x2-x1)/(y2-y1)"


@query("sp6_point_in_polygon", f"SELECT pid, unit FROM points JOIN edges ON {_CROSS} GROUP BY 1, 2 HAVING count(*) % 2 = 1", "points edges")
def point_in_polygon(spark, d):
    return spatial.inside(view(spark, d, "points"), view(spark, d, "edges"))


_HITS = f"WITH+ hit AS (SELECT way, i, unit FROM vertices JOIN edges ON {_CROSS} GROUP BY 1, 2, 3 HAVING count(*) % 2 = 1)"


@query("sp8_road_units", _HITS + " SELECT way, unit, arg_min(i, row(abs(i - 2), i)) AS at FROM hit GROUP BY 1, 2", "vertices edges")
def road_units(spark, d):
    return spatial.road_units(view(spark, d, "vertices"), view(spark, d, "edges"))


@query("sp8b_unassigned", _HITS + " SELECT DISTINCT way FROM vertices WHERE way NOT IN (SELECT way FROM hit)", "vertices edges")
def unassigned(spark, d):
    v = view(spark, d, "vertices")
    return v.join(spatial.road_units(v, view(spark, d, "edges")), "way", "left_anti").select("way").distinct()


def _away(px: str, py: str, x1: str, y1: str, x2: str, y2: str) -> str:
    """Distance of a point from a segment in the plane, as SQL."""
    dx, dy = f"({x2}-{x1})", f"({y2}-{y1})"
    t = f"greatest(0.0, least(1.0, (({px}-{x1})*{dx} + ({py}-{y1})*{dy}) / greatest({dx}*{dx} + {dy}*{dy}, 1e-300)))"
    return f"sqrt(pow({px}-{x1}-{t}*{dx}, 2) + pow({py}-{y1}-{t}*{dy}, 2))"


def _km_away(edges: str) -> str:
    """Kilometres of (x, y) from an edge, longitudes shrunk by the cosine of the point's latitude."""
    k = "cos(radians(y))"
    t = f"greatest(0.0, least(1.0, ((x-x1)*{k}*(x2-x1)*{k} + (y-y1)*(y2-y1)) / greatest(pow((x2-x1)*{k}, 2) + pow(y2-y1, 2), 1e-300)))"
    return f"sqrt(pow((x-x1)*{k} - {t}*(x2-x1)*{k}, 2) + pow((y-y1) - {t}*(y2-y1), 2)) * 111.195"


_NEAR = f""", lost AS (SELECT DISTINCT way FROM vertices WHERE way NOT IN (SELECT way FROM hit)),
 mid AS (SELECT v.way, v.i, v.x, v.y FROM vertices v JOIN lost USING (way) JOIN (SELECT way, CAST(floor(count(*)/2) AS INT) AS m FROM vertices GROUP BY way) c ON c.way = v.way AND c.m = v.i),
 near AS (SELECT way, arg_min(unit, row(km, unit)) AS unit FROM (SELECT way, unit, {_km_away('edges')} AS km FROM mid, edges) WHERE km <= 50.0 GROUP BY way)
 SELECT way, unit, CAST("at" AS INT) AS "at", 'inside' AS boundary_match FROM (SELECT way, unit, arg_min(i, row(abs(i - 2), i)) AS "at" FROM hit GROUP BY 1, 2)
 UNION ALL SELECT m.way, n.unit, CAST(m.i AS INT), CASE WHEN n.unit IS NOT NULL THEN 'nearest' END FROM mid m LEFT JOIN near n USING (way)"""


@query("sp7_jn9_nearest", _HITS + _NEAR, "vertices edges")
def nearest(spark, d):
    return spatial.road_countries(view(spark, d, "vertices"), view(spark, d, "edges"), max_km=50.0)


def _level_sql(edges: str, as_: str) -> str:
    return f"""(SELECT p.pid, CASE WHEN NOT coalesce(CASE WHEN p.pid % 4 = 0 THEN NULL ELSE p.pid % 5 END <> CASE WHEN u.unit % 6 = 0 THEN NULL ELSE u.unit % 5 END, false) THEN u.unit END AS {as_}
 FROM points p LEFT JOIN (SELECT pid, coalesce(min(unit) FILTER (WHERE held), arg_min(unit, row(km, unit)) FILTER (WHERE km <= 300.0)) AS unit FROM
 (SELECT pid, unit, sum(CASE WHEN {_CROSS} THEN 1 ELSE 0 END) % 2 = 1 AS held, min({_km_away(edges)}) AS km FROM points, {edges} GROUP BY 1, 2) GROUP BY pid) u USING (pid))"""


@query("sp10_admin_levels", f"WITH+ districts AS (SELECT unit + 100 AS unit, x1 + 4.0 AS x1, y1, x2 + 4.0 AS x2, y2 FROM edges) SELECT pid, admin1, admin2 FROM {_level_sql('edges', 'admin1')} JOIN {_level_sql('districts', 'admin2')} USING (pid)", "points edges")
def admin_levels(spark, d):
    p = view(spark, d, "points").withColumn("iso", F.when(F.col("pid") % 4 != 0, F.col("pid") % 5))
    first = view(spark, d, "edges")
    second = first.select((F.col("unit") + 100).alias("unit"), (F.col("x1") + 4.0).alias("x1"), "y1", (F.col("x2") + 4.0).alias("x2"), "y2")
    owner = lambda e: e.select("unit").distinct().withColumn("unit_iso", F.when(F.col("unit") % 6 != 0, F.col("unit") % 5))
    return spatial.admin_levels(p, [(first, owner(first)), (second, owner(second))], max_km=300.0)


@query("agg17_merged_units", f"WITH+ k AS (SELECT DISTINCT unit, CASE WHEN unit % 7 < 6 THEN unit % 7 END AS key FROM edges), m AS (SELECT e.*, coalesce(min(e.unit) FILTER (WHERE key IS NOT NULL) OVER (PARTITION BY key), e.unit) AS one FROM edges e JOIN k USING (unit)), u AS (SELECT CASE WHEN unit % 7 < 6 THEN one ELSE unit END AS unit, x1, y1, x2, y2 FROM m) SELECT pid, unit FROM points JOIN u ON {_CROSS} GROUP BY 1, 2 HAVING count(*) % 2 = 1", "points edges")
def merged_units(spark, d):
    e = view(spark, d, "edges")
    keys = e.select("unit", F.when(F.col("unit") % 7 < 6, F.col("unit") % 7).alias("key")).distinct()
    return spatial.inside(view(spark, d, "points"), spatial.merged_units(e, keys))


@query("sp9_ring_clean", """WITH+ w AS (SELECT way, list({'x': round(x/6.5)*6.5, 'y': round(y/6.5)*6.5} ORDER BY i) AS p FROM vertices GROUP BY way),
 k AS (SELECT way, [p[j] FOR j IN range(1, len(p) + 1) IF j = 1 OR p[j] <> p[j-1]] AS p FROM w), c AS (SELECT way, CASE WHEN p[1] = p[len(p)] THEN p ELSE list_append(p, p[1]) END AS p FROM k)
 SELECT way, CASE WHEN len(p) >= 4 THEN CAST(len(p) AS INT) END AS n, CASE WHEN len(p) >= 4 THEN CAST(list_sum(list_transform(p, lambda q: q.x)) AS DECIMAL(12,3)) END AS sum_x FROM c""", "vertices")
def ring_clean(spark, d):
    ways = view(spark, d, "vertices").groupBy("way").agg(F.array_sort(F.collect_list(F.struct("i", "x", "y"))).alias("p"))
    ring = ways.select("way", spatial.ring_clean(F.transform("p", lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y"))), 6.5).alias("r"))
    total = F.aggregate("r", F.lit(0.0), lambda s, v: s + v["x"]).cast("decimal(12,3)")
    return ring.select("way", F.when(F.col("r").isNotNull(), F.size("r")).alias("n"), F.when(F.col("r").isNotNull(), total).alias("sum_x"))


@query("sp10_admin", f"WITH+ low AS (SELECT pid, min(unit) AS unit FROM (SELECT pid, unit FROM points JOIN edges ON {_CROSS} GROUP BY 1, 2 HAVING count(*) % 2 = 1) GROUP BY 1) SELECT pid, CASE WHEN NOT coalesce(CASE WHEN pid % 4 = 0 THEN NULL ELSE pid % 5 END <> CASE WHEN unit % 6 = 0 THEN NULL ELSE unit % 5 END, false) THEN unit END AS unit FROM points LEFT JOIN low USING (pid)", "points edges")
def admin(spark, d):
    p = view(spark, d, "points").withColumn("iso", F.when(F.col("pid") % 4 != 0, F.col("pid") % 5))
    owners = view(spark, d, "edges").select("unit").distinct().withColumn("unit_iso", F.when(F.col("unit") % 6 != 0, F.col("unit") % 5))
    return spatial.admin_of(p, view(spark, d, "edges"), owners)


@query("sp11_antimeridian", "SELECT pid, x1, x2 FROM (SELECT pid, x AS x1, CASE WHEN pid % 3 = 0 THEN -x ELSE x + 1.0 END AS x2 FROM points) WHERE abs(x2 - x1) <= 180", "points")
def antimeridian(spark, d):
    e = view(spark, d, "points").select("pid", F.col("x").alias("x1"), F.when(F.col("pid") % 3 == 0, -F.col("x")).otherwise(F.col("x") + 1.0).alias("x2"))
    return spatial.usable_edges(e)


_BOX = "(SELECT CAST(n_nationkey AS BIGINT) AS unit, CAST((n_nationkey % 5)*60 - 150 AS DOUBLE) - 10.5 AS w, CAST((n_nationkey % 5)*60 - 150 AS DOUBLE) + 12.25 AS e, CAST(((n_nationkey - n_nationkey % 5)/5)*30 - 60 AS DOUBLE) - 7.5 AS s, CAST(((n_nationkey - n_nationkey % 5)/5)*30 - 60 AS DOUBLE) + 8.75 AS n FROM nation)"


def _boxes(spark, d):
    k = F.col("n_nationkey")
    cx, cy = ((k % 5) * 60 - 150).cast("double"), (((k - k % 5) / 5) * 30 - 60).cast("double")
    return table(spark, d, "nation").select(k.cast("long").alias("unit"), (cx - 10.5).alias("w"), (cx + 12.25).alias("e"), (cy - 7.5).alias("s"), (cy + 8.75).alias("n"))


_CLIP_DEG = 0.25
_TOUCH = f"""((bx-ax)*(y1-ay)-(by_-ay)*(x1-ax))*((bx-ax)*(y2-ay)-(by_-ay)*(x2-ax)) < 0 AND ((x2-x1)*(ay-y1)-(y2-y1)*(ax-x1))*((x2-x1)*(by_-y1)-(y2-y1)*(bx-x1)) < 0
 OR least({_away('ax', 'ay', 'x1', 'y1', 'x2', 'y2')}, {_away('bx', 'by_', 'x1', 'y1', 'x2', 'y2')}, {_away('x1', 'y1', 'ax', 'ay', 'bx', 'by_')}, {_away('x2', 'y2', 'ax', 'ay', 'bx', 'by_')}) <= {_CLIP_DEG}"""
_CLIP = f"""WITH+ b AS (SELECT n_name AS country, 0 AS r, x1, y1, x2, y2 FROM edges JOIN nation ON unit = n_nationkey WHERE unit <> 24 UNION ALL SELECT n_name, 1, x1 + 1.0, y1, x2 + 1.0, y2 FROM edges JOIN nation ON unit = n_nationkey WHERE unit % 3 = 0 AND unit <> 24),
 lines AS (SELECT DISTINCT country, geometry, {_POINTS} AS p FROM roads), good AS (SELECT * FROM lines WHERE len(p) >= 2),
 v AS (SELECT country, geometry, i, p[i].x AS x, p[i].y AS y FROM (SELECT *, unnest(range(1, len(p) + 1)) AS i FROM good)),
 held AS (SELECT DISTINCT country, geometry FROM (SELECT v.country, geometry, i, r FROM v JOIN b ON v.country = b.country AND {_CROSS} GROUP BY 1, 2, 3, 4 HAVING count(*) % 2 = 1)),
 s AS (SELECT country, geometry, p[i].x AS ax, p[i].y AS ay, p[i+1].x AS bx, p[i+1].y AS by_ FROM (SELECT *, unnest(range(1, len(p))) AS i FROM good)),
 near AS (SELECT DISTINCT s.country, geometry FROM s JOIN b ON s.country = b.country AND ({_TOUCH})), kept AS (SELECT * FROM held UNION SELECT * FROM near)
 SELECT osm_id, country FROM roads JOIN kept USING (country, geometry)"""


def _boundaries(spark, d):
    """A row for each nation but the last, a third of them with a second row, as GeoJSON in its several wrappings."""
    e = view(spark, d, "edges").where("unit <> 24")
    ring = lambda shift: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("y1", "x1"))), lambda p: F.concat(F.lit("["), (p["x1"] + shift).cast("string"), F.lit(", "), p["y1"].cast("string"), F.lit("]"))), ", ")
    rings = e.groupBy("unit").agg(ring(F.lit(0.0)).alias("ring"), ring(F.lit(1.0)).alias("moved")).join(table(spark, d, "nation"), F.col("unit") == F.col("n_nationkey"))
    bare = lambda r: F.concat(F.lit('{"type": "Polygon", "coordinates": [['), F.col(r), F.lit("]]}"))
    multi = F.concat(F.lit('{"type": "MultiPolygon", "coordinates": [[['), F.col("ring"), F.lit("]]]}"))
    bag = F.concat(F.lit('{"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [1, 2]}, {"type": "GeometryCollection", "geometries": ['), bare("ring"), F.lit("]}]}"))
    feature = F.concat(F.lit('{"type": "Feature", "properties": {}, "geometry": '), bare("moved"), F.lit("}"))
    first = rings.select(F.col("n_name").alias("iso_a3"), F.when(F.col("unit") % 3 == 0, bare("ring")).when(F.col("unit") % 3 == 1, bag).otherwise(multi).alias("geometry_json"))
    return first.union(rings.where("unit % 3 = 0").select("n_name", feature)).union(spark.createDataFrame([("NATION_24", None)], "a string, b string"))


@query("sp1_sp2_sp5_src9_src10_clip", _CLIP, "roads edges")
def clip(spark, d):
    return spatial.clip(view(spark, d, "roads"), _boundaries(spark, d), _CLIP_DEG, code="country").select("osm_id", "country")


_SMALL = f"""WITH+ b AS (SELECT x1, y1, x2, y2 FROM edges WHERE unit = 12), lines AS (SELECT DISTINCT geometry, {_POINTS} AS p FROM roads), good AS (SELECT * FROM lines WHERE len(p) >= 2),
 v AS (SELECT geometry, i, p[i].x AS x, p[i].y AS y FROM (SELECT *, unnest(range(1, len(p) + 1)) AS i FROM good)), held AS (SELECT DISTINCT geometry FROM (SELECT geometry, i FROM v JOIN b ON {_CROSS} GROUP BY 1, 2 HAVING count(*) % 2 = 1)),
 s AS (SELECT geometry, p[i].x AS ax, p[i].y AS ay, p[i+1].x AS bx, p[i+1].y AS by_ FROM (SELECT *, unnest(range(1, len(p))) AS i FROM good)), near AS (SELECT DISTINCT geometry FROM s JOIN b ON ({_TOUCH})), kept AS (SELECT * FROM held UNION SELECT * FROM near)
 SELECT osm_id FROM roads JOIN kept USING (geometry)"""


@query("udf1_sp1_touches", _SMALL, "roads edges")
def touches(spark, d):
    """The clip for one small boundary, whose edges go to every task."""
    edges = spatial.edges_array(view(spark, d, "edges").where("unit = 12"))
    return view(spark, d, "roads").where(G.touches_udf(edges, _CLIP_DEG)("geometry")).select("osm_id")


_TILES = f"""WITH+ b AS (SELECT unit AS key, s, w, n, e FROM {_BOX}), i AS (SELECT *, unnest(range(CAST(floor(s/5.0) AS INT), CAST(ceil(n/5.0) AS INT))) AS i FROM b), g AS (SELECT *, unnest(range(CAST(floor(w/5.0) AS INT), CAST(ceil(e/5.0) AS INT))) AS j FROM i),
 t AS (SELECT key, 'g5_' || i || '_' || j AS tile, greatest(s, i*5.0) AS s, greatest(w, j*5.0) AS w, least(n, (i+1)*5.0) AS n, least(e, (j+1)*5.0) AS e FROM g)"""
_D = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in "swne")


@query("sp12_tiles", f"{_TILES} SELECT key, tile, {_D} FROM t WHERE n - s > 1e-9 AND e - w > 1e-9")
def tiles(spark, d):
    return spatial.tiles(_boxes(spark, d).withColumnRenamed("unit", "key"), 5.0).drop("depth")


_QUARTER = "SELECT key, tile || '.{k}' AS tile, CAST({s} AS DOUBLE) AS s, CAST({w} AS DOUBLE) AS w, CAST({n} AS DOUBLE) AS n, CAST({e} AS DOUBLE) AS e FROM t"
_MS, _MW = "(s+n)/2.0", "(w+e)/2.0"


@query("sp13_split", f"{_TILES} " + " UNION ALL ".join(_QUARTER.format(k=k, s=s, w=w, n=n, e=e) for k, (s, w, n, e) in enumerate((("s", "w", _MS, _MW), ("s", _MW, _MS, "e"), (_MS, "w", "n", _MW), (_MS, _MW, "n", "e")))))
def split(spark, d):
    return spatial.split(spatial.tiles(_boxes(spark, d).withColumnRenamed("unit", "key"), 5.0)).drop("depth")


@query("sp16_normal_box", """WITH c AS (SELECT o_orderkey AS k, CAST(o_orderkey % 400 AS DOUBLE) - 200.0 AS a, CAST(o_custkey % 400 AS DOUBLE) - 200.0 AS b FROM orders),
 m AS (SELECT k, greatest(-90.0, least(a, b)) AS s, greatest(-180.0, least(a, b)) AS w, least(90.0, greatest(a, b)) AS n, least(180.0, greatest(a, b)) AS e FROM c)
 SELECT k, CASE WHEN n-s < 1e-3 THEN s-0.01 ELSE s END AS s, CASE WHEN e-w < 1e-3 THEN w-0.01 ELSE w END AS w, CASE WHEN n-s < 1e-3 THEN n+0.01 ELSE n END AS n, CASE WHEN e-w < 1e-3 THEN e+0.01 ELSE e END AS e FROM m""")
def normal_box(spark, d):
    a, b = (F.col("o_orderkey") % 400).cast("double") - 200.0, (F.col("o_custkey") % 400).cast("double") - 200.0
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), *spatial.normal_box(a, a, b, b))


_STATUS = "(key + length(tile) + ascii(right(tile, 1))) % 3"
_CHILDREN = " UNION ALL ".join(f"SELECT key, tile || '.{k}' AS tile FROM {{of}}" for k in range(4))


@query("sp15_tile_plan", f"""{_TILES}, l0 AS (SELECT key, tile FROM t WHERE n - s > 1e-9 AND e - w > 1e-9), c1 AS ({_CHILDREN.format(of='l0')}),
 prior AS (SELECT key, tile, CASE {_STATUS} WHEN 0 THEN 'done' WHEN 1 THEN 'split' ELSE 'failed' END AS status FROM (SELECT * FROM l0 UNION ALL SELECT * FROM c1)),
 l1 AS ({_CHILDREN.format(of="(SELECT l0.* FROM l0 JOIN prior USING (key, tile) WHERE status = 'split')")}), l2 AS ({_CHILDREN.format(of="(SELECT l1.* FROM l1 JOIN prior USING (key, tile) WHERE status = 'split')")}),
 every AS (SELECT *, 0 AS depth FROM l0 UNION ALL SELECT *, 1 FROM l1 UNION ALL SELECT *, 2 FROM l2)
 SELECT key, tile, CAST(depth AS INT) AS depth FROM every LEFT JOIN prior USING (key, tile) WHERE status IS NULL OR status <> 'done' AND NOT (status = 'split' AND depth < 2)""")
def tile_plan(spark, d):
    t = spatial.tiles(_boxes(spark, d).withColumnRenamed("unit", "key"), 5.0)
    h = (F.col("key") + F.length("tile") + F.ascii(F.right("tile", F.lit(1)))) % 3
    prior = t.unionByName(spatial.split(t)).select("key", "tile", F.when(h == 0, "done").when(h == 1, "split").otherwise("failed").alias("status"))
    return spatial.plan(t, prior, max_depth=2).select("key", "tile", "depth")


@query("sp14_prune", f"""{_TILES}, f AS (SELECT * FROM t WHERE n - s > 1e-9 AND e - w > 1e-9), o AS (SELECT unit AS key, least(y1, y2) AS os, least(x1, x2) AS ow, greatest(y1, y2) AS on_, greatest(x1, x2) AS oe FROM edges WHERE unit % 4 <> 3),
 near AS (SELECT DISTINCT f.key, f.tile FROM f JOIN o ON f.key = o.key AND w - 0.25 <= oe AND e + 0.25 >= ow AND s - 0.25 <= on_ AND n + 0.25 >= os)
 SELECT key, tile FROM f WHERE (SELECT count(*) FROM f g WHERE g.key = f.key) <= 12 OR key NOT IN (SELECT key FROM near) OR (key, tile) IN (SELECT (key, tile) FROM near)""", "edges")
def prune(spark, d):
    t = spatial.tiles(_boxes(spark, d).withColumnRenamed("unit", "key"), 5.0)
    o = view(spark, d, "edges").where("unit % 4 <> 3").select(F.col("unit").alias("key"), F.least("y1", "y2").alias("os"), F.least("x1", "x2").alias("ow"), F.greatest("y1", "y2").alias("on_"), F.greatest("x1", "x2").alias("oe"))
    return spatial.prune(t, o).select("key", "tile")


# --- sources -------------------------------------------------------------------------------------------------------------------

@query("src1_scan", "SELECT count(*) AS n, CAST(sum(l_quantity) AS DECIMAL(20,2)) AS q FROM lineitem")
def scan(spark, d):
    return table(spark, d, "lineitem").agg(F.count("*").alias("n"), F.sum("l_quantity").cast("decimal(20,2)").alias("q"))


@query("src4_fingerprint")
def fingerprint(spark, d):
    return dedup.fingerprint(table(spark, d, "lineitem"))


@query("src6_geojson_lines", "SELECT p_partkey AS osm_id, CAST(p_size AS BIGINT) AS osm_version, p_brand AS highway, CAST(NULL AS VARCHAR) AS surface, CAST(p_size AS DOUBLE) + 1.5 AS x2 FROM part")
def geojson_lines(spark, d):
    line = F.format_string('\x1e{"type":"Feature","geometry":{"type":"LineString","coordinates":[[%d,2.0],[%d.5,3.0]]},"properties":{"@id":"way/%d","@version":%d,"highway":"%s","odd":[1]}}', "p_size", F.col("p_size") + 1, "p_partkey", "p_size", "p_brand")
    out = readers.geojson_lines(table(spark, d, "part").select(line.alias("value")))
    return out.select("osm_id", "osm_version", "highway", "surface", F.get("coords", F.lit(2)).alias("x2"))


@query("src7_elements", "SELECT p_partkey AS osm_id, p_brand AS highway, CAST(2 AS INT) AS n FROM part")
def elements(spark, d):
    return _elements(table(spark, d, "part"))


def _elements(part):
    body = F.format_string('{"elements":[{"type":"node","id":1},{"type":"way","id":%d,"version":1,"geometry":[{"lat":1.0,"lon":2.0},null,%s{"lat":1.5,"lon":2.5}],"tags":{"highway":"%s"}}]}', "p_partkey", F.when(F.col("p_partkey") % 3 == 0, '{"lat":null,"lon":null},{"lat":1.5},').otherwise(""), "p_brand")
    out = readers.element_ways(part.select(body.alias("value")))
    return out.select("osm_id", F.element_at("tags", "highway").alias("highway"), F.size("points").alias("n"))


@query("src14_resolve", """WITH idx AS (SELECT CAST(p_partkey AS BIGINT) AS pos, 'u' || CAST(p_partkey AS VARCHAR) AS url, 1 + p_partkey % 3 AS n FROM part),
 listed AS (SELECT pos, url, n, 'C' || CAST((pos + k) % 40 AS VARCHAR) AS iso2 FROM idx, (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2) WHERE k < n),
 best AS (SELECT iso2, arg_min(url, row(n, pos)) AS listed_url FROM listed GROUP BY 1),
 c AS (SELECT CASE WHEN c_custkey % 50 = 49 THEN 'AN' ELSE 'C' || CAST(c_custkey AS VARCHAR) END AS iso2, CASE WHEN c_custkey % 4 = 0 THEN 's' || CAST(c_custkey AS VARCHAR) END AS slug FROM customer)
 SELECT c.iso2, CASE WHEN c.iso2 IN ('AN', 'CS') THEN 'obsolete' WHEN slug IS NOT NULL THEN 'static' WHEN listed_url IS NOT NULL THEN 'index' ELSE 'missing' END AS status, CASE WHEN c.iso2 NOT IN ('AN', 'CS') THEN coalesce('extract/' || slug, listed_url) END AS url FROM c LEFT JOIN best ON c.iso2 = best.iso2""")
def resolve(spark, d):
    return _resolve(table(spark, d, "part"), table(spark, d, "customer"))


def _resolve(part, customer):
    k = F.col("p_partkey")
    codes_ = F.transform(F.sequence(F.lit(0), (k % 3).cast("int")), lambda i: F.concat(F.lit("C"), ((k + i) % 40).cast("string")))
    index = part.select(k.alias("pos"), codes_.alias("codes"), F.concat(F.lit("u"), k.cast("string")).alias("url"))
    c = F.col("c_custkey")
    countries = customer.select(F.when(c % 50 == 49, "AN").otherwise(F.concat(F.lit("C"), c.cast("string"))).alias("iso2"), F.when(c % 4 == 0, F.concat(F.lit("s"), c.cast("string"))).alias("slug"))
    return readers.resolve_extracts(countries, index)


@query("src18_way_filter", f"SELECT t.osm_id FROM road_tags t JOIN (SELECT l_orderkey*10 + l_linenumber AS id, min(CAST((l_partkey*7 + l_suppkey*13) % 3400 AS DOUBLE)/10.0 - 170.0) AS x, min(CAST((l_partkey*3 + l_suppkey*11) % 1600 AS DOUBLE)/10.0 - 80.0) AS y FROM lineitem GROUP BY 1) p ON p.id = t.osm_id WHERE highway IN ({_list(V.ROAD_KINDS)}) AND osm_ts >= 1700000000 AND y BETWEEN -30 AND 40 AND x BETWEEN -100 AND 60", "road_tags")
def way_filter(spark, d):
    i = table(spark, d, "lineitem")
    x = (((F.col("l_partkey") * 7 + F.col("l_suppkey") * 13) % 3400).cast("double") / 10.0) - 170.0
    y = (((F.col("l_partkey") * 3 + F.col("l_suppkey") * 11) % 1600).cast("double") / 10.0) - 80.0
    p = i.groupBy((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("osm_id")).agg(F.min(x).alias("x"), F.min(y).alias("y"))
    return readers.way_filter(view(spark, d, "road_tags").join(p, "osm_id"), V.ROAD_KINDS, 1700000000, (-30, -100, 40, 60)).select("osm_id")


@query("src17_local_rows", "SELECT n_name, CASE n_name WHEN 'NATION_1' THEN 'DE' WHEN 'NATION_2' THEN 'NA' END AS iso2 FROM nation")
def local_rows(spark, d):
    rows = spark.createDataFrame([("NATION_1", "DE"), ("NATION_2", "NA")], "n_name string, iso2 string")
    return table(spark, d, "nation").select("n_name").join(F.broadcast(rows), "n_name", "left")


from wayfold.plans import roundtrips  # noqa: E402, F401  registers its queries
