"""Reference-shaped inputs, derived from the star-schema tables by SQL that both Spark and DuckDB run.

Each text uses {lineitem}-style names for tables and {fmt} for seven-decimal number text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

_X0 = "(CAST((l_partkey*7 + l_suppkey*13) % 3400 AS DOUBLE)/10.0 - 170.0)"
_Y0 = "(CAST((l_partkey*3 + l_suppkey*11) % 1600 AS DOUBLE)/10.0 - 80.0)"
_ST = "(CAST(l_linenumber AS DOUBLE)/100.0)"

ROADS = f"""SELECT CAST(l_orderkey*10 + l_linenumber AS BIGINT) AS osm_id, n_name AS country,
 CASE l_partkey % 8 WHEN 0 THEN 'primary' WHEN 1 THEN ' Primary' WHEN 2 THEN 'Tertiary-Link' WHEN 3 THEN 'tertiary link'
      WHEN 4 THEN NULL WHEN 5 THEN '' WHEN 6 THEN 'track' ELSE 'secondary' END AS kind,
 CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_orderkey % 97 = 1 THEN 'POINT (1 2)' WHEN l_orderkey % 97 = 2 THEN 'LINESTRING (1 2)'
      WHEN l_orderkey % 97 = 3 THEN 'garbage'
      ELSE 'LINESTRING (' || FMT[{_X0}] || ' ' || FMT[{_Y0}] || ', ' || FMT[{_X0} + {_ST}] || ' ' || FMT[{_Y0} - {_ST}/2.0]
           || ', ' || FMT[{_X0} + 2.0*{_ST}] || ' ' || FMT[{_Y0} + {_ST}] || ')' END AS geometry
FROM {{lineitem}} JOIN {{supplier}} ON l_suppkey = s_suppkey JOIN {{nation}} ON s_nationkey = n_nationkey"""

ROAD_TAGS = """SELECT CAST(l_orderkey*10 + l_linenumber AS BIGINT) AS osm_id, CAST(l_linenumber AS BIGINT) AS osm_version,
 n_name AS country,
 CASE l_partkey % 7 WHEN 0 THEN 'primary' WHEN 1 THEN 'Track' WHEN 2 THEN 'footway' WHEN 3 THEN 'service'
      WHEN 4 THEN 'raceway' WHEN 5 THEN 'tertiary_link' ELSE 'living_street' END AS highway,
 CASE l_suppkey % 6 WHEN 0 THEN 'asphalt' WHEN 1 THEN ' Gravel ' WHEN 2 THEN 'mud' WHEN 3 THEN NULL
      WHEN 4 THEN 'lava' ELSE 'concrete:plates' END AS surface,
 CASE l_orderkey % 9 WHEN 0 THEN '50' WHEN 1 THEN '30 mph' WHEN 2 THEN '10 knots' WHEN 3 THEN 'walk' WHEN 4 THEN '1.2.3'
      WHEN 5 THEN '80 km/h' WHEN 6 THEN NULL WHEN 7 THEN '50;30' ELSE '25MPH' END AS maxspeed,
 CASE l_linenumber WHEN 1 THEN '2' WHEN 2 THEN '2;3' WHEN 3 THEN NULL WHEN 4 THEN 'x' ELSE ' 4 ' END AS lanes,
 CASE l_partkey % 5 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' WHEN 2 THEN NULL WHEN 3 THEN 'viaduct' ELSE ' False ' END AS bridge,
 CASE l_suppkey % 4 WHEN 0 THEN 'yes' WHEN 1 THEN NULL ELSE 'no' END AS oneway,
 CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE 'Road ' || CAST(l_partkey AS VARCHAR(20)) END AS name,
 CAST(l_partkey % 50 + 0.125 AS DOUBLE) * 100.0 AS length_m,
 CASE WHEN l_orderkey % 5 = 0 THEN CAST(0 AS BIGINT) WHEN l_orderkey % 7 = 0 THEN NULL ELSE CAST(1700000000 + l_orderkey*60 AS BIGINT) END AS osm_ts
FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey JOIN {nation} ON s_nationkey = n_nationkey"""

RUN_LOG = """SELECT user_id AS iso2, ts AS run_ts, event_id, CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'EMPTY' ELSE 'SUCCESS' END AS status,
 CASE WHEN event_id % 2 = 0 THEN '2024-01-01' ELSE '' END AS since_date FROM {events}"""

COPIES = """SELECT CAST(l_orderkey*10 + l_linenumber AS BIGINT) AS osm_id,
 CASE l_returnflag WHEN 'A' THEN 'asia' WHEN 'N' THEN 'europe' ELSE 'africa' END AS extract,
 CAST(l_suppkey % 3 AS BIGINT) AS osm_version, CAST(l_partkey % 50 AS BIGINT) AS n_points FROM {lineitem}"""

_V = """(SELECT CAST(n_nationkey AS BIGINT) AS unit, CAST((n_nationkey % 5)*60 - 150 AS DOUBLE) AS cx,
 CAST(((n_nationkey - n_nationkey % 5)/5)*30 - 60 AS DOUBLE) AS cy FROM {nation}) AS v"""
EDGES = f"""SELECT unit, cx-25.0 AS x1, cy-12.0 AS y1, cx+27.5 AS x2, cy-9.3 AS y2 FROM {_V}
 UNION ALL SELECT unit, cx+27.5, cy-9.3, cx+3.3, cy+13.7 FROM {_V} UNION ALL SELECT unit, cx+3.3, cy+13.7, cx-25.0, cy-12.0 FROM {_V}"""
POINTS = f"SELECT DISTINCT CAST(l_partkey*1000 + l_suppkey AS BIGINT) AS pid, {_X0} AS x, {_Y0} AS y FROM {{lineitem}}"
#: Ways with five vertices each, as rows (way, i, x, y).
VERTICES = f"""SELECT DISTINCT CAST(l_partkey*1000 + l_suppkey AS BIGINT) AS way, CAST(k AS INT) AS i, {_X0} + CAST(k AS DOUBLE)*4.0 AS x, {_Y0} + CAST(k AS DOUBLE)*1.5 AS y
 FROM {{lineitem}} CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4) AS ks"""

NAMES = {"roads": ROADS, "road_tags": ROAD_TAGS, "run_log": RUN_LOG, "copies": COPIES, "edges": EDGES, "points": POINTS, "vertices": VERTICES}


def _fmt(text: str, function: str) -> str:
    return text.replace("FMT[", f"{function}('%.7f', ").replace("]", ")")


def duckdb_text(name: str) -> str:
    return _fmt(NAMES[name], "printf").format(**{t: t for t in TABLES})


def spark_text(name: str, sf_dir: str) -> str:
    return _fmt(NAMES[name], "format_string").format(**{t: f"parquet.`{sf_dir}/{t}.parquet`" for t in TABLES})


_stored: dict[tuple[str, str], str] = {}


def store_views(spark: SparkSession, sf_dir: str, folder: str, names: tuple[str, ...] = tuple(NAMES)) -> None:
    """Writes views as Parquet under `folder`; from then on `view` reads these. For benches, which are to time the queries and not the making of their inputs."""
    for name in names:
        spark.sql(spark_text(name, sf_dir)).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
        _stored[sf_dir, name] = f"{folder}/{name}.parquet"


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if at := _stored.get((sf_dir, name)):
        return spark.read.parquet(at)
    return spark.sql(spark_text(name, sf_dir))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
