"""Queries over tables whose suppliers number 1,000 and more, so that two pairs of part and supplier give one way or pid: each vertex number is there twice."""

from itertools import permutations, product

import duckdb
import pytest

from tests.test_queries import plain
from wayfold.plans import catalog, roundtrips  # noqa: F401  roundtrips registers its queries
from wayfold.sources.fixtures import duckdb_text


@pytest.fixture(scope="module")
def shared(sf, tmp_path_factory):
    """lineitem and nation, in which half the ways stand for two places."""
    folder = str(tmp_path_factory.mktemp("shared"))
    con = duckdb.connect()
    pairs = "SELECT l_orderkey, l_linenumber, (l_partkey % 40) * 2 AS p, l_suppkey AS s FROM src WHERE l_linenumber < 4 UNION ALL SELECT l_orderkey, l_linenumber, (l_partkey % 20) * 4 + 1, l_suppkey + 1000 FROM src WHERE l_linenumber = 4"
    con.execute(f"CREATE VIEW src AS SELECT * FROM '{sf}/lineitem.parquet'")
    con.execute(f"COPY (SELECT l_orderkey, l_linenumber, p AS l_partkey, s AS l_suppkey FROM ({pairs} UNION ALL SELECT l_orderkey, l_linenumber, (l_partkey % 40) * 2 - 1, l_suppkey + 1000 FROM src WHERE l_linenumber = 5)) TO '{folder}/lineitem.parquet'")
    con.execute(f"COPY (SELECT * FROM '{sf}/nation.parquet') TO '{folder}/nation.parquet'")
    return folder


def duck_rows(folder, sql, names):
    con = duckdb.connect()
    for t in ("lineitem", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    found = con.execute(sql)
    at = [[c[0] for c in found.description].index(n) for n in names]
    return sorted((tuple(plain(r[i]) for i in at) for r in found.fetchall()), key=repr)


def same(spark, folder, name, sql):
    df = catalog.QUERIES[name](spark, folder)
    names = sorted(df.columns)
    assert sorted((tuple(plain(v) for v in r) for r in df.select(*names).collect()), key=repr) == duck_rows(folder, sql, names)


def test_ways_are_shared(shared):
    n = duckdb.connect().execute(f"SELECT count(*) FROM (SELECT 1 FROM '{shared}/lineitem.parquet' GROUP BY l_partkey * 1000 + l_suppkey HAVING count(DISTINCT l_suppkey) > 1)").fetchone()[0]
    assert n > 20


@pytest.mark.parametrize("name", ["sp10_admin_levels", "sp8_road_units", "sp7_jn9_nearest", "src5_pbf"])
def test_same_rows(spark, shared, name):
    same(spark, shared, name, catalog.ORACLES[name])


@pytest.mark.parametrize("name", ["geo1_wkt", "geo1b_wkt_trimmed", "geo4_segment_m", "sp9_ring_clean"])
def test_ties(spark, shared, name):
    """The SQL leaves open which of two vertices of one number comes first; the rows are those of its order by place."""
    same(spark, shared, name, catalog.ORACLES[name].replace("ORDER BY i", "ORDER BY i, x, y"))


def ring_row(places):
    """n and sum_x of a way's snapped places, as the query's words have it: repeats that follow each other count once, the ring is closed, fewer than four have no row."""
    kept = [p for j, p in enumerate(places) if j == 0 or p != places[j - 1]]
    closed = kept if kept[0] == kept[-1] else [*kept, kept[0]]
    return (len(closed), sum(x for x, _ in closed)) if len(closed) >= 4 else (None, None)


def test_ring_ties_are_orders_of_the_sql(spark, shared):
    """Each row of sp9_ring_clean, and each of its SQL as it stands, is one that ORDER BY i allows; a way at one place has a single such row."""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{shared}/lineitem.parquet'")
    places = {}
    for way, i, x, y in con.execute(f"SELECT way, i, round(x/6.5)*6.5, round(y/6.5)*6.5 FROM ({duckdb_text('vertices')}) ORDER BY way, i").fetchall():
        places.setdefault(way, {}).setdefault(i, []).append((x, y))
    allowed = {way: {ring_row(sum(map(list, order), [])) for order in product(*(permutations(p) for p in by_number.values()))} for way, by_number in places.items()}
    assert {len(allowed[way]) > 1 for way in places} == {True, False}
    assert all(len(allowed[way]) == 1 for way in places if len(places[way][0]) == 1)
    found = con.execute(catalog.ORACLES["sp9_ring_clean"]).fetchall(), [(r.way, r.n, r.sum_x) for r in catalog.QUERIES["sp9_ring_clean"](spark, shared).select("way", "n", "sum_x").collect()]
    for rows in found:
        assert sorted(r[0] for r in rows) == sorted(places)
        assert [r for r in rows if (r[1], r[2] if r[2] is None else float(r[2])) not in allowed[r[0]]] == []


#: Pairs of part and supplier, two a way; each way has a segment whose metres lie in the middle between two millimetres but for the last bits.
HALVES = [(105765, 50940), (105796, 19940), (193350, 47272), (193381, 16272), (266966, 47844), (266997, 16844), (801249, 58881), (801302, 5881)]


def test_segments_round_as_the_sql(spark, shared, tmp_path):
    """Metres close to the middle between two millimetres fall to the same side as in the SQL."""
    duckdb.connect().execute(f"COPY (SELECT unnest({[p for p, _ in HALVES]}) AS l_partkey, unnest({[s for _, s in HALVES]}) AS l_suppkey) TO '{tmp_path}/lineitem.parquet'")
    duckdb.connect().execute(f"COPY (SELECT * FROM '{shared}/nation.parquet') TO '{tmp_path}/nation.parquet'")
    same(spark, str(tmp_path), "geo4_segment_m", catalog.ORACLES["geo4_segment_m"].replace("ORDER BY i", "ORDER BY i, x, y"))
