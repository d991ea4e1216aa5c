import pytest
from pyspark.sql import functions as F

from wayfold.functions import tags as N


def one(spark, column_of, values, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    return [r[0] for r in df.orderBy("i").select(column_of(F.col("v"))).collect()]


def test_clean_kind(spark):
    raw = ["Tertiary-Link", " tertiary link ", "__x__", "---", None, "Straße 1", ""]
    assert one(spark, N.clean_kind, raw) == ["tertiary_link", "tertiary_link", "x", "unknown", "unknown", "straße_1", "unknown"]


def test_speed(spark):
    assert one(spark, N.parse_speed_kmh, ["30 mph", "10 knots", "1.2.3", "walk", "50;30", " 80 km/h ", "25MPH", None]) == [48.3, 18.5, None, None, None, 80.0, 40.2, None]


def test_lanes_and_flag(spark):
    assert one(spark, N.lanes, ["2;3", " 3 ", "2.0", None]) == [None, 3, None, None]
    assert one(spark, N.flag, ["yes", "no", " False ", None, "", "viaduct"]) == [True, False, False, False, False, True]


def test_names_and_codes(spark):
    assert one(spark, N.readable_name, ["Congo, The Democratic Republic of the", "Holy See (Vatican City State)", "Korea, South"]) == ["Democratic Republic of the Congo", "Holy See", "Korea, South"]
    assert one(spark, N.clean_code, [" DE ", "-99", "n/a", "", None]) == ["DE", None, None, None, None]
    assert one(spark, N.slug, ["Côte d'Ivoire", "  A--b "]) == ["cote_d_ivoire", "a_b"]


def test_classes(spark):
    df = spark.createDataFrame([("asphalt", "track"), (None, "track"), ("lava", "primary"), ("lava", "raceway"), (" Gravel ", None)], "s string, h string")
    assert [r[0] for r in df.select(N.surface_type("s", "h")).collect()] == ["paved", "unpaved", "paved", "unknown", "unpaved"]


def test_sql_names(spark):
    N.register_sql(spark)
    assert spark.sql("SELECT clean_kind(' Tertiary-Link '), parse_speed_kmh('30 mph'), clean_kind(NULL)").first()[:] == ("tertiary_link", 48.3, "unknown")


def test_part_count(spark):
    assert one(spark, N.part_count, [0, 1, 195000, 195001], "bigint") == [1, 1, 1, 2]
    assert one(spark, N.without_scheme, ["dbfs:/a", "/dbfs:/a"]) == ["/a", "/dbfs:/a"]
    with pytest.raises(TypeError):
        N.part_count()
