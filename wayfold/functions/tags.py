"""Column functions that clean and classify road tags. All but `slug` are built-in expressions, inside code generation."""

from __future__ import annotations

from itertools import chain

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfold.functions import values as V


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_kind(c: Column | str) -> Column:
    """Letters and digits of any script, lower case, joined by `_`; `unknown` if none."""
    joined = F.regexp_replace(F.lower(F.trim(_col(c).cast("string"))), r"[^\p{L}\p{N}]+", "_")
    bare = F.regexp_replace(joined, "^_+|_+$", "")
    return F.when(bare.isNull() | (bare == ""), F.lit("unknown")).otherwise(bare)


def parse_speed_kmh(c: Column | str) -> Column:
    """Speeds with an optional unit, in km/h; NULL for anything else."""
    s = F.trim(_col(c))
    number = F.regexp_extract(s, "^([0-9.]+)", 1).try_cast("double")
    return (
        F.when(s.rlike(r"(?i)^[0-9.]+\s*mph$"), F.round(number * V.MPH, 1))
        .when(s.rlike(r"(?i)^[0-9.]+\s*knots?$"), F.round(number * V.KNOT, 1))
        .when(s.rlike(r"(?i)^[0-9.]+\s*(km/h|kmh|kph)?$"), number)
    )


def surface_type(surface: Column | str, highway: Column | str) -> Column:
    s, h = F.lower(F.trim(_col(surface))), F.lower(F.trim(_col(highway)))
    return (
        F.when(s.isin(*V.PAVED), "paved").when(s.isin(*V.UNPAVED), "unpaved")
        .when(h.isin(*V.INFERRED_PAVED), "paved").when(h.isin(*V.INFERRED_UNPAVED), "unpaved").otherwise("unknown")
    )


def lookup(c: Column, table: dict[str, str], default: str | None = None) -> Column:
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    found = F.element_at(pairs, c)
    return found if default is None else F.coalesce(found, F.lit(default))


def highway_class(c: Column | str) -> Column:
    return lookup(F.lower(F.trim(_col(c))), V.HIGHWAY_CLASS, "other")


def flag(c: Column | str) -> Column:
    v = F.lower(F.trim(_col(c)))
    return F.when(_col(c).isNull(), F.lit(False)).otherwise(~v.isin("no", "false", "0", ""))


def lanes(c: Column | str) -> Column:
    return _col(c).try_cast("int")


def epoch_timestamp(c: Column | str) -> Column:
    return F.when(_col(c) > 0, F.timestamp_seconds(_col(c)))


def text_timestamp(c: Column | str) -> Column:
    return _col(c).try_cast("timestamp")


def decimal_km(c: Column | str) -> Column:
    return _col(c).cast(T.DecimalType(20, 3))


def clean_code(c: Column | str) -> Column:
    """Codes without placeholders. The code NA is one of them: do not use it on two-letter country codes."""
    s = F.trim(_col(c))
    return F.when(F.upper(s).isin(*V.EMPTY_CODES), F.lit(None).cast("string")).otherwise(s)


@F.arrow_udf(T.StringType())
def decomposed(texts: pa.Array) -> pa.Array:
    """Unicode's compatibility decomposition (NFKD): letters apart from their accents. Spark has no such function; Arrow has."""
    return pc.utf8_normalize(texts.cast(pa.string()), "NFKD")


def slug(c: Column | str) -> Column:
    """Lower-case ASCII words joined by `_`; letters lose their accents, characters without an ASCII form go."""
    ascii_ = F.lower(F.regexp_replace(decomposed(_col(c)), r"[^\x00-\x7F]", ""))
    return F.regexp_replace(F.regexp_replace(ascii_, "[^a-z0-9]+", "_"), "^_+|_+$", "")


def readable_name(c: Column | str) -> Column:
    """Without bracketed parts; `X, The Y of the` becomes `Y of the X`."""
    n = F.trim(F.regexp_replace(_col(c), r"\s*\(.*?\)", ""))
    head, tail = F.trim(F.regexp_extract(n, "^([^,]*),(.*)$", 1)), F.trim(F.regexp_extract(n, "^([^,]*),(.*)$", 2))
    turned = F.regexp_replace(F.concat_ws(" ", tail, head), r"(?i)^the\s+", "")
    return F.when(n.contains(",") & tail.rlike(r"(?i)\bof(\s+the)?$"), turned).otherwise(n)


def first_present(df: DataFrame, *names: str) -> Column:
    """The first non-null of those candidate columns that exist, whatever the case of their names."""
    have = {c.lower(): c for c in df.columns}
    found = [F.col(have[n.lower()]) for n in names if n.lower() in have]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def part_count(n: Column | str, target: int = V.TARGET_ROWS) -> Column:
    return F.greatest(F.lit(1), F.ceil(_col(n) / F.lit(target))).cast("long")


def hash_bucket(c: Column | str, n: Column | int) -> Column:
    return F.pmod(F.xxhash64(_col(c)), n if isinstance(n, Column) else F.lit(n))


def without_scheme(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), "^dbfs:", "")


def run_columns(run_id: str, source_year: int) -> dict[str, Column]:
    """Columns that name the run a row came from."""
    return {"source_year": F.lit(source_year).cast("long"), "run_id": F.lit(run_id)}


def one_line(df: DataFrame, keep: tuple[str, ...] = ("geometry",)) -> DataFrame:
    """Line breaks in string columns become one space; `keep` columns stay."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    broken = {n: F.regexp_replace(F.col(n), r"[\r\n]+", " ") for n, t in fields.items() if isinstance(t, T.StringType) and n not in keep}
    return df.withColumns(broken) if broken else df


def flat_text(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON, binary as base64: what CSV can hold."""
    out = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            out[f.name] = F.to_json(f.name)
        elif isinstance(f.dataType, T.BinaryType):
            out[f.name] = F.base64(f.name)
    return df.withColumns(out) if out else df


def register_sql(spark) -> None:
    """SQL names of the main functions, as expressions that the optimizer inlines."""
    trimmed = "regexp_replace(regexp_replace(lower(trim(k)), '[^\\\\p{L}\\\\p{N}]+', '_'), '^_+|_+$', '')"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION clean_kind(k STRING) RETURNS STRING RETURN coalesce(nullif({trimmed}, ''), 'unknown')")
    number = "try_cast(regexp_extract(trim(s), '^([0-9.]+)', 1) AS DOUBLE)"
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION parse_speed_kmh(s STRING) RETURNS DOUBLE RETURN CASE WHEN trim(s) RLIKE '(?i)^[0-9.]+\\\\s*mph$' THEN round({number} * {V.MPH}D, 1) "
        f"WHEN trim(s) RLIKE '(?i)^[0-9.]+\\\\s*knots?$' THEN round({number} * {V.KNOT}D, 1) WHEN trim(s) RLIKE '(?i)^[0-9.]+\\\\s*(km/h|kmh|kph)?$' THEN {number} END"
    )
