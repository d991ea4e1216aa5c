"""Duplicates across overlapping files, latest rows per key, and the skip logic that builds on them."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def repeated(copies: DataFrame) -> DataFrame:
    """osm_id, best extract of ids that occur in several extracts: highest version, then most points, then extract. One aggregate, no sort of rows."""
    rank = F.struct("osm_version", "n_points", "extract")
    found = copies.groupBy("osm_id").agg(F.min("extract").alias("low"), F.max("extract").alias("high"), F.max_by("extract", rank).alias("best"))
    return found.where("low <> high").select("osm_id", "best")


def without_repeats(copies: DataFrame, best: DataFrame | None = None) -> DataFrame:
    """Keeps, of each repeated id, the rows of its best extract. Whether the side of repeated ids is broadcast follows from its size at run time, under the session's threshold."""
    best = repeated(copies) if best is None else best
    joined = copies.join(best, "osm_id", "left")
    return joined.where(F.col("best").isNull() | (F.col("best") == F.col("extract"))).drop("best")


def chosen_codes(dimension: DataFrame, wanted: list[str], *columns: str) -> tuple[DataFrame, list[str]]:
    """The rows of a dimension that one of the wanted codes names in any of `columns`, whatever case and blanks, and the codes that name none, of which a warning tells."""
    codes = sorted({w.strip().upper() for w in wanted if w and w.strip()})
    names = F.array(*[F.upper(F.trim(c)) for c in columns])
    held = {r[0] for r in dimension.select(F.explode(names).alias("c")).where(F.col("c").isin(codes)).distinct().collect()} if codes else set()
    unknown = [c for c in codes if c not in held]
    if unknown:
        warnings.warn(f"no country has these codes: {', '.join(unknown)}", stacklevel=2)
    return dimension.where(F.arrays_overlap(names, F.array(*map(F.lit, codes)).cast("array<string>"))), unknown


def latest(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("rn_", F.row_number().over(w)).where("rn_ = 1").drop("rn_")


def one_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row for each key, the greatest by `order`, by aggregation: combined map-side, safe for hot keys."""
    rest = [c for c in df.columns if c != key and c not in order]
    best = df.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("b_"))
    return best.select(key, *[F.col(f"b_.{c}").alias(c) for c in [*order, *rest]]).select(df.columns)


def finished(log: DataFrame, since: str) -> DataFrame:
    """Keys whose latest attempt under `since` ended well."""
    mine = log.where(F.coalesce("since_date", F.lit("")) == since)
    return latest(mine, ["iso2"], [F.desc("run_ts"), F.desc("event_id")]).where(F.col("status").isin("SUCCESS", "EMPTY"))


def tile_state(log: DataFrame, job_key: str) -> DataFrame:
    """Last status of each tile, and whether any of the country's rows come from another job."""
    last = log.groupBy("iso2", "tile").agg(F.max_by("status", F.struct("run_ts", "event_id")).alias("status"))
    other = log.groupBy("iso2").agg(F.bool_or(F.col("job_key") != job_key).alias("other_job"))
    return last.join(other, "iso2")


def report(log: DataFrame) -> DataFrame:
    """status, runs, countries, last: a row for each status of a run log, and one for all."""
    facts = [F.count("*").alias("runs"), F.countDistinct("iso2").alias("countries"), F.max("run_ts").alias("last")]
    return log.groupBy("status").agg(*facts).unionByName(log.agg(*facts).withColumn("status", F.lit("all")))


def to_build(work: DataFrame, manifest: DataFrame, force: bool = False) -> DataFrame:
    """Work whose output is not up to date: fingerprint, settings, file and size must all be as the manifest has them."""
    m = manifest.select("iso2", F.col("fingerprint").alias("m_fp"), F.col("settings").alias("m_set"), F.col("size").alias("m_size"))
    same = F.lit(not force) & F.col("fingerprint").eqNullSafe(F.col("m_fp")) & F.col("settings").eqNullSafe(F.col("m_set")) & F.col("file_size").isNotNull() & F.col("file_size").eqNullSafe(F.col("m_size"))
    return work.join(m, "iso2", "left").where(~same).select(work.columns)


def fingerprint(df: DataFrame) -> DataFrame:
    """Content fingerprint of a table: row count and the xor of row hashes, whatever the order of rows."""
    return df.agg(F.concat_ws("|", F.count("*"), F.coalesce(F.bit_xor(F.xxhash64(*df.columns)), F.lit(0))).alias("fingerprint"))
