"""Incremental and streaming runs: files are taken once, outputs are replaced atomically, every unit leaves a log row."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wayfold.operators.dedup import latest
from wayfold.sources.readers import geojson_lines
from wayfold.sources.store import exists


def stream_geojson(spark: SparkSession, folder: str, target: str, checkpoint: str, files_per_batch: int = 100) -> StreamingQuery:
    """Takes new GeoJSON line files of a folder into a road table, each file once, and stops when none is left. The checkpoint makes a rerun resume; a batch that is
    repeated after a failure overwrites its own partition, so nothing is doubled."""
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", files_per_batch).load(folder)

    def take(batch: DataFrame, batch_id: int) -> None:
        geojson_lines(batch).write.mode("overwrite").option("compression", "zstd").parquet(f"{target}/batch={batch_id}")

    return lines.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_event_counts(events: DataFrame, every: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums of a stream of events by type and tumbling window; rows later than the watermark are dropped by design of the window."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy(F.window("ts", every).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def pending(work: DataFrame, log: DataFrame, resume: bool = True) -> DataFrame:
    """Work (iso2) whose latest log row is not a success; all of it without `resume`."""
    if not resume:
        return work
    done = latest(log, ["iso2"], [F.desc("run_ts")]).where(F.col("status").isin("SUCCESS", "EMPTY"))
    return work.join(done.select("iso2"), "iso2", "left_anti")


def markers(found: DataFrame, boundary: str) -> DataFrame:
    """What a finished file leaves behind (found: name, path, bytes, modified): its signature and the fingerprint of the boundaries that it was read with."""
    signature = F.sha1(F.concat_ws("|", "path", F.col("bytes").cast("string"), F.unix_micros("modified").cast("string")))
    return found.withColumns({"signature": signature, "boundary": F.lit(boundary)})


def unprocessed(found: DataFrame, done: DataFrame, boundary: str) -> DataFrame:
    """Files without a marker of the same name, signature and boundary."""
    keys = ["name", "signature", "boundary"]
    return markers(found, boundary).join(done.select(keys).distinct(), keys, "left_anti").select(found.columns)


def of_job(rows: DataFrame, log: DataFrame, job_key: str, key: str = "iso2") -> DataFrame:
    """Rows of those keys all of whose log rows are of this job: what another job began is not carried on but made anew."""
    others = log.where(~F.col("job_key").eqNullSafe(F.lit(job_key))).select(key).distinct()
    return rows.join(others, key, "left_anti").select(rows.columns)


def wipe_other_jobs(spark: SparkSession, table: str, log: DataFrame, job_key: str, key: str = "iso2") -> list[str]:
    """Drops from a partitioned table the partitions of keys that another job worked on; returns them. Keys are dimension-sized."""
    gone = sorted(str(r[0]) for r in log.where(~F.col("job_key").eqNullSafe(F.lit(job_key))).select(key).distinct().collect() if r[0] is not None)
    for value in gone:
        quoted = value.replace("'", "''")
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({key}='{quoted}')")
    return gone


def run_units(spark: SparkSession, units: list[str], build: Callable[[str], DataFrame], target: str, log: str, retries: int = 1, mode: str = "force") -> DataFrame:
    """Builds each unit into its own partition folder. A unit is written aside and then moved into place, so a killed run leaves no half of it; a failure becomes
    a log row and the loop goes on; failed units get `retries` more passes. mode: 'force' builds all, 'resume' leaves out units whose latest row in the log is a success.
    Units are dimension-sized; the work inside one is a Spark job."""
    if mode not in ("force", "resume"):
        raise ValueError(f"no such mode: {mode}")
    if mode == "resume" and exists(log):
        left = {r.iso2 for r in pending(spark.createDataFrame([(u,) for u in units], "iso2 string"), spark.read.parquet(log)).collect()}
        units = [u for u in units if u in left]
    path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    todo, rows = list(units), []
    for attempt in range(retries + 1):
        failed = []
        for unit in todo:
            aside, final = f"{target}/_building-{uuid.uuid4().hex}", f"{target}/unit={unit}"
            try:
                build(unit).write.parquet(aside)
                fs = path(final).getFileSystem(conf)
                n = spark.read.parquet(aside).count()
                if n == 0:
                    fs.delete(path(aside), True)
                    rows.append((unit, attempt, "EMPTY", 0, None))
                    continue
                fs.delete(path(final), True)
                if not fs.rename(path(aside), path(final)):
                    raise OSError(f"{final} could not be put in place")
                rows.append((unit, attempt, "SUCCESS", n, None))
            except Exception as e:  # noqa: BLE001  one unit must not stop the others
                path(aside).getFileSystem(conf).delete(path(aside), True)
                rows.append((unit, attempt, "FAILED", None, str(e)[:300]))
                failed.append(unit)
        todo = failed
        if not todo:
            break
    out = spark.createDataFrame(rows, "iso2 string, attempt int, status string, row_count long, reason string").withColumn("run_ts", F.current_timestamp())
    out.coalesce(1).write.mode("append").parquet(log)
    return out


def cooldown(fails: int, base: float = 15.0, most: float = 900.0) -> float:
    """Seconds to wait after a number of failures in a row."""
    return min(base * 2 ** min(max(fails, 1) - 1, 5), most)
