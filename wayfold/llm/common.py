"""What the operators of this subpackage share: sizes of inputs, tables in the shared folder, spreading of ids."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfold.sources.store import shared_dir


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def input_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of a frame's size, without a scan. It only sets how finely work is dealt, never what is computed."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def power_of_two(x: float, least: int, most: int = 1 << 30) -> int:
    n = least
    while n < x and n < most:
        n *= 2
    return n


class Scratch:
    """Named tables of one run in the shared folder, which survive lost executors and cut lineage. (A checkpoint would cut it too, but its frame keeps the size
    estimates of the plan before it; those of joins are products, and over rounds they become numbers that planning cannot handle.) A table goes when it is dropped
    or put anew, or when the block ends; a kept one goes with the driver."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.paths = spark, f"{shared_dir(spark)}/wayfold-{name}-{uuid.uuid4().hex}", {}
        self._fs(self.root)[0].deleteOnExit(self._fs(self.root)[1])

    def _fs(self, path: str) -> tuple:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        self.drop(*self.paths)

    def put(self, name: str, df: DataFrame, compression: str | None = None) -> DataFrame:
        """Written as Parquet and read back; the table that had the name before goes afterwards. compression: the session's, if not given."""
        path, before = f"{self.root}/{name}-{uuid.uuid4().hex}", self.paths.get(name)
        df.write.parquet(path, compression=compression)
        self.paths[name] = path
        if before:
            self._delete(before)
        return self.spark.read.schema(df.schema).parquet(path)

    def _delete(self, path: str) -> None:
        fs, at = self._fs(path)
        fs.delete(at, True)

    def drop(self, *names: str) -> None:
        for name in names:
            self._delete(self.paths.pop(name))

    def keep(self, name: str) -> None:
        """The table stays when the block ends."""
        self.paths.pop(name)


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Written as Parquet in the shared folder and read back, to stay until the driver ends: for what a result is read from."""
    return Scratch(df.sparkSession, name).put(name, df, compression)


#: Arrow batches between the JVM and Python hold so many bytes, unless the session names a limit of its own. Spark's 64 MB (128 while a buffer grows), times tasks, times
#: both sides, would be much of an executor's memory outside the heap.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def in_arrow(df: DataFrame, make: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """mapInArrow with batches of bounded size."""
    conf = df.sparkSession.conf
    if conf.get(_BATCH, None) is None:
        conf.set(_BATCH, str(BATCH_BYTES))
    return df.mapInArrow(make, schema)


#: A broadcast may hold so many bytes of keys.
BROADCAST_BYTES = 32 << 20


def only_keys(df: DataFrame, keys: DataFrame, how: str, row_bytes: int = 24) -> DataFrame:
    """`df` semi- or anti-joined with a stored table of keys, on all columns of it; null keys match nothing. Keys of a checked size are broadcast, so that wide
    rows need no shuffle; beyond it the join is left to the optimizer."""
    small = keys.count() * row_bytes <= BROADCAST_BYTES
    return df.join(F.broadcast(keys) if small else keys, keys.columns, how)


def block_of(column: Column | str, blocks: int) -> Column:
    """Spreads ids over a power of two of blocks by shifts and xor; `np_block_of` does the same in numpy."""
    c = F.col(column) if isinstance(column, str) else column
    c = F.coalesce(c.cast("long"), F.lit(0))
    mixed = c.bitwiseXOR(F.shiftrightunsigned(c, 7)).bitwiseXOR(F.shiftrightunsigned(c, 17))
    return mixed.bitwiseAND(F.lit(blocks - 1).cast("long"))


def np_block_of(ids: np.ndarray, blocks: int) -> np.ndarray:
    x = ids.astype(np.int64).view(np.uint64)
    return ((x ^ (x >> np.uint64(7)) ^ (x >> np.uint64(17))) & np.uint64(blocks - 1)).astype(np.int64)


#: A sample for fitting holds so many bytes of text at most, whole texts only.
SAMPLE_BYTES = 48 << 20


def within(sizes: list[int], budget: int = SAMPLE_BYTES) -> list[bool]:
    """Which of the texts, in their order, go into a budget of bytes; one that does not fit is passed over."""
    out = []
    for n in sizes:
        out.append(n <= budget)
        budget -= n if out[-1] else 0
    return out


def sample_texts(docs: DataFrame, n: int) -> list[str]:
    """The texts of the n documents whose doc_id has the smallest xxhash64, SAMPLE_BYTES of them at most: a bounded sample for fitting, chosen on narrow columns."""
    text = F.col("text").cast("string")
    known = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).alias("bytes"), F.xxhash64(text).alias("text_hash"))
    rows = known.orderBy(F.xxhash64("doc_id"), "doc_id", "text_hash").limit(n).collect()
    ids = [(r.doc_id, r.text_hash) for r, fits in zip(rows, within([r.bytes for r in rows]), strict=True) if fits]
    if not ids:
        return []
    chosen = docs.sparkSession.createDataFrame(ids, "doc_id long, text_hash long").distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    found = texts.join(F.broadcast(chosen), ["doc_id", "text_hash"], "left_semi").collect()
    return [r.text for r in sorted(found, key=lambda r: (r.doc_id, r.text))][:n]
