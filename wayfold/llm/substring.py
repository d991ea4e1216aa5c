"""Substring dedup by a log-structured fingerprint index.

A window is n consecutive words. Each task turns a chunk of a batch into one sorted immutable run: for every distinct window
fingerprint the smallest doc_id of the chunk, dealt to buckets by the fingerprint's leading bits. A bucket's runs, those of history
and those of the batch, are merge-joined: a fingerprint that some run holds under a smaller doc_id is old. The join runs on the bucket and
a 32-bit key of one hash; every match is verified by 32 bits of a second, independent hash, there and once more in the removal, before it counts: at least 72 bits, 8 to 24
of them the bucket's. What the merge leaves is one compacted run a bucket, which `FingerprintIndex` writes, so that the next batch costs a merge and no
second look at old texts.

Cost: texts are read once for fingerprints and shuffled once for the removal; a window costs 9 to 10 shuffled bytes. Runs are made by
chunks, so a window in a third of all documents sends one entry a chunk to its bucket, not one a document: the copies inside a chunk are found there and
travel as flags, dealt by their documents. Buckets and blocks grow in number with the input, so groups stay of one size.

Defined cases: null text has no words; a null doc_id has no rank, its row neither loses words nor makes others lose them;
rows that repeat a doc_id are judged each, and never against each other; extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfold.llm import arrowtext as at
from wayfold.llm.common import block_of, in_arrow, input_bytes, np_block_of, power_of_two

U64 = np.uint64
FIRST, HISTORY, FLAG = 0, 1, 2
_PACKED = "kind int, bucket int, block int, base long, delta_bytes int, keys binary, tags binary, deltas binary"
_PACKED_ARROW = pa.schema(
    [("kind", pa.int32()), ("bucket", pa.int32()), ("block", pa.int32()), ("base", pa.int64())]
    + [("delta_bytes", pa.int32()), ("keys", pa.binary()), ("tags", pa.binary()), ("deltas", pa.binary())]
)
_TAG_MULTS = np.random.default_rng(4099).integers(1, 1 << 31, 64, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


class Layout:
    """How a fingerprint is cut: bucket bits and 32 key bits, which together are its code."""

    def __init__(self, bucket_bits: int):
        self.bucket_bits = bucket_bits

    @classmethod
    def for_bytes(cls, n: int) -> Layout:
        return cls(power_of_two(2 * n / (4 << 20), 256, 1 << 24).bit_length() - 1)

    def codes_of(self, prints: np.ndarray) -> np.ndarray:
        return prints >> U64(32 - self.bucket_bits)


def _binary(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """A binary column whose cells are values[cuts[i]:cuts[i + 1]]."""
    offsets = (cuts * values.dtype.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _pack(kind: int, bucket: np.ndarray, block: np.ndarray | int, ids: np.ndarray, keys: np.ndarray, tags: np.ndarray) -> pa.RecordBatch | None:
    """One row for each bucket, its entries ordered by doc_id; `block` is one number or follows from the bucket."""
    if not len(ids):
        return None
    order = np.lexsort((ids, bucket))
    bucket, ids = bucket[order], ids[order]
    starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    cuts = np.append(starts, len(ids))
    steps = np.diff(ids, prepend=ids[:1])
    steps[starts] = 0
    most = int(steps.max())
    width = next(w for w in (1, 2, 4, 8) if w == 8 or most < 1 << 8 * w)
    full = lambda v: pa.array(np.full(len(starts), v, np.int32))
    where = full(block) if isinstance(block, int) else pa.array(block[order][starts].astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [full(kind), pa.array(bucket[starts].astype(np.int32)), where, pa.array(ids[starts]), full(width), _binary(keys[order], cuts), _binary(tags[order], cuts), _binary(steps.astype(f"u{width}"), cuts)],
        schema=_PACKED_ARROW,
    )


def _pack_flags(ids: np.ndarray, codes: np.ndarray, tags: np.ndarray, blocks: int, buckets: int) -> pa.RecordBatch | None:
    """Flags for the blocks of their documents; they pass the merge in buckets that follow from the blocks."""
    block = np_block_of(ids, blocks)
    if blocks <= buckets:
        return _pack(FLAG, block, block, ids, codes, tags)
    out = _pack(FLAG, block, block, ids, codes, tags)
    return out and out.set_column(1, "bucket", pa.array(np.asarray(out.column(1)) % buckets))


def _unpack(rows: pa.Table, key: type = np.uint32) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, keys (of flags: codes) and tags of all entries of the rows."""
    ids, keys, tags = [np.zeros(0, np.int64)], [np.zeros(0, key)], [np.zeros(0, np.uint32)]
    columns = [rows.column(c).to_pylist() for c in ("base", "delta_bytes", "keys", "tags", "deltas")]
    for base, width, k, t, d in zip(*columns, strict=True):
        ids.append(base + np.cumsum(np.frombuffer(d, f"u{width}").astype(np.int64)))
        keys.append(np.frombuffer(k, key))
        tags.append(np.frombuffer(t, np.uint32))
    return np.concatenate(ids), np.concatenate(keys), np.concatenate(tags)


def _groups(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the runs of equal values, and each value's run."""
    new = np.concatenate(([True], sorted_values[1:] != sorted_values[:-1]))
    return np.flatnonzero(new), np.cumsum(new) - 1


class Prints:
    """The windows of a chunk: codes, tags, and where they start."""

    def __init__(self, chunk: at.Chunk, n: int, layout: Layout):
        self.words = at.words(chunk.data, chunk.offsets, at.EXACT)
        self.starts = at.window_starts(self.words.first, n)
        self.codes, self.tags = np.zeros(0, U64), np.zeros(0, np.uint32)
        if len(self.starts):
            hashes = self.words.hashes
            self.codes = layout.codes_of(at.window_hashes(hashes, n)[self.starts])
            halves, count = (hashes >> U64(32)).astype(np.uint32) ^ hashes.astype(np.uint32) * np.uint32(0x85EBCA6B), len(hashes) - n + 1
            tags = halves[:count] * _TAG_MULTS[0]
            for k in range(1, n):
                tags = (tags ^ (tags >> np.uint32(15))) * np.uint32(0x2C1B3C6D) if k % 32 == 0 else tags
                tags += halves[k : k + count] * _TAG_MULTS[k % 64]
            self.tags = ((tags ^ (tags >> np.uint32(16))) * np.uint32(0x7FEB352D))[self.starts]

    def owners(self) -> np.ndarray:
        """Of each window, the index of its text."""
        return self.words.owner()[self.starts]


def batch_runs(docs: DataFrame, n: int, layout: Layout, blocks: int = 1) -> DataFrame:
    """The sorted runs of a batch with columns doc_id and text, a chunk of at most 8 MB of text each, and the flags of the copies inside chunks."""
    buckets = 1 << layout.bucket_bits

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in at.chunks(at.gathered(batches, 16 << 20)):
            found = Prints(chunk, n, layout)
            column = chunk.rows.column(0)
            owner = found.owners()
            known = np.asarray(column.is_valid())[owner]
            codes, tags, ids = found.codes[known], found.tags[known], np.asarray(column.fill_null(0), np.int64)[owner[known]]
            if not len(ids):
                continue
            order = np.argsort(at.mix(codes ^ at.mix(tags.astype(U64))))  # equal ones together, in whatever order
            codes, tags, ids = codes[order], tags[order], ids[order]
            new = np.concatenate(([True], (codes[1:] != codes[:-1]) | (tags[1:] != tags[:-1])))
            first, which = np.flatnonzero(new), np.cumsum(new) - 1
            least = np.minimum.reduceat(ids, first)
            copy = ids > least[which]
            runs = _pack(FIRST, (codes[first] >> U64(32)).astype(np.int64), 0, least, codes[first].astype(np.uint32), tags[first])
            for out in (runs, _pack_flags(ids[copy], codes[copy], tags[copy], blocks, buckets)):
                if out is not None:
                    yield out

    return in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), make, _PACKED)


def merge(runs: DataFrame, layout: Layout, blocks: int = 1, flags: bool = True, keep: bool = False) -> DataFrame:
    """Merge-joins the runs of each bucket. flags: rows of kind FLAG name the windows that a smaller doc_id holds, by block of
    documents. keep: rows of kind HISTORY are the compacted run."""
    buckets = 1 << layout.bucket_bits

    def one(rows: pa.Table) -> pa.Table:
        kind = np.asarray(rows.column("kind"))
        bucket = int(rows.column("bucket")[0].as_py())
        first, old = (_unpack(rows.filter(pa.array(kind == k))) for k in (FIRST, HISTORY))
        ids, keys, tags = (np.concatenate(x) for x in zip(first, old, strict=True))
        out = rows.filter(pa.array(kind == FLAG)).to_batches() if flags else []
        if len(ids):
            prints = (keys.astype(U64) << U64(32)) | tags.astype(U64)
            order = np.argsort(prints)
            starts, which = _groups(prints[order])
            least = np.minimum.reduceat(ids[order], starts)
            if flags:
                late = np.empty(len(ids), bool)
                late[order] = ids[order] > least[which]
                late[len(first[0]) :] = False
                codes = (U64(bucket) << U64(32)) | keys[late].astype(U64)
                out.append(_pack_flags(ids[late], codes, tags[late], blocks, buckets))
            if keep:
                kept = prints[order][starts]
                out.append(_pack(HISTORY, np.full(len(kept), bucket), 0, least, (kept >> U64(32)).astype(np.uint32), kept.astype(np.uint32)))
        return pa.Table.from_batches([x for x in out if x is not None], _PACKED_ARROW)

    return runs.groupBy("bucket").applyInArrow(one, _PACKED)


class Flagged:
    """The flags of a block of documents."""

    def __init__(self, flags: pa.Table, n: int, layout: Layout):
        ids, codes, tags = _unpack(flags, U64)
        self.known, self.n, self.layout = np.unique(self._named(ids, codes, tags)), n, layout

    @staticmethod
    def _named(ids: np.ndarray, codes: np.ndarray, tags: np.ndarray) -> np.ndarray:
        return at.mix(at.mix(codes ^ at.mix(ids.astype(np.int64).view(U64))) ^ tags.astype(U64))

    def covered(self, chunk: at.Chunk) -> tuple[at.Words, np.ndarray]:
        """The words of a chunk of doc_id and text, and which of them lie in a flagged window."""
        column = chunk.rows.column(chunk.rows.schema.get_field_index("doc_id"))
        found = Prints(chunk, self.n, self.layout)
        gone = np.zeros(len(found.words.starts), bool)
        if len(self.known) and len(found.codes):
            owner = found.owners()
            probe = self._named(np.asarray(column.fill_null(0), np.int64)[owner], found.codes, found.tags)
            hit = self.known[np.minimum(np.searchsorted(self.known, probe), len(self.known) - 1)] == probe
            gone = at.covered(len(gone), found.starts[hit & np.asarray(column.is_valid())[owner]], self.n)
        return found.words, gone


def _kept(chunk: at.Chunk, words: at.Words, gone: np.ndarray) -> Iterator[bytes]:
    """Of each text the words that are left, joined by one space."""
    for i in range(chunk.rows.num_rows):
        mine = gone[words.first[i] : words.first[i + 1]]
        kept = chunk.text(i).split()
        yield b" ".join(compress(kept, ~mine) if mine.any() else kept)


def _removed(docs: DataFrame, flagged: DataFrame, n: int, layout: Layout, blocks: int) -> DataFrame:
    """Marks the covered words of each document and digests what is left."""

    def one(texts: pa.Table, flags: pa.Table) -> pa.Table:
        known, out = Flagged(flags, n, layout), []
        for chunk in at.chunks(texts.select(["doc_id", "text"]).to_batches()):
            words, gone = known.covered(chunk)
            removed = np.bincount(words.owner()[gone], minlength=chunk.rows.num_rows)
            digests = [hashlib.sha256(x).hexdigest() for x in _kept(chunk, words, gone)]
            out.append(pa.RecordBatch.from_arrays([chunk.rows.column(0), pa.array(words.counts()), pa.array(removed), pa.array(digests, pa.string())], schema=_DIGEST))
        return pa.Table.from_batches(out, _DIGEST)

    left = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), block_of("doc_id", blocks).cast("int").alias("block"))
    return left.groupBy("block").cogroup(flagged.groupBy("block")).applyInArrow(one, "doc_id long, n_words long, n_removed long, kept_sha256 string")


_DIGEST = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])


def kept_texts(docs: DataFrame, digest_source: DataFrame | None = None, n: int = 13) -> DataFrame:
    """The documents with their remaining text: columns of `docs`, text replaced by the kept words joined by one space."""
    layout, blocks = Layout.for_bytes(input_bytes(docs)), _blocks(docs)
    flagged = merge(batch_runs(digest_source or docs, n, layout, blocks), layout, blocks)
    names = docs.columns

    def one(texts: pa.Table, flags: pa.Table) -> pa.Table:
        known, tables = Flagged(flags, n, layout), []
        for chunk in at.chunks(texts.select(names).to_batches()):
            kept = pa.array([x.decode() for x in _kept(chunk, *known.covered(chunk))], pa.string())
            tables.append(pa.Table.from_batches([chunk.rows]).set_column(names.index("text"), "text", kept))
        return pa.concat_tables(tables) if tables else texts.select(names)

    left = docs.withColumn("wayfold_block", block_of("doc_id", blocks).cast("int"))
    return left.groupBy("wayfold_block").cogroup(flagged.groupBy("block")).applyInArrow(one, docs.schema)


def _blocks(docs: DataFrame) -> int:
    return power_of_two(2 * input_bytes(docs) / (4 << 20), 256, 1 << 24)


def dedup(docs: DataFrame, n: int = 13, history: DataFrame | None = None, layout: Layout | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each document: its words without those in windows that `history` (runs of an
    index) or the batch itself holds under a smaller doc_id."""
    layout, blocks = layout or Layout.for_bytes(input_bytes(docs)), _blocks(docs)
    runs = batch_runs(docs, n, layout, blocks)
    flagged = merge(runs if history is None else runs.unionByName(history), layout, blocks)
    return _removed(docs, flagged, n, layout, blocks)


class FingerprintIndex:
    """Runs under a folder that all machines share. `add` judges a batch against all batches before it and then adds its run;
    beyond `fanout` runs they are compacted into one. Manifests are rows (version, run, bucket_bits, n); the
    last version counts, so that a lost driver leaves the index as it was before the batch."""

    def __init__(self, spark: SparkSession, path: str, n: int = 13, expected_bytes: int = 1 << 30, fanout: int = 4):
        self.spark, self.path, self.fanout = spark, path.rstrip("/"), fanout
        layout = Layout.for_bytes(expected_bytes)
        self.n, self.layout, self.version, self.runs = n, layout, 0, []
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest")
        if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
            rows = spark.read.parquet(f"{self.path}/manifest")
            last = rows.orderBy(F.col("version").desc()).first()
            self.version, self.n, self.layout = last.version, last.n, Layout(last.bucket_bits)
            self.runs = [r.run for r in rows.where(F.col("version") == last.version).select("run").collect()]

    def _publish(self, runs: list[str]) -> None:
        self.version, self.runs = self.version + 1, runs
        rows = [(self.version, r, self.layout.bucket_bits, self.n) for r in runs]
        schema = "version int, run string, bucket_bits int, n int"
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")

    def history(self) -> DataFrame | None:
        return self.spark.read.schema(_PACKED).parquet(*[f"{self.path}/{r}" for r in self.runs]) if self.runs else None

    def add(self, docs: DataFrame, out: str) -> DataFrame:
        """Writes the judged batch to `out` (Parquet), then takes the batch into the index."""
        dedup(docs, self.n, self.history(), self.layout).write.parquet(out)
        run = f"run-{uuid.uuid4().hex}"
        merge(batch_runs(docs, self.n, self.layout), self.layout, 1, flags=False, keep=True).write.parquet(f"{self.path}/{run}")
        self._publish([*self.runs, run])
        if len(self.runs) > self.fanout:
            self.compact()
        return self.spark.read.parquet(out)

    def compact(self) -> None:
        """One run in the place of all."""
        run = f"run-{uuid.uuid4().hex}"
        merge(self.history(), self.layout, 1, flags=False, keep=True).write.parquet(f"{self.path}/{run}")
        self._publish([run])
