"""Near-duplicate groups by b-bit MinHash, confirmed on full shingle sets.

One pass over the texts gives each document the number of its distinct shingles, a 128-bit identity of the shingle set, `bands`
hashes of `rows` minima each, and a signature of the low `BITS` bits of every minimum. Documents with one set form a class. Classes that share a band are
candidates; a pair goes on if the collision-corrected estimate from the count of equal low bits is not far (six standard deviations) under the threshold,
and links if the full sets say so.

With 25 bands of 5 rows a pair at similarity 0.8 shares no band with probability (1 - 0.8^5)^25, about 5 in 100 000; more
similar pairs are missed far more rarely.

Candidates are compared where a bucket's members meet, and no pair is written out but those that join two groups. A bucket is cut into blocks by a hash, of
about `BLOCK` members or `BLOCK_BYTES` of sets each, and a cell holds the members of two blocks: a hot bucket is many cells of one size, dealt over all tasks.
In a cell, members take their turn as pivot, those of the rarest group first, and meet only members of other groups, so that
a pivot that joins a large group takes it over whole. The first `FIRST` bands go first; their links make groups, and of the other bands only buckets that
still hold two groups or more are compared. No link between two groups is overlooked, and what is skipped joins documents already joined.

Cost: texts are read twice (once for signatures, once for the sets of classes that share a bucket). A set travels once for every bucket in which its class still
meets another group, times the blocks of that bucket. Comparisons inside a bucket whose members do not join grow with the square of its size, in numpy over
packed signatures; the rows written do not. All joins are plain equi-joins between stored tables, which adaptive execution splits where a key is hot.

Defined cases: null or wordless text has n_shingles 0 and is linked with nothing; a null doc_id links with nothing, has a null
component_id and is kept; rows that repeat a doc_id are judged each by their own text; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.llm import arrowtext as at
from wayfold.llm.common import Scratch, in_arrow, only_keys
from wayfold.llm.graph import components

U64 = np.uint64
BITS = 4
FIRST, BLOCK, BLOCK_BYTES = 5, 512, 16 << 20
_COLUMNS = 2048


class Plan:
    def __init__(self, shingle: int = 5, threshold: float = 0.8, bands: int = 25, rows: int = 5, signature: int = 128, seed: int = 11):
        if bands * rows > signature or signature % 16:
            raise ValueError("bands * rows must fit the signature, whose length is a multiple of 16")
        self.shingle, self.threshold, self.bands, self.rows, self.signature = shingle, threshold, bands, rows, signature
        rng = np.random.default_rng(seed)
        self.mult = rng.integers(1, 1 << 63, signature, dtype=U64) * U64(2) + U64(1)
        self.add = rng.integers(1, 1 << 63, signature, dtype=U64)
        self.percent = round(threshold * 100)

    def least_estimate(self) -> float:
        """Estimates under this are not of pairs at the threshold."""
        chance = 2.0**-BITS
        p = self.threshold + (1 - self.threshold) * chance
        return (p - 6 * math.sqrt(p * (1 - p) / self.signature) - chance) / (1 - chance)


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct shingle hashes of one text's words; fewer words than n make one shingle."""
    if not len(hashes):
        return np.zeros(0, U64)
    return np.unique(at.window_hashes(hashes, min(n, len(hashes))))


def identity(found: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set of shingles."""
    return int(found.sum()), int(at.mix(found + U64(7)).sum())


def minima(found: np.ndarray, plan: Plan) -> np.ndarray:
    out = np.full(plan.signature, np.iinfo(U64).max, U64)
    for i in range(0, len(found), _COLUMNS):
        grid = plan.mult[:, None] * found[None, i : i + _COLUMNS]
        grid += plan.add[:, None]
        np.minimum(out, grid.min(axis=1), out=out)
    return out


def _texts(df: DataFrame) -> DataFrame:
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def signatures(docs: DataFrame, plan: Plan) -> DataFrame:
    """doc_id, text_hash, n_shingles, set_a, set_b (identity of the set), bands array<long>, bits array<long> (16 low-bit groups each)."""
    schema = "doc_id long, text_hash long, n_shingles long, set_a long, set_b long, bands array<long>, bits array<long>"
    arrow = pa.schema([(c, pa.int64()) for c in ("doc_id", "text_hash", "n_shingles", "set_a", "set_b")] + [(c, pa.list_(pa.int64())) for c in ("bands", "bits")])
    places = (np.arange(16, dtype=U64) * U64(BITS))[None, :]
    salt = np.arange(plan.bands, dtype=U64) + U64(1)
    weights = (np.arange(plan.rows, dtype=U64) * U64(2) + U64(3))[None, :]

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in at.chunks(batches, limit=2 << 20):
            found = at.words(chunk.data, chunk.offsets, at.FOLDED)
            n = chunk.rows.num_rows
            counts, a, b = np.zeros(n, np.int64), np.zeros(n, U64), np.zeros(n, U64)
            bands, bits = np.zeros((n, plan.bands), U64), np.zeros((n, plan.signature // 16), U64)
            for i in range(n):
                mine = shingles(found.hashes[found.first[i] : found.first[i + 1]], plan.shingle)
                if not len(mine):
                    continue
                counts[i], (a[i], b[i]) = len(mine), identity(mine)
                low = minima(mine, plan)
                grid = at.mix(low[: plan.bands * plan.rows].reshape(plan.bands, plan.rows)) * weights
                bands[i] = at.mix(grid.sum(axis=1) + salt)
                bits[i] = ((low & U64((1 << BITS) - 1)).reshape(-1, 16) << places).sum(axis=1, dtype=U64)
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * x.shape[1]), pa.array(x.reshape(-1).view(np.int64))) for x in (bands, bits)]
            yield pa.RecordBatch.from_arrays([chunk.rows.column(0), chunk.rows.column(2), pa.array(counts), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), *lists], schema=arrow)

    return in_arrow(_texts(docs).withColumn("text_hash", F.xxhash64("text")), make, schema)


def shingle_sets(docs: DataFrame, n: int) -> DataFrame:
    """set_a, set_b, shingles array<long> (sorted distinct hashes) of each document that has any."""
    schema = "set_a long, set_b long, shingles array<long>"

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in at.chunks(batches, limit=2 << 20):
            found = at.words(chunk.data, chunk.offsets, at.FOLDED)
            sets = [shingles(found.hashes[found.first[i] : found.first[i + 1]], n) for i in range(chunk.rows.num_rows)]
            sets = [x for x in sets if len(x)]
            if not sets:
                continue
            named = np.array([identity(x) for x in sets], U64).view(np.int64)
            cuts = np.concatenate(([0], np.cumsum([len(x) for x in sets]))).astype(np.int32)
            column = pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(sets).view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(named[:, 0]), pa.array(named[:, 1]), column], names=["set_a", "set_b", "shingles"])

    return in_arrow(_texts(docs), make, schema)


def estimate(x: Column, y: Column, signature: int) -> Column:
    """Similarity from two bit signatures, corrected for low bits that agree by chance, as a column; `Cell.estimates` does the same in numpy."""
    ones = int("1" * 16, 16)

    def differing(a: Column, b: Column) -> Column:
        d = a.bitwiseXOR(b)
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        return F.bit_count(d.bitwiseAND(F.lit(ones).cast("long")))

    unequal = F.aggregate(F.zip_with(x, y, differing), F.lit(0), lambda s, v: s + v)
    chance = 2.0**-BITS
    return ((F.lit(1.0) - unequal / F.lit(float(signature))) - F.lit(chance)) / F.lit(1 - chance)


def _places(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The members of the ranges, one after the other."""
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(int(counts.sum()))


class Cell:
    """The members of two blocks of a bucket, or of one."""

    def __init__(self, rows: pa.Table, plan: Plan):
        self.plan = plan
        self.side, self.label = (np.asarray(rows.column(c), np.int64).copy() for c in ("side", "label"))
        flat = lambda c: np.asarray(rows.column(c).combine_chunks().flatten(), np.int64)
        self.bits = flat("bits").view(U64).reshape(rows.num_rows, -1)
        self.codes = np.unique(flat("shingles"), return_inverse=True)[1]
        self.count = np.asarray(pa.compute.list_value_length(rows.column("shingles")), np.int64)
        self.first = np.cumsum(self.count) - self.count
        self.flags = np.zeros(int(self.codes.max(initial=-1)) + 1, bool)

    def estimates(self, p: int, others: np.ndarray) -> np.ndarray:
        d = self.bits[others] ^ self.bits[p]
        d |= d >> U64(2)
        d |= d >> U64(1)
        unequal = np.bitwise_count(d & U64(int("1" * 16, 16))).sum(axis=1)
        chance = 2.0**-BITS
        return (1 - unequal / self.plan.signature - chance) / (1 - chance)

    def linked(self, p: int, others: np.ndarray) -> np.ndarray:
        """Those of the others whose full sets are similar enough to the pivot's."""
        others = others[self.estimates(p, others) >= self.plan.least_estimate()]
        if not len(others):
            return others
        mine = self.codes[self.first[p] : self.first[p] + self.count[p]]
        self.flags[mine] = True
        counts = self.count[others]
        common = np.add.reduceat(self.flags[self.codes[_places(self.first[others], counts)]], np.cumsum(counts) - counts, dtype=np.int64)
        self.flags[mine] = False
        return others[100 * common >= self.plan.percent * (len(mine) + counts - common)]

    def joined(self) -> list[tuple[int, int]]:
        """Pairs of labels that links join, none of them implied by those before it."""
        out = []
        two = len(np.unique(self.side)) > 1  # of two blocks, each one's own pairs meet in a cell of their own
        size = np.unique(self.label, return_inverse=True, return_counts=True)
        order = np.lexsort((self.label, size[2][size[1]]))
        now = self.label.copy()
        for k, p in enumerate(order):
            rest = order[k + 1 :]
            rest = rest[(now[rest] != now[p]) & (self.side[rest] != self.side[p])] if two else rest[now[rest] != now[p]]
            if not len(rest):
                continue
            for label in np.unique(now[self.linked(p, rest)]):
                out.append((int(now[p]), int(label)))
                now[now == label] = now[p]
            if (now == now[p]).all():
                break
        return out


def _cells(batches: Iterable[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """The cells of a sorted stream, each whole."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        keys = np.stack([np.asarray(batch.column(batch.schema.get_field_index(c)), np.int64) for c in names])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            if i == j:
                continue
            key = keys[:, i].tolist()
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held)


def _compared(members: DataFrame, sets: DataFrame, plan: Plan) -> DataFrame:
    """(a, b): labels that links between members (band, cid, label, blocks) join, cell by cell."""
    key = ["band", "low", "high"]

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _cells(batches, key):
            found = np.array(Cell(rows, plan).joined(), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    block = F.pmod(F.xxhash64("cid"), F.col("blocks"))
    dealt = members.withColumn("side", block).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select("band", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "label", "cid")
    whole = dealt.join(sets, "cid").select(*key, "side", "label", "bits", "shingles")
    return in_arrow(whole.repartition(*key).sortWithinPartitions(*key), make, "a long, b long")


def _labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    return members.withColumn("label", F.col("cid")) if labels is None else members.join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid"))


def near_duplicates(docs: DataFrame, shingle: int = 5, threshold: float = 0.8, **more: int) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept (doc_id = component_id)."""
    return verdicts(docs, shingle, threshold, **more).drop("text_hash")


def verdicts(docs: DataFrame, shingle: int = 5, threshold: float = 0.8, **more: int) -> DataFrame:
    """As near_duplicates, with text_hash (xxhash64 of the text): doc_id and text decide on a row."""
    plan = Plan(shingle, threshold, **more)
    with Scratch(docs.sparkSession, "near-dedup") as scratch:
        sigs = scratch.put("signatures", signatures(docs, plan))
        usable = sigs.where("doc_id IS NOT NULL AND n_shingles > 0")
        classes = usable.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("bits").alias("bits"))
        classes = scratch.put("classes", classes.withColumn("cid", F.monotonically_increasing_id()))
        labels = _labels(docs, classes, plan, scratch)
        named = classes.select("set_a", "set_b", "cid", "rep").join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
        least = named.groupBy("label").agg(F.min("rep").alias("component_id"))
        named = scratch.put("named", named.select("set_a", "set_b", "label").join(least, "label").drop("label"))
        narrow = ["doc_id", "text_hash", "n_shingles", "set_a", "set_b"]
        grouped = usable.select(narrow).join(named, ["set_a", "set_b"])
        alone = sigs.where("doc_id IS NULL OR n_shingles = 0").select(narrow).withColumn("component_id", F.col("doc_id"))
        out = grouped.select(alone.columns).unionByName(alone)
        kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
        out = scratch.put("verdicts", out.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), "text_hash"))
        scratch.keep("verdicts")
        return out


def _labels(docs: DataFrame, classes: DataFrame, plan: Plan, scratch: Scratch) -> DataFrame:
    """(cid, label): groups of linked classes; a class without links may be left out."""
    spread = classes.select("cid", "n", F.posexplode("bands").alias("at", "band"))
    sizes = spread.groupBy("band").agg(F.count("*").alias("size"), F.sum("n").alias("all")).where("size > 1")
    blocks = F.least("size", F.ceil(F.greatest(F.col("size") / BLOCK, F.col("all") * 8 / BLOCK_BYTES)).cast("long"))
    sizes = scratch.put("sizes", sizes.select("band", blocks.alias("blocks")))
    members = scratch.put("members", spread.select("cid", "at", "band").join(sizes, "band"))
    met = scratch.put("met", members.select("cid").distinct().join(classes.select("cid", "set_a", "set_b", "rep", "bits"), "cid"))
    reps = scratch.put("reps", met.select(F.col("rep").alias("doc_id")).distinct())
    sets = shingle_sets(only_keys(_texts(docs), reps, "left_semi", 8), plan.shingle).dropDuplicates(["set_a", "set_b"])
    sets = scratch.put("sets", met.select("cid", "set_a", "set_b", "bits").join(sets, ["set_a", "set_b"]).select("cid", "bits", "shingles"))
    scratch.drop("sizes", "met", "reps")

    pairs = scratch.put("pairs", _compared(_labelled(members.where(f"at < {FIRST}"), None), sets, plan))
    labels = components(pairs, scratch=scratch, name="first").withColumnRenamed("node", "cid")
    named = scratch.put("named-members", _labelled(members.where(f"at >= {FIRST}"), labels).select("band", "cid", "label", "blocks"))
    open_ = scratch.put("open", named.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("band"))
    pairs = scratch.put("pairs", _compared(named.join(open_, "band"), sets, plan))
    scratch.drop("sets", "members", "named-members", "open")
    merged = components(pairs, scratch=scratch, name="merged").withColumnRenamed("label", "further")
    every = labels.unionByName(merged.select(F.col("node").alias("cid"), F.col("node").alias("label"))).groupBy("cid").agg(F.min("label").alias("label"))
    return scratch.put("labels", every.join(merged, every.label == merged.node, "left").select("cid", F.coalesce("further", "label").alias("label")))
