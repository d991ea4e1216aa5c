"""Conflict-constrained best-fit packing of documents into bins of fixed capacity.

Documents are dealt by a hash of doc_id to groups of at most about `GROUP` pieces, and each group is packed by itself, largest piece first. A bin carries
the bitmap of its sources and the set bits of its duplicate clusters; a piece fits a bin with room enough that holds neither its source nor, from another
document, its cluster. Bins are kept in residual order: a tree over residual capacities holds, at each node, the AND of the source
bitmaps below, so that the search for the successor skips in one step whole ranges whose bins all hold the source, and goes on from residual to
residual until the tightest compatible bin is found. Only if there is none, a bin is opened. Pieces of one cluster have one size and follow one another; bins that
got one of them wait outside the order until the last is placed, so that a large cluster does not search among its own bins.

A text longer than the capacity is cut: full pieces fill bins of their own, and the rest is packed like any other piece. Nothing
is dropped. Sizes are numbers of words (runs without ASCII white space).

Cost: texts are read once for sizes and cluster hashes; rows of 50 bytes are shuffled to their groups, which stay of one size as the corpus grows. A hot
source or cluster is spread over all groups by the hash of doc_id; conflicts cost bins, not time.

Defined cases: null or wordless text has size 0: one piece of 0 words in a bin like any other; a null source conflicts with nothing; a null doc_id
is packed with key 0; rows that repeat a doc_id are packed each; equal sizes go by cluster, doc_id, then source; extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.llm import arrowtext as at
from wayfold.llm.common import block_of, in_arrow, power_of_two

CAPACITY, GROUP = 2048, 16384
SCHEMA = "doc_id long, piece int, n_words long, bin string, bin_used long, position int, source string, cluster long"
_ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("n_words", pa.int64()), ("bin", pa.string()), ("bin_used", pa.int64()), ("position", pa.int32()), ("source", pa.string()), ("cluster", pa.int64())])


class Bins:
    """Open bins in residual order. `place` finds the tightest compatible bin, or opens one, and returns its index."""

    def __init__(self, capacity: int):
        self.capacity, self.leaves = capacity, power_of_two(capacity + 1, 1)
        self.none = -1  # the AND over no bins: all bits set
        self.tree = [self.none] * (2 * self.leaves)
        self.at: list[dict[int, list[int]]] = [{} for _ in range(self.leaves)]  # by residual: bins by source bitmap
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.residual: list[int] = []
        self.waiting: list[int] = []  # bins that hold the cluster at hand
        self.cluster = 0

    def _refresh(self, residual: int) -> None:
        total = self.none
        for bitmap in self.at[residual]:
            total &= bitmap
        node = self.leaves + residual
        self.tree[node] = total
        node >>= 1
        while node:
            new = self.tree[2 * node] & self.tree[2 * node + 1]
            if new == self.tree[node]:
                break
            self.tree[node] = new
            node >>= 1

    def _successor(self, least: int, source: int) -> int:
        """The smallest residual of `least` or more at which some bin lacks the source bit; -1 if there is none."""
        node = self.leaves + least
        if least > self.capacity:
            return -1
        while self._shut(node, source):
            while node & 1:  # the right child: up to where a right sibling exists
                node >>= 1
                if node <= 1:
                    return -1
            if node <= 1:
                return -1
            node += 1
        while node < self.leaves:
            node = 2 * node if not self._shut(2 * node, source) else 2 * node + 1
        return node - self.leaves

    def _shut(self, node: int, source: int) -> bool:
        """No bin below, or all of them hold the source."""
        return self.tree[node] == self.none or bool(source and self.tree[node] & source)

    def _enter(self, b: int) -> None:
        self.at[self.residual[b]].setdefault(self.sources[b], []).append(b)
        self._refresh(self.residual[b])

    def _settle(self, b: int, cluster: int) -> None:
        if cluster:
            self.waiting.append(b)
        else:
            self._enter(b)

    def place(self, size: int, source: int, cluster: int) -> int:
        if cluster != self.cluster:
            for b in self.waiting:
                self._enter(b)
            self.waiting, self.cluster = [], cluster
        residual = self._successor(size, source)
        while residual >= 0:
            for bitmap, bins in self.at[residual].items():
                if bitmap & source:
                    continue
                for k in range(len(bins) - 1, -1, -1):
                    b = bins[k]
                    if not self.clusters[b] & cluster:
                        bins.pop(k)
                        if not bins:
                            del self.at[residual][bitmap]
                        self._refresh(residual)
                        self.residual[b] -= size
                        self.sources[b] |= source
                        self.clusters[b] |= cluster
                        self._settle(b, cluster)
                        return b
            residual = self._successor(residual + 1, source)
        b = len(self.residual)
        self.residual.append(self.capacity - size)
        self.sources.append(source)
        self.clusters.append(cluster)
        self._settle(b, cluster)
        return b


def pack_pieces(pieces: list[tuple[int, int, int]], capacity: int) -> list[int]:
    """Bins of (size, source bit or 0, cluster bit or 0), in the order given."""
    bins = Bins(capacity)
    return [bins.place(*p) for p in pieces]


def pieces(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, cluster (hash of the words, -1 for none), source."""

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in at.chunks(batches, limit=4 << 20):
            found = at.words(chunk.data, chunk.offsets, at.FOLDED)
            counts = found.counts()
            places = np.arange(len(found.hashes), dtype=np.uint64) - np.repeat(found.first[:-1], counts).astype(np.uint64)
            mixed = at.mix(found.hashes + places * np.uint64(0x9E3779B97F4A7C15))
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed)))
            cluster = at.mix(sums[found.first[1:]] - sums[found.first[:-1]] + counts.astype(np.uint64)).view(np.int64)
            cluster = np.where(counts > 0, cluster, -1)
            yield pa.RecordBatch.from_arrays([chunk.rows.column(0), chunk.rows.column(2), pa.array(counts), pa.array(cluster)], names=["doc_id", "source", "n_words", "cluster"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("source"))
    return in_arrow(texts, make, "doc_id long, source string, n_words long, cluster long")


def pack(docs: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """A row for each piece: its bin (unique over all groups), the words used in the bin, and its position there."""
    groups = power_of_two(docs.count() / group, 1)

    def one(rows: pa.Table) -> pa.Table:
        key = rows.column("block")[0].as_py()
        ids, sizes = rows.column("doc_id").to_pylist(), rows.column("n_words").to_pylist()
        sources, clusters = rows.column("source").to_pylist(), rows.column("cluster").to_pylist()
        bit_of = {s: 1 << k for k, s in enumerate(sorted({s for s in sources if s is not None}))}
        seen: dict[int, int] = {}
        for c in clusters:
            seen[c] = seen.get(c, 0) + 1
        cluster_bit = {c: 1 << k for k, c in enumerate(sorted(c for c, n in seen.items() if n > 1 and c != -1))}
        whole, rest = [], []
        for i, size in enumerate(sizes):
            full = size // capacity if size > capacity else 0
            whole += [(i, p, capacity) for p in range(full)]
            if size - full * capacity or not full:
                rest.append((i, full, size - full * capacity))
        rest.sort(key=lambda x: (-x[2], clusters[x[0]], ids[x[0]] is None, ids[x[0]] or 0, sources[x[0]] or ""))
        bins = Bins(capacity)
        placed = [(i, p, n, bins.place(n, bit_of.get(sources[i], 0), cluster_bit.get(clusters[i], 0))) for i, p, n in rest]
        used, position = [capacity - r for r in bins.residual], [0] * len(bins.residual)
        out: dict[str, list] = {c: [] for c in _ARROW.names}
        for k, (i, p, n) in enumerate(whole):
            for c, v in zip(_ARROW.names, (ids[i], p, n, f"{key}-f{k}", capacity, 0, sources[i], clusters[i]), strict=True):
                out[c].append(v)
        for i, p, n, b in placed:
            for c, v in zip(_ARROW.names, (ids[i], p, n, f"{key}-{b}", used[b], position[b], sources[i], clusters[i]), strict=True):
                out[c].append(v)
            position[b] += 1
        return pa.table(out, _ARROW)

    return pieces(docs).withColumn("block", block_of("doc_id", groups)).groupBy("block").applyInArrow(one, SCHEMA)
