"""Exact top-k search by inner product, with a pivot table.

Vectors are made integer, component by component. Pivots are chosen farthest-first from a bounded sample. A candidate's distances to all
pivots give, for each query, the largest of the lower bounds |d(q, p) - d(x, p)| of its distance, and with the norms an upper bound of the
inner product: q.x = (|q|^2 + |x|^2 - d(q, x)^2) / 2. Candidates lie in blocks of neighbours (by their nearest pivot and the distance from it); blocks are evaluated in
the order of their largest bound until the next one lies under the k-th best score: exact stopping. The k-th best score in the sample is a floor from the start, so
that groups without good candidates end at once. Where vectors have no clusters, as in the test tables, bounds exclude little and nearly all are evaluated.

The work is a grid: queries and candidates are dealt to groups of bounded size by a hash of vec_id, and every pair of a query group and a candidate
group is one task's cell; the cells' best are ranked per query. Rows sent are queries x candidate groups and candidates x query groups.
The sample (at most `SAMPLE` vectors, pivots among them) is the only thing that the driver holds.

Defined cases: vectors that are null, or hold a null or non-finite component, take no part, nor does a null vec_id; rows that repeat a
vec_id are queries and candidates each, and only the query's own row is none of its candidates; vectors of other lengths than the query's are no candidates; fewer
candidates than k give all of them; ties go to the smaller vec_id; an empty table gives no rows. Components beyond 2**62 after scaling are clipped, and scores beyond
64 bits wrap. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfold.llm.common import block_of, power_of_two, stored

SAMPLE, PIVOTS, BLOCK, QUERIES_A_CELL, CANDIDATES_A_CELL = 1024, 32, 256, 2048, 8192


def integer_vectors(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """vec_id, v array<long>: floor(scale * x) of each component, for the rows that take part."""
    x = F.col("embedding")
    number = lambda e: e.cast("double")
    whole = F.forall(x, lambda e: F.coalesce(e.isNotNull() & ~F.isnan(number(e)) & (F.abs(number(e)) < F.lit(float("inf"))), F.lit(False)))
    limit = float(1 << 62)
    made = F.transform(x, lambda e: F.greatest(F.least(F.lit(float(scale)) * number(e), F.lit(limit)), F.lit(-limit)))
    good = vectors.where(F.col("vec_id").isNotNull() & x.isNotNull()).where(whole)
    v = F.transform(made, lambda e: F.floor(e).cast("long"))
    return good.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first from the vector of largest norm on."""
    if not len(sample):
        return sample
    x = sample.astype(np.float64)
    picked = [int((x * x).sum(1).argmax())]
    far = ((x - x[picked[0]]) ** 2).sum(1)
    while len(picked) < min(count, len(x)) and far.max() > 0:
        picked.append(int(far.argmax()))
        far = np.minimum(far, ((x - x[picked[-1]]) ** 2).sum(1))
    return sample[picked]


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: in floats where they are exact, else in 64-bit integers."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[-1])
    return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64) if most < 2**53 else a @ b


class PivotTable:
    """Candidates of one length: rows (names of their own), ids, vectors, and their distances to the pivots."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray, block: int = BLOCK):
        self.pivots, self.block = pivots.astype(np.float64), block
        table = self.distances(vectors)
        if len(pivots) and len(rows):
            near = table.argmin(axis=0)
            order = np.lexsort((table[near, np.arange(len(rows))], near))
            rows, ids, vectors, table = rows[order], ids[order], vectors[order], table[:, order]
        self.rows, self.ids, self.vectors = rows, ids, vectors
        self.norms = (vectors.astype(np.float64) ** 2).sum(1)
        self.table = table.astype(np.float32)
        self.longest = float((self.pivots**2).sum(1).max(initial=0)) if self.pivots.size else 0.0
        self.cuts = np.arange(0, len(rows), block)
        self.most = float(np.abs(vectors).max(initial=0))
        self.exact = vectors.astype(np.float64) if self.most * self.most * max(1, vectors.shape[1]) < 2**53 else vectors
        self._least, self._gap = np.empty(len(rows), np.float32), np.empty(len(rows), np.float32)

    def distances(self, v: np.ndarray) -> np.ndarray:
        x = v.astype(np.float64)
        square = (x**2).sum(1)[:, None] + (self.pivots**2).sum(1)[None] - 2 * x @ self.pivots.T
        return np.sqrt(np.maximum(square, 0)).T.copy()  # pivot by vector

    def bounds(self, query: np.ndarray, to_pivots: np.ndarray) -> np.ndarray:
        """Upper bounds of the inner products with all candidates, rounding allowed for."""
        self._least[:] = 0
        for own, d in zip(self.table, to_pivots.astype(np.float32), strict=True):
            np.subtract(own, d, out=self._gap)
            np.abs(self._gap, out=self._gap)
            np.maximum(self._least, self._gap, out=self._least)
        norm = float((query.astype(np.float64) ** 2).sum())
        slack = 4e-6 * (norm + self.norms + self.longest) + 1e-3
        return (norm + self.norms - np.square(self._least, dtype=np.float64)) / 2 + slack

    def best(self, own: int, query: np.ndarray, to_pivots: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray, int]:
        """ids and scores of the k best (of those at `floor` or more) but for the row `own`, and how many candidates were evaluated."""
        ids, scores, done = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        if not len(self.rows):
            return ids, scores, done
        top = np.maximum.reduceat(self.bounds(query, to_pivots), self.cuts)
        order = np.argsort(-top, kind="stable")
        order = order[top[order] >= floor]
        exact = self.exact.dtype == np.float64 and float(np.abs(query).max(initial=0)) * self.most * max(1, len(query)) < 2**53
        q, vectors = (query.astype(np.float64), self.exact) if exact else (query, self.vectors)
        least = floor
        for b in order:
            if len(scores) == k and top[b] < scores[-1]:
                break
            low, high = self.cuts[b], min(self.cuts[b] + self.block, len(self.rows))
            done += int(high - low)
            s = vectors[low:high] @ q
            good = np.flatnonzero((s >= least) & (self.rows[low:high] != own))
            if len(good):
                ids, scores = np.concatenate((ids, self.ids[low + good])), np.concatenate((scores, s[good].astype(np.int64)))
                keep = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[keep], scores[keep]
                if len(scores) == k:
                    least = max(floor, scores[-1])
        return ids, scores, done


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows, ids = (np.asarray(table.column(c), np.int64) for c in ("id", "vec_id"))
    lists = table.column("v").combine_chunks()
    flat = np.asarray(lists.flatten(), np.int64)
    return rows, ids, flat.reshape(len(ids), -1) if len(ids) and len(flat) else np.zeros((len(ids), 0), np.int64)


def search(queries: DataFrame, candidates: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k largest inner products of each query over the candidates other than itself.
    Both frames have id (one number a row, the same in both for one row), vec_id and v array<long>."""
    sized = candidates.withColumn("dim", F.size("v"))
    rows = sized.orderBy(F.xxhash64("vec_id", "v"), "vec_id", "id").limit(SAMPLE).collect()
    sample: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dim in {r.dim for r in rows}:
        mine = [r for r in rows if r.dim == dim]
        sample[dim] = np.array([r.id for r in mine], np.int64), np.array([r.v for r in mine], np.int64).reshape(len(mine), dim)
    pivots = {dim: choose_pivots(v, PIVOTS) for dim, (_, v) in sample.items()}
    n_query, n_all = queries.count(), candidates.count()
    query_groups, groups = power_of_two(n_query / QUERIES_A_CELL, 1), power_of_two(n_all / CANDIDATES_A_CELL, 1)

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(4)]
        if left.num_rows and right.num_rows:
            q_rows, q_ids, q = _matrix(left)
            rows, ids, v = _matrix(right)
            dim = v.shape[1]
            known, some = sample.get(dim, (np.zeros(0, np.int64), np.zeros((0, dim), np.int64)))
            table = PivotTable(rows, ids, v, pivots.get(dim, some))
            to_pivots = table.distances(q)
            seen = _products(q, some.T)
            for j in range(len(q_ids)):
                mine = seen[j][known != q_rows[j]]
                floor = float(np.partition(mine, len(mine) - k)[len(mine) - k]) if len(mine) >= k else -np.inf
                i, s, _ = table.best(int(q_rows[j]), q[j], to_pivots[:, j], k, floor)
                for column, values in zip(out, (np.full(len(i), q_rows[j]), np.full(len(i), q_ids[j]), i, s), strict=True):
                    column.append(values)
        return pa.table(dict(zip(("query", "query_id", "vec_id", "score"), map(np.concatenate, out), strict=True)))

    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = queries.select("id", "vec_id", "v", F.size("v").alias("dim"), block_of("id", query_groups).cast("int").alias("row"), every(groups).alias("col"))
    right = sized.select("id", "vec_id", "v", "dim", every(query_groups).alias("row"), block_of("id", groups).cast("int").alias("col"))
    key = ["dim", "row", "col"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(cell, "query long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """Queries: the rows whose vec_id is divisible by `every`; candidates: all rows."""
    whole = stored(integer_vectors(vectors).withColumn("id", F.monotonically_increasing_id()), "vectors")
    return search(whole.where(F.col("vec_id") % every == 0), whole, k)
