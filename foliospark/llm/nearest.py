"""Approximate nearest neighbours by collision counting with virtual rehashing.

Every row is indexed: a chunk of rows keeps a sorted array of its values under each of PROJECTIONS single Gaussian
projections. For a query, windows centred on its own projections widen step by step (virtual rehashing: the windows
are buckets of growing width over the same arrays), and each row counts the windows it lies in. Rows that reach
the collision threshold are verified by their exact Euclidean distance on original vectors, in double precision.
A query stops when its windows' half-width is STOP times its k-th best verified distance: a row nearer than that
lies in a window with a probability of 0.77 at least, against a threshold of SHARE of the windows, so it is missed
with a probability of about 0.002 at most.

The query set is cut into blocks of BLOCK rows; each block is broadcast (its size is bounded by the block) to all
chunks, and each chunk returns its k best for each query. These are ranked over all chunks.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component take no part, as
queries or as candidates; vectors of another length than the query's aren't candidates. A query's own vec_id is no
candidate. Ties go to the smaller vec_id; rows that repeat a vec_id count once, with the nearest. A query with
fewer candidates than k gets them all. Rows without vec_id take no part. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.common import cut, map_batches, read_table
from foliospark.llm.vectors import matrix, valid

PROJECTIONS = 64
SHARE = 0.62
STOP = 1.2
GROWTH = 1.25
CHUNK = 8000
BLOCK = 2048
#: Rows of a chunk whose nearest one sets a query's first width; it has no other effect.
PROBES = 64
SEED = 2


class Index:
    """Sorted projections of a chunk of vectors of one length."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x, self.squares = ids, x, (x * x).sum(axis=1)
        self.planes = np.random.default_rng([SEED, x.shape[1]]).standard_normal((x.shape[1], PROJECTIONS))
        values = np.ascontiguousarray((x @ self.planes).T)
        self.order = np.argsort(values, axis=1).astype(np.int32)
        self.values = np.take_along_axis(values, self.order, axis=1)

    def _squared(self, q: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Squared distances, near enough to choose which ones to compute exactly."""
        return np.maximum(self.squares[rows] - 2 * (self.x[rows] @ q) + q @ q, 0)

    def _verify(self, q: np.ndarray, rows: np.ndarray, best: tuple, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest of best (ids, distances) and the rows, by exact distance, ties to the smaller id."""
        near = self._squared(q, rows)
        if len(rows) > k:
            most = np.partition(near, k - 1)[k - 1]
            if len(best[1]) >= k:
                most = min(most, best[1][-1] ** 2)
            if len(np.unique(self.ids[rows[near <= most]])) >= k or len(best[1]) >= k:  # repeated ids count once
                rows = rows[near <= most + 1e-9 * (q @ q + self.squares[rows].max())]
        d = np.concatenate([best[1], np.sqrt(np.cumsum((self.x[rows] - q) ** 2, axis=1)[:, -1])])
        i = np.concatenate([best[0], self.ids[rows]])
        at = np.lexsort((i, d))
        at = at[np.sort(np.unique(i[at], return_index=True)[1])][:k]
        return i[at], d[at]

    def nearest(self, own: np.ndarray, q: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, distances) of the k nearest rows found for each query, nearest first; own: the queries' ids."""
        n, m, centre = len(self.ids), len(q), q @ self.planes
        need = int(np.ceil(SHARE * PROJECTIONS))
        probes = np.linspace(0, n - 1, min(n, PROBES)).astype(int)
        half = np.array([np.sqrt(self._squared(v, probes[self.ids[probes] != o]).min(initial=np.inf)) for v, o in zip(q, own, strict=True)])
        spread = np.ptp(self.values[:, [0, -1]], axis=1).max()
        half = np.maximum(np.where(np.isfinite(half), 0.6 * half, spread), max(spread * 1e-6, 1e-12))
        low = np.stack([np.searchsorted(v, c) for v, c in zip(self.values, centre.T, strict=True)], axis=1)
        high = low.copy()
        counts = np.zeros((m, n), np.uint8)
        best = [(np.zeros(0, np.int64), np.zeros(0))] * m
        open_ = np.arange(m)
        while len(open_):
            reach = half[open_]
            left = np.stack([np.searchsorted(v, c - reach, "left") for v, c in zip(self.values, centre[open_].T, strict=True)], axis=1)
            right = np.stack([np.searchsorted(v, c + reach, "right") for v, c in zip(self.values, centre[open_].T, strict=True)], axis=1)
            still = []
            for a, b, j in zip(left, right, open_, strict=True):
                old_a, old_b = low[j], high[j]
                parts = [self.order[p, s:e] for p in range(PROJECTIONS) for s, e in ((a[p], old_a[p]), (old_b[p], b[p]))]
                before = counts[j] >= need
                counts[j] += np.bincount(np.concatenate(parts), minlength=n).astype(np.uint8)
                low[j], high[j] = a, b
                rows = np.flatnonzero((counts[j] >= need) & ~before & (self.ids != own[j]))
                if len(rows):
                    best[j] = self._verify(q[j], rows, best[j], k)
                found = best[j][1]
                if len(found) >= k and half[j] >= STOP * found[-1] or not a.any() and (b == n).all():
                    continue
                half[j] *= GROWTH
                if len(found) >= k:  # no wider than what ends the search
                    half[j] = min(half[j], max(half[j] / GROWTH, STOP * found[-1]) * 1.0000001)
                still.append(j)
            open_ = np.array(still, dtype=int)
        return best


def _search(rows: DataFrame, queries: list[tuple], k: int) -> DataFrame:
    """(query_id, vec_id, score): the k best of each chunk of rows for each query (id, vector) of a block."""
    shared = rows.sparkSession.sparkContext.broadcast(queries)

    def answer(ids: list[np.ndarray], vectors: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        index, out = Index(np.concatenate(ids), np.concatenate(vectors)), []
        asked = [(own, q) for own, q in shared.value if len(q) == index.x.shape[1]]
        for at in range(0, len(asked), 256):  # bounds the counts held at a time
            part = asked[at : at + 256]
            found = index.nearest(np.array([o for o, _ in part]), np.array([q for _, q in part]), k)
            out += [(np.full(len(i), o, np.int64), i, d) for (o, _), (i, d) in zip(part, found, strict=True)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[i] for o in out])) for i in range(3)], names=["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}
        for batch in batches:
            column = batch.column(1)
            sizes = column.value_lengths().to_numpy()
            for d in np.unique(sizes):
                at = np.flatnonzero(sizes == d)
                ids, vectors = held.setdefault(int(d), ([], []))
                ids.append(batch.column(0).to_numpy()[at])
                vectors.append(matrix(column.take(pa.array(at))))
                if sum(map(len, ids)) >= CHUNK:
                    yield from answer(*held.pop(int(d)))
        for ids, vectors in held.values():
            yield from answer(ids, vectors)

    return map_batches(rows, run, "query_id long, vec_id long, score double")


def nearest(df: DataFrame, queries: DataFrame, *, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of df found for each row of queries."""
    usable = lambda x: valid(x.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v")).where("id IS NOT NULL"), "v")
    rows, asked = usable(df), cut(usable(queries).dropDuplicates(["id"]))
    blocks = max(1, -(-asked.count() // (BLOCK // 2)))  # by hash, so that a block stays under BLOCK rows
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    found = None
    for b in range(blocks):
        block = [(r["id"], np.array(r["v"], np.float64)) for r in dealt.where(F.col("block") == b).collect()]  # a block at a time
        part = _search(rows, block, k).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
        part = part.select("query_id", F.row_number().over(best).cast("int").alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
        part = cut(part) if blocks > 1 else part
        found = part if found is None else found.unionByName(part)
    return found


def op8_nearest(spark, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 100 = 0"), k=10)


OP8_SQL = r"""
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), d AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_distance(q.e, v.e) AS score
  FROM v q JOIN v ON v.vec_id <> q.vec_id AND len(v.e) = len(q.e) WHERE q.vec_id % 100 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10
"""
