"""Vector store on DataFrames: embedding, upsert, filtered k-NN, delete and count."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliospark.functions import vector as V

#: Queries that are broadcast at a time in a batch search, rows that a matrix product takes, and what rounding may shift
#: (a part of the largest squared length, or of 1 for cosines).
BLOCK_QUERIES = 1_000
ROWS_AT_A_TIME = 2_000
SLACK = 1e-9


def knn(vectors: DataFrame, query: Sequence[float], k: int = 10, *, metric: str = "cosine", filters: Mapping[str, object] | None = None, id_col: str = "chunk_id", vec_col: str = "embedding", min_score: float | None = None) -> DataFrame:
    """The k nearest rows with score, nearest first, ties by id. filters: equality on columns, before the search.

    The plan is scan, pushed filter, score, TakeOrderedAndProject: k rows of each partition reach the driver's side.
    """
    for name, value in (filters or {}).items():
        vectors = vectors.where(F.array_contains(name, value) if vectors.schema[name].dataType.typeName() == "array" else F.col(name) == F.lit(value))
    scored = vectors.withColumn("score", V.score(metric, F.col(vec_col), query)).where(F.col("score").isNotNull())
    if min_score is not None:
        scored = scored.where(F.col("score") >= min_score)
    order = F.col("score").desc() if V.descending(metric) else F.col("score").asc()
    return scored.orderBy(order, F.col(id_col)).limit(k)


def knn_batch(vectors: DataFrame, queries: DataFrame, k: int = 10, *, metric: str = "cosine", id_col: str = "chunk_id", vec_col: str = "embedding", query_id: str = "query_id", query_vec: str = "query_vec") -> DataFrame:
    """(query_id, rank, id, score): the k nearest rows of each query, ties by id.

    Queries meet the rows in blocks of about BLOCK_QUERIES, so that what is broadcast stays bounded. Matrix products
    choose each partition's candidates for each query, and those alone are scored exactly and ranked. Rows and queries
    without a vector, or with null or NaN in it, are left out, as are rows of another length than the query's.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).alias("_id"), F.col(vec_col).alias("_v"))
    asked = queries.select(F.col(query_id).alias("query_id"), F.col(query_vec).cast("array<double>").alias("_q")).where("_q IS NOT NULL")
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    order = F.col("score").desc() if V.descending(metric) else F.col("score").asc()
    w = Window.partitionBy("query_id").orderBy(order, F.col("_id"))
    schema = T.StructType([T.StructField("_i", T.IntegerType()), *asked.schema.fields])
    out = None
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b).collect() if blocks > 1 else asked.collect()  # a block at a time
        for dims in {len(r["_q"]) for r in block} or {1}:
            some = [r for r in block if len(r["_q"]) == dims]
            small = spark.createDataFrame([(i, r["query_id"], r["_q"]) for i, r in enumerate(some)], schema)
            near = _candidates(rows, np.array([r["_q"] for r in some], np.float64).reshape(len(some), dims), k, metric).join(F.broadcast(small), "_i")
            scored = near.select("query_id", "_id", V.score(metric, F.col("_v"), F.col("_q")).alias("score")).where("score IS NOT NULL")
            best = scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            out = best if out is None else out.unionByName(best)
    return out.select("query_id", "rank", F.col("_id").alias(id_col), "score")


def _scores(metric: str, asked: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Scores of all rows for all queries, larger is nearer; NaN for what has none."""
    with np.errstate(all="ignore"):
        if metric == "euclid":
            return 2 * asked @ x.T - (asked**2).sum(1)[:, None] - (x**2).sum(1)  # less the squared distance
        products = asked @ x.T
        return products if metric == "dot" else products / (np.linalg.norm(asked, axis=1)[:, None] * np.linalg.norm(x, axis=1))


def _nearest(query: np.ndarray, score: np.ndarray, k: int, slack: float) -> np.ndarray:
    """Places of each query's k best scores, and of those that rounding, up to the slack, may hide behind the last of them."""
    order = np.lexsort((-score, query))
    begins = np.flatnonzero(np.r_[True, np.diff(query[order]) != 0])
    ends = np.r_[begins[1:], len(order)]
    last = score[order][np.minimum(begins + k, ends) - 1]
    return order[score[order] >= np.repeat(last - slack, ends - begins)]


def _candidates(rows: DataFrame, asked: np.ndarray, k: int, metric: str) -> DataFrame:
    """(_i, _id, _v) of rows (_id, _v): for each query (by its number), what may be among its k nearest of each partition."""
    shared = rows.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        asked, held = shared.value, None
        largest = (asked**2).sum(1).max(initial=0)
        for batch in batches:
            fits = batch.filter(pc.fill_null(pc.equal(pc.list_value_length(batch.column(1)), asked.shape[1]), False))
            for at in range(0, len(fits) if len(asked) else 0, ROWS_AT_A_TIME):
                part = fits.slice(at, ROWS_AT_A_TIME)
                x = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(part), -1)
                scores = _scores(metric, asked, x)
                query, place = np.nonzero(~np.isnan(scores))
                if not len(query):
                    continue
                largest = max(largest, np.nanmax((x**2).sum(1), initial=0))
                slack = SLACK * (1 if metric == "cosine" else 1 + largest)
                best = _nearest(query, scores[query, place], k, slack)
                query, place = query[best], place[best]
                new = pa.table([pa.array(query), pa.array(scores[query, place]), part.column(0).take(pa.array(place)), part.column(1).take(pa.array(place))], names=["_i", "s", "_id", "_v"])
                held = new if held is None else pa.concat_tables([held, new])
                held = held.take(pa.array(_nearest(held.column("_i").to_numpy(), held.column("s").to_numpy(), k, slack)))
        if held is not None:
            for b in held.combine_chunks().to_batches():
                yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int32()), b.column(2), b.column(3)], names=["_i", "_id", "_v"])

    return rows.mapInArrow(run, T.StructType([T.StructField("_i", T.IntegerType()), *rows.schema.fields]))


def check_dimension(vectors: DataFrame, dim: int, *, vec_col: str = "embedding") -> DataFrame:
    """vectors; a row of another length raises an error when it is read."""
    bad = F.raise_error(F.concat(F.lit(f"expected {dim} dimensions, found "), F.coalesce(F.size(vec_col).cast("string"), F.lit("null"))))
    return vectors.withColumn(vec_col, F.when(F.size(vec_col) == dim, F.col(vec_col)).otherwise(bad.cast(vectors.schema[vec_col].dataType)))


def upsert(store: DataFrame, batch: DataFrame, *, key: str = "chunk_id", seq: str = "seq") -> DataFrame:
    """The store after a batch with a sequence column: the last row of a key wins, and replaces the store's."""
    last = batch.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(F.col(seq).desc()))).where("_n = 1").drop("_n", seq)
    kept = store.join(last.select(key), key, "left_anti")
    return kept.unionByName(last)


def delete(store: DataFrame, ids: DataFrame | Sequence[str], *, key: str = "chunk_id") -> DataFrame:
    if isinstance(ids, DataFrame):
        return store.join(ids.select(key).distinct(), key, "left_anti")
    return store.where(~F.col(key).isin(list(ids)))


def count(store: DataFrame) -> int:
    return store.count()


class SparkVectorStore:
    """A vector collection kept as Parquet snapshots under a folder; each change writes a new snapshot."""

    def __init__(self, spark, folder: str, *, dim: int = 1536, metric: str = "cosine"):
        if metric not in V.METRICS:
            raise ValueError(f"unknown metric {metric!r}; one of {V.METRICS}")
        self.spark, self.folder, self.dim, self.metric, self.version = spark, folder, dim, metric, 0
        self._write(spark.createDataFrame([], "chunk_id string, text string, embedding array<float>, metadata map<string,string>"))

    def _write(self, rows: DataFrame) -> None:
        path = f"{self.folder}/v{self.version + 1}"
        rows.write.mode("overwrite").parquet(path)
        self.version += 1

    def read(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/v{self.version}")

    def upsert(self, rows: DataFrame) -> int:
        """rows with chunk_id, text, embedding, metadata and seq; returns the number of rows handed in."""
        n = rows.count()
        self._write(upsert(self.read(), check_dimension(rows, self.dim)))
        return n

    def search(self, query: Sequence[float], top_k: int = 10, filters: Mapping[str, str] | None = None) -> DataFrame:
        rows = self.read()
        for name, value in (filters or {}).items():
            rows = rows.where(F.col("metadata")[name] == value)
        return knn(rows, query, top_k, metric=self.metric).select("chunk_id", "text", "score", "metadata")

    def delete(self, ids: Sequence[str]) -> int:
        self._write(delete(self.read(), ids))
        return len(ids)

    def count(self) -> int:
        return self.read().count()


def get_vector_store(kind: str, spark, folder: str, **options) -> SparkVectorStore:
    """The store of a kind; only spark exists."""
    if kind != "spark":
        raise ValueError(f"unknown vector store {kind!r}")
    return SparkVectorStore(spark, folder, **options)
