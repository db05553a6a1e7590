"""Embedding near-dedup: Euclidean p-stable hashing in several tables, then exact cosines.

A normalised vector's key in a table is floor((a.x + b) / WIDTH) for PROJECTIONS Gaussian projections a and offsets
b. Vectors of one key are compared exactly, in double precision. Cosine 0.9 is a distance of 0.447, for which a
projection agrees with a probability of 0.82 and one of TABLES tables with 0.99 (0.95: 0.9998).

A pair is counted in the first table whose key it shares, which each task sees from the vectors themselves; so
links are counted where they are found, and neither pairs nor all links of a group leave the task, only a count and
one link to the group's smallest vector. A key with more than BLOCK vectors is dealt into blocks; each pair of
blocks is a group of its own, so no key is gathered in one task. Vectors with equal components are one class, and
only its smallest vec_id goes on.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component link with nothing and
are kept. Vectors of different length are never compared. Rows that repeat a vec_id and its vector count as one
vector and share its result. A null vec_id has no component and is kept. An empty table gives no rows. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import broadcast_if_small, cut, map_batches, read_table, sorted_groups
from foliospark.llm.components import components
from foliospark.llm.vectors import matrix, valid

TABLES = 26
PROJECTIONS = 9
WIDTH = 2.0
BLOCK = 1000
SEED = 1
#: Keys with blocks up to which their list is broadcast; beyond that it is joined by shuffle.
BROADCAST_KEYS = 100_000


def _planes(dims: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([SEED, dims])
    return rng.standard_normal((dims, TABLES * PROJECTIONS)), rng.uniform(0, WIDTH, TABLES * PROJECTIONS)


def keys_of(unit: np.ndarray) -> np.ndarray:
    """Keys (rows x TABLES) of normalised vectors."""
    a, b = _planes(unit.shape[1])
    cells = np.floor((unit @ a + b) / WIDTH).astype(np.int64).reshape(len(unit), TABLES, PROJECTIONS).astype(np.uint64)
    key = np.full((len(unit), TABLES), unit.shape[1], np.uint64)
    for k in range(PROJECTIONS):
        key = (key ^ cells[:, :, k]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow of squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit vectors) for each vector length in the column."""
    sizes = column.value_lengths().to_numpy()
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        yield rows, _unit(matrix(column.take(pa.array(rows))))


def _keyed(reps: DataFrame) -> DataFrame:
    """(k, key, id, m, v): each vector in each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, unit in _by_length(batch.column(2)):
                keys = keys_of(unit)
                of = pa.array(rows)
                for k in range(TABLES):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), k, np.int32)), pa.array(keys[:, k]), *(batch.column(c).take(of) for c in range(3))], names=["k", "key", "id", "m", "v"])

    return map_batches(reps.select("id", "m", "v"), run, "k int, key long, id long, m long, v array<double>" if reps.schema["v"].dataType.simpleString() == "array<double>" else "k int, key long, id long, m long, v array<float>")


def _group(k: int, ids: np.ndarray, m: np.ndarray, unit: np.ndarray, side: np.ndarray, threshold: float):
    """Counts and links of one group: (id, links counted here, smallest id linked through the group)."""
    n = len(ids)
    near = unit @ unit.T >= threshold
    np.fill_diagonal(near, False)
    if side[0] >= 0:  # two blocks: pairs across them only
        near &= side[:, None] != side[None, :]
    rows = np.flatnonzero(near.any(axis=1))
    if not len(rows):
        return None
    near, ids, m = near[np.ix_(rows, rows)], ids[rows], m[rows]
    fresh = near
    if k:
        keys = keys_of(unit[rows])[:, :k]
        fresh = near.copy()
        for t in range(k):  # a pair that shares an earlier key was counted there
            fresh &= keys[:, None, t] != keys[None, :, t]
    root, n = ids.copy(), len(rows)
    while True:
        low = np.minimum(root, np.where(near, root[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (low == root).all():
            return ids, fresh @ m, root
        root = low


def _compare(groups: DataFrame, threshold: float) -> DataFrame:
    """(id, links, root) from rows (k, key, x, y, side, id, m, v) that are sorted by group within their partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in sorted_groups(batches, 4):
            c = {n: table.column(n).to_numpy() for n in ("k", "side", "id", "m")}
            vectors, out = table.column("v").chunk(0), []
            for a, b in zip(bounds, bounds[1:], strict=False):
                if b - a > 1:
                    part = vectors.slice(a, b - a)
                    if len(set(part.value_lengths().to_pylist())) == 1 and (got := _group(int(c["k"][a]), c["id"][a:b], c["m"][a:b], _unit(matrix(part)), c["side"][a:b], threshold)):
                        out.append(got)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[i] for o in out])) for i in range(3)], names=["id", "links", "root"])

    return map_batches(groups, run, "id long, links long, root long")


def near_duplicate_vectors(df: DataFrame, *, threshold: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept), one row for each row of df; id has the name of id_col."""
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))
    hashed = rows.select("id", "v", F.xxhash64(F.lit(1), "v").alias("e1"), F.xxhash64(F.lit(2), "v").alias("e2"))
    good = valid(hashed, "v").where("id IS NOT NULL")
    classes = cut(good.select("e1", "e2", "id").distinct().groupBy("e1", "e2").agg(F.min("id").alias("rep"), F.count("*").alias("m")))
    reps = cut(good.join(classes, ["e1", "e2"]).where("id = rep").select("id", "m", "v").dropDuplicates(["id"]))
    keyed = _keyed(reps)
    sizes = keyed.select("k", "key").groupBy("k", "key").agg(F.count("*").alias("n"))
    several = cut(sizes.where(F.col("n") > BLOCK).select("k", "key", F.ceil(F.col("n") / BLOCK).cast("int").alias("g")))
    dealt = keyed.join(broadcast_if_small(several, BROADCAST_KEYS), ["k", "key"], "left").withColumn("own", F.when(F.col("g").isNotNull(), F.pmod(F.xxhash64("id"), F.col("g")).cast("int")).otherwise(0))
    other = F.explode(F.when(F.col("g").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("g") - 1)))
    pairs = dealt.select("*", other.alias("o")).select("k", "key", F.least("own", "o").alias("x"), F.greatest("own", "o").alias("y"), F.when(F.col("own") == F.col("o"), -1).otherwise(0).alias("s"), "own", "id", "m", "v")
    # a vector meets its own block once, as x = y
    groups = pairs.select("k", "key", "x", "y", F.when(F.col("x") == F.col("y"), F.lit(-1)).otherwise((F.col("own") == F.col("x")).cast("int")).alias("side"), "id", "m", "v")
    spread = groups.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "k", "key", "x", "y").sortWithinPartitions("k", "key", "x", "y")
    found = cut(_compare(spread, threshold).groupBy("id", "root").agg(F.sum("links").alias("links")))
    parts = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    results = classes.join(counts, F.col("rep") == F.col("id"), "left").drop("id").join(parts, F.col("rep") == F.col("node"), "left").select("e1", "e2", (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "rep").alias("c"))
    out = hashed.select("id", "e1", "e2").join(results, ["e1", "e2"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("c", "id"))
    return out.select(F.col("id").alias(id_col), F.when(F.col("id").isNull(), F.lit(0)).otherwise(F.coalesce("links", F.lit(0))).cast("long").alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def op9_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"))


OP9_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), r AS (
  SELECT vec_id AS n, vec_id AS c FROM embeddings
  UNION
  SELECT l.b, r.c FROM r JOIN l ON l.a = r.n WHERE l.b > r.c
), c AS (SELECT n, min(c) AS c FROM r GROUP BY n), k AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, coalesce(k.n, 0)::BIGINT AS n_links, c.c AS component_id, e.vec_id = c.c AS kept
FROM embeddings e LEFT JOIN c ON c.n = e.vec_id LEFT JOIN k ON k.a = e.vec_id
"""
