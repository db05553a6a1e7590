import numpy as np
from pyspark.sql import functions as F

from foliospark.llm import embedding_dedup, nearest

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in zip(ids, vectors, strict=True)]
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS k", "'x' AS v", "2 AS key", "5 AS m")


def clustered(rng, n, dims=16):
    centres = rng.standard_normal((n // 8 + 1, dims))
    out = [centres[rng.integers(len(centres))] + rng.standard_normal(dims) * rng.choice([0.02, 0.2, 0.4]) for _ in range(n)]
    return [np.float32(x) for x in out] + [np.float32(out[0])] * 5 + [np.float32(out[1]) * 2]


ODD = [None, [], [0.0] * 16, [float("nan")] * 16, [None] * 16, [float("inf")] * 16, [1.0] * 3, [1.0] * 3]


def test_links_and_components_equal_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(4)
    vectors = clustered(rng, 400)
    # a hot group that needs blocks
    monkeypatch.setattr(embedding_dedup, "BLOCK", 40)
    vectors += [np.float32(vectors[2] + rng.standard_normal(16) * 0.01) for _ in range(150)]
    all_ = [*vectors, *ODD]
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicate_vectors(table(spark, all_)).collect()}
    assert len(got) == len(all_)
    x = np.array([np.float64(v) for v in vectors])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    found, want = sum(got[i]["n_links"] for i in range(len(vectors))), near.sum()
    assert 0.995 * want <= found <= want
    assert all(got[i]["n_links"] <= near[i].sum() for i in range(len(vectors)))
    root = np.arange(len(vectors))
    while True:
        low = np.minimum(root, np.where(near, root[None, :], 10**9).min(axis=1))
        if (low == root).all():
            break
        root = low
    assert np.mean([got[i]["component_id"] == root[i] for i in range(len(vectors))]) > 0.99
    assert all(got[i]["kept"] == (got[i]["component_id"] == i) for i in got)
    odd = [(got[len(vectors) + i]["n_links"], got[len(vectors) + i]["component_id"] - len(vectors)) for i in range(len(ODD))]
    assert odd == [(0, 0), (0, 1), (0, 2), (0, 3), (0, 4), (0, 5), (1, 6), (1, 6)]


def test_repeated_rows_null_ids_and_empty_tables(spark):
    df = table(spark, [[1, 0], [1, 0], [1, 0], [1, 0.1], [1, 0]], [3, 3, 5, 8, None])
    got = sorted(((-1 if r["vec_id"] is None else r["vec_id"]), r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_duplicate_vectors(df).collect())
    assert got == [(-1, 0, None, True), (3, 2, 3, True), (3, 2, 3, True), (5, 2, 3, False), (8, 2, 3, False)]
    assert embedding_dedup.near_duplicate_vectors(df.limit(0)).count() == 0


def brute_nearest(ids, x, queries, k):
    out = {}
    for q in queries:
        d = np.sqrt(np.cumsum((x - x[ids.index(q)]) ** 2, axis=1)[:, -1])
        out[q] = sorted((float(v), i) for v, i in zip(d, ids, strict=True) if i != q)[:k]
    return out


def test_recall_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(nearest, "CHUNK", 700)
    monkeypatch.setattr(nearest, "BLOCK", 16)
    rng = np.random.default_rng(9)
    vectors = [np.float32(v) for v in rng.standard_normal((2000, 64))] + clustered(rng, 500, 64)
    df = table(spark, [*vectors, *ODD])
    got = nearest.nearest(df, df.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect()
    want = brute_nearest(list(range(len(vectors))), np.array([np.float64(v) for v in vectors]), range(0, len(vectors), 100), 10)
    hits = 0
    for q, best in want.items():
        mine = [(r["score"], r["vec_id"]) for r in got if r["query_id"] == q]
        assert [r["rank"] for r in got if r["query_id"] == q] == list(range(1, 11))
        assert mine == sorted(mine)
        hits += len(set(mine) & set(best))
    assert hits >= 0.97 * 10 * len(want)


def test_few_candidates_ties_and_empty_tables(spark):
    df = table(spark, [[1, 0], [2, 0], [0, 1], [2, 0], [2, 0], None, [1, 2, 3]], [0, 7, 5, 6, 6, 8, 9])
    got = [(r["rank"], r["vec_id"]) for r in nearest.nearest(df, df.where("vec_id = 0")).orderBy("rank").collect()]
    assert got == [(1, 6), (2, 7), (3, 5)]
    assert nearest.nearest(df, df.where("vec_id = 8")).count() == 0
    assert nearest.nearest(df.limit(0), df.limit(0)).count() == 0
    assert nearest.nearest(df, df.where(F.col("vec_id").isNull())).count() == 0
