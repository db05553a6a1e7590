"""Registered queries of this subpackage against their SQL in DuckDB."""

import random

import duckdb
import pytest

from foliospark.llm import queries

SF = "/root/testdata/sf0.001"


def equal(spark, name, folder):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder if t == 'documents' else SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, folder)
    names = sorted(got.columns)
    plain = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    rows = sorted(tuple(plain(r[c]) for c in names) for r in got.collect())
    cursor = con.execute(queries.ORACLES[name])
    found = [d[0] for d in cursor.description]
    assert sorted(found) == names
    want = sorted(tuple(plain(dict(zip(found, r, strict=True))[c]) for c in names) for r in cursor.fetchall())
    assert rows == want
    return rows


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    assert equal(spark, name, SF)


def test_secret_scans_equal_sql_on_many_kinds_of_spans(spark, tmp_path):
    rng = random.Random(12)
    mixed = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    key = lambda n, a=mixed: "".join(rng.choice(a) for _ in range(n))
    parts = [
        lambda: key(rng.randrange(15, 60)), lambda: "AKIA" + key(rng.randrange(12, 20), "ABCDEFGHIJ0123456789"), lambda: key(rng.randrange(10, 50), "0123456789abcdef"), lambda: f"password = {key(rng.randrange(8, 30))}",
        lambda: f"Api_Key:'{key(20)}'", lambda: "the quick brown fox", lambda: "é" * 3, lambda: key(24) + "example" + key(30), lambda: key(40, "abcdefghijklmnopqrstuvwxyz"), lambda: key(40, "0123456789"), lambda: key(30, "ab-/"),
        lambda: "abcdefghijklmnopqrst" + key(25), lambda: "0123abcd-0123-4567-89ab-0123456789ab", lambda: key(22, "0123456789-"), lambda: "aaaaaaaaaaaaaaaaaaaaaaaaa", lambda: f"/{key(21)}/{key(16, '0123456789abcdef')}/{key(25)}",
    ]
    texts = [None, ""] + ["".join(rng.choice(parts)() + rng.choice(["", " ", "\n", ", ", "/", "="]) for _ in range(rng.randrange(1, 12))) for _ in range(150)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "d"))
    (file,) = (tmp_path / "d").glob("part-*.parquet")
    file.rename(tmp_path / "documents.parquet")
    rows = equal(spark, "op1_secret_scans", str(tmp_path))
    assert sum("entropy" in r[-1] for r in rows) > 30
