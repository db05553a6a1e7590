import random

import pandas as pd
from conftest import NASTY

from foliospark.llm import components, minhash


def shingles(text, n):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if len(words) >= n else frozenset([tuple(words)])


def brute(rows, n, percent=80):
    """{id: (set size, component)} by all pairs."""
    sets = {i: shingles(t, n) for i, t in rows}
    ids, root = sorted(sets), {i: i for i in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, i in enumerate(ids):
        for j in ids[a + 1 :]:
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                a_, b_ = sorted((find(i), find(j)))
                root[b_] = a_
    return {i: (len(sets[i]), find(i)) for i in ids}


def check(got, rows, n):
    want = brute(rows, n)
    assert len(got) == len(rows)
    for r in got:
        size, component = want[r["doc_id"]]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (size, component, component == r["doc_id"]), r


def edited(words, changes, rng):
    out = list(words)
    for _ in range(changes):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10**9)}"
    return " ".join(out)


def test_near_copies_chains_and_odd_texts(spark, documents):
    rng = random.Random(5)
    base = [[f"v{rng.randrange(4000)}" for _ in range(rng.randrange(40, 200))] for _ in range(25)]
    texts = list(NASTY)
    for b in base:
        texts += [edited(b, rng.randrange(0, 8), rng) for _ in range(rng.randrange(1, 6))]
    chain = base[0][:]
    for _ in range(12):  # each is near the one before it, the ends are far apart
        for _ in range(4):
            chain[rng.randrange(len(chain))] = f"c{rng.randrange(10**9)}"
        texts.append(" ".join(chain))
    hot = base[1]
    texts += [edited(hot, 2, rng) for _ in range(60)] + [" ".join(hot)] * 30
    passage = " ".join(base[2][:40])
    texts += [passage + " " + " ".join(f"u{rng.randrange(10**9)}" for _ in range(30)) for _ in range(40)]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    got = minhash.near_duplicates(documents(texts, ids), words=4).collect()
    check(got, list(zip(ids, texts, strict=True)), 4)


def test_query_on_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = pd.read_parquet(f"{sf}/documents.parquet")
    check(minhash.op5_minhash(spark, sf).collect(), list(zip(docs["doc_id"], docs["text"], strict=True)), 4)


def test_only_outsiders_visit_other_blocks(spark):
    rows = spark.range(10_001).selectExpr("id", "0 AS k", "7L AS v", "1L AS mask", "0L AS label", "id = 10000 AS out", "10L AS n", "21 AS g")
    dealt = minhash.dealt_into_blocks(rows)
    assert dealt.count() == 10_000 + 21
    assert dealt.groupBy("x").count().agg({"count": "max"}).head()[0] < 600
    every = dealt.where("id = 10000").select("x").distinct().count()
    assert every == 21


def test_null_ids_and_repeated_rows_and_empty_tables(spark, documents):
    docs = documents(["one two three four five", "one two three four five", "one two three four five", None], [None, 4, 4, 9])
    got = sorted((r["doc_id"] or -1, r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs, words=4).collect())
    assert got == [(-1, None, True), (4, 4, True), (4, 4, True), (9, 9, True)]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0
    assert minhash.keep_one(docs).count() == 4


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        lo, hi = sorted((find(a), find(b)))
        root[hi] = lo
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if any(x in p and p[0] != p[1] for p in pairs)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
