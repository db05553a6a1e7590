import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from test_minhash import brute
from test_texts import brute_lines

import corpus_pipeline
from foliospark.llm import bpe, language_id, mixing


def test_each_stage_on_its_own_input(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    before = pd.read_parquet(f"{sf}/documents.parquet")
    columns = list(before.columns)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(k))
        before.astype({"doc_id": "int64"}).to_parquet(f"{path}.in.parquet")
        out = stage(spark, spark.read.parquet(f"{path}.in.parquet"), sf)
        if name != "bpe":
            assert out.columns == columns
        after = out.toPandas()
        assert len(after), name
        by_id = before.set_index("doc_id")["text"]
        if name == "language_id":
            kept = set(after["doc_id"])
            assert all((i in kept) == any(c.isalpha() for c in t) for i, t in by_id.items())
        elif name == "line_dedup":
            want = {i: text for (i, _), (text, n) in brute_lines(list(by_id.items())).items() if not n or text.strip()}
            assert dict(zip(after["doc_id"], after["text"], strict=True)) == want
        elif name == "minhash":
            assert set(after["doc_id"]) == {i for i, (_, c) in brute(list(by_id.items()), 5).items() if c == i}
        elif name == "mixing":
            sizes = before.assign(n=before["text"].map(lambda t: len(t.encode().split()))).groupby("source")["n"].sum().to_dict()
            targets = mixing.water_fill(sizes, mixing.cyclic_weights(sizes), 1.5 * sum(sizes.values()), 2.0)
            taken = after.assign(n=after["text"].map(lambda t: len(t.encode().split()))).groupby("source")["n"].sum()
            largest = before["text"].map(lambda t: len(t.encode().split())).max()
            assert all(abs(taken.get(s, 0) - targets[s]) <= largest for s in sizes)
            assert after.groupby("doc_id").size().max() <= 2
        else:
            with open(bpe.default_ranks()[0]) as f:
                enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(f.readlines()), special_tokens={})
            assert len(after) == len(before)
            texts = before.drop_duplicates("doc_id").set_index("doc_id")["text"]
            for r in after.itertuples():
                assert list(r.ids) == enc.encode_ordinary(texts[r.doc_id])
                assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
        before = after
    assert corpus_pipeline.ORACLE_SQL is None


def test_language_stage_rejects_other_languages_and_letter_junk(spark):
    sf = "/root/testdata/sf0.001"
    letters = "abcdefghijklmnopqrstuvwxyz"
    junk = " ".join("".join(letters[(i * i * 7 + j * 11 + i * j * 5) % 26] for j in range(3 + i % 7)) for i in range(60))
    texts = {
        1: "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
        2: "Все люди рождаются свободными и равными в своем достоинстве и правах.",
        3: "人人生而自由 在尊严和权利上一律平等",
        4: junk,
        5: "x" * 300,
        6: "1234 !!",
        7: "That it.",
        8: "Von.",
        9: "All human beings are born free and equal in dignity and rights. They are endowed with reason and conscience.",
        10: "Alle Menschen sind frei und gleich an Würde und Rechten geboren. Sie sind mit Vernunft und Gewissen begabt.",
    }
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.keep_known_languages(spark, docs, sf)
    assert sorted(r["doc_id"] for r in out.collect()) == [7, 8, 9, 10]


def _count(spark, df, path):
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_run_gives_the_last_stage_s_rows(spark):
    sf = "/root/testdata/sf0.001"
    got = corpus_pipeline.run(spark, sf)
    assert got.columns == ["doc_id", "lang", "source", "ids", "n_tokens", "decoded_sha256"]
    texts = {r["doc_id"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = got.collect()
    assert rows and {r["doc_id"] for r in rows} <= texts
    assert all(len(r["ids"]) == r["n_tokens"] for r in rows)


def test_stages_take_empty_null_and_clashing_input(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    rows = [(None, None, None, None, None), (1, "", None, "s", 0), (2, "All human beings are born free and equal in dignity and rights.", "en", None, 9), (2, "All human beings are born free and equal in dignity and rights.", "en", None, 9)]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    odd = spark.createDataFrame(rows, columns).selectExpr("*", "1 AS size", "'x' AS id", "2 AS k", "9 AS n", "'t' AS t", "3 AS copies", "1.5D AS score")
    for docs in (odd.limit(0), odd):
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, sf)
            if name != "bpe":
                assert out.columns == docs.columns, name
            docs = _count(spark, out, str(tmp_path / f"{k}"))
        left = docs.count()
    assert left >= 1


def _full_collections(spark):
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    return sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())


def test_stages_begin_on_collected_heaps(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        before = _full_collections(spark)
        stage(spark, docs, "/root/testdata/sf0.001")
        assert _full_collections(spark) > before, name


def test_language_stage_learns_and_sets_limits_from_all_labelled_rows(spark, tmp_path, monkeypatch):
    words = {"en": "all human beings are born free and equal in dignity and rights".split(), "fr": "tous les êtres humains naissent libres et égaux en dignité et en droits".split()}
    draw = random.Random(3)
    rows = [(i, lang, " ".join(draw.choices(words[lang], k=draw.randint(3, 9)))) for i in range(4000) for lang in ["fr" if i % 5 == 1 else "en"]]
    frame = pd.DataFrame(rows, columns=["doc_id", "lang", "text"])
    frame.to_parquet(tmp_path / "documents.parquet")
    seen, own = [], language_id.least_fits
    monkeypatch.setattr(language_id, "least_fits", lambda labelled, model: seen.extend([model, own(labelled, model)]) or seen[1])
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.keep_known_languages(spark, docs, str(tmp_path)).count() > 3900
    model, least = seen
    labelled = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    assert min(Counter(r[1] for r in labelled).values()) > 100 and max(Counter(r[1] for r in labelled).values()) > language_id.MAX_DOCS
    count = Counter((lang, w) for _, lang, text in labelled for w in text.split())
    known = sorted({w for _, w in count})
    counts = np.array([[count[lang, w] for lang in ("en", "fr")] for w in known], float)
    probs = np.full_like(model.probs, 1 / model.trie.n, dtype=float)
    for _ in range(2):
        total = language_id.SMOOTHING + language_id.expected_counts(known, counts, model.trie, probs)
        probs = total / total.sum(axis=1, keepdims=True)
    assert model.langs == ["en", "fr"] and np.allclose(model.probs, probs, rtol=1e-5)
    langs, _, fits, _ = language_id.Scorer(model).judge([r[2] for r in labelled])
    for lang in ("en", "fr"):
        reached = sorted(f for (_, g, _), h, f in zip(labelled, langs, fits, strict=True) if g == h == lang)
        assert abs(least[lang] - (reached[int(0.01 * (len(reached) - 1))] - language_id.FIT_MARGIN)) < 1e-9


def test_lowest_is_exact_among_equal_and_close_values(spark):
    draw = random.Random(5)
    values = {"a": [-2.5] * 700 + [-2.5 - k * 1e-13 for k in range(300)], "b": [draw.gauss(-3, 0.4) for _ in range(2001)], "c": [-1.0], "d": [-7.25, -0.125]}
    rows = spark.createDataFrame([(g, v) for g, x in values.items() for v in x], "lang string, lang_fit double")
    for share in (0.0, 0.01, 0.31, 1.0):
        assert language_id._lowest(rows, share) == {g: sorted(x)[int(share * (len(x) - 1))] for g, x in values.items()}
    assert language_id._lowest(rows.limit(0), 0.01) == {}
