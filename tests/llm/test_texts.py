import math
import random
import time
import zlib
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from conftest import NASTY
from pyspark.sql import functions as F

from foliospark.llm import language_id, line_dedup, mixing, token_counts, url_filter

SF = "/root/testdata/sf0.001"


# --- line dedup


def brute_lines(rows):
    """[(text, lines removed)] by a scan in order of id: a window seen before loses its three lines."""
    seen, out = {}, {}
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        lines = (text or "").split("\n")
        full = [(k, x.strip(" \t\r")) for k, x in enumerate(lines) if x.strip(" \t\r")]
        gone = set()
        for p in range(len(full) - 2):
            key = tuple(s for _, s in full[p : p + 3])
            if seen.setdefault(key, (i, text, p)) != (i, text, p):
                gone |= {k for k, _ in full[p : p + 3]}
        out[i, text] = (text if text is None else "\n".join(x for k, x in enumerate(lines) if k not in gone), len(gone))
    return out


def test_line_windows_equal_a_scan(spark, documents):
    rng = random.Random(6)
    texts = list(NASTY) + ["\n".join(rng.choice(["a", "b ", "\tc", "", "d\r", " "]) for _ in range(rng.randrange(1, 12))) for _ in range(150)] + ["q\nr\ns\nq\nr\ns\nt"]
    got = line_dedup.with_lines_removed(documents(texts)).select("doc_id", "text", "n_removed").collect()
    want = brute_lines(list(enumerate(texts)))
    assert len(got) == len(texts)
    for r in got:
        assert (r["text"], r["n_removed"]) == want[r["doc_id"], texts[r["doc_id"]]], r["doc_id"]


def test_lines_of_repeated_rows_null_ids_and_large_tables(spark, documents, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_DOCS", 0)
    docs = documents(["a\nb\nc\nd"] * 4, [2, 2, None, 1])
    got = sorted((r["doc_id"] or 0, r["text"]) for r in line_dedup.with_lines_removed(docs).collect())
    assert got == [(0, ""), (1, "a\nb\nc\nd"), (2, ""), (2, "")]
    assert line_dedup.remove_repeated_lines(docs).count() == 1
    assert line_dedup.remove_repeated_lines(docs).columns == docs.columns
    assert line_dedup.with_lines_removed(docs.limit(0)).count() == 0


# --- token counts


def best_segmentation(word, scores):
    top = [(0.0, 0)] + [None] * len(word)
    for j in range(1, len(word) + 1):
        options = [(top[i][0] + scores[word[i:j]], top[i][1] + 1) for i in range(j) if word[i:j] in scores]
        if word[j - 1] not in scores:
            n = len(word[j - 1].encode())
            options.append((top[j - 1][0] + token_counts.BYTE_SCORE * n, top[j - 1][1] + n))
        top[j] = max(options, key=lambda o: (o[0], -o[1]))
    return top[-1][1]


def test_token_counts_equal_a_search_for_each_word(spark, documents):
    scores = token_counts.load_scores(token_counts.default_vocabulary())
    texts = [*NASTY, "unbelievable internationalization 漢字かな ☃☃ ABCabc don't", *pd.read_parquet(f"{SF}/documents.parquet")["text"][:20]]
    got = {r["doc_id"]: (r["n_words"], r["n_tokens"]) for r in token_counts.count_tokens(documents(texts), token_counts.default_vocabulary()).collect()}
    memo = {}
    for i, t in enumerate(texts):
        words = [w.decode() for w in (t or "").encode().split()]
        for w in words:
            if w not in memo:
                memo[w] = best_segmentation("▁" + w, scores)
        assert got[i] == (len(words), sum(memo[w] for w in words)), i
    assert token_counts.count_tokens(documents(texts).limit(0), token_counts.default_vocabulary()).count() == 0


# --- URL filters


def brute_rule(host, path, rules):
    fits = [(len(h.split(".")), len(p), v == "block", v, h + p) for v, h, p in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[3:] if fits else None


URLS = [None, "", "no scheme", "http://", "://x/en/", "HTTP://WWW.Example.COM/en/a", "http://example.com", "http://example.com/en", "http://example.com/en/", "http://a.b.example.com/en/?q=/x#y", "http://net/es/1", "http://x.net/esp", "http://x.net?/es/", "http://com/", "a://b://c.com/en/", "http://example.com:80/en/", "http://ex.com/English/x", "http://..com/a", "http://x.net//es/"]


@pytest.mark.parametrize("form", ["trie", "table"])
def test_url_rules_equal_a_scan_of_all_rules(spark, form):
    rules = [*url_filter.RULES, ("block", "com", "/Eng"), ("allow", "ex.com", "/English/"), ("allow", "ex.com", "/Engl"), ("block", "ex.com", "/Engl"), ("allow", "b.example.com", "")]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)] + [(99, URLS[5], "x")], "page_id long, url string, host string")
    if form == "trie":
        got = url_filter.judge_urls(pages, rules)
    else:
        got = url_filter.judge_urls_by_table(pages, spark.createDataFrame(rules, "verdict string, host string, path string").groupBy("host", "path").agg(F.max("verdict").alias("verdict")))
    rows = got.collect()
    assert len(rows) == len(URLS) + 1
    for r in rows:
        host, path = url_filter.split_url(r["url"])
        assert (r["host"], r["path"]) == (host, path)
        want = brute_rule(host, path, rules)
        assert (r["verdict"], r["rule"]) == (want or ("allow", None)), r["url"]
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


def test_odd_urls_and_long_segments():
    trie = url_filter.UrlTrie(url_filter.RULES)
    assert trie.match("x.net", "/es/\0ends//a/b") == ("block", "net/es/")
    assert trie.match("\0site.net", "/\0ends/") is None
    began = time.time()
    for _ in range(20):
        assert trie.match("x.example.com", "/en/" + "a" * 1_000_000) == ("block", "example.com/en/")
    assert time.time() - began < 5
    assert url_filter.UrlTrie([("block", "a.b", "/x"), ("allow", "a.b", "/xyz")]).match("c.a.b", "/xyz" + "z" * 10**6) == ("allow", "a.b/xyz")


# --- mixing


def test_water_filling():
    sizes = {"a": 100, "b": 100, "c": 100, "d": 0}
    targets = mixing.water_fill(sizes, mixing.cyclic_weights(sizes), 450, 2.0)
    assert targets == pytest.approx({"a": 200, "b": 2 / 3 * 250, "c": 1 / 3 * 250, "d": 0})
    assert mixing.cyclic_weights([None, "b", "a", "Z"]) == {"Z": 5, "a": 2, "b": 1, None: 5}
    assert mixing.water_fill({"a": 10}, {"a": 1}, 100, 2.0) == {"a": 20}


def test_mix_comes_near_its_targets_and_repeats_itself(spark, documents):
    rng = random.Random(8)
    n = 3000
    texts = [None if rng.random() < 0.02 else " ".join("w" * rng.randrange(0, 60)) for _ in range(n)]
    sources = [rng.choice(["hot"] * 6 + ["a", "b", "ä", None, "z"]) for _ in range(n)]
    docs = documents(texts, sources=sources)
    mixed = mixing.mix_sources(docs).select("doc_id", "source", "size", "source_size", "target", "taken", "copies")
    rows = mixed.collect()
    assert len(rows) == n
    sizes = pd.Series({r["doc_id"]: r["size"] for r in rows})
    assert all(sizes[i] == len((t or "").split()) for i, t in enumerate(texts))
    total = {}
    for s, t in zip(sources, texts, strict=True):
        total[s] = total.get(s, 0) + len((t or "").split())
    targets = mixing.water_fill(total, mixing.cyclic_weights(total), 1.5 * sum(total.values()), 2.0)
    for s in total:
        mine = [r for r in rows if r["source"] == s]
        assert {(r["source_size"], round(r["target"], 6)) for r in mine} == {(total[s], round(targets[s], 6))}
        assert abs(sum(r["taken"] for r in mine) - targets[s]) <= 30
    assert all(r["taken"] <= 2 * r["size"] and r["taken"] == r["size"] * r["copies"] for r in rows)
    again = mixing.mix_sources(docs.repartition(7)).select(*mixed.columns).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_mix_of_empty_tables_and_repeated_rows(spark, documents):
    docs = documents(["a b c"] * 5 + [""] * 3, [1] * 5 + [2] * 3)
    assert mixing.mix_sources(docs.limit(0)).count() == 0
    rows = mixing.mix_sources(docs).collect()
    taken = sorted((r["doc_id"], r["taken"]) for r in rows)
    assert taken == [(1, 3)] * 2 + [(1, 6)] * 3 + [(2, 0)] * 3  # 24 words of a target of 22.5
    many = documents(["w " * 7] * 400 + ["a b"], [5] * 400 + [6], sources=["x"] * 400 + ["y"])
    rows = mixing.mix_sources(many).collect()
    assert len(rows) == 401
    for s in "xy":
        mine = [r for r in rows if r["source"] == s]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 7
        assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in mine)


def test_mix_query_on_the_whole_table(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    sizes = docs["text"].map(lambda t: len((t or "").encode().split()))
    totals = sizes.groupby(docs["source"]).sum().to_dict()
    targets = mixing.water_fill(totals, mixing.cyclic_weights(totals), 1.5 * sum(totals.values()), 2.0)
    rows = mixing.op10_mixing(spark, SF).collect()
    assert {r["doc_id"]: r["size"] for r in rows} == dict(zip(docs["doc_id"], sizes, strict=True))
    source, taken = dict(zip(docs["doc_id"], docs["source"], strict=True)), dict.fromkeys(totals, 0)
    for r in rows:
        s = source[r["doc_id"]]
        assert r["source_size"] == totals[s] and r["target"] == pytest.approx(targets[s])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[s] += r["taken"]
    assert all(abs(taken[s] - targets[s]) <= sizes.max() for s in totals)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.op10_mixing(spark, SF).collect()))


# --- language ID


def all_segmentations(word, ids, probs):
    if not word:
        return np.ones(len(probs))
    total = np.zeros(len(probs))
    for j in range(1, len(word) + 1):
        if word[:j] in ids:
            total += probs[:, ids[word[:j]]] * all_segmentations(word[j:], ids, probs)
        elif j == 1:
            total += language_id.UNKNOWN * all_segmentations(word[1:], ids, probs)
    return total


def exact_log(word, ids, probs):
    """The log of the sum over all segmentations, in fractions."""
    sums = [Fraction(1)]
    for j in range(1, len(word) + 1):
        total = Fraction(0)
        for i in range(j):
            if word[i:j] in ids:
                total += sums[i] * Fraction(float(probs[ids[word[i:j]]]))
            elif i == j - 1:
                total += sums[i] * Fraction(language_id.UNKNOWN)
        sums.append(total)
    return math.log(sums[-1].numerator) - math.log(sums[-1].denominator)


PIECES = ["▁", "▁a", "a", "b", "ab", "▁ab", "ba", "aba"]


def test_forward_sums_all_segmentations_and_counts_add_up():
    ids = {p: i for i, p in enumerate(PIECES)}
    probs = np.random.default_rng(1).dirichlet(np.ones(len(PIECES)), 2)
    words, trie = ["abab", "a", "xab", "bbabab"], language_id.Trie(PIECES)
    got = np.exp(language_id.log_scores(words, trie, language_id._table(probs)))
    assert got == pytest.approx(np.array([all_segmentations("▁" + w, ids, probs) for w in words]))
    counts = np.array([[1.0, 0.0]] * 4)
    total = language_id.expected_counts(words, counts, trie, probs)
    assert total[1].sum() == 0
    lengths = np.array([len(p) for p in PIECES])
    assert (total[0] * lengths).sum() == pytest.approx(sum(len(w) + 1 for w in words) - 1)  # all letters but x
    each = [language_id.expected_counts([w], counts[:1], trie, probs) for w in words]
    assert total == pytest.approx(sum(each))


def test_words_of_any_length_have_exact_sums():
    rng = random.Random(8)
    ids, trie = {p: i for i, p in enumerate(PIECES)}, language_id.Trie(PIECES)
    probs = np.array([[0.3, 0.1, 0.05, 0.2, 1e-6, 0.3, 1e-8, 0.04], [1e-7, 0.5, 0.2, 0.1, 0.1, 0.05, 0.04, 0.01]])
    words = ["x" * 40 + "aaaaa", "".join(rng.choice("abx") for _ in range(200)), "a" * 500, "ab", "x" * 300, ""]
    got = language_id.log_scores(words, trie, language_id._table(probs))
    for w, row in zip(words, got, strict=True):
        assert row == pytest.approx([exact_log("▁" + w, ids, p) for p in probs], rel=1e-9)
    assert got[0][0] != pytest.approx(got[0][1], rel=1e-3)
    counts = np.ones((len(words), 2))
    total = language_id.expected_counts(words, counts, trie, probs)
    lengths = np.array([len(p) for p in PIECES])
    letters = sum(len(w) + 1 - w.count("x") for w in words)
    assert (total * lengths).sum(axis=1) == pytest.approx([letters, letters])


def test_trie_holds_all_pieces_of_the_vocabulary():
    pieces = language_id.load_pieces(language_id.default_vocabulary())
    trie = language_id.Trie(pieces)
    lattice = language_id.Lattice(pieces, trie)
    whole = {}
    for d, (starts, piece, _) in enumerate(lattice.edges[1:], 1):
        for s, p in zip(starts[starts < lattice.n], piece[starts < lattice.n], strict=True):
            if d == len(pieces[lattice.order[s]]):
                whole[pieces[lattice.order[s]]] = pieces[p]
    assert whole == {p: p for p in pieces}


def test_letters_are_unicode_letters():
    assert language_id.words_of("½ ² ① 12_x 漢字カナ Straße ªº Ⅷ 一") == ["x", "漢字カナ", "straße", "ªº", "一"]
    assert language_id.words_of(None) == []


def test_language_query_on_the_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: (r["lang"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = language_id.op4_language_id(spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(truth)
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    known = [r for r in held if truth[r["doc_id"]][0] is not None]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]][0] for r in known]) > 0.97
    assert all((r["lang_pred"] == "und") == (not any(c.isalpha() for c in truth[r["doc_id"]][1] or "")) for r in rows)


def test_languages_of_held_out_rows_and_odd_texts(spark, documents):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("held", language_id.held_out(F.col("doc_id")))
    model = language_id.train(docs.where("NOT held"), language_id.default_vocabulary(), max_docs=150)
    rows = language_id.predict(docs.where("held").drop("lang", "source"), model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) > 100
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.97
    odd = language_id.predict(documents([*NASTY, "12 34 ! ½ ² ①", "漢" * 200]), model).orderBy("doc_id").collect()
    assert [r["lang_pred"] == "und" for r in odd[:4]] == [True] * 4 and odd[len(NASTY)]["lang_pred"] == "und"
    assert all((r["score"] == 0) == (r["lang_pred"] == "und") and 0 <= r["score"] <= 1 for r in odd)
    assert odd[len(NASTY) + 1]["lang_pred"] in model.langs and not math.isnan(odd[-1]["score"])
    none = language_id.train(documents(["a"], langs=[None]), language_id.default_vocabulary())
    assert [r["lang_pred"] for r in language_id.predict(documents(["a b"]), none).collect()] == ["und"]
    assert language_id.predict(docs.limit(0), model).count() == 0
