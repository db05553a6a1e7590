import hashlib
import random
import time

import pandas as pd
import public_tokenizers
import tiktoken
from conftest import NASTY

from foliospark.llm import bpe


def reference():
    with open(bpe.default_ranks()[0]) as f:
        ranks = bpe.read_ranks(f.readlines())
    return ranks, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


random.seed(3)
POOL = "abcXYZ  \n\t'sdtl1209.,;!?=-_éßñÄ²½ªº \u0085\u001c\u001d 　漢字かなЖд١٢́\U0001f600"
TEXTS = [
    *NASTY,
    "<|endoftext|> isn't special, it's text'll",
    "a" * 3000,
    "abab" * 700,
    "=" * 2000 + " " * 999 + "x",
    "漢字" * 400,
    "".join(random.choice("acgt") for _ in range(1500)),
    *("".join(random.choice(POOL) for _ in range(random.randrange(1, 80))) for _ in range(600)),
]


def test_ids_equal_the_library_and_decode_back(spark, documents):
    _, enc = reference()
    rows = bpe.decode(bpe.encode(documents(TEXTS), *bpe.default_ranks()), *bpe.default_ranks()).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        text = TEXTS[r["doc_id"]] or ""
        assert list(r["ids"]) == enc.encode_ordinary(text), repr(text[:80])
        assert bytes(r["decoded"]) == text.encode()


def test_leftmost_contraction_of_long_words_when_ranks_are_not_in_order():
    ranks = {bytes([i]): i for i in range(256)} | {b"xa": 256, b"xab": 257, b"ab": 258}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = bpe.Codec(bpe.Merges(ranks), public_tokenizers.PATTERN)
    for text in ("xabab" * 60, "abxab" * 50, "ababab", "xab"):
        ids, counts = codec.encode([text])
        assert ids.tolist() == enc.encode_ordinary(text)
        assert counts.tolist() == [len(ids)]


def test_random_vocabularies_and_words_of_any_length():
    rng = random.Random(9)
    for _ in range(25):
        ranks = {bytes([i]): i for i in range(256)}
        words = list({"".join(rng.choice("abc") for _ in range(rng.randrange(2, 7))) for _ in range(rng.randrange(1, 60))})
        rng.shuffle(words)
        ranks |= {w.encode(): 256 + i for i, w in enumerate(words)}  # in no order of length, not all can be reached
        enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        codec = bpe.Codec(bpe.Merges(ranks), public_tokenizers.PATTERN)
        texts = ["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 400))) for _ in range(40)] + ["a" * 37, "ab" * 33, "aab" * 21]
        ids, counts = codec.encode(texts)
        assert ids.tolist() == [t for x in texts for t in enc.encode_ordinary(x)]
        assert counts.tolist() == [len(enc.encode_ordinary(x)) for x in texts]


def test_long_runs_take_seconds_and_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 50)
    ranks, enc = reference()
    codec = bpe.Codec(bpe.Merges(ranks), public_tokenizers.PATTERN)
    rng = random.Random(4)
    runs = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(16_000)), "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(330_000))]
    began = time.time()
    ids, _ = codec.encode(runs)
    assert time.time() - began < 120
    assert ids.tolist() == [t for x in runs for t in enc.encode_ordinary(x)]
    for at in range(0, len(TEXTS), 30):
        some = [t or "" for t in TEXTS[at : at + 30]]
        ids, counts = codec.encode(some)
        assert ids.tolist() == [t for x in some for t in enc.encode_ordinary(x)]
        assert len(codec.known) == len(codec.sizes) == len(codec.met)


def test_query_on_the_whole_table(spark):
    _, enc = reference()
    sf = "/root/testdata/sf0.001"
    texts = pd.read_parquet(f"{sf}/documents.parquet").set_index("doc_id")["text"]
    rows = bpe.op3_bpe(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = enc.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_empty_table(spark, documents):
    assert bpe.encode(documents(TEXTS).limit(0), *bpe.default_ranks(), hashes=True).count() == 0
