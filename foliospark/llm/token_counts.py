"""Token counts of a unigram vocabulary by dynamic programming on a trie of distinct pre-tokens.

A text's pre-tokens are its words with the word mark before them. The distinct ones of a batch form a trie, which
is walked depth first in sorted order: a node's best score and token count come from its ancestors' by the pieces
that end there, once for all pre-tokens that share the prefix; only the path to the current node is held. Counts at
the ends of pre-tokens are stored, and texts sum them. Common pre-tokens' counts are kept between batches, at most
CACHE_WORDS.

A piece's score is a Zipf weight by its rank in the public vocabulary, log(1 / (rank + RANK_SHIFT)); tokens are
those of the best segmentation, the one with fewer tokens on a tie. A character that isn't a piece counts as one
token for each UTF-8 byte, at BYTE_SCORE each.

Defined results: a null or empty text has 0 words and 0 tokens. Repeated rows are counted alike. Whole texts are
counted, pre-tokens of any length too. Input columns named like an output are replaced.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from foliospark.llm.common import append_columns, read_table, text_of

MARK = "▁"
RANK_SHIFT = 10
BYTE_SCORE = -25.0
CACHE_WORDS = 300_000


def load_scores(model_file: str) -> dict[str, float]:
    """Scores of a public vocabulary's pieces by rank."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
    return {p: -math.log(rank + RANK_SHIFT) for rank, p in enumerate(pieces)}


def count_words(words: list[str], scores: dict[str, float], longest: int) -> dict[str, int]:
    """Token counts of distinct pre-tokens (with the mark), each shared prefix computed once."""
    out: dict[str, int] = {}
    best, tokens = [0.0], [0]  # along the path from the root to the current node
    find, before = scores.get, ""
    for word in sorted(words):
        shared = 0
        for a, b in zip(before, word, strict=False):
            if a != b:
                break
            shared += 1
        del best[shared + 1 :], tokens[shared + 1 :]
        for j in range(shared + 1, len(word) + 1):
            top, n = -math.inf, 0
            for i in range(max(0, j - longest), j):
                s = find(word[i:j])
                if s is None:
                    if i < j - 1:
                        continue
                    size = len(word[i].encode("utf-8", "surrogatepass"))
                    s, k = BYTE_SCORE * size, size
                else:
                    k = 1
                s += best[i]
                if s > top or s == top and tokens[i] + k < n:
                    top, n = s, tokens[i] + k
            best.append(top)
            tokens.append(n)
        out[word], before = tokens[len(word)], word
    return out


FIELDS = [T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType())]


def count_tokens(df: DataFrame, model_file: str, *, text_col: str = "text") -> DataFrame:
    """df with n_words and n_tokens."""
    scores = load_scores(model_file)
    shared = df.sparkSession.sparkContext.broadcast((scores, max(map(len, scores))))  # the vocabulary's size

    def make():
        table, longest = shared.value
        known: dict[bytes, int] = {}

        def compute(batch: pa.RecordBatch):
            # bytes split at ASCII white space only
            words = [(t or "").encode("utf-8", "surrogatepass").split() for t in text_of(batch, text_col)]
            new = {w for ws in words for w in ws} - known.keys()
            if len(known) + len(new) > CACHE_WORDS:
                known.clear()
                new = {w for ws in words for w in ws}
            marked = {MARK + w.decode("utf-8", "surrogatepass"): w for w in new}
            known.update((marked[w], n) for w, n in count_words(list(marked), table, longest).items())
            return [pa.array([len(ws) for ws in words], pa.int64()), pa.array([sum(map(known.__getitem__, ws)) for ws in words], pa.int64())]

        return compute

    return append_columns(df, FIELDS, make)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op6_token_counts(spark, sf_dir: str, model_file: str | None = None) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, model_file or default_vocabulary()).select("doc_id", "n_words", "n_tokens")
