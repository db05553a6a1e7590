"""Byte-level BPE encoding and decoding with recursive DuckDB queries in each partition.

A text is split by the tokenizer's pattern. Each distinct pre-token that isn't a token itself becomes rows (word,
place, token), one for each byte. A recursive query joins neighbours with the merge table (pairs of tokens whose
bytes together are a token) and contracts each word's leftmost pair of least rank, for all words at once, until no
word has a pair. In the same round it contracts the other pairs that no earlier merge can reach: a pair of rank r
goes once the leftmost-least order gets to it, unless a merge before it takes one of its tokens. Such a merge makes
a token of rank r at most that ends with the pair's left token and holds all of the token before, or one of rank
below r that begins with its right token and holds all of the token after. Whether the vocabulary has any is a
property of two neighbours, kept beside the merge table (Merges). Nor may the new token and the one beside it be in a
token of lower rank, as that could then come too early. So words of any length take few rounds. In a run of equal tokens, where such
pairs overlap, every second one goes, from the run's left end.
Decoding joins the ids with the vocabulary and concatenates the bytes by an ordered aggregation.

Encodings of pre-tokens are kept between batches, at most CACHE_WORDS and those of one slice of texts; texts are
taken in slices of about SLICE_CHARS, so that memory doesn't grow with the partition.

Defined results: a null or empty text has no ids and decodes to no bytes. Repeated rows are encoded alike. Whole
texts are encoded. The strings of special tokens are ordinary text. Input columns named like an output are
replaced. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import tempfile
from collections.abc import Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from foliospark.llm.common import append_columns, read_table, slices, text_of

CACHE_WORDS = 250_000
#: Characters of texts that are encoded at a time, and rows in one recursive query (a single text or word may have more).
SLICE_CHARS = 2_000_000
QUERY_BYTES = 1_000_000
MEMORY_LIMIT = "200MB"

#: White space as the tokenizer's pattern means it (Unicode White_Space), which excludes the separators 1C-1F.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


class Splitter:
    """Texts to pre-tokens.

    ASCII and Latin-1 texts use an equivalent of the pattern in Python's re; others use the pattern itself.
    """

    def __init__(self, pattern: str):
        import regex

        self.full = regex.compile(pattern.replace(r"\s", f"[{SPACE}]").replace(f"[^[{SPACE}]", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]"))
        letters, numbers = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾"
        space = "\\t-\\r \\x85\\xa0"
        fast = pattern.replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]").replace(rf"[^\s[{letters}][{numbers}]]", f"[^{space}{letters}{numbers}]").replace(r"\s", f"[{space}]").replace(r"\S", f"[^{space}]")
        self.fast = re.compile(fast)
        self.wide = re.compile("[^\x00-\xff]")

    def __call__(self, text: str | None) -> list[str]:
        if not text:
            return []
        return (self.full if self.wide.search(text) else self.fast).findall(text)


def read_ranks(lines: list[str]) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


class Merges:
    """What a vocabulary's pairs of tokens merge to, and which tokens bar them. Vocabularies have 65536 tokens at most.

    pair: the left token's rank * PAIR + the right one's. merges: (pair, rank of the token they make, whether that is
    part of a token of lower rank). before: (pair, that rank or NONE, least rank of the tokens that end with the pair and are longer). after: (pair, least rank of
    the tokens that begin with the pair).
    """

    def __init__(self, ranks: dict[bytes, int]):
        made, ends, begins = {}, {}, {}
        find = ranks.get
        for word, rank in ranks.items():
            n = len(word)
            for size in range(2, n + 1):
                for part, known in ((word[:size], begins), (word[n - size :], ends)):
                    if known is ends and size == n:
                        break
                    for i in range(1, size):
                        if (a := find(part[:i])) is not None and (b := find(part[i:])) is not None:
                            pair = a * PAIR + b
                            if known.get(pair, NONE) > rank:
                                known[pair] = rank
                            if size == n:
                                made[pair] = rank
        columns = lambda *x: tuple(np.fromiter(c, np.int64) for c in x)
        barred = sorted(made.keys() | ends.keys())
        late = {t for pair, rank in made.items() for t in divmod(pair, PAIR) if t > rank}
        self.merges = columns(made.keys(), made.values(), (rank in late for rank in made.values()))
        self.before = columns(barred, (made.get(p, NONE) for p in barred), (ends.get(p, NONE) for p in barred))
        self.after = columns(begins.keys(), begins.values())
        self.ranks = ranks


PAIR = 1 << 17
#: Marks a word's first token, so that it is no pair's right side.
FIRST = 1 << 16
NONE = 1 << 30

#: Rows are tokens: n (round), w (word), g (word and place), t (token). pairs: tokens that merge with the next one, with
#: those around them (p, a, b) and what they make (r). first: the word's leftmost of least rank; free: no earlier merge
#: can reach the pair; tied: the pair before it makes the same token; runs: tied pairs with the one at their left end.
_RECURSIVE = f"""
WITH RECURSIVE state(n, w, g, t) AS (
  SELECT 0, w, g, t FROM words
  UNION ALL
  (WITH around AS (
    SELECT n, w, g, t, lag(t) OVER o AS p, lead(t) OVER o AS a, lead(t, 2) OVER o AS b, lead(g) OVER o AS g2 FROM state WINDOW o AS (ORDER BY g)
  ), pairs AS (
    SELECT w, g, g2, p, around.t, a, b, m.t AS r, CASE WHEN late THEN m.t END AS late FROM around JOIN merges m ON m.ab = (around.t % {FIRST})::BIGINT * {PAIR} + a
  ), least AS (
    SELECT w, (min(r::BIGINT * {1 << 31} + g) % {1 << 31})::INT AS g FROM pairs GROUP BY w
  ), judged AS (
    SELECT pairs.g, g2, pairs.r, least.g IS NOT NULL AS first, coalesce(x.r = pairs.r, false) AS tied,
      coalesce(x.r >= pairs.r AND x.longer > pairs.r, true) AND coalesce(y.least >= pairs.r, true)
        AND coalesce(u.r > late AND u.longer > late, true) AND coalesce(v.least > late, true) AS free
    FROM pairs LEFT JOIN before x ON x.ab = (p % {FIRST})::BIGINT * {PAIR} + pairs.t
      LEFT JOIN after y ON y.ab = a::BIGINT * {PAIR} + b
      LEFT JOIN before u ON u.ab = (p % {FIRST})::BIGINT * {PAIR} + late + pairs.t // {FIRST} * {FIRST}
      LEFT JOIN after v ON v.ab = late::BIGINT * {PAIR} + b LEFT JOIN least ON least.g = pairs.g
  ), near AS (
    SELECT g FROM judged WHERE tied UNION SELECT j.g FROM judged j JOIN judged k ON k.tied AND k.g = j.g2
  ), runs AS (
    SELECT g, g2, r, free, tied, max(CASE WHEN NOT tied THEN g::BIGINT * 2 + free::INT END) OVER (ORDER BY g ROWS UNBOUNDED PRECEDING) AS head,
      row_number() OVER (ORDER BY g) AS i FROM judged SEMI JOIN near USING (g)
  ), chosen AS (
    SELECT g, g2, r FROM judged WHERE NOT tied AND (free OR first)
    UNION ALL
    SELECT g, g2, r FROM (SELECT *, i - min(i) OVER (PARTITION BY head) AS place FROM runs) WHERE tied AND free AND head % 2 = 1 AND place % 2 = 0
  ), marks AS (
    SELECT g, r FROM chosen UNION ALL SELECT g2, -1 FROM chosen
  )
  SELECT s.n + 1, w, s.g, CASE WHEN c.r IS NULL THEN s.t ELSE c.r + s.t // {FIRST} * {FIRST} END
  FROM state s SEMI JOIN least USING (w) LEFT JOIN marks c ON c.g = s.g WHERE c.r IS NULL OR c.r >= 0)
), ends AS (SELECT w, max(n) AS n FROM state GROUP BY w)
SELECT w, t % {FIRST} AS t FROM state JOIN ends USING (w, n) ORDER BY g
"""

_DECODE = "SELECT d, string_agg(hex, '' ORDER BY p) AS h FROM tokens JOIN vocabulary USING (id) GROUP BY d"


class Codec:
    """Encodes pre-tokens and decodes ids with one in-memory DuckDB connection of one thread."""

    def __init__(self, merges: Merges, pattern: str):
        import duckdb

        ranks = merges.ranks
        self.split = Splitter(pattern)
        spill = os.path.join(tempfile.gettempdir(), f"foliospark-bpe-{os.getpid()}")  # scratch of this process, removed by DuckDB
        self.con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": MEMORY_LIMIT, "temp_directory": spill})
        self.con.execute("SET preserve_insertion_order = false")
        small = lambda x: x.astype(np.int32)
        self._table("merges", ab=merges.merges[0], t=small(merges.merges[1]), late=merges.merges[2] > 0)
        self._table("before", ab=merges.before[0], r=small(merges.before[1]), longer=small(merges.before[2]))
        self._table("after", ab=merges.after[0], least=small(merges.after[1]))
        self._table("vocabulary", id=np.fromiter(ranks.values(), np.int64), hex=[x.hex() for x in ranks])
        self.single = ranks
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.names = pa.array([str(i) for i in range(max(ranks.values()) + 1)])
        self.known: dict[str, int] = {}
        self.starts, self.sizes, self.met, self.flat, self.used = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(1 << 16, np.int32), 0

    def close(self) -> None:
        """Frees the connection's memory, and what is known."""
        self.con.close()
        self.known = {}

    def _table(self, name: str, **columns) -> None:
        self.con.register("source", pa.table(columns))
        self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM source")
        self.con.unregister("source")

    def _forget(self, most: int) -> None:
        """Forgets pre-tokens that weren't met again since they were learned or kept here, and all if many are left.

        known: places of pre-tokens in starts and sizes, which say where in flat their ids are; met: met again.
        """
        keep = np.flatnonzero(self.met) if self.met.sum() * 2 <= most else np.zeros(0, np.int64)
        words = list(self.known)  # in the order of their places
        self.known = {words[k]: i for i, k in enumerate(keep.tolist())}
        sizes, old = self.sizes[keep], self.starts[keep]
        self.starts = np.cumsum(sizes) - sizes
        ids = self.flat[np.repeat(old - self.starts, sizes) + np.arange(sizes.sum())]
        self.sizes, self.met, self.used = sizes, np.zeros(len(keep), bool), len(ids)
        self.flat = np.concatenate([ids, np.zeros(max(1 << 16, len(ids)), np.int32)])

    def _contract(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The words' ids, one after the other, and how many each has."""
        ids, counts, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        while at < len(words):
            size, end = 0, at
            while end < len(words) and (end == at or size + len(words[end]) <= QUERY_BYTES):
                size += len(words[end])
                end += 1
            sizes = np.array([len(w) for w in words[at:end]])
            flat = np.frombuffer(b"".join(words[at:end]), np.uint8)
            t = self.bytes[flat]
            t[np.cumsum(sizes) - sizes] += FIRST
            self.con.register("words", pa.table({"w": np.repeat(np.arange(end - at, dtype=np.int32), sizes), "g": np.arange(len(flat), dtype=np.int32), "t": t}))
            got = self.con.sql(_RECURSIVE).to_arrow_table()
            self.con.unregister("words")
            ids.append(got["t"].to_numpy())
            counts.append(np.bincount(got["w"].to_numpy(), minlength=end - at))
            at = end
        return np.concatenate(ids), np.concatenate(counts)

    def _learn(self, words: list[str]) -> None:
        """Adds the encodings of the pre-tokens, none of them known, to what is known."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        single = [self.single.get(x) for x in raw]
        sizes = np.ones(len(words), np.int64)
        many = np.array([k for k, s in enumerate(single) if s is None], np.int64)
        ids, sizes[many] = self._contract([raw[k] for k in many])
        starts = np.cumsum(sizes) - sizes
        while self.used + sizes.sum() > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        new = self.flat[self.used : self.used + int(sizes.sum())]
        of = np.repeat(np.array([s is None for s in single], bool), sizes)
        new[of] = ids
        new[~of] = [s for s in single if s is not None]
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words)), strict=True))
        self.starts, self.sizes, self.met = np.concatenate([self.starts, starts + self.used]), np.concatenate([self.sizes, sizes]), np.concatenate([self.met, np.zeros(len(words), bool)])
        self.used += len(new)

    def encode(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The texts' ids, one after the other, and how many each has."""
        split = [self.split(t) for t in texts]
        flat = list(chain.from_iterable(split))
        if len(self.known) > CACHE_WORDS:
            self._forget(CACHE_WORDS)
        before = len(self.known)
        if new := {w for w in flat if w not in self.known}:
            self._learn(list(new))
        at = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        self.met[at[at < before]] = True
        sizes = self.sizes[at]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.flat[np.repeat(self.starts[at] - ends[:-1], sizes) + np.arange(ends[-1])]
        bounds = ends[np.cumsum([0, *map(len, split)])]
        return ids, np.diff(bounds)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The bytes of each list of ids in hex."""
        self.con.register("tokens", pa.table({"d": np.repeat(np.arange(len(counts), dtype=np.int64), counts), "p": np.arange(len(ids), dtype=np.int64), "id": ids.astype(np.int64)}))
        got = self.con.sql(_DECODE).to_arrow_table()
        self.con.unregister("tokens")
        out = [""] * len(counts)
        for d, h in zip(got["d"].to_pylist(), got["h"].to_pylist(), strict=True):
            out[d] = h
        return out


def _lists(ids: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(ids, pa.int32()))


def load_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Ranks from a file that the driver's machine has, or that Spark can read."""
    try:
        with open(path) as f:
            return read_ranks(f.readlines())
    except FileNotFoundError:
        return read_ranks([r[0] for r in spark.read.text(path).collect()])  # a vocabulary


def _codec_maker(spark: SparkSession, ranks_file: str, pattern: str):
    """A function that makes a task's codec; the merge tables are broadcast, a vocabulary's size."""
    ranks = load_ranks(spark, ranks_file)
    if max(ranks.values(), default=0) >= FIRST:
        raise ValueError("vocabularies beyond 65536 tokens don't fit the merge tables' keys")
    shared = spark.sparkContext.broadcast(Merges(ranks))
    return lambda: Codec(shared.value, pattern)


def encode(df: DataFrame, ranks_file: str, pattern: str, *, text_col: str = "text", with_ids: bool = True, hashes: bool = False) -> DataFrame:
    """df with ids (array of int) and n_tokens; with hashes ids_sha256 and decoded_sha256 (of the decoded bytes), too."""
    new_codec = _codec_maker(df.sparkSession, ranks_file, pattern)

    def make():
        codec = new_codec()

        def part(texts: list[str | None]) -> list[pa.Array]:
            ids, counts = codec.encode(texts)
            out = [_lists(ids, counts)] if with_ids else []
            out.append(pa.array(counts, pa.int64()))
            if hashes:
                names = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), codec.names.take(pa.array(ids)))
                out.append(pa.array([hashlib.sha256(x.encode()).hexdigest() for x in pc.binary_join(names, ",").to_pylist()]))
                out.append(pa.array([hashlib.sha256(bytes.fromhex(h)).hexdigest() for h in codec.decode(ids, counts)]))
            return out

        def compute(batch: pa.RecordBatch):
            texts = text_of(batch, text_col)
            parts = [part(texts[s]) for s in slices([len(t or "") for t in texts], SLICE_CHARS)] or [part([])]
            return [pa.concat_arrays(column) for column in zip(*parts, strict=True)]

        compute.close = codec.close
        return compute

    fields = [("ids", T.ArrayType(T.IntegerType()))] * with_ids + [("n_tokens", T.LongType())] + [("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())] * hashes
    return append_columns(df, [T.StructField(n, t) for n, t in fields], make)


def decode(df: DataFrame, ranks_file: str, pattern: str, *, ids_col: str = "ids") -> DataFrame:
    """df with decoded (binary): the bytes of ids (null: none)."""
    new_codec = _codec_maker(df.sparkSession, ranks_file, pattern)

    def make():
        codec = new_codec()

        def compute(batch: pa.RecordBatch):
            lists = [np.array(x or [], np.int64) for x in text_of(batch, ids_col)]
            out = []
            for s in slices([len(x) for x in lists], SLICE_CHARS):
                some = lists[s]
                out += [bytes.fromhex(h) for h in codec.decode(np.concatenate(some), np.array([len(x) for x in some]))]
            return [pa.array(out, pa.binary())]

        compute.close = codec.close
        return compute

    return append_columns(df, [T.StructField("decoded", T.BinaryType())], make)


def default_ranks() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op3_bpe(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, *default_ranks(), with_ids=False, hashes=True).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
