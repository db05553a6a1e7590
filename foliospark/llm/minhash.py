"""MinHash near-dedup by a signature-coordinate inverted join.

1. Each text becomes the set of its distinct word shingles (64-bit hashes) and a signature of minima: COORDINATES
   that are posted, and more that are only counted, ALL in total. Texts with the same words are one class, named by
   its smallest doc_id; only one member goes on.
2. Each class is posted under its (coordinate, value) pairs. Pairs with one posting can't collide and go; a class
   left with fewer than MATCHES pairs has no partner and goes. The rest are ordered from rare to frequent, and a
   class with m of them keeps the first m - MATCHES + 1: two classes that collide in MATCHES coordinates share one
   of these. This prefix keeps frequent values out of the join.
3. In each posting list every class is compared with the list's smallest one. Collisions are counted over all
   coordinates; pairs with ALL_MATCHES or more are confirmed on full shingle sets. Confirmed links give components.
4. Members of a list that are then in another component than its smallest one, outsiders, are compared with the
   members of other components inside the list, each pair in the first list that holds both. A long list is dealt
   into blocks; outsiders visit all of them, the others stay in one. First only an outsider's NEAREST members by collisions are confirmed, which finds a group's centre. Then
   all pairs at the match threshold that are still in different components are confirmed in the list itself, to
   which full sets are sent; only links leave it. So each candidate pair is either tested or already in one
   component, and neither a group of copies nor a group that is almost near makes rows for all its pairs.

A pair of similarity 0.8 is missed with a probability of about 2e-5 (26 of 48 coordinates, and 82 of 128).

Defined results: a null text, or one without words, has an empty set, is linked with nothing and stays. A row
without an id stays and has no component. Rows that repeat an id with the same text are one document, and share
their result. An empty table gives no rows. Extra columns are ignored by near_duplicates and kept by keep_one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import broadcast_if_small, cut, map_batches, packed, read_table, release, sorted_groups, text_of
from foliospark.llm.components import components

COORDINATES, MATCHES = 48, 26
ALL, ALL_MATCHES = 128, 82
SHORT = 4 * COORDINATES + 2 * (ALL - COORDINATES)
#: Rows of a posting list that stay in one group; longer lists are dealt into blocks, which outsiders visit.
BLOCK = 500
NEAREST = 2
#: Rows with signatures or sets in a partition.
ROWS = 10_000
CACHE_WORDS = 100_000
#: Ids up to which the documents to compare are picked by a broadcast (8 bytes each); beyond that by a shuffle join.
BROADCAST_IDS = 250_000

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


class Shingler:
    """Texts to sorted arrays of distinct 64-bit shingle hashes."""

    def __init__(self, words: int):
        self.n, self.hashes = words, _WordHashes()
        self.factors = _mix(np.arange(1, words + 1, dtype=np.uint64) * _GOLDEN) | np.uint64(1)

    @staticmethod
    def words(text: str | None) -> list[bytes]:
        return (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII white space

    def of_words(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.zeros(0, np.uint64)
        w = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
        n = min(self.n, len(w))
        total = np.full(len(w) - n + 1, n, np.uint64) * _GOLDEN
        for k in range(n):
            total += w[k : len(w) - n + 1 + k] * self.factors[k]
        return np.unique(_mix(total))


def _signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Minima of non-empty sets: those that are posted (sets x COORDINATES), and their short form in bytes (see _unpack)."""
    k = np.arange(1, ALL + 1, dtype=np.uint64)
    a, b = _mix(k * _GOLDEN) | np.uint64(1), _mix(k + _GOLDEN)
    flat, starts = np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])
    out, short = np.empty((len(sets), COORDINATES), np.int64), np.empty((len(sets), SHORT), np.uint8)
    posted, counted = short[:, : 4 * COORDINATES], short[:, 4 * COORDINATES :]
    for i in range(ALL):
        x = flat * a[i] + b[i]
        least = np.minimum.reduceat(x ^ (x >> np.uint64(32)), starts)
        if i < COORDINATES:
            out[:, i] = least.view(np.int64)
            posted[:, 4 * i : 4 * i + 4] = _mix(least).astype("<u4")[:, None].view(np.uint8)
        else:
            at = 2 * (i - COORDINATES)
            counted[:, at : at + 2] = _mix(least).astype("<u2")[:, None].view(np.uint8)
    return out, short


def _unpack(short: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """32 bits of each minimum that is posted, and 16 bits of each that is only counted."""
    rows = np.frombuffer(b"".join(short), np.uint8).reshape(-1, SHORT)
    return np.ascontiguousarray(rows[:, : 4 * COORDINATES]).view("<u4"), np.ascontiguousarray(rows[:, 4 * COORDINATES :]).view("<u2")


def _signed(docs: DataFrame, words: int) -> DataFrame:
    """(id, n, h1, h2, sig, short) of (id, text): set size, 128-bit hash of the words, signatures (null: no words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        shingler = Shingler(words)
        for batch in batches:
            lists = [shingler.words(t) for t in text_of(batch, "text")]
            sets = [shingler.of_words(w) for w in lists]
            full = [i for i, s in enumerate(sets) if len(s)]
            sig: list = [None] * len(sets)
            short: list = [None] * len(sets)
            if full:
                for i, row, bits in zip(full, *_signatures([sets[i] for i in full]), strict=True):
                    sig[i], short[i] = row, bits.tobytes()
            names = [np.frombuffer(xxhash.xxh3_128_digest(b" ".join(w)), dtype=np.int64) for w in lists]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([int(h[0]) for h in names], pa.int64()), pa.array([int(h[1]) for h in names], pa.int64()), pa.array(sig, pa.list_(pa.int64())), pa.array(short, pa.binary())],
                names=["id", "n", "h1", "h2", "sig", "short"],
            )

    return map_batches(docs.select("id", "text"), run, "id long, n long, h1 long, h2 long, sig array<long>, short binary")


def _prefix(reps: DataFrame) -> DataFrame:
    """(k, v, id, mask): the rare postings of the classes that can have a partner; mask has a class's coordinates as bits."""
    posts = reps.select("id", F.posexplode("sig").alias("k", "v"))
    shared = posts.groupBy("k", "v").agg(F.count("*").alias("df")).where("df > 1")
    lists = posts.join(shared, ["k", "v"]).groupBy("id").agg(F.sort_array(F.collect_list(F.struct("df", "k", "v"))).alias("p"))  # COORDINATES entries at most
    kept = lists.where(F.size("p") >= MATCHES).select("id", F.slice("p", 1, F.size("p") - (MATCHES - 1)).alias("p"))
    mask = F.aggregate("p", F.lit(0).cast("long"), lambda m, x: m + F.pow(F.lit(2.0), x["k"]).cast("long"))
    return kept.select("id", mask.alias("mask"), F.explode("p").alias("x")).select("x.k", "x.v", "id", "mask")


def _sizes_fit(a, b, percent: int):
    return (100 * a >= percent * b) & (100 * b >= percent * a)


def _collide(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose signatures collide in ALL_MATCHES coordinates or more."""

    @F.pandas_udf("boolean")
    def match(x: pd.Series, y: pd.Series) -> pd.Series:
        (p, q), (r, s) = _unpack(list(x)), _unpack(list(y))
        return pd.Series((p == r).sum(axis=1) + (q == s).sum(axis=1) >= ALL_MATCHES)

    side = lambda c: reps.select(F.col("id").alias(c), F.col("short").alias(f"s{c}"), F.col("n").alias(f"n{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(_sizes_fit(F.col("na"), F.col("nb"), percent)).where(match("sa", "sb")).select("a", "b")


def _outsiders(posts: DataFrame, first: DataFrame, found: DataFrame, reps: DataFrame) -> DataFrame:
    """(k, v, g, id, mask, label, out, n, short): members of the posting lists that have outsiders; g: blocks of the list."""
    labelled = posts.join(found.select(F.col("node").alias("id"), "component"), "id", "left").select("k", "v", "id", "mask", F.coalesce("component", "id").alias("label"))
    heads = first.where("size > 2").join(found.select(F.col("node").alias("least"), "component"), "least", "left").select("k", "v", "least", "size", F.coalesce("component", "least").alias("head"))
    members = labelled.join(heads, ["k", "v"]).where("id <> least").select("k", "v", F.ceil(F.col("size") / BLOCK).cast("int").alias("g"), "id", "mask", "label", (F.col("label") != F.col("head")).alias("out"))
    lists = packed(cut(members.where("out").select("k", "v").distinct()))
    return members.join(lists, ["k", "v"], "left_semi").join(reps.select("id", "n", "short"), "id")


def dealt_into_blocks(rows: DataFrame) -> DataFrame:
    """rows (id, g blocks, out, ...) with own, the block of their list that they are in, once for each block x that they visit."""
    own = F.pmod(F.xxhash64("id"), F.col("g")).cast("int")
    visits = F.when(F.col("out"), F.sequence(F.lit(0), F.col("g") - 1)).otherwise(F.array("own"))
    return rows.withColumn("own", own).select("*", F.explode(visits).alias("x"))


def _across(rows: DataFrame, percent: int, want: str) -> DataFrame:
    """Pairs of the lists' members in different components, one of them an outsider, that collide often enough.

    want: "nearest", (a, b) of each outsider's NEAREST; "members", (k, v, id) of the rows that are in pairs; "links",
    (a, b) of pairs confirmed on the rows' shingles, but for those that join what links of the list have joined.
    """
    dealt = dealt_into_blocks(rows)
    full = ["shingles"] if want == "links" else []
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["k", "v", "x"]
    spread = dealt.select(*keys, "own", "id", "mask", "label", "out", "n", "short", *full).repartition(parts, *keys).sortWithinPartitions(*keys)
    bit = np.int64(1) << np.arange(COORDINATES, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in sorted_groups(batches, len(keys)):
            c = {f: table.column(f).to_numpy(zero_copy_only=False) for f in ("k", "x", "own", "id", "mask", "label", "out", "n")}
            posted, counted = _unpack(table.column("short").to_pylist())
            sets = table.column("shingles") if full else None
            pairs: set[tuple[int, ...]] = set()
            for s, e in zip(bounds, bounds[1:], strict=False):
                k, ids, labels, out, n, mask = c["k"][s], *(c[f][s:e] for f in ("id", "label", "out", "n", "mask"))
                at_home = c["own"][s:e] == c["x"][s]
                root: dict[int, int] = {}

                def find(x: int, root=root) -> int:
                    while (up := root.get(x, x)) != x:
                        x = up
                    return x

                read: dict[int, np.ndarray] = {}

                def shingles(j: int, s=s, read=read) -> np.ndarray:
                    if j not in read:
                        read[j] = np.frombuffer(sets[int(s + j)].as_py(), np.uint64)
                    return read[j]

                for i in np.flatnonzero(out):
                    some = at_home & (labels != labels[i]) & _sizes_fit(n, n[i], percent)
                    if want != "nearest":  # else both look for their nearest
                        some &= ~out | (ids > ids[i])
                    at = np.flatnonzero(some)
                    if not len(at):
                        continue
                    same = posted[s:e][at] == posted[s + i]
                    hits = same.sum(axis=1) + (counted[s:e][at] == counted[s + i]).sum(axis=1)
                    # the first list that holds both: the first coordinate that is in both prefixes with one value
                    shared = same & ((mask[at] & mask[i])[:, None] & bit != 0)
                    good = (hits >= ALL_MATCHES) & (shared.argmax(axis=1) == k)
                    at, hits = at[good], hits[good]
                    if want == "members":
                        v = table.column("v")[int(s)].as_py()
                        pairs.update((int(k), v, j) for j in ids[[*at, i]].tolist() if len(at))
                        continue
                    for j in at[np.argsort(-hits, kind="stable")][: NEAREST if want == "nearest" else None]:
                        if full:
                            a, b = find(labels[i]), find(labels[j])
                            if a == b or not _similar(shingles(i), shingles(j), percent):
                                continue
                            root[max(a, b)] = min(a, b)
                        pairs.add((min(ids[i], ids[j]), max(ids[i], ids[j])))
            if pairs:
                flat = np.array(sorted(pairs), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(flat[:, i]) for i in range(len(names))], names=names)

    names = ["k", "v", "id"] if want == "members" else ["a", "b"]
    return map_batches(spread, run, ", ".join(f"{c} long" for c in names)).distinct()


def _sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """(id, shingles): the full sets of the documents with these ids, as bytes of sorted 64-bit hashes."""
    found = docs.select("id", "text").join(broadcast_if_small(cut(ids.distinct()), BROADCAST_IDS), "id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            sets = [shingler.of_words(shingler.words(t)).tobytes() for t in text_of(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["id", "shingles"])

    return map_batches(found, run, "id long, shingles binary").dropDuplicates(["id"])


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, for sorted arrays of distinct hashes, none of them empty."""
    both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirm(docs: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= percent * union."""

    @F.pandas_udf("boolean")
    def similar(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([_similar(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64), percent) for p, q in zip(x, y, strict=True)], dtype=bool)

    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    sets = packed(cut(_sets(docs, ids, words)), ROWS)
    found = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
    return cut(found.where(similar("x", "y")).select("a", "b").distinct())


def near_duplicates(docs: DataFrame, *, words: int = 5, percent: int = 80, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, n_shingles, component_id, kept), one row for each row of docs; id has the name of id_col."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = cut(_signed(rows, words))
    classes = cut(signed.where("n > 0 AND id IS NOT NULL").groupBy("h1", "h2").agg(F.min("id").alias("rep")))
    whole = cut(signed.join(classes, ["h1", "h2"]).where("id = rep").select("id", "n", "sig", "short").dropDuplicates(["id"]))
    keys = cut(signed.select("id", "n", "h1", "h2"))
    del signed
    release(spark)
    posts = cut(_prefix(whole))
    reps = cut(whole.join(posts.select("id").distinct(), "id", "left_semi").select("id", "n", "short"))  # those that can have a partner
    del whole
    release(spark)
    first = packed(cut(posts.groupBy("k", "v").agg(F.min("id").alias("least"), F.count("*").alias("size")).where("size > 1")))
    stars = posts.join(first, ["k", "v"]).where("id <> least").select(F.col("least").alias("a"), F.col("id").alias("b")).distinct()
    links = packed(_confirm(rows, packed(cut(_collide(stars, reps, percent))), words, percent))
    found = packed(cut(components(links)))
    release(spark)
    near = packed(_confirm(rows, packed(cut(_across(_outsiders(posts, first, found, reps), percent, "nearest"))), words, percent))
    if not near.isEmpty():
        links = packed(cut(links.unionByName(near)))
        found = packed(cut(components(links)))
    release(spark)
    left = packed(cut(_outsiders(posts, first, found, reps)), ROWS)
    needed = packed(cut(_across(left, percent, "members")))
    some = left.join(needed.withColumn("k", F.col("k").cast("int")), ["k", "v", "id"], "left_semi")
    last = packed(cut(_across(some.join(_sets(rows, needed.select("id"), words), "id"), percent, "links")))
    del left, some
    if not last.isEmpty():
        found = packed(cut(components(links.unionByName(last))))
    release(spark)
    names = classes.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left").select("h1", "h2", F.coalesce("component", "rep").alias("c"))
    out = keys.join(names, ["h1", "h2"], "left")
    component = F.when(F.col("id").isNotNull(), F.when(F.col("n") > 0, F.col("c")).otherwise(F.col("id")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, *, words: int = 5, percent: int = 80, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """docs without the near duplicates of a kept document: of each component the smallest id stays."""
    judged = near_duplicates(docs, words=words, percent=percent, text_col=text_col, id_col=id_col)
    gone = broadcast_if_small(cut(judged.where("NOT kept").select(F.col(id_col)).distinct()), BROADCAST_IDS)
    return docs.join(gone, id_col, "left_anti").select(*docs.columns)


def op5_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), words=4, percent=80)


OP5_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), h AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * p.n >= 80 * (x.n + y.n - p.n)
), l AS (SELECT a, b FROM h UNION ALL SELECT b, a FROM h
), r AS (
  SELECT doc_id AS n, doc_id AS c FROM documents
  UNION
  SELECT l.b, r.c FROM r JOIN l ON l.a = r.n WHERE l.b > r.c
), c AS (SELECT n, min(c) AS c FROM r GROUP BY n)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.c AS component_id, d.doc_id = c.c AS kept
FROM documents d JOIN c ON c.n = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
