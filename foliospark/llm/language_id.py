"""Language ID by segmentation-marginalised unigrams.

The text's letter runs (Unicode letters), lower-cased and with the word mark before them, are cut into pieces of a
fixed public vocabulary in every possible way. A language's probability of a word is the sum over all segmentations
of the product of its piece probabilities, found by the forward algorithm; a text's log-probability is the sum over
its words. Piece probabilities are learned from labelled rows by expectation steps (forward-backward) on word counts,
the first from equal probabilities. Every letter is a segment of its own with a small probability when it isn't in
the vocabulary. Words of any length are summed whole: sums are kept in proportion to a scale for each word and
language, so that none is too small for a float.

Learning takes all labelled rows (max_docs=None, as the pipeline does), or at most about max_docs of each language,
chosen by a hash of doc_id; limits of fit (least_fits) come from all of them, and prediction takes every row and whole
texts. The model is languages x pieces floats; MODEL_BYTES bounds what is broadcast.

Defined results: a text that is null or has no letter gets `und` and score 0. score is the language's share of the
probability with equal priors; ties go to the language first in code point order. Repeated rows are scored alike.
Without any labelled row each text gets `und` and score 0. Input columns named like an output are replaced. An empty
table gives no rows.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import chain, groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliospark.llm.common import append_columns, cut, map_batches, read_table, slices, text_of

MARK = "▁"
MAX_DOCS = 1500
MODEL_BYTES = 128 << 20
CACHE_WORDS = 200_000
#: Characters of texts that are judged at a time, and letters whose segmentations are (one text or word may have more).
SLICE_CHARS = 1_000_000
LATTICE_LETTERS = 100_000
#: Letters after which sums are scaled again.
RESCALE = 8
SMOOTHING = 0.5
UNKNOWN = 1e-9
#: How well labelled texts fit their language: of those, the share that is left out, and what a text may lack to the
#: rest, in nats for each character and for the whole text.
FIT_SHARE = 0.01
FIT_MARGIN = 1.0
FIT_SLACK = 40.0
#: Bins for one nat in which least_fits counts, from round to round; so few numbers in each, however many rows there are.
FIT_BINS = (1e2, 1e5, 1e8, 1e11)


def load_pieces(model_file: str) -> list[str]:
    """Pieces of a public vocabulary that can stand in a lower-cased letter run."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)))
    kept = {p for p in pieces if p == p.lower() and p.removeprefix(MARK).isalpha() and MARK not in p[1:]}
    return sorted(kept | {MARK})


@cache
def _letter_runs() -> re.Pattern:
    """Runs of Unicode letters."""
    letters = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isalpha()]
    runs = [[c for _, c in g] for _, g in groupby(enumerate(letters), lambda x: ord(x[1]) - x[0])]
    return re.compile("[" + "".join(f"{r[0]}-{r[-1]}" for r in runs) + "]+")


#: Latin-1 as bytes, with spaces for all that aren't letters.
_LATIN_LETTERS = bytes(c if chr(c).isalpha() else 32 for c in range(256))


def _runs(text: str | None) -> list[bytes] | list[str]:
    """Lower-cased letter runs of the whole text; in Latin-1 if the text can be, which is faster."""
    low = (text or "").lower()
    try:
        return low.encode("latin-1").translate(_LATIN_LETTERS).split()
    except UnicodeEncodeError:
        return _letter_runs().findall(low)


def _word(run: bytes | str) -> str:
    return run.decode("latin-1") if isinstance(run, bytes) else run


def words_of(text: str | None) -> list[str]:
    """Lower-cased letter runs of the whole text."""
    return [_word(r) for r in _runs(text)]


class Trie:
    """Pieces in a double array: letter c leads from node x to y = base[x] + code of c, if owner[y] is x. piece[y] is the
    number of the piece that ends there, or -1. Letters that no piece has get code 0, which leads nowhere."""

    def __init__(self, pieces: list[str]):
        self.n, self.longest = len(pieces), max(map(len, pieces), default=1)
        letters = [c for c, _ in Counter("".join(pieces)).most_common()]
        self.codes = np.zeros(max(map(ord, letters), default=0) + 2, np.int32)  # the last one is for letters beyond
        self.codes[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        root: dict = {}
        for k, p in enumerate(pieces):
            node = root
            for c in p:
                node = node.setdefault(int(self.codes[ord(c)]), {})
            node[0] = k
        base, owner, piece, used = {0: 0}, {}, {}, bytearray(1 << 16)
        used[0] = first = 1
        nodes = [(0, root)]
        for at, kids in nodes:  # grows while it is read
            codes = sorted(c for c in kids if c)
            piece[at] = kids.get(0, -1)
            if not codes:
                continue
            free = first = used.find(0, first)
            while free < codes[0] or any(used[free - codes[0] + c] for c in codes):
                free = used.find(0, free + 1)
                if free + len(letters) + 2 > len(used):
                    used += bytes(len(used))
            base[at] = free - codes[0]
            for c in codes:
                y = base[at] + c
                used[y], owner[y] = 1, at
                nodes.append((y, kids[c]))
            if first + len(letters) + 2 > len(used):
                used += bytes(len(used))
        size = max(piece) + len(letters) + 2
        self.base, self.owner, self.piece = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        for array, found in ((self.base, base), (self.owner, owner), (self.piece, piece)):
            array[list(found)] = list(found.values())


class Lattice:
    """All pieces that stand in words. Words go from long to short, and letters by position: first that of each word,
    then the second of each that has one. edges[d]: (start, piece) of the pieces of d letters, by start; the piece after
    the last one stands for a letter that isn't a piece."""

    def __init__(self, words: list[str], trie: Trie):
        sizes = np.array([len(w) for w in words])
        self.order = np.argsort(-sizes, kind="stable")
        sizes = sizes[self.order]
        self.n, self.longest, self.depth = len(words), int(sizes[0]), trie.longest
        #: How many words have more letters than so many, and where the letters at a position begin.
        self.more = np.searchsorted(-sizes, -np.arange(self.longest + 1)).tolist()
        begins = np.concatenate([[0], np.cumsum(self.more)])
        self.begins = begins.tolist()
        place = np.repeat(np.arange(self.longest), self.more[:-1])
        word = np.arange(len(place)) - begins[place]
        points = np.frombuffer("".join(words[k] for k in self.order).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = trie.codes[np.minimum(points, len(trie.codes) - 1)][(np.cumsum(sizes) - sizes)[word] + place]
        at, node = np.arange(len(place)), np.zeros(len(place), np.int32)
        self.edges: list[tuple] = [()]
        for d in range(1, trie.longest + 1):
            inside = place[at] + d <= sizes[word[at]]
            at, node = at[inside], node[inside]
            to = trie.base[node] + codes[begins[place[at] + d - 1] + word[at]]
            there = trie.owner[to] == node
            if d == 1:
                piece = np.where(there, trie.piece[to], -1)
                starts, piece = at, np.where(piece < 0, trie.n, piece)
            at, node = at[there], to[there]
            if d > 1:
                piece = trie.piece[node]
                starts, piece = at[piece >= 0], piece[piece >= 0]
            self.edges.append((starts, piece, np.searchsorted(starts, begins).tolist()))
            if not len(at):
                break

    def _at(self, i: int, d: int) -> tuple | None:
        """(words, pieces) of the pieces of d letters from position i."""
        starts, piece, bounds = self.edges[d]
        a, b = bounds[i], bounds[i + 1]
        return (starts[a:b] - self.begins[i], piece[a:b]) if a < b else None

    def forward(self, table: np.ndarray, kept: list | None = None) -> np.ndarray:
        """log-probabilities of the words (by order), summed over segmentations, by the pieces' probabilities in table.

        kept gets, for each position, the sums up to it and their scales (logs)."""
        shape = (self.n, table.shape[1])
        out, scale, recent = np.empty(shape), np.zeros(shape), {0: np.ones(shape)}
        if kept is not None:
            kept.append((recent[0], scale))
        for j in range(1, self.longest + 1):
            n, left = self.more[j - 1], self.more[j]
            total = np.zeros((n, shape[1]))
            for d in range(1, min(j, len(self.edges) - 1) + 1):
                if found := self._at(j - d, d):
                    total[found[0]] += recent[j - d][found[0]] * table[found[1]]
            recent[j] = total
            recent.pop(j - self.depth, None)
            if kept is not None:
                kept.append((total, scale))
            out[left:n] = np.log(total[left:]) + scale[left:n]
            if j % RESCALE == 0 and left:
                recent, scale = _scaled(recent, scale, left)
        return out

    def backward(self, table: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each position the sums over segmentations of what follows it, and their scales (logs)."""
        shape = (self.n, table.shape[1])
        scale, recent, out = np.zeros(shape), {}, []
        for i in range(self.longest, -1, -1):
            n = self.more[i]
            total = np.ones((self.more[i - 1] if i else self.n, shape[1]))
            total[:n] = 0
            for d in range(1, min(self.longest - i, len(self.edges) - 1) + 1):
                if found := self._at(i, d):
                    total[found[0]] += recent[i + d][found[0]] * table[found[1]]
            recent[i] = total
            recent.pop(i + self.depth, None)
            out.append((total, scale))
            if i % RESCALE == 0 and n:
                recent, scale = _scaled(recent, scale, n)
        return out[::-1]


def _scaled(recent: dict[int, np.ndarray], scale: np.ndarray, n: int) -> tuple[dict[int, np.ndarray], np.ndarray]:
    """The sums of the first n words over their largest, and the scales that make up for it."""
    top = np.zeros((n, scale.shape[1]))
    for x in recent.values():
        np.maximum(top[: len(x)], x[:n], out=top[: len(x)])
    scale = scale.copy()
    scale[:n] += np.log(top)
    new = {}
    for i, x in recent.items():
        new[i] = x.copy()
        new[i][:n] /= top[: len(x)]
    return new, scale


def _table(probs: np.ndarray) -> np.ndarray:
    """Probabilities by piece and language, with those of other letters at the end."""
    return np.vstack([probs.T.astype(np.float64), np.full((1, probs.shape[0]), UNKNOWN)])


def log_scores(words: list[str], trie: Trie, table: np.ndarray) -> np.ndarray:
    """log P(word | language) as words x languages; words without the mark."""
    out = np.zeros((len(words), table.shape[1]))
    for s in slices([len(w) + 1 for w in words], LATTICE_LETTERS):
        lattice = Lattice([MARK + w for w in words[s]], trie)
        out[s.start + lattice.order] = lattice.forward(table)
    return out


def expected_counts(words: list[str], counts: np.ndarray, trie: Trie, probs: np.ndarray) -> np.ndarray:
    """Expected piece counts (languages x pieces) of words with counts (words x languages), by forward-backward."""
    table = _table(probs)
    logs = np.log(table)
    total = np.zeros((probs.shape[0], trie.n + 1))
    for s in slices([len(w) + 1 for w in words], LATTICE_LETTERS):
        lattice = Lattice([MARK + w for w in words[s]], trie)
        before: list = []
        all_ = lattice.forward(table, before)
        after, n = lattice.backward(table), counts[s.start + lattice.order]
        with np.errstate(divide="ignore"):
            before, after = ([np.log(x) + scale[: len(x)] for x, scale in side] for side in (before, after))
        for i in range(lattice.longest):
            for d in range(1, min(lattice.longest - i, len(lattice.edges) - 1) + 1):
                if found := lattice._at(i, d):
                    w, piece = found
                    share = np.exp(before[i][w] + after[i + d][w] + logs[piece] - all_[w]) * n[w]
                    for lang in range(len(total)):
                        total[lang] += np.bincount(piece, weights=share[:, lang], minlength=trie.n + 1)
    return total[:, :-1]


class LanguageModel:
    def __init__(self, langs: list[str], pieces: list[str] | Trie, probs: np.ndarray):
        self.langs, self.trie, self.probs = langs, pieces if isinstance(pieces, Trie) else Trie(pieces), probs.astype(np.float32)
        if self.probs.nbytes > MODEL_BYTES:
            raise ValueError("the model is beyond MODEL_BYTES; use fewer languages or pieces")


def _word_counts(rows: DataFrame) -> DataFrame:
    """(lang, word, n) of rows (lang, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, Counter] = {}
            for lang, text in zip(text_of(batch, "lang"), text_of(batch, "text"), strict=True):
                seen.setdefault(lang, Counter()).update(words_of(text))
            flat = [(g, w, n) for g, c in seen.items() for w, n in c.items()]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in flat], t) for k, t in ((0, pa.string()), (1, pa.string()), (2, pa.int64()))], names=["lang", "word", "n"])

    return map_batches(rows, count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _labelled(labelled: DataFrame, text_col: str, lang_col: str, id_col: str) -> DataFrame:
    """(id, lang, text) of the labelled rows."""
    return labelled.where(F.col(lang_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))


def _learned(rows: DataFrame, max_docs: int | None) -> tuple[list[str], DataFrame]:
    """The languages of (id, lang, text), and (lang, text) of all rows or about max_docs of each."""
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row for each language
    if not sizes or max_docs is None:
        return sorted(sizes), rows.select("lang", "text")
    share = F.create_map(*[F.lit(x) for g in sorted(sizes) for x in (g, min(1.0, max_docs / sizes[g]))])
    unit = F.shiftrightunsigned(F.xxhash64(F.lit(11), "id"), 11) / F.lit(float(1 << 53))
    return sorted(sizes), rows.where(unit < share[F.col("lang")]).select("lang", "text")


def train(labelled: DataFrame, vocabulary: str, *, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", max_docs: int | None = MAX_DOCS, steps: int = 2) -> LanguageModel:
    """A model from the labelled rows (lang not null), all of them without max_docs; vocabulary: file of a public piece
    vocabulary."""
    spark = labelled.sparkSession
    langs, rows = _learned(_labelled(labelled, text_col, lang_col, id_col), max_docs)
    pieces = load_pieces(vocabulary)
    probs = np.full((max(1, len(langs)), len(pieces)), 1.0 / len(pieces))
    if not langs:
        return LanguageModel([], pieces, probs)
    trie = LanguageModel(langs, pieces, probs).trie  # checks the size
    words = cut(_word_counts(rows))
    wide = words.groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"))  # an entry for each language
    index = {g: k for k, g in enumerate(langs)}
    for _ in range(steps):
        shared = spark.sparkContext.broadcast((trie, probs))

        def expect(frames: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            trie, probs = shared.value
            for frame in frames:
                counts = np.zeros((len(frame), len(langs)))
                for k, by in enumerate(frame["by"]):
                    for g, n in dict(by).items():
                        counts[k, index[g]] = n
                total = expected_counts(list(frame["word"]), counts, trie, probs)
                lang, piece = np.nonzero(total)
                yield pd.DataFrame({"lang": lang, "piece": piece, "n": total[lang, piece]})

        got = wide.mapInPandas(expect, "lang int, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect()  # at most languages x pieces
        total = np.full_like(probs, SMOOTHING)
        for r in got:
            total[r["lang"], r["piece"]] += r["n"]
        probs = total / total.sum(axis=1, keepdims=True)
        shared.unpersist()
    return LanguageModel(langs, trie, probs)


FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
FIT_FIELDS = [T.StructField("lang_fit", T.DoubleType()), T.StructField("lang_chars", T.LongType())]


class Scorer:
    """Predictions for texts; word scores are kept between slices of them, about CACHE_WORDS and those of one slice."""

    def __init__(self, model: LanguageModel):
        self.model, self.probs = model, _table(model.probs)
        self._forget()

    def _forget(self) -> None:
        self.at: dict[bytes | str, int] = {}
        self.table = np.zeros((1 << 12, len(self.model.langs) + 1))  # the last column has the word's characters with its mark

    def _learn(self, runs: list) -> None:
        words = [_word(r) for r in runs]
        begin = len(self.at)
        while begin + len(words) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[begin : begin + len(words), :-1] = log_scores(words, self.model.trie, self.probs)
        self.table[begin : begin + len(words), -1] = [len(w) + 1 for w in words]
        self.at.update(zip(runs, range(begin, begin + len(words)), strict=True))

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        return self.judge(texts)[:2]

    def judge(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float | None], list[int]]:
        """Language, score, log-probability in it a character (null for und), and characters with word marks."""
        out: tuple[list, ...] = ([], [], [], [])
        for s in slices([len(t or "") for t in texts], SLICE_CHARS):
            for whole, part in zip(out, self._judge(texts[s]), strict=True):
                whole += part
        return out

    def _judge(self, texts: list[str | None]) -> tuple[list, ...]:
        langs = self.model.langs
        words = [_runs(t) for t in texts]
        out, score, fit, chars = ["und"] * len(texts), [0.0] * len(texts), [None] * len(texts), [0] * len(texts)
        full = [k for k, w in enumerate(words) if w]
        if not full or not langs:
            return out, score, fit, chars
        flat = list(chain.from_iterable(words))
        if len(self.at) > CACHE_WORDS:
            self._forget()
        if new := {w for w in flat if w not in self.at}:
            self._learn(list(new))
        starts = np.cumsum([0, *(len(words[k]) for k in full[:-1])])
        total = np.add.reduceat(self.table[np.fromiter(map(self.at.__getitem__, flat), np.int64, len(flat))], starts, axis=0)
        total, size = total[:, :-1], total[:, -1]
        most = total.max(axis=1, keepdims=True)
        p = np.exp(total - most)
        p /= p.sum(axis=1, keepdims=True)
        for k, n in zip(full, size, strict=True):
            chars[k] = int(n)
        for k, best, row, m in zip(full, p.argmax(axis=1), p, most[:, 0], strict=True):
            out[k], score[k], fit[k] = langs[best], float(row[best]), float(m) / chars[k]
        return out, score, fit, chars


def predict(df: DataFrame, model: LanguageModel, *, text_col: str = "text", with_fit: bool = False) -> DataFrame:
    """df with lang_pred and score, and with_fit lang_fit and lang_chars (see Scorer.judge)."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = Scorer(shared.value)

        def compute(batch: pa.RecordBatch):
            langs, scores, fits, chars = scorer.judge(text_of(batch, text_col))
            out = [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            return [*out, pa.array(fits, pa.float64()), pa.array(chars, pa.int64())] if with_fit else out

        return compute

    return append_columns(df, FIELDS + FIT_FIELDS if with_fit else FIELDS, make)


def least_fits(labelled: DataFrame, model: LanguageModel, *, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> dict[str, float]:
    """The lang_fit of a language that a long text of it reaches: what its labelled rows reach, less FIT_MARGIN."""
    judged = predict(_labelled(labelled, text_col, lang_col, id_col), model, with_fit=True)
    own = cut(judged.where("lang_pred = lang AND lang_fit IS NOT NULL").select("lang", "lang_fit"))
    return {g: least - FIT_MARGIN for g, least in _lowest(own, FIT_SHARE).items()}


def _lowest(rows: DataFrame, share: float) -> dict[str, float]:
    """By lang the lang_fit that a share of its rows is below, of rank floor(share * (n - 1)) from 0.

    Rows are counted in bins, then those of the bin with that rank in finer ones, and at last by value; so all rows
    count, but only numbers of a few thousand bins for each language come to the driver."""
    rank: dict[str, int] = {}
    found: dict[str, float] = {}
    for scale in (*FIT_BINS, None):
        key = F.col("lang_fit") if scale is None else F.floor(F.col("lang_fit") * F.lit(scale))
        bins: dict[str, list[tuple]] = {}
        for r in rows.groupBy("lang", key.alias("bin")).agg(F.count("*").alias("n")).collect():
            bins.setdefault(r["lang"], []).append((r["bin"], r["n"]))
        for g, counts in bins.items():
            rank.setdefault(g, int(share * (sum(n for _, n in counts) - 1)))
            for found[g], n in sorted(counts):
                if rank[g] < n:
                    break
                rank[g] -= n
        if found and scale is not None:
            rows = rows.where(key == F.create_map(*[F.lit(x) for kv in sorted(found.items()) for x in kv])[F.col("lang")])
    return found


def fits(least: dict[str, float]) -> F.Column:
    """Whether a row of predict with_fit fits its language; short texts need less, languages without a limit nothing."""
    if not least:
        return F.lit(True)
    limit = F.create_map(*[F.lit(x) for kv in sorted(least.items()) for x in kv])[F.col("lang_pred")]
    return F.coalesce((F.col("lang_fit") - limit) * F.col("lang_chars") >= -FIT_SLACK, F.lit(True))


def held_out(id_col) -> F.Column:
    """Whether crc32 of the id as text leaves no remainder by 5 (null id: no)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op4_language_id(spark, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", held_out(F.col("doc_id")))
    model = train(docs.where(~F.col("held_out") & F.col("doc_id").isNotNull()), vocabulary or default_vocabulary())
    return predict(docs.select("doc_id", "text", "held_out"), model).select("doc_id", "held_out", "lang_pred", "score")
