"""Line dedup: windows of three consecutive lines that occurred before are removed.

Lines are compared without white space at their ends; blank lines are no part of windows and always stay. Each
window of three successive lines is hashed to 128 bits. For hashes with more than one occurrence the first one is
found over the whole table, by (doc_id, text hash, place); every other occurrence marks its three lines, marks of
overlapping windows merge, and marked lines are removed.

Occurrences are counted with map-side combination and joined back to the windows, so a window that fills a third
of the table is a skewed join key that adaptive execution splits, never a group in one task. Texts meet the marks
by a broadcast while the marked documents are few (BROADCAST_DOCS), else by a shuffle join.

Defined results: null and empty texts stay as they are; a text with fewer than three non-blank lines has no
window. Rows that agree on doc_id and text are one document, stay or change together, and aren't each other's
copies; a null doc_id orders after all others. An empty table gives no rows. Extra columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliospark.llm.common import append_columns, broadcast_if_small, cut, map_batches, read_table, text_of

WINDOW = 3
#: Marked documents up to which marks are broadcast, and marks among them.
BROADCAST_DOCS = 100_000
BROADCAST_MARKS = 1_000_000


def full_lines(text: str) -> list[tuple[int, str]]:
    """(line number, stripped line) of the lines that aren't blank."""
    return [(i, s) for i, x in enumerate(text.split("\n")) if (s := x.strip(" \t\r"))]


def without(text: str, starts: list[int]) -> tuple[str, int]:
    """The text without the lines covered by windows that start at these places among its full lines; lines removed."""
    full = full_lines(text)
    gone = {full[p][0] for s in starts for p in range(s, s + WINDOW)}
    return "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone), len(gone)


def _windows(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """(g1, g2, id, t, at): each window's hash, its document (id and text hash) and its first line's place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import xxhash

        for batch in batches:
            digests, row, at = [], [], []
            for k, text in enumerate(text_of(batch, "text")):
                lines = [s.encode("utf-8", "surrogatepass") for _, s in full_lines(text or "")]
                n = len(lines) - WINDOW + 1
                if n > 0:
                    digests += [xxhash.xxh3_128_digest(b"\n".join(lines[i : i + WINDOW])) for i in range(n)]
                    row += [k] * n
                    at += range(n)
            g = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
            of = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(g[:, 0]), pa.array(g[:, 1]), batch.column(0).take(of), batch.column(1).take(of), pa.array(at, pa.int32())], names=["g1", "g2", "id", "t", "at"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("t"), F.col(text_col).alias("text"))
    return map_batches(rows, run, "g1 long, g2 long, id long, t long, at int")


def repeated_windows(docs: DataFrame, *, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, t, starts): for each document with repeats, the places where windows start that occurred before."""
    windows = cut(_windows(docs, text_col, id_col))
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "t", "at")
    firsts = windows.groupBy("g1", "g2").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").select("g1", "g2", F.col("first.id").alias("fid"), F.col("first.t").alias("ft"), F.col("first.at").alias("fat"))
    later = windows.join(firsts, ["g1", "g2"]).where(~(F.col("id").eqNullSafe(F.col("fid")) & (F.col("t") == F.col("ft")) & (F.col("at") == F.col("fat"))))
    return cut(later.groupBy("id", "t").agg(F.collect_set("at").alias("starts")))  # at most the lines of one document


def with_lines_removed(docs: DataFrame, *, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """docs with repeated lines removed from text_col, and n_removed (lines removed, long)."""
    found = repeated_windows(docs, text_col=text_col, id_col=id_col).select(F.col("id").alias("ld_id"), F.col("t").alias("ld_t"), F.col("starts").alias("ld_starts"))
    if (found.agg(F.sum(F.size("ld_starts"))).first()[0] or 0) <= BROADCAST_MARKS:
        found = broadcast_if_small(found, BROADCAST_DOCS)
    joined = docs.drop("n_removed", "ld_starts").join(found, docs[id_col].cast("long").eqNullSafe(found["ld_id"]) & (F.xxhash64(docs[text_col]) == found["ld_t"]), "left").drop("ld_id", "ld_t")

    def make():
        def compute(batch: pa.RecordBatch):
            starts = batch.column(batch.schema.get_field_index("ld_starts")).to_pylist()
            new = [without(t, s) if s else (t, 0) for t, s in zip(text_of(batch, text_col), starts, strict=True)]
            return [pa.array([x for x, _ in new], pa.string()), pa.array([n for _, n in new], pa.int64())]

        return compute

    return append_columns(joined, [T.StructField(text_col, T.StringType()), T.StructField("n_removed", T.LongType())], make).drop("ld_starts")


def remove_repeated_lines(docs: DataFrame, *, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """docs without repeated lines; documents of which nothing but blank lines is left go, as all they held is elsewhere."""
    out = with_lines_removed(docs, text_col=text_col, id_col=id_col)
    return out.where((F.col("n_removed") == 0) | F.col(text_col).rlike(r"[^ \t\r\n]")).select(*docs.columns)


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, text (what is left) and n_removed (lines removed)."""
    return with_lines_removed(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "text", "n_removed")


OP2_SQL = r"""
WITH l AS (
  SELECT doc_id, row_number() OVER () AS r, string_split(text, chr(10)) AS ls FROM documents
), u AS (
  SELECT doc_id, r, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM l
), f AS (
  SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS s FROM u
), n AS (
  SELECT doc_id, r, i, s, row_number() OVER w AS p, lead(s, 1) OVER w AS s2, lead(s, 2) OVER w AS s3
  FROM f WHERE s <> '' WINDOW w AS (PARTITION BY r ORDER BY i)
), o AS (
  SELECT *, row_number() OVER (PARTITION BY s, s2, s3 ORDER BY doc_id, p) AS k FROM n WHERE s3 IS NOT NULL
), g AS (
  SELECT DISTINCT n.r, n.i FROM o JOIN n ON n.r = o.r AND n.p BETWEEN o.p AND o.p + 2 WHERE o.k > 1
), kept AS (
  SELECT u.r, string_agg(u.line, chr(10) ORDER BY u.i) AS text FROM u ANTI JOIN g ON g.r = u.r AND g.i = u.i GROUP BY u.r
), c AS (SELECT r, count(*) AS n FROM g GROUP BY r)
SELECT l.doc_id, CASE WHEN l.ls IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text, coalesce(c.n, 0)::BIGINT AS n_removed
FROM l LEFT JOIN kept ON kept.r = l.r LEFT JOIN c ON c.r = l.r
"""
