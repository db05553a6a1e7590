"""Paper metadata: search, lookup, category streams and feed entries over a metadata table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.functions.text import clean_arxiv_id


def search(papers: DataFrame, query: str, max_results: int = 10) -> DataFrame:
    """Papers by relevance: words of the query in the title count three, in the abstract one; ties by id."""
    score = F.lit(0)
    for word in query.lower().split():
        score = score + F.lower("title").contains(word).cast("int") * 3 + F.coalesce(F.lower("abstract").contains(word), F.lit(False)).cast("int")
    return papers.withColumn("score", score).where("score > 0").orderBy(F.desc("score"), "arxiv_id").limit(max_results)


def rows_by_id(papers: DataFrame, arxiv_id: str) -> DataFrame:
    """All rows with the paper's id, none if there are none. The id may have a version or be part of a URL."""
    return papers.where(F.col("arxiv_id") == clean_arxiv_id(F.lit(arxiv_id)))


def fetch_by_id(papers: DataFrame, arxiv_id: str):
    """The paper's row, any of them if several have its id (rows_by_id gives all); ValueError if there is none."""
    found = rows_by_id(papers, arxiv_id).head()
    if found is None:
        raise ValueError(f"no paper {arxiv_id}")
    return found


def fetch_by_ids(papers: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Papers in the order of ids."""
    wanted = papers.sparkSession.createDataFrame([(i, x) for i, x in enumerate(ids)], "pos int, raw string").withColumn("arxiv_id", clean_arxiv_id("raw"))
    return papers.join(wanted.select("pos", "arxiv_id"), "arxiv_id").orderBy("pos").drop("pos")


def by_category(papers: DataFrame, category: str, start: str, end: str) -> DataFrame:
    """Papers of a category published from start to end (ISO dates, both included), oldest first."""
    day = F.to_date(F.try_to_timestamp("published"))
    return papers.where(F.array_contains("categories", category) & day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))).orderBy("published", "arxiv_id")


def to_download(papers: DataFrame, files: DataFrame) -> DataFrame:
    """Papers whose file (path ending in <id>.pdf) isn't there yet; files: as the binaryFile source lists them."""
    have = files.select(F.regexp_extract("path", r"([^/]+)\.pdf$", 1).alias("arxiv_id")).distinct()
    return papers.join(have, "arxiv_id", "left_anti")


ENTRY = "id string, title string, summary string, published string, updated string, author array<struct<name:string>>, category array<struct<_term:string>>, link array<struct<_href:string,_title:string>>"


def parse_entries(entries: DataFrame) -> DataFrame:
    """Metadata rows of feed entries with the columns of ENTRY (as the XML source reads them)."""
    pdf = F.filter("link", lambda x: x["_title"] == "pdf")
    return entries.select(
        clean_arxiv_id("id").alias("arxiv_id"),
        F.regexp_replace(F.trim("title"), r"\s+", " ").alias("title"),
        F.transform("author", lambda a: a["name"]).alias("authors"),
        F.trim("summary").alias("abstract"),
        F.transform("category", lambda c: c["_term"]).alias("categories"),
        F.get(F.transform(pdf, lambda x: x["_href"]), 0).alias("pdf_url"),
        "published",
        "updated",
        F.lit(None).cast("string").alias("local_pdf_path"),
    )


def read_feed(spark, path: str) -> DataFrame:
    return parse_entries(spark.read.format("xml").option("rowTag", "entry").schema(ENTRY).load(path))


def save_chunks(chunks: DataFrame, path: str) -> None:
    chunks.write.mode("overwrite").json(path)


def load_chunks(spark, path: str, *, array_file: bool = False) -> DataFrame:
    """Chunks written by save_chunks, or one JSON array in a file."""
    from foliospark.schemas import CHUNKS

    return spark.read.schema(CHUNKS).option("multiLine", array_file).json(path)
