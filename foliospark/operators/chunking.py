"""Section-aware chunks of documents, by windows and one aggregation over each document's blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions.text import estimate_tokens, short_hash, strip, strip_html, word_count
from foliospark.sources.blocks import FIGURES, FURNITURE, TABLES

#: Section types in order, each with the terms that show it.
SECTION_TERMS = {
    "abstract": ["abstract"],
    "introduction": ["introduction"],
    "related_work": ["related work", "background", "prior work"],
    "methodology": ["method", "approach", "model", "architecture", "framework", "transformer", "vision transformer"],
    "experiments": ["experiment", "experimental", "setup", "implementation", "training", "fine-tuning", "pre-training", "supervision"],
    "results": ["result", "evaluation", "performance", "comparison", "scaling", "inspection", "attention", "ablation", "analysis", "breakdown", "computational"],
    "discussion": ["discussion"],
    "conclusion": ["conclusion", "future work", "summary"],
    "references": ["references", "bibliography"],
    "appendix": ["appendix"],
    "unknown": ["acknowledgement", "acknowledgment", "funding"],
}
TEXT_TYPES = ("Text", "ListGroup", "Caption")
MIN_WORDS = 30


def classify_section(header: Column | str) -> Column:
    """The first section type, in order, with a term in the header; numbering is removed first."""
    x = F.col(header) if isinstance(header, str) else header
    x = F.regexp_replace(x, r"(?U)[A-Z]\d*\.\d*\s+", "")
    x = F.lower(strip(F.regexp_replace(x, r"(?U)^[\d\.\s]+", "")))
    terms = F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(term).alias("term")) for kind, found in SECTION_TERMS.items() for term in found])
    # a lambda's variable, so that the header is cleaned once and not for each term
    first = F.transform(F.array(x), lambda h: F.get(F.filter(terms, lambda t: h.contains(t["term"])), F.lit(0))["kind"])
    return F.coalesce(F.get(first, F.lit(0)), F.lit("unknown"))


def sections(blocks: DataFrame) -> DataFrame:
    """Blocks that aren't furniture, with section_idx, section and section_type.

    A section starts at each header; a header of unknown type inherits the last known one of its document.
    """
    w = Window.partitionBy("doc_id").orderBy("page_idx", "block_idx")
    is_header = F.col("block_type") == "SectionHeader"
    rows = blocks.where(~F.col("block_type").isin(*FURNITURE)).withColumn("text", strip_html("content"))
    rows = rows.withColumn("kind", F.when(is_header, F.nullif(classify_section("text"), F.lit("unknown"))))
    return rows.select(
        "*",
        F.row_number().over(w).alias("place"),
        F.sum(is_header.cast("int")).over(w).alias("section_idx"),
        F.coalesce(F.last(F.when(is_header, F.col("text")), ignorenulls=True).over(w), F.lit("preamble")).alias("section"),
        F.coalesce(F.last("kind", ignorenulls=True).over(w), F.lit("unknown")).alias("section_type"),
    )


def chunk(blocks: DataFrame, *, min_words: int = MIN_WORDS) -> DataFrame:
    """Chunks of each document with their ordinal: visual blocks at their place, a section's text at its end.

    Texts below min_words words are dropped. Equations are in no chunk. Ids depend on content only, so one text in
    two documents has one id.
    """
    rows = sections(blocks)
    text = (
        rows.where(F.col("block_type").isin(*TEXT_TYPES) & (F.col("content") != ""))
        .groupBy("doc_id", "section_idx")
        .agg(
            F.first("section").alias("section"),
            F.first("section_type").alias("section_type"),
            F.array_sort(F.collect_list(F.when(F.col("text") != "", F.struct("place", "text")))).alias("parts"),  # a section's blocks
            F.array_sort(F.collect_set("page_number")).alias("page_numbers"),
        )
        .withColumn("content", F.array_join(F.transform("parts", lambda x: x["text"]), "\n\n"))
        .withColumn("words", word_count("content").cast("int"))
        .where(F.col("words") >= min_words)
    )
    ends = rows.groupBy("doc_id", "section_idx").agg(F.max("place").alias("end"))
    text = text.join(ends, ["doc_id", "section_idx"]).select(
        "doc_id", short_hash("content").alias("chunk_id"), "section", "section_type", F.lit("text").alias("chunk_type"), "content", "page_numbers", F.col("words").alias("word_count"), F.lit(None).cast("string").alias("block_type"), F.col("end").alias("place"), F.lit(1).alias("late")
    )
    kind = F.when(F.col("block_type").isin(*TABLES), "table").otherwise("figure")
    visual = rows.where(F.col("block_type").isin(*FIGURES, *TABLES)).select(
        "doc_id",
        short_hash(F.concat("content", F.col("page_number").cast("string"))).alias("chunk_id"),
        "section",
        "section_type",
        kind.alias("chunk_type"),
        "content",
        F.array("page_number").alias("page_numbers"),
        word_count("content").cast("int").alias("word_count"),
        "block_type",
        "place",
        F.lit(0).alias("late"),
    )
    w = Window.partitionBy("doc_id").orderBy("place", "late")
    return text.unionByName(visual).withColumn("ordinal", F.row_number().over(w)).drop("place", "late")


def with_tokens(chunks: DataFrame) -> DataFrame:
    return chunks.withColumn("tokens", estimate_tokens("content"))


def dedupe_chunks(chunks: DataFrame) -> DataFrame:
    """One row for each chunk id: the smallest document's, with the number of documents that hold it."""
    return chunks.groupBy("chunk_id").agg(F.min("doc_id").alias("doc_id"), F.countDistinct("doc_id").alias("n_docs"), F.min("word_count").alias("word_count"))
