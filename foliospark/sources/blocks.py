"""Typed page blocks: from HTML pages, and from documents split into lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.functions.text import strip, word_count

#: Block types by the flag they set, and furniture that is no content.
FIGURES = ("Figure", "FigureGroup", "PictureGroup")
TABLES = ("TableGroup",)
EQUATIONS = ("Equation",)
FURNITURE = ("PageHeader", "PageFooter", "Footnote")
#: Types joined by page_markdown, as the data model has named them, and those that pages hold now.
MARKDOWN_LEGACY = ("Text", "Title", "Section-header", "Caption")
MARKDOWN_CURRENT = ("Text", "SectionHeader", "ListGroup", "Caption")

TAG_TYPES = {"h1": "SectionHeader", "h2": "SectionHeader", "h3": "SectionHeader", "p": "Text", "ul": "ListGroup", "ol": "ListGroup", "nav": "PageHeader", "header": "PageHeader", "footer": "PageFooter", "figure": "Figure", "table": "TableGroup", "caption": "Caption", "math": "Equation"}
_ELEMENT = r"(?is)<(h1|h2|h3|p|ul|ol|nav|header|footer|figure|table|caption|math)(?:\s[^>]*)?>(.*?)(?=</\1>|<(?:h1|h2|h3|p|ul|ol|nav|header|footer|figure|table|caption|math)[\s>]|\z)"


def html_to_blocks(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(doc_id, page_idx, page_number, block_idx, block_type, content) of HTML pages, one page for each document.

    An element ends at its end tag or where the next block element starts; scripts and styles are no content.
    """
    body = F.regexp_replace(F.col(html_col), r"(?is)<(script|style)[^>]*>.*?</\1>", "")
    tags = F.regexp_extract_all(body, F.lit(_ELEMENT), F.lit(1))
    contents = F.regexp_extract_all(body, F.lit(_ELEMENT), F.lit(2))
    types = F.create_map(*[F.lit(x) for pair in TAG_TYPES.items() for x in pair])
    rows = pages.select(F.col(id_col).alias("doc_id"), F.posexplode(F.arrays_zip(tags.alias("tag"), contents.alias("content"))).alias("block_idx", "b"))
    return rows.select("doc_id", F.lit(0).alias("page_idx"), F.lit(0).alias("page_number"), "block_idx", types[F.lower("b.tag")].alias("block_type"), F.col("b.content").alias("content"))


def drop_furniture(blocks: DataFrame) -> DataFrame:
    return blocks.where(~F.col("block_type").isin(*FURNITURE))


def page_summary(blocks: DataFrame) -> DataFrame:
    """One row for each page: flags by block type, and words of the raw content (tags count as words)."""
    t = F.col("block_type")
    flag = lambda types, name: F.coalesce(F.bool_or(t.isin(*types)), F.lit(False)).alias(name)
    return drop_furniture(blocks).groupBy("doc_id", "page_idx", "page_number").agg(flag(FIGURES, "has_figures"), flag(TABLES, "has_tables"), flag(EQUATIONS, "has_equations"), F.sum(word_count("content")).cast("int").alias("word_count"), F.count("*").cast("int").alias("n_blocks"))


def page_markdown(blocks: DataFrame, *, legacy_types: bool = True) -> DataFrame:
    """(doc_id, page_idx, markdown): contents of the text types in block order, with a blank line between."""
    types = MARKDOWN_LEGACY if legacy_types else MARKDOWN_CURRENT
    ordered = F.array_sort(F.collect_list(F.when(F.col("block_type").isin(*types), F.struct("block_idx", "content"))))
    return blocks.groupBy("doc_id", "page_idx").agg(F.array_join(F.transform(ordered, lambda x: x["content"]), "\n\n").alias("markdown"))


def document_titles(docs: DataFrame, *, title_col: str = "title", path_col: str = "source_path") -> DataFrame:
    """docs with title falling back to the file's name without its suffix."""
    stem = F.regexp_extract(F.col(path_col), r"([^/]+?)(?:\.[^./]*)?$", 1)
    return docs.withColumn(title_col, F.coalesce(F.nullif(F.col(title_col), F.lit("")), stem))


#: Columns of the metadata of a PDF file, all strings but the last.
PDF_METADATA = "title string, author string, subject string, keywords string, creator string, producer string, creation_date string, modification_date string, page_count int"


def parse_pdfs(files: DataFrame, parser) -> DataFrame:
    """Blocks of files (path, content as of the binaryFile source); parser: path, bytes -> iterable of block tuples.

    A PDF library is not part of this package: the parser is the boundary, and it runs in Python workers.
    """

    def run(frames):
        import pandas as pd

        for frame in frames:
            rows = [(path, *block) for path, content in zip(frame["path"], frame["content"], strict=True) for block in parser(path, content)]
            yield pd.DataFrame(rows, columns=["doc_id", "page_idx", "page_number", "block_idx", "block_type", "content"])

    return files.select("path", "content").mapInPandas(run, "doc_id string, page_idx int, page_number int, block_idx int, block_type string, content string")


def text_to_blocks(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lines_per_page: int = 8, header_words: int = 6) -> DataFrame:
    """Blocks of plain texts: lines are blocks, and a line of up to header_words words is a section header."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.posexplode(F.split(F.col(text_col), "\n")).alias("block_idx", "content"))
    kind = F.when(word_count("content") <= header_words, "SectionHeader").otherwise("Text")
    page = F.floor(F.col("block_idx") / lines_per_page).cast("int")
    return rows.where(strip("content") != "").select("doc_id", page.alias("page_idx"), page.alias("page_number"), "block_idx", kind.alias("block_type"), "content")
