"""Page routing: which pages need text-only processing, visual processing, or none."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions.text import strip
from foliospark.sources.blocks import EQUATIONS, FIGURES, TABLES

#: Fixed values.
STRUCTURAL_TERMS = ("references", "bibliography", "acknowledgments", "acknowledgements", "funding", "author contributions")
GUARD_LEGACY = ("Picture", "Table", "Formula")
GUARD_CURRENT = (*FIGURES, *TABLES, *EQUATIONS)
EMPTY_REASON = "no content blocks after filtering headers/footers"
STRUCTURAL_REASON = "structural section: "
FIGURE_REASON = "Figure/FigureGroup/PictureGroup block detected"
TABLE_REASON = "TableGroup block detected"
EQUATION_REASON = "Equation block detected"
TEXT_REASON = "text-only blocks"
PROMOTED_REASON = "promoted: adjacent to VLM page"


def route_pages(blocks: DataFrame, pages: DataFrame | None = None, *, legacy_types: bool = True) -> DataFrame:
    """(doc_id, page_idx, page_number, route, confidence, reasons) of each page on its own.

    pages (doc_id, page_idx, page_number) adds pages without blocks. legacy_types: structural pages are skipped even
    if they hold figures, tables or equations by their present names. One aggregation by page decides everything.
    """
    t = F.col("block_type")
    has = lambda types: F.coalesce(F.bool_or(t.isin(*types)), F.lit(False))
    header = F.lower(strip("content"))
    term = F.lit(False)
    for word in STRUCTURAL_TERMS:
        term = term | F.lower("content").contains(word)
    facts = blocks.groupBy("doc_id", "page_idx", "page_number").agg(
        F.bool_and(t.isin("PageHeader", "PageFooter")).alias("furniture"),
        F.min_by(F.when((t == "SectionHeader") & term, header), F.when((t == "SectionHeader") & term, F.col("block_idx"))).alias("structural"),
        has(GUARD_LEGACY if legacy_types else GUARD_CURRENT).alias("guard"),
        has(FIGURES).alias("figures"),
        has(TABLES).alias("tables"),
        has(EQUATIONS).alias("equations"),
    )
    if pages is not None:
        facts = pages.select("doc_id", "page_idx", "page_number").join(facts, ["doc_id", "page_idx", "page_number"], "left")
    return _decide(facts)


def _decide(facts: DataFrame) -> DataFrame:
    flags = [(F.coalesce(F.col(c), F.lit(False)), r) for c, r in (("figures", FIGURE_REASON), ("tables", TABLE_REASON), ("equations", EQUATION_REASON))]
    n = sum((f.cast("int") for f, _ in flags), F.lit(0))
    empty = F.coalesce(F.col("furniture"), F.lit(True))
    skip = F.col("structural").isNotNull() & ~F.col("guard")
    route = F.when(empty | skip, "skip").when(n > 0, "vlm").otherwise("text_only")
    confidence = F.when(empty, F.lit(0.95)).when(skip, F.lit(0.85)).when(n > 0, F.least(F.lit(0.7) + n * F.lit(0.1), F.lit(0.95))).otherwise(F.lit(0.9))
    seen = F.array_compact(F.array(*[F.when(f, F.lit(r)) for f, r in flags]))
    reasons = F.when(empty, F.array(F.lit(EMPTY_REASON))).when(skip, F.array(F.concat(F.lit(STRUCTURAL_REASON), "structural"))).when(n > 0, seen).otherwise(F.array(F.lit(TEXT_REASON)))
    return facts.select("doc_id", "page_idx", "page_number", route.alias("route"), confidence.alias("confidence"), reasons.alias("reasons"))


def promote(decisions: DataFrame) -> DataFrame:
    """Text pages next to a visual page become visual.

    Promotion runs forward through a run of text pages and one page backward: a text page is promoted if the last
    page before it that isn't text is visual, or if the next page is visual. One window sort by document.
    """
    w = Window.partitionBy("doc_id").orderBy("page_idx")
    before = F.last(F.when(F.col("route") != "text_only", F.col("route")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    after = F.lead("route").over(w)
    hit = (F.col("route") == "text_only") & (F.coalesce(before == "vlm", F.lit(False)) | F.coalesce(after == "vlm", F.lit(False)))
    marked = decisions.withColumn("_hit", hit)
    return marked.select(
        "doc_id",
        "page_idx",
        "page_number",
        F.when(F.col("_hit"), "vlm").otherwise(F.col("route")).alias("route"),
        F.when(F.col("_hit"), F.lit(0.65)).otherwise(F.col("confidence")).alias("confidence"),
        F.when(F.col("_hit"), F.concat("reasons", F.array(F.lit(PROMOTED_REASON)))).otherwise(F.col("reasons")).alias("reasons"),
    )


def route_documents(blocks: DataFrame, pages: DataFrame | None = None, *, legacy_types: bool = True) -> DataFrame:
    return promote(route_pages(blocks, pages, legacy_types=legacy_types))


def split_by_route(pages: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(text-only pages, visual pages) of pages; the last decision for a page number wins, skipped pages are in neither."""
    last = decisions.groupBy("doc_id", "page_number").agg(F.max_by("route", "page_idx").alias("route"))
    routed = pages.join(last, ["doc_id", "page_number"])
    return routed.where("route = 'text_only'").drop("route"), routed.where("route = 'vlm'").drop("route")
