"""Structured extraction: prompts for pages, parsing of answers, and merging of per-page results per document."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions.text import is_blank, strip
from foliospark.schemas import CONFIDENCE_FIELDS, LISTS, PARTIAL, SCALARS

#: The fields in prompt order, each with its instruction.
FIELD_PROMPTS = {
    "title": "Full paper title exactly as written",
    "authors": "All authors with names, affiliations, emails if present",
    "institutions": "All affiliated institutions with name, department, country",
    "problem_statement": "1-3 sentences: what problem does this paper solve and why it matters",
    "abstract": "Full abstract text verbatim",
    "datasets": "All datasets used — name, description, size, splits",
    "methods": "Key methods/architectures proposed — name, description, novelty",
    "results": "Quantitative results — method name, metrics, dataset, conditions",
    "baselines": "Baseline systems compared against — name, metrics, notes",
    "limitations": "Limitations stated or inferable — description, type",
    "conclusion_summary": "1-2 sentence summary of conclusions",
}
PROMPT_HEAD = "Extract the following fields from this research paper page:\n\n"
PROMPT_RULES = (
    "\n\nRules:\n"
    "- Only extract information explicitly present in the provided content\n"
    "- Do not infer, hallucinate, or fill gaps with prior knowledge\n"
    "- For fields not present on this page, use empty string or empty list\n"
    "- Extract confidence scores per field: 1.0 if clearly present, 0.5 if partially present, 0.0 if absent\n"
    "- Return valid JSON matching the PartialExtraction schema exactly"
    "- Set extraction_confidence to a float 0.0-1.0 reflecting overall extraction quality\n"
    "- Set field_confidence.title, field_confidence.authors, etc. individually\n"
)
#: Fields by page position: first page, the two after it, others.
FIRST_PAGE = ("title", "authors", "institutions", "abstract", "problem_statement", "datasets", "methods")
EARLY_PAGE = ("problem_statement", "abstract", "datasets", "methods", "baselines")
LATER_PAGE = ("datasets", "methods", "results", "baselines", "limitations", "conclusion_summary")
#: Lists that make a partial result count as filled; institutions and arxiv_id don't.
FILLING_SCALARS = ("title", "problem_statement", "abstract", "conclusion_summary")
FILLING_LISTS = ("authors", "datasets", "methods", "results", "baselines", "limitations")


def target_fields(page_idx: Column | str) -> Column:
    i = F.col(page_idx) if isinstance(page_idx, str) else page_idx
    names = lambda xs: F.array(*[F.lit(x) for x in xs])
    return F.when(i == 0, names(FIRST_PAGE)).when(i <= 2, names(EARLY_PAGE)).otherwise(names(LATER_PAGE))


def build_prompt(fields: Column | None) -> Column:
    """The instruction for an array of field names; null or empty means all fields, unknown names are ignored."""
    lines = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(f"- {k}: {v}").alias("line")) for k, v in FIELD_PROMPTS.items()])
    everything = F.lit(True) if fields is None else fields.isNull() | (F.size(fields) == 0)
    chosen = lines if fields is None else F.filter(lines, lambda x: everything | F.array_contains(fields, x["k"]))
    return F.concat(F.lit(PROMPT_HEAD), F.array_join(F.transform(chosen, lambda x: x["line"]), "\n"), F.lit(PROMPT_RULES))


def build_messages(system: Column, prompt: Column, page_text: Column, image_uri: Column) -> Column:
    """Array of (role, parts): parts are (type, value), with the image first and the page's text last, if present."""
    part = lambda kind, value: F.struct(F.lit(kind).alias("type"), value.alias("value"))
    image = F.when(image_uri.isNotNull(), part("image_url", image_uri))
    text = F.when(F.coalesce(page_text, F.lit("")) != "", part("text", F.concat(F.lit("Page content:\n\n"), page_text)))
    user = F.array_compact(F.array(image, part("text", prompt), text))
    return F.array(F.struct(F.lit("system").alias("role"), F.array(part("text", system)).alias("parts")), F.struct(F.lit("user").alias("role"), user.alias("parts")))


def image_data_uri(path: Column, content: Column) -> Column:
    kind = F.when(F.lower(path).rlike(r"\.jpe?g$"), "jpeg").otherwise("png")
    return F.concat(F.lit("data:image/"), kind, F.lit(";base64,"), F.base64(content))


def strip_fence(raw: Column) -> Column:
    """raw without leading and trailing characters of a code fence marked json (any of ` j s o n), then white space."""
    return strip(F.regexp_replace(strip(raw), r"^[`json]+|[`json]+\z", ""))


def extract_pages(pages: DataFrame, extractor: Callable[[pd.DataFrame], pd.DataFrame], *, retries: int = 3) -> DataFrame:
    """Runs an extractor over page rows in Python workers; failures become rows with success = false.

    extractor: frame with doc_id, page_idx, prompt, page_text -> frame with raw_text, prompt_tokens,
    completion_tokens, model, of the same length. Blank pages without an image are left out before the workers.
    """
    from foliospark.schemas import EXTRACTION_LOG

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import time

        for frame in frames:
            out = []
            for at in range(len(frame)):
                one, began, error, got = frame.iloc[at : at + 1], time.monotonic(), None, None
                for _ in range(retries):
                    try:
                        got = extractor(one).iloc[0]
                        error = None
                        break
                    except Exception as e:  # any failure of the model counts as an attempt
                        error = str(e)
                row = one.iloc[0]
                known = got is not None
                out.append((row["doc_id"], row["page_idx"], got["raw_text"] if known else None, got["prompt_tokens"] if known else 0, got["completion_tokens"] if known else 0, (time.monotonic() - began) * 1000, got["model"] if known else None, known, error))
            yield pd.DataFrame(out, columns=EXTRACTION_LOG.names)

    kept = pages.where(~is_blank("page_text") | F.col("image_uri").isNotNull()) if "image_uri" in pages.columns else pages.where(~is_blank("page_text"))
    return kept.mapInPandas(run, EXTRACTION_LOG)


def parse_answers(log: DataFrame) -> DataFrame:
    """log with parsed (struct of PARTIAL) and parse_error: the raw JSON as it is, else without its fence."""
    schema = PARTIAL.simpleString()
    valid = lambda x: F.try_parse_json(x).isNotNull()
    raw, bare = F.col("raw_text"), strip_fence(F.col("raw_text"))
    json = F.when(valid(raw), raw).when(valid(bare), bare)
    return log.withColumn("parsed", F.from_json(json, schema)).withColumn("parse_error", F.when(raw.isNotNull() & json.isNull(), F.lit("not JSON")))


def extract_documents(pages: DataFrame, extractor: Callable[[pd.DataFrame], pd.DataFrame], *, strategy: str = "union", retries: int = 3) -> tuple[DataFrame, DataFrame]:
    """(merged, failed) of documents given as pages (doc_id, page_idx, page_text, maybe image_uri).

    Each page is asked for the fields of its place, its answer is parsed, and a document's pages merge. failed has
    (doc_id, n_pages, error) of documents without any usable page, blank ones included.
    """
    asked = pages.withColumn("prompt", build_prompt(target_fields("page_idx")))
    log = parse_answers(extract_pages(asked, extractor, retries=retries))
    good = F.col("success") & F.col("parsed").isNotNull()
    partials = log.where(good).select(F.col("doc_id").cast("string").alias("doc_id"), F.col("page_idx").alias("partial_idx"), *[_or_empty(f, F.col(f"parsed.{f.name}")).alias(f.name) for f in PARTIAL.fields if f.name not in ("doc_id", "partial_idx")])
    errors = log.groupBy("doc_id").agg(F.bool_or(good).alias("ok"), F.min(F.coalesce("error", "parse_error")).alias("error"))
    counts = pages.groupBy("doc_id").agg(F.count("*").alias("n_pages"))
    failed = counts.join(errors, "doc_id", "left").where(~F.coalesce("ok", F.lit(False))).select("doc_id", "n_pages", F.coalesce("error", F.lit("no page with content")).alias("error"))
    return merge_extractions(partials, strategy=strategy), failed


def _or_empty(field, value: Column) -> Column:
    """The value; what an answer leaves out is an empty list, or a confidence of 0."""
    kind = field.dataType.typeName()
    if kind == "array":
        return F.coalesce(value, F.array().cast(field.dataType))
    return F.coalesce(value, F.lit(0.0)) if kind == "double" else value


def drop_empty_partials(partials: DataFrame) -> DataFrame:
    """Partial results with content; all of a document's if none has."""
    filled = F.lit(False)
    for c in FILLING_SCALARS:
        filled = filled | (F.coalesce(F.col(c), F.lit("")) != "")
    for c in FILLING_LISTS:
        filled = filled | (F.coalesce(F.size(c), F.lit(0)) > 0)
    w = Window.partitionBy("doc_id")
    marked = partials.withColumn("_filled", filled).withColumn("_any", F.bool_or("_filled").over(w)).withColumn("_pages", F.count("*").over(w))
    return marked.where(F.col("_filled") | ~F.col("_any")).drop("_filled", "_any")


def pick_scalar(value: Column, order: Column, strategy: str) -> Column:
    """The first value that isn't blank, or the last one under last_wins; an empty string if there is none."""
    by = F.max_by if strategy == "last_wins" else F.min_by
    full = ~is_blank(value)
    return F.coalesce(by(F.when(full, value), F.when(full, order)), F.lit(""))


def item_key(field: str, item: Column, ddl: str) -> Column:
    """What makes two items of a list the same one."""
    if field == "results":
        return F.concat(F.coalesce(item["method_name"], F.lit("None")), F.lit("_"), F.coalesce(item["dataset"], F.lit("None")))
    if field == "limitations":
        return item["description"]
    name = F.nullif(item["name"], F.lit(""))
    return F.coalesce(name, item["description"] if "description:" in ddl else F.to_json(item))


def _first_by_key(field: str, ddl: str) -> Column:
    """An aggregate: a document's items in order, the first of each key. Items lists are one document's."""
    lists = F.array_sort(F.collect_list(F.struct(F.col("partial_idx").alias("i"), F.col(field).alias("items"))))
    flat = F.flatten(F.transform(lists, lambda x: F.coalesce(x["items"], F.array().cast(f"array<{ddl}>"))))
    pairs = F.transform(flat, lambda x, j: F.struct(F.coalesce(item_key(field, x, ddl), F.lit("\0null")).alias("k"), j.alias("j"), x.alias("item")))
    # sorted by key, the first of each key stands after another key; a lambda's variable keeps the array from being sorted again
    firsts = F.get(F.transform(F.array(F.array_sort(pairs)), lambda v: F.filter(v, lambda x, j: (j == 0) | (F.get(v, j - 1)["k"] != x["k"]))), F.lit(0))
    ordered = F.array_sort(F.transform(firsts, lambda x: F.struct(x["j"].alias("j"), x["item"].alias("item"))))
    return F.transform(ordered, lambda x: x["item"])


def merge_extractions(partials: DataFrame, *, strategy: str = "union") -> DataFrame:
    """One row for each document from its partial results (schema PARTIAL), in one aggregation by document."""
    kept = drop_empty_partials(partials)
    i, conf = F.col("partial_idx"), F.col("extraction_confidence")
    scalars = [pick_scalar(F.col(c), i, strategy).alias(c) for c in SCALARS]
    lists = [_first_by_key(c, t).alias(c) for c, t in LISTS.items()]
    best = F.struct(*[F.coalesce(F.max(F.col("field_confidence")[c]), F.lit(0.0)).alias(c) for c in CONFIDENCE_FIELDS])
    mean = F.coalesce(F.avg(F.when(conf > 0, conf)), F.lit(0.0))
    out = kept.groupBy("doc_id").agg(*scalars, *lists, mean.alias("extraction_confidence"), best.alias("field_confidence"), F.first("_pages").alias("pages_processed"), F.count("*").alias("pages_with_content"))
    for c in ("arxiv_id", "abstract", "conclusion_summary"):
        out = out.withColumn(c, F.nullif(F.col(c), F.lit("")))
    return out.withColumn("merge_strategy", F.lit(strategy))


def validate(extractions: DataFrame, *, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(valid rows with stripped title and problem_statement, invalid rows with a reason); strict raises instead."""
    conf = F.col("extraction_confidence")
    reason = (
        F.when(is_blank("title"), F.lit("title is blank"))
        .when(is_blank("problem_statement"), F.lit("problem_statement is blank"))
        .when(~F.coalesce(conf.between(0.0, 1.0), F.lit(False)), F.lit("extraction_confidence is outside 0..1"))
    )
    marked = extractions.withColumn("title", strip("title")).withColumn("problem_statement", strip("problem_statement")).withColumn("reason", reason)
    if strict:
        checked = marked.withColumn("reason", F.when(F.col("reason").isNotNull(), F.raise_error(F.col("reason")).cast("string")))
        return checked.where(F.col("reason").isNull()).drop("reason"), marked.limit(0)
    return marked.where(F.col("reason").isNull()).drop("reason"), marked.where(F.col("reason").isNotNull())


def metric_rows(extractions: DataFrame) -> DataFrame:
    """(doc_id, source, owner, name, value_raw, value_num, value_is_string, dataset) of result and baseline metrics."""
    results = extractions.select("doc_id", F.explode("results").alias("r")).select("doc_id", F.lit("results").alias("source"), F.col("r.method_name").alias("owner"), F.explode("r.metrics").alias("m"))
    bases = extractions.select("doc_id", F.explode("baselines").alias("b")).select("doc_id", F.lit("baselines").alias("source"), F.col("b.name").alias("owner"), F.explode("b.metrics").alias("m"))
    number = F.expr("try_cast(m.value_raw AS DOUBLE)")
    return results.unionByName(bases).select("doc_id", "source", "owner", "m.name", "m.value_raw", number.alias("value_num"), number.isNull().alias("value_is_string"), "m.dataset")
