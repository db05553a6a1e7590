"""Evaluation of extractions and answers: consistency, hallucination, field scores and retrieval quality.

Checks return one row for each finding with its doc_id, so that reports are aggregations. Thresholds and
severities that the contracts leave open are parameters with the defaults below.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions.text import numbers_in, similarity, strip
from foliospark.functions.vector import cosine
from foliospark.models import entailed, fuzzy_contains, sentences
from foliospark.operators.extraction import metric_rows

SEVERITY = {"author_institution_mismatch": 0.2, "impossible_value": 0.4, "metric_conflict": 0.3, "dataset_result_mismatch": 0.2, "metric_baseline_conflict": 0.2, "duplicate_entry": 0.2, "near_duplicate_entry": 0.1}
AFFILIATION_SIMILARITY = 0.8
NEAR_DUPLICATE = 0.85
FIELD_WEIGHTS = {"title": 1.0, "authors": 1.0, "institutions": 1.0, "problem_statement": 1.5, "datasets": 1.5, "methods": 2.0, "results": 2.0, "baselines": 1.5, "limitations": 1.0}


def _finding(df: DataFrame, kind: str, field: str, value, severity: float | None = None) -> DataFrame:
    return df.select("doc_id", F.lit(kind).alias("inconsistency_type"), F.lit(field).alias("field_name"), value.cast("string").alias("value"), F.lit(SEVERITY[kind] if severity is None else severity).alias("severity"))


def _names(extractions: DataFrame, field: str, path: str = "name") -> DataFrame:
    return extractions.select("doc_id", F.explode(field).alias("_x")).select("doc_id", F.col(f"_x.{path}").alias("name")).where("name IS NOT NULL")


def check_affiliations(extractions: DataFrame, least: float = AFFILIATION_SIMILARITY) -> DataFrame:
    """Affiliations that no institution of the same document resembles."""
    places = extractions.select("doc_id", F.explode("authors").alias("a")).select("doc_id", F.explode("a.affiliations").alias("place")).distinct()
    known = _names(extractions, "institutions").withColumnRenamed("name", "known").distinct()
    miss = places.join(known.withColumnRenamed("doc_id", "d"), (F.col("doc_id") == F.col("d")) & (similarity(F.col("place"), F.col("known")) >= least), "left_anti")
    return _finding(miss, "author_institution_mismatch", "authors", F.col("place"))


def check_metric_ranges(extractions: DataFrame) -> DataFrame:
    """Percentages outside 0..100, BLEU outside 0..1, perplexity not above 0, and one metric with several values."""
    m = metric_rows(extractions)
    name, v = F.lower("name"), F.col("value_num")
    percent = F.col("value_raw").endswith("%") | name.rlike("accuracy|precision|recall|f1|percent")
    number = F.coalesce(v, F.expr("try_cast(regexp_replace(value_raw, '%$', '') AS DOUBLE)"))
    bad = (name.contains("bleu") & ~number.between(0.0, 1.0)) | (name.contains("perplexity") & (number <= 0)) | (percent & ~name.contains("bleu") & ~number.between(0.0, 100.0))
    impossible = _finding(m.where(bad), "impossible_value", "results", F.concat_ws("=", "name", "value_raw"))
    several = m.groupBy("doc_id", "owner", "name", "dataset").agg(F.countDistinct("value_raw").alias("n")).where("n > 1")
    return impossible.unionByName(_finding(several, "metric_conflict", "results", F.concat_ws("/", "owner", "name")))


def check_result_datasets(extractions: DataFrame) -> DataFrame:
    """Results on a dataset that isn't listed; results without a dataset pass."""
    used = _names(extractions, "results", "dataset").distinct()
    miss = used.join(_names(extractions, "datasets"), ["doc_id", "name"], "left_anti")
    return _finding(miss, "dataset_result_mismatch", "results", F.col("name"))


def check_baselines(extractions: DataFrame) -> DataFrame:
    """Methods of results that aren't proposed and aren't listed as baselines."""
    others = extractions.select("doc_id", F.explode("results").alias("r")).where("NOT r.is_proposed").select("doc_id", F.col("r.method_name").alias("name")).distinct()
    miss = others.join(_names(extractions, "baselines"), ["doc_id", "name"], "left_anti")
    return _finding(miss, "metric_baseline_conflict", "baselines", F.col("name"))


def check_duplicates(extractions: DataFrame, near: float = NEAR_DUPLICATE) -> DataFrame:
    """Names that stand twice in authors, datasets or methods, ignoring case and outer space; similar ones count less."""
    out = None
    for field in ("authors", "datasets", "methods"):
        names = _names(extractions, field).select("doc_id", F.lower(strip("name")).alias("n")).groupBy("doc_id", "n").agg(F.count("*").alias("k"))
        exact = _finding(names.where("k > 1"), "duplicate_entry", field, F.col("n"))
        a, b = names.select("doc_id", F.col("n").alias("a")), names.select("doc_id", F.col("n").alias("b"))
        similar = a.join(b, "doc_id").where((F.col("a") < F.col("b")) & (similarity(F.col("a"), F.col("b")) >= near))  # names of one document
        part = exact.unionByName(_finding(similar, "near_duplicate_entry", field, F.concat_ws(" ~ ", "a", "b")))
        out = part if out is None else out.unionByName(part)
    return out


def consistency_score(severity_sum: Column) -> Column:
    return F.greatest(F.lit(0.0), F.lit(1.0) - F.least(F.coalesce(severity_sum, F.lit(0.0)), F.lit(1.0)))


def inconsistencies(extractions: DataFrame) -> DataFrame:
    out = check_affiliations(extractions)
    for check in (check_metric_ranges, check_result_datasets, check_baselines, check_duplicates):
        out = out.unionByName(check(extractions))
    return out


def consistency_report(extractions: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """(doc_id, n_inconsistencies, score) for each document."""
    found = inconsistencies(extractions) if found is None else found
    sums = found.groupBy("doc_id").agg(F.sum("severity").alias("s"), F.count("*").alias("n"))
    return extractions.select("doc_id").join(sums, "doc_id", "left").select("doc_id", F.coalesce("n", F.lit(0)).alias("n_inconsistencies"), consistency_score(F.col("s")).alias("score"))


def number_in_source(value: Column, numbers: Column, tolerance: float = 0.05) -> Column:
    """Whether a number of the source is within the tolerance of the value, of 100 times it or of a hundredth."""
    near = lambda n, v: F.abs(n - v) <= F.lit(tolerance) * F.abs(v)
    return F.exists(numbers, lambda n: near(n, value) | near(n, value * 100) | near(n, value / 100))


def value_in_source(value: Column, source: Column, tolerance: float = 0.05, numeric: Column | None = None) -> Column:
    """Numbers within the tolerance, in either form; other values as a part of the source, ignoring case.

    numeric: whether a value is a number, where that is known; a text may consist of digits. By default what reads as one is.
    """
    number = F.regexp_replace(strip(value), "%$", "").try_cast("double")
    is_number = number.isNotNull() if numeric is None else numeric & number.isNotNull()
    return F.when(is_number, number_in_source(number, numbers_in(source), tolerance)).otherwise(F.lower(source).contains(F.lower(value)))


def _flag(df: DataFrame, kind: str, field: str, value: Column) -> DataFrame:
    return df.select("doc_id", F.lit(kind).alias("hallucination_type"), F.lit(field).alias("field_name"), value.alias("flagged_value"))


def hallucination_checks(extractions: DataFrame, sources: DataFrame, *, tolerance: float = 0.05) -> DataFrame:
    """(doc_id, hallucination_type, field_name, flagged_value, supported) for every checked claim.

    sources: (doc_id, source_text). Metrics, authors, datasets and the sentences of the problem statement.
    """
    text = F.col("source_text")
    joined = lambda df: df.join(sources.select("doc_id", "source_text"), "doc_id")
    checks = []
    m = joined(metric_rows(extractions)).withColumn("supported", value_in_source(F.col("value_raw"), text, tolerance))
    checks.append((m, "fabricated_metric", "results", F.col("value_raw")))
    a = joined(_names(extractions, "authors")).withColumn("supported", fuzzy_contains(F.col("name"), text))
    checks.append((a, "fabricated_author", "authors", F.col("name")))
    d = joined(_names(extractions, "datasets")).withColumn("supported", F.lower(text).contains(F.lower("name")))
    checks.append((d, "fabricated_dataset", "datasets", F.col("name")))
    s = joined(extractions.select("doc_id", F.explode(sentences(F.col("problem_statement"))).alias("name"))).withColumn("supported", entailed(F.col("name"), text))
    checks.append((s, "unsupported_claim", "problem_statement", F.col("name")))
    out = None
    for df, kind, field, value in checks:
        part = df.select("doc_id", F.lit(kind).alias("hallucination_type"), F.lit(field).alias("field_name"), value.alias("flagged_value"), "supported")
        out = part if out is None else out.unionByName(part)
    return out


def rate(flagged: Column, total: Column) -> Column:
    return F.coalesce(F.try_divide(flagged.cast("double"), total.cast("double")), F.lit(0.0))


def hallucination_report(extractions: DataFrame, checks: DataFrame) -> DataFrame:
    """(doc_id, n_flags, checked_claims, hallucination_rate) for each document."""
    sums = checks.groupBy("doc_id").agg(F.count_if(~F.col("supported")).alias("n_flags"), F.count("*").alias("checked_claims"))
    out = extractions.select("doc_id").join(sums, "doc_id", "left").fillna(0, ["n_flags", "checked_claims"])
    return out.withColumn("hallucination_rate", rate(F.col("n_flags"), F.col("checked_claims")))


#: What a judge is asked about a field; other fields get OTHER_CRITERION.
FIELD_CRITERIA = {
    "title": "5: the same title as in the paper. 3: other punctuation only. 1: another title.",
    "authors": "5: every author, names spelled as in the paper, with affiliations. One point less for each that is missing or misspelled.",
    "institutions": "5: every institution once, with its right name.",
    "problem_statement": "5: the paper's problem, whole and right. 3: in part. 1: wrong, or the main aspects are missing.",
    "datasets": "5: every dataset of the paper with its right name and size.",
    "methods": "How complete and how right the description of the paper's methods is.",
    "results": "5: all main numbers with their metrics and conditions. Less for each error.",
    "baselines": "How complete the compared methods are, and how right their numbers.",
    "limitations": "5: every limitation that the authors state.",
}
OTHER_CRITERION = "How complete and how right the value is."
SOURCE_EXCERPT = 4000


def judge_prompt(field: Column, predicted: Column, reference: Column, source: Column, *, excerpt: int = SOURCE_EXCERPT) -> Column:
    """A judge's prompt for one field: its criterion, the value (JSON text), and the reference or else an excerpt of the source."""
    criteria = F.create_map(*[F.lit(x) for kv in FIELD_CRITERIA.items() for x in kv])
    against = F.when(reference.isNotNull(), F.concat(F.lit("Reference value: "), reference)).otherwise(F.concat(F.lit("Source text: "), F.substring(F.coalesce(source, F.lit("")), 1, excerpt)))
    lines = (F.concat(F.lit("Field: "), field), F.concat(F.lit("Criterion: "), F.coalesce(criteria[field], F.lit(OTHER_CRITERION))), F.concat(F.lit("Extracted value: "), F.coalesce(predicted, F.lit("null"))), against)
    return F.concat_ws("\n", *lines, F.lit("Explain briefly, then end with a line 'Score: n', n from 1 to 5."))


def field_scores(samples: DataFrame) -> DataFrame:
    """(doc_id, field_name, score in 0..1) from judge samples (doc_id, field_name, completion): means over 5."""
    from foliospark.models import g_eval_score

    return samples.groupBy("doc_id", "field_name").agg((F.avg(g_eval_score(F.col("completion"))) / 5.0).alias("score"))


def overall_score(scores: DataFrame, weights: Mapping[str, float] = FIELD_WEIGHTS) -> DataFrame:
    """(doc_id, overall): the weighted mean; fields without a weight count 1."""
    w = F.coalesce(F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])[F.col("field_name")], F.lit(1.0))
    return scores.groupBy("doc_id").agg((F.sum(w * F.col("score")) / F.sum(w)).alias("overall"))


def faithfulness(answers: DataFrame) -> DataFrame:
    """(sample_id, faithfulness): supported sentences of answer in context; null without sentences."""
    claims = answers.select("sample_id", "context", F.explode(sentences(F.col("answer"))).alias("claim"))
    means = claims.groupBy("sample_id").agg(F.avg(entailed(F.col("claim"), F.col("context")).cast("double")).alias("faithfulness"))
    return answers.select("sample_id").join(means, "sample_id", "left")


def answer_relevancy(questions: DataFrame) -> DataFrame:
    """(sample_id, answer_relevancy): mean cosine of generated questions' vectors (generated) with the question's (asked)."""
    return questions.groupBy("sample_id").agg(F.avg(cosine("generated", "asked")).alias("answer_relevancy"))


def context_precision(retrieved: DataFrame) -> DataFrame:
    """(sample_id, context_precision): mean relevance of the retrieved rows."""
    return retrieved.groupBy("sample_id").agg(F.avg(F.col("relevant").cast("double")).alias("context_precision"))


def context_recall(facts: DataFrame) -> DataFrame:
    """(sample_id, context_recall): share of the reference's facts that are covered."""
    return facts.groupBy("sample_id").agg(F.avg(F.col("covered").cast("double")).alias("context_recall"))


def answer_correctness(answers: DataFrame) -> DataFrame:
    """(sample_id, answer_correctness): F1 of the distinct words of answer and reference."""
    from foliospark.models import overlap_score

    p, r = overlap_score(F.col("answer"), F.col("reference")), overlap_score(F.col("reference"), F.col("answer"))
    return answers.select("sample_id", F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)).alias("answer_correctness"))


def answer_similarity(answers: DataFrame, embedder) -> DataFrame:
    """(sample_id, answer_similarity): cosine of the embedded answer and reference, 0 at least; null if one has no vector."""
    from foliospark.models import embed_column

    both = embed_column(embed_column(answers.select("sample_id", "answer", "reference"), embedder, text_col="answer", out="_a"), embedder, text_col="reference", out="_r")
    return both.select("sample_id", F.greatest(F.lit(0.0), cosine("_a", "_r")).alias("answer_similarity"))


METRICS = ("faithfulness", "answer_relevancy", "context_precision", "context_recall", "answer_correctness", "answer_similarity")


def summary(samples: DataFrame) -> DataFrame:
    """Means of the metric columns that samples has; nulls don't count."""
    have = [c for c in METRICS if c in samples.columns]
    return samples.agg(F.count("*").alias("n_samples"), *[F.avg(c).alias(c) for c in have])
