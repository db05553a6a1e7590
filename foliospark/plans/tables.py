"""The driver's tables seen as blocks, partial extractions, vectors and a graph, by fixed rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliospark.functions.text import strip
from foliospark.schemas import PARTIAL

#: Headings that lines of documents stand for, by line number.
HEADINGS = ["Abstract", "1 Introduction", "2. Prior work", "3.1 Method", "A.1 Details", "BERT. Model", "Experimental results", "Attention", "Future work", "Acknowledgements", "References", "B.2 Appendix"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings")


def conversation_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation is a document and a turn a page of up to two blocks; types follow from the text's length."""
    n = F.length("text")
    first = F.when(n % 13 == 0, F.lit(None).cast("string")).when(n % 5 == 0, "SectionHeader").when(n % 5 == 1, "PageHeader").otherwise("Text")
    second = F.when(n % 11 == 0, "Figure").when(n % 11 == 1, "TableGroup").when(n % 11 == 2, "Equation").when(n % 11 == 3, "Picture")
    head = F.when(n % 3 == 0, F.lit(" References ")).otherwise(F.lit("Method"))
    content = F.when(first == "SectionHeader", head).otherwise(F.col("text"))
    blocks = F.array_compact(F.array(F.when(first.isNotNull(), F.struct(first.alias("t"), content.alias("c"))), F.when(second.isNotNull(), F.struct(second.alias("t"), F.lit("<img>").alias("c")))))
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", F.posexplode(blocks).alias("block_idx", "b"))
    return rows.select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page_idx"), F.col("turn").alias("page_number"), "block_idx", F.col("b.t").alias("block_type"), F.col("b.c").alias("content"))


def conversation_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page_idx"), F.col("turn").alias("page_number"))


def document_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents as blocks: every ninth is a heading of HEADINGS, some stand for figures, tables and equations."""
    i = F.col("block_idx")
    rows = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("block_idx", "line"))
    kind = F.when(i % 9 == 3, "SectionHeader").when(i % 7 == 6, "Figure").when(i % 11 == 10, "TableGroup").when(i % 13 == 12, "Equation").when(i % 17 == 16, "PageFooter").otherwise("Text")
    heading = F.element_at(F.array(*[F.lit(h) for h in HEADINGS]), (i % len(HEADINGS) + 1).cast("int"))
    page = F.floor(i / 8).cast("int")
    return rows.where(strip("line") != "").select("doc_id", page.alias("page_idx"), page.alias("page_number"), "block_idx", kind.alias("block_type"), F.when(kind == "SectionHeader", F.concat(F.lit("<h2>"), heading, F.lit("</h2>"))).otherwise(F.col("line")).alias("content"))


def partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation is a paper and a turn a page's partial extraction; values follow from the text."""
    n, turn = F.length("text"), F.col("turn")
    name = lambda prefix, k: F.concat(F.lit(prefix), (n % k).cast("string"))
    null = F.lit(None)
    metric = F.array(F.struct(F.lit("accuracy").alias("name"), (n % 140).cast("string").alias("value_raw"), *[null.cast("string").alias(c) for c in ("dataset", "split", "conditions")]))
    empty = lambda c: F.array().cast(PARTIAL[c].dataType)
    some = lambda cond, c, struct: F.when(cond, F.array(struct).cast(PARTIAL[c].dataType)).otherwise(empty(c))
    s = lambda **kv: F.struct(*[(v if v is not None else null.cast("string")).alias(k) for k, v in kv.items()])
    author = F.struct(name("author ", 9).alias("name"), F.array(name("place ", 4)).alias("affiliations"), null.cast("string").alias("email"), (turn == 0).alias("is_corresponding"))
    result = F.struct(name("method ", 5).alias("method_name"), metric.alias("metrics"), F.when(n % 2 == 0, name("data ", 8)).alias("dataset"), (n % 3 == 0).alias("is_proposed"))
    base = F.struct(name("method ", 3).alias("name"), null.cast("string").alias("citation"), metric.alias("metrics"), null.cast("string").alias("notes"))
    limit = F.struct(name("limit ", 6).alias("description"), F.lit("data").alias("type"), F.lit(True).alias("is_author_stated"))
    filled = n % 4 != 0
    conf = (n % 10) / F.lit(10.0)
    columns = {
        "title": F.when(filled & (n % 3 == 0), F.substring("text", 1, 20)).otherwise(F.lit(" ")),
        "problem_statement": F.when(filled & (turn > 0), F.substring("text", 5, 30)).otherwise(F.lit("")),
        "abstract": F.when(filled & (n % 5 == 0), F.col("text")),
        "conclusion_summary": F.when(filled & (n % 7 == 0), F.col("role")),
        "arxiv_id": F.when(n % 6 == 0, F.lit("2301.00001")),
        "authors": some(filled, "authors", author),
        "institutions": some(F.lit(True), "institutions", s(name=name("place ", 3), department=None, country=None)),
        "datasets": some(filled & (n % 2 == 0), "datasets", s(name=name("data ", 6), description=None, size=None, source_url=None, split_info=None)),
        "methods": some(filled & (n % 3 == 1), "methods", F.struct(name("method ", 5).alias("name"), name("d", 2).alias("description"), null.cast("string").alias("novelty"), F.array().cast("array<string>").alias("components"))),
        "results": some(filled, "results", result),
        "baselines": some(filled & (n % 3 == 2), "baselines", base),
        "limitations": some(filled & (n % 5 == 3), "limitations", limit),
    }
    fields = [f.name for f in PARTIAL["field_confidence"].dataType.fields]
    rows = read(spark, sf_dir, "conversations").where("text IS NOT NULL")
    return rows.select(F.col("conv_id").cast("string").alias("doc_id"), turn.cast("int").alias("partial_idx"), *[c.alias(k) for k, c in columns.items()], conf.alias("extraction_confidence"), F.struct(*[(conf * F.lit(1.0 if f == "title" else 0.5)).alias(f) for f in fields]).alias("field_confidence"))


def graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders are papers, suppliers authors, parts datasets, part types methods, nations institutions."""
    empty = F.create_map().cast("map<string,string>")
    prop = lambda k, v: F.create_map(F.lit(k), v)
    node = lambda df, label, key, p: df.select(F.lit(label).alias("label"), key.cast("string").alias("key"), p.alias("props"))
    out = node(read(spark, sf_dir, "orders"), "Paper", F.col("o_orderkey"), prop("title", F.concat(F.lit("order "), F.col("o_orderkey").cast("string"))))
    out = out.unionByName(node(read(spark, sf_dir, "supplier"), "Author", F.col("s_suppkey"), prop("email", F.col("s_name"))))
    out = out.unionByName(node(read(spark, sf_dir, "part"), "Dataset", F.concat_ws("#", "p_name", "p_partkey"), prop("description", F.col("p_brand"))))
    out = out.unionByName(node(read(spark, sf_dir, "part").select("p_type").distinct(), "Method", F.col("p_type"), empty))
    return out.unionByName(node(read(spark, sf_dir, "nation"), "Institution", F.col("n_name"), empty))


def graph_edges(spark: SparkSession, sf_dir: str, *types: str) -> DataFrame:
    """AUTHORED_BY with order, USES_DATASET, PROPOSES_METHOD from line items; BUILDS_ON to a customer's last order."""
    lines, parts = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "part")
    typed = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    paper = F.col("l_orderkey").cast("string").alias("a")
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    chain = read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("a"), F.lag("o_orderkey").over(w).cast("string").alias("b"), F.lit("").alias("o"))
    made = {
        "AUTHORED_BY": ("Author", lines.select(paper, F.col("l_suppkey").cast("string").alias("b"), F.col("l_linenumber").cast("string").alias("o")).distinct()),
        "USES_DATASET": ("Dataset", typed.select(paper, F.concat_ws("#", "p_name", "p_partkey").alias("b"), F.lit("").alias("o")).distinct()),
        "PROPOSES_METHOD": ("Method", typed.select(paper, F.col("p_type").alias("b"), F.lit("").alias("o")).distinct()),
        "BUILDS_ON": ("Paper", chain.where("b IS NOT NULL")),
    }
    out = None
    for rel in types:
        label, df = made[rel]
        props = F.create_map(F.lit("order"), F.col("o")) if rel == "AUTHORED_BY" else F.create_map().cast("map<string,string>")
        part = df.select(F.concat_ws("|", F.lit(rel), "a", "b", "o").alias("edge_id"), F.lit(rel).alias("rel_type"), F.lit("Paper").alias("src_label"), F.col("a").alias("src_key"), F.lit(label).alias("dst_label"), F.col("b").alias("dst_key"), props.alias("props"))
        out = part if out is None else out.unionByName(part)
    return out
