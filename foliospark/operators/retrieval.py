"""Retrieval: vector and graph context for a question, within token budgets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions.text import estimate_tokens, similarity
from foliospark.models import Embedder, embed_column, overlap_score
from foliospark.operators.graph import find_related_papers
from foliospark.operators.vectors import knn

#: Defaults of the retrieval configuration.
TOP_K, RERANK_TOP_K, MIN_SCORE, CONTEXT_TOKENS = 10, 5, 0.65, 3000
MAX_HOPS, NODES_PER_HOP, GRAPH_TOKENS, TOP_PAPERS = 2, 10, 2000, 5
CITATION_TYPES = ("BUILDS_ON", "COMPARES_TO")
DIRECT_TYPES = ("AUTHORED_BY", "AFFILIATED_WITH", "USES_DATASET", "PROPOSES_METHOD")


def rerank(results: DataFrame, query: str, *, top_k: int | None = RERANK_TOP_K, scorer=overlap_score, id_col: str = "chunk_id") -> DataFrame:
    """results with the scorer's score instead of theirs, best first, ties by id; top_k None keeps all."""
    scored = results.withColumn("score", scorer(F.lit(query), F.col("text"))).orderBy(F.desc("score"), id_col)
    return scored if top_k is None else scored.limit(top_k)


def retrieve(vectors: DataFrame, query: str, embedder: Embedder, *, top_k: int = TOP_K, rerank_top_k: int = RERANK_TOP_K, min_score: float = MIN_SCORE, filters: Mapping[str, object] | None = None, scorer=overlap_score) -> DataFrame:
    """Embeds the query, searches with filters, keeps vector scores of min_score or more, and reranks."""
    found = knn(vectors, embedder.embed([query])[0], top_k, filters=filters, min_score=min_score)
    return rerank(found, query, top_k=rerank_top_k, scorer=scorer)


def index_chunks(chunks: DataFrame, embedder: Embedder) -> DataFrame:
    """Vector rows of chunks: the last of each id by doc_id, with section_type, doc_id and page_numbers."""
    last = chunks.withColumn("_n", F.row_number().over(Window.partitionBy("chunk_id").orderBy(F.desc("doc_id"), F.desc("ordinal")))).where("_n = 1")
    rows = last.select("chunk_id", F.col("content").alias("text"), "section_type", "chunk_type", F.col("doc_id").alias("source_path"), "page_numbers")
    return embed_column(rows, embedder)


def within_budget(rows: DataFrame, budget: int, *, order: Sequence, group: Sequence[str] = (), tokens: str = "tokens") -> DataFrame:
    """The longest prefix in the order whose tokens sum to the budget at most, with rank and running total.

    A row has one token at least, so without groups only the first budget rows are ranked, and no more are gathered.
    """
    if not group:
        rows = rows.orderBy(*order).limit(budget)
    w = Window.partitionBy(*group).orderBy(*order) if group else Window.orderBy(*order)
    run = rows.withColumn("rank", F.row_number().over(w)).withColumn("total", F.sum(tokens).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return run.where(F.col("total") <= budget)


def format_context(results: DataFrame, *, budget: int = CONTEXT_TOKENS, headers: bool = True, group: Sequence[str] = ()) -> DataFrame:
    """One text (context) of ranked results (score, chunk_id, text, section_type); the lowest ranked are dropped first."""
    rows = results.withColumn("tokens", estimate_tokens("text"))
    kept = within_budget(rows, budget, order=[F.desc("score"), "chunk_id"], group=group)
    head = F.concat(F.lit("["), F.col("rank").cast("string"), F.lit("] "), F.coalesce("section_type", F.lit("unknown")), F.lit("\n")) if headers else F.lit("")
    parts = F.array_sort(F.collect_list(F.struct("rank", F.concat(head, "text").alias("x"))))  # within the budget
    return kept.groupBy(*group).agg(F.array_join(F.transform(parts, lambda p: p["x"]), "\n\n").alias("context"), F.count("*").alias("n_chunks"), F.max("total").alias("tokens"))


def neighbours(edges: DataFrame, paper: str, rel_types: Sequence[str] = DIRECT_TYPES) -> DataFrame:
    return edges.where(F.col("rel_type").isin(list(rel_types)) & (F.col("src_label") == "Paper") & (F.col("src_key") == paper))


def retrieve_for_paper(nodes: DataFrame, edges: DataFrame, paper: str, *, max_hops: int = MAX_HOPS, nodes_per_hop: int = NODES_PER_HOP) -> DataFrame:
    """Facts around a paper: (kind, rel_type, key, distance) of direct neighbours and cited papers."""
    direct = neighbours(edges, paper).select(F.lit("neighbour").alias("kind"), "rel_type", F.col("dst_key").alias("key"), F.lit(1).alias("distance"))
    cited = find_related_papers(nodes, edges, paper, max_hops=max_hops, rel_types=CITATION_TYPES, shortest=True, max_nodes_per_hop=nodes_per_hop)
    return direct.unionByName(cited.select(F.lit("related").alias("kind"), F.lit("BUILDS_ON|COMPARES_TO").alias("rel_type"), "key", "distance"))


def retrieve_by_concept(nodes: DataFrame, edges: DataFrame, concept: str, *, top_papers: int = TOP_PAPERS, least: float = 0.7) -> DataFrame:
    """(paper, method, score): papers that propose a method whose name holds the concept or is similar to it."""
    score = F.when(F.lower("key").contains(concept.lower()), F.lit(1.0)).otherwise(similarity(F.col("key"), F.lit(concept)))
    methods = nodes.where(F.col("label").isin("Method", "Concept")).select("label", F.col("key").alias("method"), score.alias("score")).where(F.col("score") >= least)
    links = edges.where(F.col("rel_type").isin("PROPOSES_METHOD", "ADDRESSES_CONCEPT")).select(F.col("src_key").alias("paper"), F.col("dst_label").alias("label"), F.col("dst_key").alias("method"))
    best = links.join(methods, ["label", "method"]).groupBy("paper").agg(F.max(F.struct("score", "method")).alias("x"))
    return best.select("paper", "x.method", "x.score").orderBy(F.desc("score"), "paper").limit(top_papers)


def comparison(edges: DataFrame, papers: Sequence[str]) -> DataFrame:
    """(label, item, n_papers, status): methods and datasets of the papers; shared by all, unique to one, or partial."""
    used = edges.where(F.col("rel_type").isin("PROPOSES_METHOD", "USES_DATASET") & F.col("src_key").isin(list(papers)))
    n = used.groupBy(F.col("dst_label").alias("label"), F.col("dst_key").alias("item")).agg(F.countDistinct("src_key").alias("n_papers"))
    status = F.when(F.col("n_papers") == len(set(papers)), "shared").when(F.col("n_papers") == 1, "unique").otherwise("partial")
    return n.withColumn("status", status)


#: Node labels from the most to the least important when a budget cuts.
PRIORITY = ("Paper", "Method", "Dataset", "Result", "Metric", "Author", "Institution")
PROSE = {"AUTHORED_BY": "was written by", "AFFILIATED_WITH": "works at", "USES_DATASET": "uses dataset", "PROPOSES_METHOD": "proposes method", "BUILDS_ON": "builds on", "COMPARES_TO": "compares to", "HAS_RESULT": "has result", "ON_DATASET": "is measured on", "USES_METRIC": "uses metric"}


def format_graph_context(nodes: DataFrame, edges: DataFrame, *, budget: int = GRAPH_TOKENS) -> DataFrame:
    """One text: nodes by type, then edges as sentences; less important types are dropped first."""
    rank = F.lit(len(PRIORITY))
    for i, label in enumerate(PRIORITY):
        rank = F.when(F.col("label") == label, i).otherwise(rank)
    verb = F.create_map(*[F.lit(x) for kv in PROSE.items() for x in kv])
    node_lines = nodes.select(rank.alias("p"), F.lit(0).alias("e"), F.concat_ws(" ", "label", "key").alias("line"))
    prose = F.concat_ws(" ", "src_label", "src_key", F.coalesce(verb[F.col("rel_type")], F.lower("rel_type")), "dst_label", "dst_key")
    edge_lines = edges.withColumn("label", F.col("dst_label")).select(rank.alias("p"), F.lit(1).alias("e"), F.concat(prose, F.lit(".")).alias("line"))
    rows = node_lines.unionByName(edge_lines).withColumn("tokens", estimate_tokens("line"))
    kept = within_budget(rows, budget, order=["p", "e", "line"])
    parts = F.array_sort(F.collect_list(F.struct("e", "p", "line")))
    return kept.agg(F.array_join(F.transform(parts, lambda x: x["line"]), "\n").alias("context"), F.coalesce(F.max("total"), F.lit(0)).alias("tokens"))


def hybrid_context(vector_context: DataFrame, graph_context: DataFrame) -> DataFrame:
    """Both contexts as one text with section headers."""
    a = vector_context.agg(F.concat(F.lit("## Retrieved passages\n\n"), F.coalesce(F.max("context"), F.lit(""))).alias("a"))  # one row each
    b = graph_context.agg(F.concat(F.lit("## Graph facts\n\n"), F.coalesce(F.max("context"), F.lit(""))).alias("b"))
    return a.crossJoin(b).select(F.concat_ws("\n\n", "a", "b").alias("context"))


def nodes_to_rows(nodes: DataFrame) -> DataFrame:
    return nodes.select(F.concat_ws(":", "label", "key").alias("id"), "label", "key", "props")
