"""A labelled property graph in two DataFrames: building it from extractions, and reading it.

nodes(label, key, props map), edges(edge_id, rel_type, src_label, src_key, dst_label, dst_key, props map).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions.text import is_blank, short_hash, similarity

EDGE_COLS = ["rel_type", "src_label", "src_key", "dst_label", "dst_key"]


def upsert_nodes(writes: DataFrame) -> DataFrame:
    """Nodes after writes (label, key, props, seq): the last write of each property wins, an empty string too.

    Nodes without properties stay. A missing key is the empty string, so all such nodes of a label are one.
    """
    rows = writes.select("label", F.coalesce("key", F.lit("")).alias("key"), "props", "seq")
    nodes = rows.groupBy("label", "key").agg(F.count("*").alias("_n")).drop("_n")
    values = rows.select("label", "key", "seq", F.explode("props").alias("p", "v")).groupBy("label", "key", "p").agg(F.max_by("v", "seq").alias("v"))
    maps = values.groupBy("label", "key").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("p", "v")))).alias("props"))  # a node's properties
    empty = F.create_map().cast("map<string,string>")
    return nodes.join(maps, ["label", "key"], "left").withColumn("props", F.coalesce("props", empty))


def _sorted_props(props) -> F.Column:
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(F.coalesce(props, F.create_map().cast("map<string,string>"))))))


def upsert_edges(writes: DataFrame, nodes: DataFrame, *, update_props: bool = False) -> DataFrame:
    """Edges after writes (EDGE_COLS, props, seq): one for each distinct set of properties, none without both ends.

    update_props: one edge for each pair of ends and type instead, with the last write's properties.
    """
    ends = nodes.select("label", "key").distinct()
    found = writes.join(ends.select(F.col("label").alias("src_label"), F.col("key").alias("src_key")), ["src_label", "src_key"], "left_semi")
    found = found.join(ends.select(F.col("label").alias("dst_label"), F.col("key").alias("dst_key")), ["dst_label", "dst_key"], "left_semi")
    found = found.withColumn("_p", _sorted_props(F.col("props")))
    if update_props:
        found = found.groupBy(*EDGE_COLS).agg(F.max_by("_p", "seq").alias("_p"))
    rows = found.select(*EDGE_COLS, "_p").distinct()
    return rows.select(F.sha1(F.to_json(F.struct(*EDGE_COLS, "_p"))).alias("edge_id"), *EDGE_COLS, F.from_json("_p", "map<string,string>").alias("props"))


def paper_key(arxiv_id, title) -> F.Column:
    """The arXiv id, or the hash of the title without one."""
    return F.when(F.coalesce(arxiv_id, F.lit("")) != "", arxiv_id).otherwise(short_hash(title, 12))


def paper_writes(extractions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node writes, edge writes) of papers, authors with affiliations, datasets and methods; seq orders them.

    extractions: doc_id, arxiv_id, title, abstract, problem_statement, authors, datasets, methods and seq.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    props = lambda **kv: F.create_map(*[x for k, v in kv.items() for x in (F.lit(k), v)])
    papers = extractions.withColumn("paper", paper_key(F.col("arxiv_id"), F.col("title")))
    node = lambda df, label, key, p: df.select(F.lit(label).alias("label"), key.alias("key"), p.alias("props"), "seq")
    edge = lambda df, rel, sl, sk, dl, dk, p=None: df.select(
        F.lit(rel).alias("rel_type"), F.lit(sl).alias("src_label"), sk.alias("src_key"), F.lit(dl).alias("dst_label"), dk.alias("dst_key"), (F.create_map().cast("map<string,string>") if p is None else p).alias("props"), "seq"
    )
    authors = papers.select("paper", "seq", F.posexplode("authors").alias("order", "a"))
    places = authors.select("seq", F.col("a.name").alias("author"), F.explode("a.affiliations").alias("place"))
    named = {"Dataset": ("datasets", "USES_DATASET"), "Method": ("methods", "PROPOSES_METHOD")}
    nodes = node(papers, "Paper", F.col("paper"), props(title=text("title"), abstract=text("abstract"), problem_statement=text("problem_statement")))
    nodes = nodes.unionByName(node(authors, "Author", F.col("a.name"), props(email=text("a.email"))))
    nodes = nodes.unionByName(node(places, "Institution", F.col("place"), props(country=F.lit(""))))
    edges = edge(authors, "AUTHORED_BY", "Paper", F.col("paper"), "Author", F.col("a.name"), props(order=F.col("order").cast("string")))
    edges = edges.unionByName(edge(places, "AFFILIATED_WITH", "Author", F.col("author"), "Institution", F.col("place")))
    for label, (column, rel) in named.items():
        items = papers.select("paper", "seq", F.explode(column).alias("x"))
        nodes = nodes.unionByName(node(items, label, F.col("x.name"), props(description=text("x.description"))))
        edges = edges.unionByName(edge(items, rel, "Paper", F.col("paper"), label, F.col("x.name")))
    return nodes, edges


def map_to_schema(fields: DataFrame, types: Sequence[str], *, threshold: float = 0.7) -> tuple[DataFrame, DataFrame]:
    """(accepted, escalated) of fields (field_name, field_value): the nearest registered type by edit distance.

    A field at or above the threshold gets mapped_type; others go to people with up to three candidates.
    """
    candidates = F.array(*[F.struct(similarity(F.col("field_name"), F.lit(t)).alias("score"), F.lit(t).alias("type")) for t in types])
    ranked = F.reverse(F.array_sort(candidates))
    scored = fields.withColumn("_r", ranked).withColumn("mapped_type", F.get("_r", 0)["type"]).withColumn("confidence", F.get("_r", 0)["score"])
    accepted = scored.where(F.col("confidence") >= threshold).drop("_r")
    low = scored.where(F.col("confidence") < threshold)
    names = F.transform(F.slice("_r", 1, 3), lambda x: x["type"])
    return accepted, low.select("field_name", F.col("field_value").cast("string").alias("field_value"), names.alias("candidate_types"), "confidence", F.lit("confidence below threshold").alias("reason"))


def _both_ways(edges: DataFrame) -> DataFrame:
    out = edges.select("edge_id", F.col("src_label").alias("l"), F.col("src_key").alias("k"), F.col("dst_label").alias("l2"), F.col("dst_key").alias("k2"))
    back = edges.where("NOT (src_label = dst_label AND src_key = dst_key)").select("edge_id", F.col("dst_label").alias("l"), F.col("dst_key").alias("k"), F.col("src_label").alias("l2"), F.col("src_key").alias("k2"))
    return out.unionByName(back)


def find_related_papers(nodes: DataFrame, edges: DataFrame, key: str, *, max_hops: int = 2, rel_types: Sequence[str] | None = None, shortest: bool = False, paths: bool = False, max_nodes_per_hop: int | None = None) -> DataFrame:
    """(key, title, distance): papers within max_hops edges, any direction and label between, the paper itself not.

    A path uses no edge twice. A paper can stand at several distances; shortest keeps the least. rel_types: None for
    any. paths: adds the edge ids of one path. max_nodes_per_hop: keeps that many nodes of each hop, by key. With
    shortest a node goes on from its least distance only, with one path, so hubs don't multiply paths.
    """
    if not 1 <= max_hops <= 3:
        raise ValueError("max_hops is 1 to 3")
    chosen = edges if rel_types is None else edges.where(F.col("rel_type").isin(list(rel_types)))
    steps = _both_ways(chosen)
    front = steps.where((F.col("l") == "Paper") & (F.col("k") == F.lit(key))).select(F.col("l2").alias("l"), F.col("k2").alias("k"), F.array("edge_id").alias("path"))
    hops = []
    for hop in range(1, max_hops + 1):
        if hop > 1:
            nxt = front.join(steps, ["l", "k"]).where(~F.array_contains("path", F.col("edge_id")))
            front = nxt.select(F.col("l2").alias("l"), F.col("k2").alias("k"), F.concat("path", F.array("edge_id")).alias("path"))
        if shortest:  # the nodes that no hop before has met, with their first path
            front = front.groupBy("l", "k").agg(F.min("path").alias("path"))
            front = front.where((F.col("l") != "Paper") | (F.col("k") != F.lit(key)))
            front = front.join(met, ["l", "k"], "left_anti") if hop > 1 else front
        if max_nodes_per_hop is not None:
            first = front.select("l", "k").distinct().orderBy("l", "k").limit(max_nodes_per_hop)
            front = front.join(F.broadcast(first), ["l", "k"], "left_semi")
        if shortest:
            met = front.select("l", "k") if hop == 1 else met.unionByName(front.select("l", "k"))
        if hop == max_hops and not paths:
            front = front.select("l", "k").distinct().withColumn("path", F.lit(None).cast("array<string>"))
        hops.append(front.where("l = 'Paper'").where(F.col("k") != F.lit(key)).groupBy("k").agg(F.min("path").alias("path")).withColumn("distance", F.lit(hop)))
    found = hops[0]
    for h in hops[1:]:
        found = found.unionByName(h)
    if shortest:
        found = found.groupBy("k").agg(F.min_by("path", "distance").alias("path"), F.min("distance").alias("distance"))
    titles = nodes.where("label = 'Paper'").select(F.col("key").alias("k"), F.col("props")["title"].alias("title"))
    out = found.join(titles, "k").select(F.col("k").alias("key"), "title", "distance", *(["path"] if paths else []))
    return out.orderBy("distance", "key")


def _papers_by(edges: DataFrame, nodes: DataFrame, rel: str, label: str, text: str) -> DataFrame:
    hits = edges.where((F.col("rel_type") == rel) & (F.col("dst_label") == label)).where(F.lower("dst_key").contains(text.lower()))
    titles = nodes.where("label = 'Paper'").select(F.col("key").alias("src_key"), F.col("props")["title"].alias("title"))
    return hits.join(titles, "src_key").select(F.col("src_key").alias("paper"), "title", F.col("dst_key").alias(label.lower()))


def find_papers_by_dataset(nodes: DataFrame, edges: DataFrame, text: str) -> DataFrame:
    """A row for each edge to a dataset whose name holds the text, ignoring case; the text is literal."""
    return _papers_by(edges, nodes, "USES_DATASET", "Dataset", text)


def find_papers_by_method(nodes: DataFrame, edges: DataFrame, text: str) -> DataFrame:
    return _papers_by(edges, nodes, "PROPOSES_METHOD", "Method", text)


def coauthors(edges: DataFrame, author: str) -> DataFrame:
    """(coauthor, paths): authors who share a paper, with the number of paths between, most first, ties by name."""
    wrote = edges.where("rel_type = 'AUTHORED_BY'").select("edge_id", F.col("src_key").alias("paper"), F.col("dst_key").alias("author"))
    mine = wrote.where(F.col("author") == author).select("paper", F.col("edge_id").alias("own"))
    pairs = wrote.join(mine, "paper").where((F.col("edge_id") != F.col("own")) & (F.col("author") != author))
    return pairs.groupBy(F.col("author").alias("coauthor")).agg(F.count("*").alias("paths")).orderBy(F.desc("paths"), "coauthor")


def write_graph(nodes: DataFrame, edges: DataFrame, folder: str) -> None:
    """Parquet with labels and edge types as partitions, so that reads of one type prune the rest."""
    nodes.write.mode("overwrite").partitionBy("label").parquet(f"{folder}/nodes")
    edges.write.mode("overwrite").partitionBy("rel_type").parquet(f"{folder}/edges")


def register_views(nodes: DataFrame, edges: DataFrame) -> None:
    """Views nodes and edges for SQL text; there is no Cypher parser."""
    nodes.createOrReplaceTempView("nodes")
    edges.createOrReplaceTempView("edges")


def drop_blank_keys(writes: DataFrame) -> DataFrame:
    """Option for strict graphs: node writes whose key isn't blank."""
    return writes.where(~is_blank("key"))
