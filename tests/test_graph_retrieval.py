import math
import random

import pytest
from pyspark.sql import functions as F

from foliospark.models import HashingEmbedder, embed_column, g_eval_score, sentences
from foliospark.operators import graph as G
from foliospark.operators import retrieval as R
from foliospark.operators import vectors as V
from foliospark.schemas import NODES
from foliospark.sources.registry import SchemaRegistry

WRITES = "label string, key string, props map<string,string>, seq int"
EDGE_WRITES = "rel_type string, src_label string, src_key string, dst_label string, dst_key string, props map<string,string>, seq int"


def edges_of(spark, *rows):
    full = [(f"e{i}", *r, {}) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, "edge_id string, rel_type string, src_label string, src_key string, dst_label string, dst_key string, props map<string,string>")


def papers(spark, *keys):
    return spark.createDataFrame([("Paper", k, {"title": f"t{k}"}) for k in keys], NODES)


def test_last_write_of_each_property_wins(spark):
    w = spark.createDataFrame([("Dataset", "a", {"description": "x", "u": "1"}, 1), ("Dataset", "a", {"description": ""}, 2), ("Result", None, {}, 3), ("Result", None, {}, 4)], WRITES)
    assert {(r["label"], r["key"]): r["props"] for r in G.upsert_nodes(w).collect()} == {("Dataset", "a"): {"description": "", "u": "1"}, ("Result", ""): {}}


def test_edges_need_both_ends_and_differ_by_properties(spark):
    nodes = spark.createDataFrame([("Paper", "p", {}), ("Author", "a", {})], NODES)
    row = lambda dst, order, seq: ("AUTHORED_BY", "Paper", "p", "Author", dst, {"order": order}, seq)
    w = spark.createDataFrame([row("a", "0", 1), row("a", "2", 2), row("a", "0", 3), row("gone", "1", 4)], EDGE_WRITES)
    assert sorted(r["props"]["order"] for r in G.upsert_edges(w, nodes).collect()) == ["0", "2"]
    assert [r["props"]["order"] for r in G.upsert_edges(w, nodes, update_props=True).collect()] == ["0"]


def test_trails(spark):
    chain = edges_of(spark, *[("BUILDS_ON", "Paper", str(i), "Paper", str(i + 1)) for i in (1, 2, 3)])
    nodes = papers(spark, "1", "2", "3", "4")
    got = [(r["key"], r["title"], r["distance"]) for r in G.find_related_papers(nodes, chain, "1", max_hops=3).collect()]
    assert got == [("2", "t2", 1), ("3", "t3", 2), ("4", "t4", 3)]
    both = edges_of(spark, ("BUILDS_ON", "Paper", "1", "Paper", "2"), ("AUTHORED_BY", "Paper", "1", "Author", "x"), ("AUTHORED_BY", "Paper", "2", "Author", "x"), ("USES_DATASET", "Paper", "3", "Dataset", "d"))
    assert [(r["key"], r["distance"]) for r in G.find_related_papers(nodes, both, "1").collect()] == [("2", 1), ("2", 2)]
    assert [(r["key"], r["distance"]) for r in G.find_related_papers(nodes, both, "1", shortest=True).collect()] == [("2", 1)]
    assert [(r["key"], r["distance"], len(r["path"])) for r in G.find_related_papers(nodes, both, "1", rel_types=["AUTHORED_BY"], paths=True).collect()] == [("2", 2, 2)]
    with pytest.raises(ValueError, match="max_hops"):
        G.find_related_papers(nodes, both, "1", max_hops=4)


def test_lookups_and_coauthors(spark):
    e = edges_of(spark, ("USES_DATASET", "Paper", "1", "Dataset", "ImageNet_1k"), ("USES_DATASET", "Paper", "2", "Dataset", "CIFAR"), ("PROPOSES_METHOD", "Paper", "1", "Method", "ViT"), ("AUTHORED_BY", "Paper", "1", "Author", "a"), ("AUTHORED_BY", "Paper", "1", "Author", "b"), ("AUTHORED_BY", "Paper", "1", "Author", "b"), ("AUTHORED_BY", "Paper", "2", "Author", "c"))
    nodes = papers(spark, "1", "2")
    assert [r["paper"] for r in G.find_papers_by_dataset(nodes, e, "net_").collect()] == ["1"]
    assert G.find_papers_by_dataset(nodes, e, "i%a").count() == 0
    assert [r["method"] for r in G.find_papers_by_method(nodes, e, "VIT").collect()] == ["ViT"]
    assert [(r["coauthor"], r["paths"]) for r in G.coauthors(e, "a").collect()] == [("b", 2)]
    G.register_views(nodes, e)
    assert spark.sql("SELECT count(*) AS n FROM edges JOIN nodes ON src_key = key").head()["n"] == 7
    assert [(r["item"], r["status"]) for r in R.comparison(e, ["1", "2"]).orderBy("item").collect()] == [("CIFAR", "unique"), ("ImageNet_1k", "unique"), ("ViT", "unique")]
    assert [(r["paper"], r["score"]) for r in R.retrieve_by_concept(spark.createDataFrame([("Method", "ViT", {})], NODES), e, "vit").collect()] == [("1", 1.0)]
    around = R.retrieve_for_paper(nodes, e, "1")
    assert around.where("kind = 'neighbour'").count() == 5


def test_schema_mapping_and_registry(spark, tmp_path):
    fields = spark.createDataFrame([("Datasets", "x"), ("zzz", "y")], "field_name string, field_value string")
    accepted, low = G.map_to_schema(fields, ["Paper", "Dataset", "Method"])
    assert [(r["field_name"], r["mapped_type"]) for r in accepted.collect()] == [("Datasets", "Dataset")]
    assert [(r["field_name"], len(r["candidate_types"])) for r in low.collect()] == [("zzz", 3)]
    path = str(tmp_path / "registry.json")
    SchemaRegistry(path).add_node_type("Concept", ["name"])
    again = SchemaRegistry(path)
    assert again.node_types["Concept"] == ["name"] and "Concept" not in SchemaRegistry().node_types
    assert "  USES_METRIC: no properties" in again.as_prompt() and "  Paper: arxiv_id, title" in again.as_prompt()


def test_vector_store(spark, tmp_path):
    store = V.get_vector_store("spark", spark, str(tmp_path), dim=4)
    rows = spark.createDataFrame([("abc123", "a", [0.1] * 4, {"section_type": "methodology"}, 1), ("def456", "b", [0.2] * 4, {"section_type": "experiments"}, 2), ("abc123", "a2", [0.1] * 4, {"section_type": "methodology"}, 3)], "chunk_id string, text string, embedding array<float>, metadata map<string,string>, seq int")
    assert (store.upsert(rows), store.count()) == (3, 2)
    assert [(r["chunk_id"], r["text"]) for r in store.search([0.1] * 4, 2).collect()] == [("abc123", "a2"), ("def456", "b")]  # a tie by id
    assert [r["chunk_id"] for r in store.search([0.1] * 4, 2, {"section_type": "experiments"}).collect()] == ["def456"]
    assert (store.delete(["abc123", "gone"]), store.count()) == (2, 1)
    with pytest.raises(ValueError, match="unknown vector store"):
        V.get_vector_store("other", spark, "x")
    with pytest.raises(Exception, match="expected 4 dimensions"):
        store.upsert(rows.withColumn("embedding", F.array(F.lit(1.0).cast("float"))))


def test_retrieval_context(spark):
    e = HashingEmbedder(dim=64)
    df = spark.createDataFrame([("1", "vision transformer attention", "methodology"), ("2", "graph database", "results"), ("3", "", "results"), ("4", None, "results")], "chunk_id string, text string, section_type string")
    vectors = embed_column(df, e)
    assert vectors.count() == 4
    assert [r["chunk_id"] for r in R.retrieve(vectors, "transformer attention", e, min_score=0.5).collect()] == ["1"]
    ranked = spark.createDataFrame([("a", "x" * 40, "s", 0.9), ("b", "y" * 40, None, 0.8), ("c", "z" * 40, "s", 0.7)], "chunk_id string, text string, section_type string, score double")
    r = R.format_context(ranked, budget=25).head()
    assert (r["n_chunks"], r["tokens"]) == (2, 20) and r["context"].startswith("[1] s\nxxx") and "[2] unknown\nyyy" in r["context"]
    nodes = papers(spark, "p1")
    g = R.format_graph_context(nodes, edges_of(spark, ("PROPOSES_METHOD", "Paper", "p1", "Method", "ViT")))
    assert g.head()["context"] == "Paper p1\nPaper p1 proposes method Method ViT."
    both = R.hybrid_context(R.format_context(ranked), g).head()["context"]
    assert both.index("## Retrieved passages") < both.index("## Graph facts")
    assert R.nodes_to_rows(nodes).head()["id"] == "Paper:p1"


def test_small_models(spark):
    df = spark.createDataFrame([("Score: 4",), ("I say 3/5.",), ("none",), (None,)], "c string")
    assert [r[0] for r in df.select(g_eval_score(F.col("c"))).collect()] == [4.0, 3.0, 1.0, 1.0]
    assert spark.range(1).select(sentences(F.lit("One. Two!  Three"))).head()[0] == ["One.", "Two!", "Three"]


@pytest.mark.parametrize("metric", ["cosine", "dot", "euclid"])
def test_batch_search_equals_brute_force_with_ties_and_odd_vectors(spark, metric):
    rng = random.Random(3)
    rows = [(i, [float(rng.randrange(-2, 3)) for _ in range(3)]) for i in range(400)] + [(400, None), (401, [1.0]), (402, [0.0, 0.0, 0.0]), (403, [1.0, None, 2.0])]
    asked = [(i, [float(rng.randrange(-2, 3)) + 0.1 for _ in range(3)]) for i in range(7)] + [(7, [5.0]), (8, None)]
    got = V.knn_batch(spark.createDataFrame(rows, "chunk_id long, embedding array<double>").repartition(5), spark.createDataFrame(asked, "query_id long, query_vec array<double>"), 6, metric=metric).collect()

    def score(a, b):
        if b is None or len(a) != len(b) or None in b:
            return None
        dot = sum(x * y for x, y in zip(a, b, strict=True))
        norm = math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(x * x for x in b))
        return dot if metric == "dot" else (dot / norm if norm else None) if metric == "cosine" else math.sqrt(sum((x - y) ** 2 for x, y in zip(a, b, strict=True)))

    sign = 1 if metric == "euclid" else -1
    for q, v in asked:
        scored = [(sign * round(s, 12), i) for i, x in rows if v is not None and (s := score(v, x)) is not None]
        want = [i for _, i in sorted(scored)[:6]]
        mine = sorted((r["rank"], r["chunk_id"]) for r in got if r["query_id"] == q)
        assert [round(r["score"], 9) for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])] == [round(sign * s, 9) for s, _ in sorted(scored)[:6]]
        assert len(mine) == len(want)
