import pytest
from pyspark.sql import functions as F
from test_extraction import frame, named, partial

from foliospark.api import Workspace
from foliospark.operators import evaluation as A
from foliospark.operators import extraction as E
from foliospark.schemas import BLOCKS, PAPER_META
from foliospark.sources import papers as P
from foliospark.streaming import ingest as S


def metric(name, value):
    return {"name": name, "value_raw": value, "dataset": None, "split": None, "conditions": None}


@pytest.fixture
def merged(spark):
    rows = [
        partial("d", 0, title="T", problem_statement="Models fail. Nobody knows why aliens dance.", arxiv_id="2301.00001", extraction_confidence=0.5,
                authors=[named("Ann Lee", "authors", affiliations=["MIT", "Nowhere College"]), named("ann lee ", "authors", affiliations=[])],
                institutions=[named("M.I.T", "institutions"), named("MIT", "institutions")], datasets=[named("ImageNet"), named("ImageNets")], methods=[named("ViT", "methods", description="m")],
                results=[{"method_name": "old", "metrics": [metric("accuracy", "120"), metric("BLEU", "0.4"), metric("perplexity", "-1"), metric("accuracy", "91.2%")], "dataset": "CIFAR", "is_proposed": False}]),
        partial("e", 0, title="U", problem_statement="p"),
    ]
    return E.merge_extractions(frame(spark, rows))


def test_consistency(spark, merged):
    found = A.inconsistencies(merged)
    assert sorted((r["inconsistency_type"], r["value"]) for r in found.collect()) == [
        ("author_institution_mismatch", "Nowhere College"), ("dataset_result_mismatch", "CIFAR"), ("duplicate_entry", "ann lee"), ("impossible_value", "accuracy=120"),
        ("impossible_value", "perplexity=-1"), ("metric_baseline_conflict", "old"), ("metric_conflict", "old/accuracy"), ("near_duplicate_entry", "imagenet ~ imagenets"),
    ]
    assert {r["doc_id"]: r["score"] for r in A.consistency_report(merged, found).collect()} == {"d": 0.0, "e": 1.0}
    s = spark.createDataFrame([(0.3,), (0.4,)], "s double")
    assert s.agg(A.consistency_score(F.sum("s"))).head()[0] == 1.0 - (0.3 + 0.4)


def test_hallucination(spark, merged):
    sources = spark.createDataFrame([("d", "Ann Leee shows models fail on imagenet with 0.912 and 1.2 points")], "doc_id string, source_text string")
    checks = A.hallucination_checks(merged, sources)
    got = {(r["hallucination_type"], r["flagged_value"]): r["supported"] for r in checks.collect()}
    assert got[("fabricated_metric", "91.2%")] and got[("fabricated_metric", "120")] and not got[("fabricated_metric", "0.4")]
    assert got[("fabricated_author", "Ann Lee")] and got[("fabricated_dataset", "ImageNet")] and not got[("fabricated_dataset", "ImageNets")]
    assert got[("unsupported_claim", "Models fail.")] is False  # one of its two words is in the source; "fail." is not
    assert not got[("unsupported_claim", "Nobody knows why aliens dance.")]
    r = {x["doc_id"]: x for x in A.hallucination_report(merged, checks).collect()}
    assert r["e"]["hallucination_rate"] == 0.0 and 0 < r["d"]["hallucination_rate"] < 1
    assert spark.range(1).select(A.rate(F.lit(2), F.lit(8)), A.rate(F.lit(0), F.lit(0))).head()[:] == (0.25, 0.0)


def test_rag_scores(spark):
    samples = spark.createDataFrame([(1, "Cats sleep. Dogs fly.", "cats sleep. all day", "cats sleep"), (2, "", "x", "y")], "sample_id int, answer string, context string, reference string")
    f = {r["sample_id"]: r["faithfulness"] for r in A.faithfulness(samples).collect()}
    assert f == {1: 0.5, 2: None}
    c = {r["sample_id"]: r["answer_correctness"] for r in A.answer_correctness(samples).collect()}
    assert 0 < c[1] < 1 and c[2] == 0.0
    q = spark.createDataFrame([(1, [1.0, 0.0], [1.0, 0.0]), (1, [0.0, 1.0], [1.0, 0.0])], "sample_id int, generated array<double>, asked array<double>")
    assert A.answer_relevancy(q).head()["answer_relevancy"] == 0.5
    s = A.summary(A.faithfulness(samples)).head()
    assert (s["n_samples"], s["faithfulness"]) == (2, 0.5)
    fields = A.field_scores(spark.createDataFrame([("d", "title", "Score: 5"), ("d", "title", "4/5"), ("d", "results", "?")], "doc_id string, field_name string, completion string"))
    assert A.overall_score(fields).head()["overall"] == pytest.approx((0.9 + 2 * 0.2) / 3)


def test_workspace(spark, tmp_path, merged):
    w = Workspace(spark, str(tmp_path / "w"))
    words = " ".join(f"word{i}" for i in range(40))
    blocks = spark.createDataFrame([("d", 0, 0, 0, "SectionHeader", "Method"), ("d", 0, 0, 1, "Text", words), ("e", 0, 0, 0, "Text", "short")], BLOCKS)
    status = lambda df: sorted((r["doc_id"], r["status"]) for r in df.collect())
    assert status(w.ingest(blocks)) == [("d", "completed"), ("e", "completed")]
    assert status(w.ingest(blocks)) == [("d", "already_exists"), ("e", "already_exists")]
    assert status(w.ingest(blocks, force=True)) == [("d", "completed"), ("e", "completed")]
    assert w.read("chunks").count() == 1
    assert [r["source_path"] for r in w.search("word1 word2 word3", filters={"section_type": "methodology"}).collect()] == ["d"]
    for bad in (lambda: w.search("ab"), lambda: w.search("abc", top_k=51), lambda: w.related("x", max_hops=4), lambda: w.extract("x", ["nope"])):
        with pytest.raises(ValueError):
            bad()
    assert w.health() == {"status": "ok"}


def test_workspace_keeps_tables_apart_and_failed_writes_out(spark, tmp_path):
    words = lambda k: " ".join(f"word{k}n{i}" for i in range(40))
    block = lambda d, k: (d, 0, 0, 0, "Text", words(k))

    class Failing:
        def embed(self, texts):
            raise RuntimeError("no model")

    w = Workspace(spark, str(tmp_path / "w"))
    blocks = spark.createDataFrame([block(str(k), k) for k in range(5)], BLOCKS)
    assert {r["status"] for r in w.submit(blocks).collect()} == {"queued"}
    broken = Workspace(spark, str(tmp_path / "w"), Failing())
    with pytest.raises(Exception, match="no model"):
        broken.ingest(blocks)
    assert w.read("chunks").count() == 0
    w.ingest(blocks)
    assert (w.read("chunks").count(), w.read("vectors").count()) == (5, 5)
    assert {r["status"] for r in w.submit(blocks).collect()} == {"already_exists"}
    rows = [partial(d, 0, title=f"T{d}", problem_statement="p", arxiv_id=f"2301.0000{d}") for d in "12"]
    w.add_extractions(frame(spark, rows))
    assert (w.read("chunks").count(), w.read("vectors").count(), w.read("extractions").count()) == (5, 5, 2)
    assert [r["source_path"] for r in w.search(words(1)).collect()][0] == "1"
    w.ingest(blocks.where("doc_id = '1'"), force=True)
    assert w.paper("2301.00001")["title"] == "T1"
    assert (w.read("chunks").count(), w.read("vectors").count()) == (5, 5)
    w.ingest(spark.createDataFrame([block("9", 1)], BLOCKS))  # the same chunk id again: the last write has it
    assert (w.read("chunks").count(), w.read("vectors").count()) == (6, 5)
    assert [r["source_path"] for r in w.search(words(1)).collect()][0] == "9"


def test_workspace_extractions(spark, tmp_path):
    w = Workspace(spark, str(tmp_path / "x"))
    rows = [partial(d, 0, title=f"T{d}", problem_statement="p", arxiv_id=f"2301.0000{d}", datasets=[named("ImageNet")], authors=[named("Ann", "authors", affiliations=["MIT"])]) for d in "12"]
    assert w.add_extractions(frame(spark, [*rows, partial("3", 0)])).count() == 1
    assert w.paper("2301.00001")["title"] == "T1"
    with pytest.raises(KeyError):
        w.paper("2301.99999")
    assert w.extract("2301.00002", ["title"]).head().asDict() == {"title": "T2"}
    assert [(r["key"], r["distance"]) for r in w.related("2301.00001").collect()] == [("2301.00002", 2)]
    sources = spark.createDataFrame([("1", "Ann p ImageNet")], "doc_id string, source_text string")
    assert w.evaluate(sources).count() == 2


def test_streams(spark, tmp_path):
    blocks = spark.createDataFrame([("d", 0, 0, 0, "Text", " ".join("x" * 40))], BLOCKS)
    blocks.write.parquet(str(tmp_path / "in"))
    w = Workspace(spark, str(tmp_path / "w"))
    for _ in range(2):
        S.ingest_stream(S.stream_blocks(spark, str(tmp_path / "in")), w, str(tmp_path / "c")).awaitTermination(120)
    assert w.read("chunks").count() == 1
    events = spark.readStream.schema(spark.read.parquet("/root/testdata/sf0.001/events.parquet").schema).parquet("/root/testdata/sf0.001/events.parquet*")
    q = S.event_windows(events).writeStream.format("memory").queryName("event_windows").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.sql("SELECT sum(n) AS n FROM event_windows").head()["n"] == 1000


def test_paper_sources(spark, tmp_path):
    rows = [("2301.00001", "Graph nets", ["A"], "about graphs", ["cs.LG"], None, "2023-01-02T00:00:00Z", None, None), ("2301.00002", "Vision", ["B"], "graph of pixels", ["cs.CV", "cs.LG"], None, "2023-02-01T00:00:00Z", None, None)]
    papers = spark.createDataFrame(rows, PAPER_META)
    ids = lambda df: [r["arxiv_id"] for r in df.collect()]
    assert ids(P.search(papers, "graph")) == ["2301.00001", "2301.00002"]
    assert P.fetch_by_id(papers, "2301.00002v3")["title"] == "Vision"
    with pytest.raises(ValueError, match="no paper"):
        P.fetch_by_id(papers, "2301.00009")
    assert ids(P.fetch_by_ids(papers, ["2301.00002", "2301.00001v1"])) == ["2301.00002", "2301.00001"]
    assert ids(P.by_category(papers, "cs.LG", "2023-02-01", "2023-02-01")) == ["2301.00002"]
    files = spark.createDataFrame([("/x/2301.00001.pdf",)], "path string")
    assert ids(P.to_download(papers, files)) == ["2301.00002"]
    feed = tmp_path / "feed.xml"
    feed.write_text('<feed><entry><id>http://arxiv.org/abs/2301.00003v1</id><title>A\n  B</title><summary> s </summary><published>2023-01-01T00:00:00Z</published><author><name>N</name></author><category term="cs.AI"/><link href="http://x/pdf" title="pdf"/></entry></feed>')
    r = P.read_feed(spark, str(feed)).head()
    assert (r["arxiv_id"], r["title"], r["authors"], r["abstract"], r["categories"], r["pdf_url"]) == ("2301.00003", "A B", ["N"], "s", ["cs.AI"], "http://x/pdf")
    papers.write.json(str(tmp_path / "meta"))
    q = S.stream_category(spark, str(tmp_path / "meta"), "cs.CV", "2023-01-01", "2023-12-31").writeStream.format("memory").queryName("category").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert ids(spark.table("category")) == ["2301.00002"]
    chunks = spark.createDataFrame([("d", "c", "s", "results", "text", "x", [1], 1, None, 1)], "doc_id string, chunk_id string, section string, section_type string, chunk_type string, content string, page_numbers array<int>, word_count int, block_type string, ordinal int")
    P.save_chunks(chunks, str(tmp_path / "chunks"))
    assert P.load_chunks(spark, str(tmp_path / "chunks")).head()["page_numbers"] == [1]
