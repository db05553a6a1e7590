import json
import random

import pytest
from pyspark.sql import functions as F

from foliospark.operators import extraction as E
from foliospark.schemas import CONFIDENCE_FIELDS, LISTS, PARTIAL, SCALARS


def partial(doc, idx, **values):
    row = {"doc_id": doc, "partial_idx": idx, **dict.fromkeys(SCALARS, ""), **{c: [] for c in LISTS}, "extraction_confidence": 0.0, "field_confidence": dict.fromkeys(CONFIDENCE_FIELDS, 0.0)}
    return row | values


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in PARTIAL.names) for r in rows], PARTIAL)


def named(name, kind="datasets", **more):
    fields = [f.name for f in PARTIAL[kind].dataType.elementType.fields]
    return {f: None for f in fields} | {"name": name} | more


def test_merge_of_two_partials(spark):
    rows = [
        partial("d", 0, title="An Image is Worth 16x16 Words", authors=[named("Dosovitskiy", "authors", affiliations=["Google Brain"])], datasets=[named("ImageNet")], extraction_confidence=0.9, field_confidence=dict.fromkeys(CONFIDENCE_FIELDS, 0.0) | {"title": 0.95, "authors": 0.9}),
        partial("d", 1, problem_statement="CNNs dominate vision", datasets=[named("CIFAR-10"), named("ImageNet")], methods=[named("ViT", "methods")], extraction_confidence=0.7, field_confidence=dict.fromkeys(CONFIDENCE_FIELDS, 0.0) | {"datasets": 0.8}),
    ]
    r = E.merge_extractions(frame(spark, rows)).head()
    assert (r["title"], r["problem_statement"], r["abstract"], r["arxiv_id"]) == ("An Image is Worth 16x16 Words", "CNNs dominate vision", None, None)
    assert [x["name"] for x in r["authors"]] == ["Dosovitskiy"]
    assert [x["name"] for x in r["datasets"]] == ["ImageNet", "CIFAR-10"]
    assert [x["name"] for x in r["methods"]] == ["ViT"]
    assert r["extraction_confidence"] == pytest.approx(0.8)
    assert (r["field_confidence"]["title"], r["field_confidence"]["datasets"], r["field_confidence"]["results"]) == (0.95, 0.8, 0.0)
    assert (r["pages_processed"], r["pages_with_content"], r["merge_strategy"]) == (2, 2, "union")


def model(rows, strategy):
    """A plain scan over ordered partials."""
    full = [r for r in rows if any(r[c] for c in (*E.FILLING_SCALARS, *E.FILLING_LISTS))] or rows
    pick = lambda c: ([v for v in (r[c] for r in full) if v and v.strip()] or [""])[-1 if strategy == "last_wins" else 0]
    out = {c: pick(c) for c in SCALARS}
    for c in LISTS:
        seen = {}
        for r in full:
            for x in r[c]:
                if c == "results":
                    key = f"{x['method_name']}_{x['dataset']}"
                elif c == "limitations":
                    key = x["description"]
                else:
                    key = x["name"] or (x["description"] if "description" in x else json.dumps(x))
                seen.setdefault(key, x)
        out[c] = [x.get("name", x.get("method_name", x.get("description"))) for x in seen.values()]
    conf = [r["extraction_confidence"] for r in full if r["extraction_confidence"] > 0]
    return out, (sum(conf) / len(conf) if conf else 0.0), (len(rows), len(full))


@pytest.mark.parametrize("strategy", ["union", "last_wins"])
def test_merge_equals_a_scan(spark, strategy):
    rng, docs = random.Random(3), {}
    for d in range(80):
        docs[str(d)] = [
            partial(
                str(d), i,
                title=rng.choice(["", " ", "　", "t1", "t2"]), abstract=rng.choice([None, "", "a"]), arxiv_id=rng.choice(["", "2301.00001"]), conclusion_summary=rng.choice([None, "", "\t"]),
                institutions=[named("i", "institutions")] if rng.random() < 0.3 else [],
                datasets=[named(rng.choice(["a", "b", ""]), description=rng.choice(["x", "y"])) for _ in range(rng.choice([0, 0, 2]))],
                results=[{"method_name": rng.choice(["a", "a_b"]), "metrics": [], "dataset": rng.choice([None, "c", "b_c", "None"]), "is_proposed": True} for _ in range(rng.choice([0, 0, 2]))],
                limitations=[{"description": rng.choice("pq"), "type": "other", "is_author_stated": True}] if rng.random() < 0.3 else [],
                extraction_confidence=rng.choice([0.0, 0.5, 0.25]),
            )
            for i in range(rng.randrange(1, 6))
        ]
    rows = [r for rs in docs.values() for r in rs]
    rng.shuffle(rows)
    got = {r["doc_id"]: r for r in E.merge_extractions(frame(spark, rows), strategy=strategy).collect()}
    assert len(got) == len(docs)
    for d, rs in docs.items():
        want, conf, pages = model(rs, strategy)
        r = got[d]
        for c in SCALARS:
            assert (r[c] or "") == want[c], (d, c)
        for c in LISTS:
            assert [x["name"] if "name" in x.asDict() else x.asDict().get("method_name", x.asDict().get("description")) for x in r[c]] == want[c], (d, c)
        assert r["extraction_confidence"] == pytest.approx(conf)
        assert (r["pages_processed"], r["pages_with_content"]) == pages


def test_validation(spark):
    rows = [partial("ok", 0, title="　 t ", problem_statement="p", extraction_confidence=0.5), partial("t", 0, title=" ", problem_statement="p"), partial("p", 0, title="t"), partial("c", 0, title="t", problem_statement="p", extraction_confidence=1.5)]
    good, bad = E.validate(E.merge_extractions(frame(spark, rows)))
    assert [(r["doc_id"], r["title"]) for r in good.collect()] == [("ok", "t")]
    assert {r["doc_id"]: r["reason"].split()[0] for r in bad.collect()} == {"t": "title", "p": "problem_statement", "c": "extraction_confidence"}
    with pytest.raises(Exception, match="title is blank|problem_statement is blank|outside 0..1"):
        E.validate(E.merge_extractions(frame(spark, rows)), strict=True)[0].collect()


def test_prompts_and_messages(spark):
    df = spark.createDataFrame([(0,), (2,), (3,)], "i int").select("i", E.target_fields("i").alias("f"))
    rows = df.select("i", "f", E.build_prompt(F.col("f")).alias("p")).orderBy("i").collect()
    assert [tuple(r["f"]) for r in rows] == [E.FIRST_PAGE, E.EARLY_PAGE, E.LATER_PAGE]
    assert [r["p"].count("\n- ") for r in rows] == [7 + 6, 5 + 6, 6 + 6]
    none = spark.range(1).select(E.build_prompt(None).alias("a"), E.build_prompt(F.array().cast("array<string>")).alias("b"), E.build_prompt(F.array(F.lit("abstract"), F.lit("title"), F.lit("what"))).alias("c")).head()
    assert none["a"] == none["b"]
    assert none["c"].index("- title") < none["c"].index("- abstract") and "what:" not in none["c"]
    m = spark.range(1).select(E.build_messages(F.lit("s"), F.lit("p"), F.lit("text"), F.lit(None).cast("string")).alias("m")).head()["m"]
    assert [(x["role"], [p["type"] for p in x["parts"]]) for x in m] == [("system", ["text"]), ("user", ["text", "text"])]
    uri = spark.createDataFrame([("/a/x.JPG", bytearray(b"abc"))], "path string, content binary").select(E.image_data_uri(F.col("path"), F.col("content")).alias("u")).head()["u"]
    assert uri == "data:image/jpeg;base64,YWJj"


def test_extractor_and_answers(spark):
    def extractor(frame):
        import pandas as pd

        text = frame.iloc[0]["page_text"]
        if text == "boom":
            raise RuntimeError("no model")
        return pd.DataFrame([{"raw_text": text, "prompt_tokens": 1, "completion_tokens": 2, "model": "m"}])

    texts = ['{"title": "T"}', '```json\n{"title": "F"}\n```', "not json", "boom", " "]
    pages = spark.createDataFrame([("d", i, "p", t) for i, t in enumerate(texts)], "doc_id string, page_idx int, prompt string, page_text string")
    log = E.parse_answers(E.extract_pages(pages, extractor)).orderBy("page_idx").collect()
    assert [(r["success"], r["error"], r["parsed"] and r["parsed"]["title"], r["parse_error"]) for r in log] == [(True, None, "T", None), (True, None, "F", None), (True, None, None, "not JSON"), (False, "no model", None, None)]


def test_metric_rows(spark):
    metric = lambda v: {"name": "acc", "value_raw": v, "dataset": None, "split": None, "conditions": None}
    rows = [partial("d", 0, title="t", results=[{"method_name": "m", "metrics": [metric("91.2%"), metric("0.5")], "dataset": None, "is_proposed": True}])]
    got = [(r["value_raw"], r["value_num"], r["value_is_string"]) for r in E.metric_rows(frame(spark, rows)).orderBy("value_raw").collect()]
    assert got == [("0.5", 0.5, False), ("91.2%", None, True)]
