import sys

import pytest
from pyspark.sql import functions as F

from foliospark.functions import text as X
from foliospark.functions import vector as V


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return df.select(column.alias("x")).head()[0]


def test_white_space_equals_python(spark):
    points = [c for c in range(1, 0x3200) if not 0xD800 <= c < 0xE000]
    rows = spark.createDataFrame([(c, f"{chr(c)}a{chr(c)}b{chr(c)}") for c in points], "c int, t string")
    for r in rows.select("c", "t", X.strip("t").alias("s"), X.word_count("t").alias("n"), X.is_blank(F.substring("t", 1, 1)).alias("b")).collect():
        assert (r["s"], r["n"], r["b"]) == (r["t"].strip(), len(r["t"].split()), not r["t"][0].strip()), hex(r["c"])
    assert sys.maxunicode > 0x3200


def test_html_tokens_and_ids(spark):
    assert one(spark, X.strip_html("t"), t=" <p class='x'>a &amp; b</p>\n") == "a &amp; b"
    assert one(spark, X.strip_html(F.lit(None).cast("string"))) == ""
    assert one(spark, X.estimate_tokens("t"), t="\U0001f600" * 9) == 2
    assert one(spark, X.estimate_tokens("t"), t="") == 1
    assert one(spark, X.short_hash("t"), t="abc") == "a9993e364706816a"
    assert one(spark, X.point_id("t"), t="abc123") == "abc12300-0000-0000-0000-000000000000"
    assert one(spark, X.clean_arxiv_id("t"), t="http://arxiv.org/abs/2304.01373v2") == "2304.01373"
    assert one(spark, X.clean_arxiv_id("t", strict=False), t="hep-th/9901001") is None
    with pytest.raises(Exception, match="no arXiv id"):
        one(spark, X.clean_arxiv_id("t"), t="hep-th/9901001")
    with pytest.raises(Exception, match="not a hex id"):
        one(spark, X.point_id("t"), t="xyz")


def test_scores(spark):
    lit = lambda *x: F.array(*[F.lit(float(v)) for v in x])
    assert one(spark, V.cosine(lit(1, 0), lit(1, 1))) == pytest.approx(0.5**0.5)
    assert one(spark, V.cosine(lit(0, 0), lit(1, 1))) is None
    assert one(spark, V.euclid(lit(1, 0), lit(4, 4))) == 5.0
    assert one(spark, V.dot(lit(1, 2), lit(3, 4))) == 11.0
    with pytest.raises(ValueError, match="unknown metric"):
        V.score("manhattan", "a", "b")
    assert one(spark, X.similarity(F.lit(" Abc "), F.lit("abd"))) == pytest.approx(2 / 3)
