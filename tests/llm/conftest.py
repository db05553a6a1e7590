import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Makes a documents table with columns whose names the operators use themselves."""

    def make(texts, ids=None, langs=None, sources=None):
        n = len(texts)
        rows = [((ids or range(n))[i] if ids is None or i < len(ids) else i, t, (langs or ["en"] * n)[i], (sources or ["s"] * n)[i], len(t or "")) for i, t in enumerate(texts)]
        frame = spark.createDataFrame(rows, DOCUMENTS)
        return frame.selectExpr("*", "1 AS size", "'x' AS id", "2 AS k", "'v' AS v", "0 AS at", "1.5D AS score", "'t' AS t", "9 AS n", "7 AS h1", "'q' AS host", "3 AS copies", "'l' AS label")

    return make


NASTY = [None, "", " ", "\n\n\n", "a", "word " * 3, "ÄÖ ß  x　y\u001cz", "same text here now", "same text here now", "x" * 5000, "\U0001f600 emoji \U0001f600", "line one\nline two\nline three\nline four"]
