import hashlib
import random
import re

from foliospark.operators import chunking, routing
from foliospark.schemas import BLOCKS
from foliospark.sources import blocks as B

TYPES = ["SectionHeader", "Text", "Text", "Text", "ListGroup", "Caption", "Figure", "FigureGroup", "PictureGroup", "TableGroup", "Equation", "PageHeader", "PageFooter", "Footnote", "Picture", "Table"]


def frame(spark, docs):
    rows = [(d, p, p, b, kind, text) for d, pages in docs.items() for p, blocks in enumerate(pages) for b, (kind, text) in enumerate(blocks)]
    pages = [(d, p, p) for d, pages in docs.items() for p, _ in enumerate(pages)]
    return spark.createDataFrame(rows, BLOCKS), spark.createDataFrame(pages, "doc_id string, page_idx int, page_number int")


def one_page(spark, *blocks):
    b, p = frame(spark, {"d": [list(blocks)]})
    r = routing.route_pages(b, p).head()
    return r["route"], r["confidence"]


def test_pages_on_their_own(spark):
    ref, text = ("SectionHeader", "<h2>References</h2>"), ("Text", "x")
    assert one_page(spark) == ("skip", 0.95)
    assert one_page(spark, ("PageHeader", "x")) == ("skip", 0.95)
    assert one_page(spark, ref, text) == ("skip", 0.85)
    assert one_page(spark, ref, text, ("Figure", "")) == ("skip", 0.85)
    assert one_page(spark, ref, text, ("Picture", "")) == ("text_only", 0.9)
    assert one_page(spark, ("Figure", "")) == ("vlm", 0.7 + 1 * 0.1)
    assert one_page(spark, ("Figure", ""), ("Equation", "")) == ("vlm", 0.7 + 2 * 0.1)
    assert one_page(spark, ("Figure", ""), ("TableGroup", ""), ("Equation", "")) == ("vlm", 0.95)
    assert one_page(spark, text) == ("text_only", 0.9)


def scanned(routes):
    out = list(routes)
    for i, r in enumerate(out):
        near = ([out[i - 1]] if i else []) + ([out[i + 1]] if i + 1 < len(out) else [])
        if r == "text_only" and "vlm" in near:
            out[i] = "vlm"
    return out


def test_promotion_equals_a_scan_in_place(spark):
    rng = random.Random(2)
    names = {"T": "text_only", "V": "vlm", "S": "skip"}
    cases = ["TVTTSTTV", "TTTV", "VTTT", "STS"] + ["".join(rng.choice("TTTVS") for _ in range(rng.randrange(1, 14))) for _ in range(200)]
    rows = [(str(d), i, i, names[c], 0.9, ["r"]) for d, s in enumerate(cases) for i, c in enumerate(s)]
    df = spark.createDataFrame(rows, "doc_id string, page_idx int, page_number int, route string, confidence double, reasons array<string>")
    got = {}
    for r in routing.promote(df).orderBy("doc_id", "page_idx").collect():
        got.setdefault(r["doc_id"], []).append(r["route"])
        assert (r["confidence"] == 0.65) == (len(r["reasons"]) == 2)
    for d, s in enumerate(cases):
        assert got[str(d)] == scanned([names[c] for c in s]), s


def test_split_takes_the_last_decision(spark):
    pages = spark.createDataFrame([("d", 1), ("d", 2), ("d", 3)], "doc_id string, page_number int")
    made = spark.createDataFrame([("d", 0, 1, "vlm"), ("d", 1, 1, "text_only"), ("d", 2, 2, "vlm"), ("d", 3, 3, "skip")], "doc_id string, page_idx int, page_number int, route string")
    text, vlm = routing.split_by_route(pages, made)
    assert [r["page_number"] for r in text.collect()] == [1]
    assert [r["page_number"] for r in vlm.collect()] == [2]


def test_classification(spark):
    want = {"3.1 Method": "methodology", "A.1 Details": "unknown", "BERT. Model": "methodology", "Model training": "methodology", "Experimental results": "experiments", "Attention": "results", "Acknowledgements": "unknown", "٣.١ Abstract": "abstract"}
    df = spark.createDataFrame([(k,) for k in want], "h string")
    assert {r["h"]: r["c"] for r in df.select("h", chunking.classify_section("h").alias("c")).collect()} == want


def sequential_class(header):
    x = re.sub(r"[A-Z]\d*\.\d*\s+", "", header)
    x = re.sub(r"^[\d\.\s]+", "", x).strip().lower()
    return next((k for k, terms in chunking.SECTION_TERMS.items() if any(w in x for w in terms)), "unknown")


def sequential_chunks(pages, least):
    """A scan over blocks that keeps an open section."""
    out, section, kind, known, parts, numbers = [], "preamble", "unknown", "unknown", [], []

    def close():
        text = "\n\n".join(parts)
        if len(text.split()) >= least:
            out.append((hashlib.sha1(text.encode()).hexdigest()[:16], section, kind, "text", text, sorted(set(numbers))))

    for page, blocks in enumerate(pages):
        for t, content in blocks:
            if t in B.FURNITURE:
                continue
            plain = re.sub(r"<[^>]+>", "", content).strip()
            if t == "SectionHeader":
                close()
                parts, numbers, section = [], [], plain
                found = sequential_class(plain)
                known = found if found != "unknown" else known
                kind = known
            elif t in B.FIGURES or t in B.TABLES:
                out.append((hashlib.sha1((content + str(page)).encode()).hexdigest()[:16], section, kind, "table" if t in B.TABLES else "figure", content, [page]))
            elif t in chunking.TEXT_TYPES and content:
                numbers.append(page)
                if plain:
                    parts.append(plain)
    close()
    return out


def test_chunks_equal_a_scan(spark):
    rng = random.Random(7)
    words = ["alpha", "beta gamma", "<b>delta</b>", "　", "eps\u001clon", "", "zeta eta"]
    heads = ["<h1>3.1 Method</h1>", "Results", "Attention is", "Thanks", "Acknowledgements", "BERT. Model", "References"]
    docs = {}
    for d in range(60):
        docs[str(d)] = [[(t := rng.choice(TYPES), rng.choice(heads) if t == "SectionHeader" else " ".join(rng.choice(words) for _ in range(rng.randrange(0, 9)))) for _ in range(rng.randrange(0, 7))] for _ in range(rng.randrange(1, 5))]
    blocks, _ = frame(spark, docs)
    got = {}
    for r in chunking.chunk(blocks, min_words=8).orderBy("doc_id", "ordinal").collect():
        got.setdefault(r["doc_id"], []).append((r["chunk_id"], r["section"], r["section_type"], r["chunk_type"], r["content"], list(r["page_numbers"])))
    for d, pages in docs.items():
        assert got.get(d, []) == sequential_chunks(pages, 8), d


def test_block_sources(spark):
    html = "<html><script>var p = '<p>no</p>';</script><nav>menu</nav><H1 class=a>Title</H1><p>one <b>two<p>three</p><ul><li>x</ul><footer>f</footer>"
    df = spark.createDataFrame([(1, html), (2, None)], "page_id long, html string")
    got = [(r["block_type"], r["content"]) for r in B.html_to_blocks(df).orderBy("block_idx").collect()]
    assert got == [("PageHeader", "menu"), ("SectionHeader", "Title"), ("Text", "one <b>two"), ("Text", "three"), ("ListGroup", "<li>x"), ("PageFooter", "f")]
    blocks, _ = frame(spark, {"d": [[("Text", "a"), ("SectionHeader", "b"), ("Caption", "c"), ("PictureGroup", "<p x>d e</p>"), ("Footnote", "z")]]})
    s = B.page_summary(blocks).head()
    assert (s["has_figures"], s["has_tables"], s["has_equations"], s["word_count"], s["n_blocks"]) == (True, False, False, 6, 4)
    assert B.page_markdown(blocks).head()["markdown"] == "a\n\nc"
    assert B.page_markdown(blocks, legacy_types=False).head()["markdown"] == "a\n\nb\n\nc"
    titled = B.document_titles(spark.createDataFrame([("", "/x/paper.v2.pdf"), ("T", "/x/y.pdf")], "title string, source_path string"))
    assert [r["title"] for r in titled.collect()] == ["paper.v2", "T"]
    assert B.text_to_blocks(spark.createDataFrame([(1, "a b c d e f g\nshort\n\nx")], "doc_id long, text string")).count() == 3
