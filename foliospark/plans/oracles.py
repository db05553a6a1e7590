"""DuckDB SQL for the registered queries, written on its own: sequential recursion and direct rules where Spark uses windows."""

from __future__ import annotations

from foliospark.operators.chunking import SECTION_TERMS
from foliospark.operators.evaluation import SEVERITY
from foliospark.operators.extraction import EARLY_PAGE, FIELD_PROMPTS, FIRST_PAGE, LATER_PAGE, PROMPT_HEAD, PROMPT_RULES
from foliospark.plans.tables import HEADINGS


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _knn(score: str, order: str, where: str = "true") -> str:
    return f"""
WITH q AS (SELECT embedding::DOUBLE[] AS q FROM embeddings ORDER BY vec_id LIMIT 1),
s AS (SELECT vec_id, label, {score} AS s FROM embeddings, q WHERE {where})
SELECT vec_id, label, round(s, 9) AS score FROM s ORDER BY s {order}, vec_id LIMIT 10
"""


_V = "embedding::DOUBLE[]"
_BATCH = f"""
WITH q AS (SELECT label AS query_id, arg_min(embedding, vec_id)::DOUBLE[] AS q FROM embeddings GROUP BY label),
s AS (SELECT query_id, vec_id, label, list_cosine_similarity(q, {_V}) AS s FROM embeddings, q),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS rank FROM s)
"""

_PAGES = """
WITH p AS (SELECT conv_id AS doc_id, turn, length(text) AS n, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations),
f AS (SELECT *, n % 13 <> 0 AS has1, n % 13 <> 0 AND n % 5 = 0 AS header, n % 13 <> 0 AND n % 5 = 1 AS furniture, n % 11 < 4 AS has2,
  (n % 11 = 0)::INT AS fig, (n % 11 = 1)::INT AS tab, (n % 11 = 2)::INT AS eq, n % 11 = 3 AS pic FROM p),
o AS (SELECT *, CASE WHEN NOT has2 AND (NOT has1 OR furniture) THEN 'skip' WHEN header AND n % 3 = 0 AND NOT pic THEN 'skip'
    WHEN fig + tab + eq > 0 THEN 'vlm' ELSE 'text_only' END AS route,
  CASE WHEN NOT has2 AND (NOT has1 OR furniture) THEN 0.95::DOUBLE WHEN header AND n % 3 = 0 AND NOT pic THEN 0.85::DOUBLE
    WHEN fig + tab + eq > 0 THEN 0.7::DOUBLE + 0.1::DOUBLE ELSE 0.9::DOUBLE END AS confidence,
  CASE WHEN NOT has2 AND (NOT has1 OR furniture) THEN 'no content blocks after filtering headers/footers' WHEN header AND n % 3 = 0 AND NOT pic THEN 'structural section: references'
    WHEN fig = 1 THEN 'Figure/FigureGroup/PictureGroup block detected' WHEN tab = 1 THEN 'TableGroup block detected' WHEN eq = 1 THEN 'Equation block detected'
    ELSE 'text-only blocks' END AS reasons FROM f)
"""

#: A scan that changes pages in place, one page after another.
_SCAN = (
    _PAGES.replace("WITH p", "WITH RECURSIVE p")
    + """
, s AS (
  SELECT o.doc_id, o.i, CASE WHEN o.route = 'text_only' AND nx.route = 'vlm' THEN 'vlm' ELSE o.route END AS now, o.route AS was
  FROM o LEFT JOIN o nx ON nx.doc_id = o.doc_id AND nx.i = o.i + 1 WHERE o.i = 1
  UNION ALL
  SELECT o.doc_id, o.i, CASE WHEN o.route = 'text_only' AND (s.now = 'vlm' OR nx.route = 'vlm') THEN 'vlm' ELSE o.route END, o.route
  FROM s JOIN o ON o.doc_id = s.doc_id AND o.i = s.i + 1 LEFT JOIN o nx ON nx.doc_id = o.doc_id AND nx.i = o.i + 1
)
"""
)

_LINES = f"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
u AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS i FROM d),
b AS (SELECT doc_id, i, i // 8 AS page, line, [{", ".join(map(_text, HEADINGS))}][i % {len(HEADINGS)} + 1] AS heading,
  CASE WHEN i % 9 = 3 THEN 'SectionHeader' WHEN i % 7 = 6 THEN 'Figure' WHEN i % 11 = 10 THEN 'TableGroup' WHEN i % 13 = 12 THEN 'Equation' WHEN i % 17 = 16 THEN 'PageFooter' ELSE 'Text' END AS kind
  FROM u WHERE regexp_matches(line, '\\S'))
"""

_CLASS = "CASE " + " ".join(f"WHEN regexp_matches(x, {_text('|'.join(terms))}) THEN '{kind}'" for kind, terms in SECTION_TERMS.items()) + " ELSE 'unknown' END"
_SECTIONS = (
    _LINES
    + f"""
, h AS (SELECT doc_id, i, page, line, kind, heading, lower(trim(regexp_replace(regexp_replace(heading, '[A-Z]\\d*\\.\\d*\\s+', '', 'g'), '^[\\d\\.\\s]+', ''))) AS x FROM b WHERE kind <> 'PageFooter'),
c AS (SELECT *, CASE WHEN kind = 'SectionHeader' THEN nullif({_CLASS}, 'unknown') END AS cls FROM h),
s AS (SELECT *, count(*) FILTER (kind = 'SectionHeader') OVER w AS section_idx,
  coalesce(last_value(CASE WHEN kind = 'SectionHeader' THEN heading END IGNORE NULLS) OVER w, 'preamble') AS section,
  coalesce(last_value(cls IGNORE NULLS) OVER w, 'unknown') AS section_type
  FROM c WINDOW w AS (PARTITION BY doc_id ORDER BY i))
"""
)
_CHUNKS = (
    _SECTIONS
    + """
, m AS (SELECT doc_id, section_idx, max(i) AS e FROM s GROUP BY ALL),
t AS (SELECT doc_id, section_idx, any_value(section) AS section, any_value(section_type) AS section_type,
  string_agg(regexp_replace(regexp_replace(regexp_replace(line, '<[^>]+>', '', 'g'), '^\\s+', ''), '\\s+$', ''), chr(10) || chr(10) ORDER BY i) AS content,
  list_sort(list_distinct(list(page))) AS pages FROM s WHERE kind = 'Text' GROUP BY ALL),
k AS (
  SELECT t.doc_id, m.e AS i, 1 AS late, substr(sha1(content), 1, 16) AS chunk_id, section, section_type, 'text' AS chunk_type, content, len(regexp_extract_all(content, '\\S+'))::INTEGER AS word_count, array_to_string(pages, ',') AS pages
  FROM t JOIN m USING (doc_id, section_idx) WHERE len(regexp_extract_all(content, '\\S+')) >= 30
  UNION ALL
  SELECT doc_id, i, 0, substr(sha1(line || page), 1, 16), section, section_type, CASE kind WHEN 'Figure' THEN 'figure' ELSE 'table' END, line, len(regexp_extract_all(line, '\\S+'))::INTEGER, page::VARCHAR
  FROM s WHERE kind IN ('Figure', 'TableGroup')
)
"""
)


def _partials(strategy: str) -> str:
    way = "arg_max" if strategy == "last_wins" else "arg_min"
    pick = lambda c: f"coalesce({way}({c}, turn) FILTER (regexp_matches(coalesce({c}, ''), '\\S')), '')"
    return f"""
WITH p AS (SELECT conv_id::VARCHAR AS doc_id, turn, length(text) AS n, length(text) % 4 <> 0 AS f, text, role FROM conversations),
q AS (SELECT *, CASE WHEN f AND n % 3 = 0 THEN substr(text, 1, 20) ELSE ' ' END AS title, CASE WHEN f AND turn > 0 THEN substr(text, 5, 30) ELSE '' END AS problem_statement,
  CASE WHEN f AND n % 5 = 0 THEN text END AS abstract, CASE WHEN f AND n % 7 = 0 THEN role END AS conclusion_summary, CASE WHEN n % 6 = 0 THEN '2301.00001' END AS arxiv_id,
  (n % 10)::DOUBLE / 10 AS conf FROM p),
m AS (SELECT doc_id, {pick("title")} AS title, {pick("problem_statement")} AS problem_statement, nullif({pick("abstract")}, '') AS abstract,
  nullif({pick("conclusion_summary")}, '') AS conclusion_summary, nullif({pick("arxiv_id")}, '') AS arxiv_id,
  round(coalesce(avg(conf) FILTER (conf > 0), 0), 9) AS confidence, round(max(conf), 9) AS title_confidence, count(*) AS pages_processed, count(*) AS pages_with_content
  FROM q GROUP BY doc_id)
"""


#: Every partial has a title of one blank, which counts as content, so none is dropped.
_ITEMS = """
WITH p AS (SELECT conv_id::VARCHAR AS doc_id, turn, length(text) AS n, length(text) % 4 <> 0 AS f FROM conversations),
i AS (
  SELECT doc_id, turn, 'authors' AS field, 'author ' || n % 9 AS item FROM p WHERE f
  UNION ALL SELECT doc_id, turn, 'institutions', 'place ' || n % 3 FROM p
  UNION ALL SELECT doc_id, turn, 'datasets', 'data ' || n % 6 FROM p WHERE f AND n % 2 = 0
  UNION ALL SELECT doc_id, turn, 'methods', 'method ' || n % 5 FROM p WHERE f AND n % 3 = 1
  UNION ALL SELECT doc_id, turn, 'results', 'method ' || n % 5 || '_' || CASE WHEN n % 2 = 0 THEN 'data ' || n % 8 ELSE 'None' END FROM p WHERE f
  UNION ALL SELECT doc_id, turn, 'baselines', 'method ' || n % 3 FROM p WHERE f AND n % 3 = 2
  UNION ALL SELECT doc_id, turn, 'limitations', 'limit ' || n % 6 FROM p WHERE f AND n % 5 = 3
), g AS (SELECT doc_id, field, item, min(turn) AS turn FROM i GROUP BY ALL)
"""

#: Results and baselines as merged: the first turn of each key decides.
_MERGED_RESULTS = """
WITH p AS (SELECT conv_id::VARCHAR AS doc_id, turn, length(text) AS n, length(text) % 4 <> 0 AS f FROM conversations),
r AS (SELECT doc_id, 'method ' || n % 5 AS method, CASE WHEN n % 2 = 0 THEN 'data ' || n % 8 END AS dataset, arg_min(n, turn) AS n FROM p WHERE f GROUP BY ALL),
ds AS (SELECT DISTINCT doc_id, 'data ' || n % 6 AS name FROM p WHERE f AND n % 2 = 0),
bs AS (SELECT doc_id, 'method ' || n % 3 AS name, arg_min(n, turn) AS n FROM p WHERE f AND n % 3 = 2 GROUP BY ALL),
au AS (SELECT doc_id, 'author ' || n % 9 AS name, arg_min(n, turn) AS n FROM p WHERE f GROUP BY ALL),
ins AS (SELECT DISTINCT doc_id, 'place ' || n % 3 AS name FROM p),
d1 AS (SELECT DISTINCT r.doc_id, r.dataset FROM r WHERE dataset IS NOT NULL AND NOT EXISTS (SELECT 1 FROM ds WHERE ds.doc_id = r.doc_id AND ds.name = r.dataset)),
d2 AS (SELECT DISTINCT r.doc_id, r.method FROM r WHERE r.n % 3 <> 0 AND NOT EXISTS (SELECT 1 FROM bs WHERE bs.doc_id = r.doc_id AND bs.name = r.method))
"""

_NAMES = """
, nm AS (
  SELECT doc_id, 'authors' AS field, name FROM au UNION ALL SELECT doc_id, 'datasets', name FROM ds
  UNION ALL SELECT DISTINCT doc_id, 'methods', 'method ' || n % 5 FROM p WHERE f AND n % 3 = 1
), me AS (
  SELECT doc_id, method AS owner, dataset_key, v FROM (SELECT doc_id, method, n, '' AS dataset_key, (n % 140)::VARCHAR AS v FROM r)
  UNION ALL SELECT doc_id, name, '', (n % 140)::VARCHAR FROM bs
), findings AS (
  SELECT doc_id, 'dataset_result_mismatch' AS inconsistency_type FROM d1
  UNION ALL SELECT doc_id, 'metric_baseline_conflict' FROM d2
  UNION ALL SELECT doc_id, 'author_institution_mismatch' FROM (SELECT DISTINCT doc_id, 'place ' || n % 4 AS place FROM au) a
    WHERE NOT EXISTS (SELECT 1 FROM ins WHERE ins.doc_id = a.doc_id AND 1 - levenshtein(a.place, ins.name)::DOUBLE / 7 >= 0.8)
  UNION ALL SELECT doc_id, 'impossible_value' FROM me WHERE v::INT > 100
  UNION ALL SELECT doc_id, 'metric_conflict' FROM (SELECT doc_id, owner FROM me GROUP BY ALL HAVING count(DISTINCT v) > 1)
  UNION ALL SELECT a.doc_id, 'near_duplicate_entry' FROM nm a JOIN nm b ON a.doc_id = b.doc_id AND a.field = b.field AND a.name < b.name
    WHERE 1 - levenshtein(a.name, b.name)::DOUBLE / greatest(length(a.name), length(b.name)) >= 0.85
)
"""

_VALUE = """
WITH v AS (
  SELECT doc_id, source, n_chars AS n, text,
    CASE n_chars % 3 WHEN 0 THEN 'it has ' || n_chars || ' characters' WHEN 1 THEN 'about ' || n_chars * 2 ELSE text END AS src FROM documents
), r AS (
  SELECT doc_id, source, CASE WHEN n % 2 = 0 THEN len(list_filter(list_transform(regexp_extract_all(src, '[0-9]+(?:\\.[0-9]+)?'), lambda x: x::DOUBLE),
      lambda x: abs(x - n / 100.0::DOUBLE) <= 0.05 * (n / 100.0::DOUBLE) OR abs(x - n / 100.0::DOUBLE * 100) <= 0.05 * (n / 100.0::DOUBLE * 100) OR abs(x - n / 100.0::DOUBLE / 100) <= 0.05 * (n / 100.0::DOUBLE / 100))) > 0
    ELSE contains(lower(src), lower(upper(substr(text, 3, 12)))) END AS supported FROM v
)
"""


def _related(edges: str, hops: int, least: bool = False) -> str:
    """Trails of two-way edges as a recursion that carries the edges used."""
    distance = "min(h)" if least else "h"
    group = "k" if least else "k, h"
    return f"""
WITH RECURSIVE e AS ({edges}),
b AS (SELECT id, a, b FROM e UNION ALL SELECT id, b, a FROM e WHERE a <> b),
p AS (SELECT 'Paper:' || min(o_orderkey) AS k0 FROM orders),
w AS (
  SELECT b.b AS k, 1 AS h, [b.id] AS used FROM b, p WHERE b.a = p.k0
  UNION ALL
  SELECT b.b, h + 1, list_append(used, b.id) FROM w JOIN b ON b.a = w.k WHERE h < {hops} AND NOT list_contains(used, b.id)
)
SELECT substr(k, 7) AS key, 'order ' || substr(k, 7) AS title, {distance} AS distance FROM w, p WHERE starts_with(k, 'Paper:') AND k <> k0 GROUP BY {group}
"""


_AUTHORED = "SELECT DISTINCT concat_ws('|', l_orderkey, l_suppkey, l_linenumber) AS id, 'Paper:' || l_orderkey AS a, 'Author:' || l_suppkey AS b FROM lineitem"
_BUILDS = "SELECT a || '>' || b AS id, a, b FROM (SELECT 'Paper:' || o_orderkey AS a, 'Paper:' || lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS b FROM orders) WHERE b IS NOT NULL"


def _prompt_chars() -> str:
    size = lambda names: len(PROMPT_HEAD) + len("\n".join(f"- {k}: {v}" for k, v in FIELD_PROMPTS.items() if k in names)) + len(PROMPT_RULES)
    case = lambda f: f"CASE WHEN turn = 0 THEN {f(FIRST_PAGE)} WHEN turn <= 2 THEN {f(EARLY_PAGE)} ELSE {f(LATER_PAGE)} END"
    return f"SELECT conv_id AS doc_id, turn AS page_idx, {case(lambda x: _text(','.join(x)))} AS fields, {case(lambda x: f'{size(x)}::BIGINT')} AS prompt_chars FROM conversations"


ORACLES = {
    "knn_cosine": _knn(f"list_cosine_similarity(q, {_V})", "DESC"),
    "knn_dot": _knn(f"list_dot_product(q, {_V})", "DESC"),
    "knn_euclid": _knn(f"list_distance(q, {_V})", "ASC"),
    "knn_filtered": _knn(f"list_cosine_similarity(q, {_V})", "DESC", "label = 3"),
    "knn_batch": _BATCH + "SELECT query_id, rank::INTEGER AS rank, vec_id, round(s, 9) AS score FROM r WHERE rank <= 5",
    "context_precision": _BATCH + "SELECT query_id AS sample_id, avg((label = query_id)::INT) AS context_precision FROM r WHERE rank <= 10 GROUP BY query_id",
    "vector_upsert": "SELECT vec_id::VARCHAR AS chunk_id, CASE WHEN vec_id % 2 = 0 THEN 'new 3' ELSE label::VARCHAR END AS text FROM embeddings WHERE vec_id % 7 <> 0",
    "html_strip": """
SELECT page_id, text, raw_words, len(regexp_extract_all(text, '\\S+'))::BIGINT AS words FROM (
  SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '^\\s+', ''), '\\s+$', '') AS text, len(regexp_extract_all(html, '\\S+'))::BIGINT AS raw_words FROM pages)
""",
    "block_explode": """
WITH b AS (SELECT page_id, regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', '', 'g') AS h FROM pages),
t AS (SELECT page_id, unnest(regexp_extract_all(h, '(?i)<(h1|h2|h3|p|ul|ol|nav|header|footer)[\\s>]', 1)) AS tag FROM b)
SELECT page_id, CASE lower(tag) WHEN 'p' THEN 'Text' WHEN 'ul' THEN 'ListGroup' WHEN 'ol' THEN 'ListGroup' WHEN 'nav' THEN 'PageHeader' WHEN 'header' THEN 'PageHeader' WHEN 'footer' THEN 'PageFooter' ELSE 'SectionHeader' END AS block_type, count(*) AS n
FROM t GROUP BY ALL
""",
    "page_flags": _PAGES + "SELECT doc_id, turn AS page_idx, fig = 1 AS has_figures, tab = 1 AS has_tables, eq = 1 AS has_equations, ((has1 AND NOT furniture)::INT + has2::INT)::INTEGER AS n_blocks FROM f WHERE (has1 AND NOT furniture) OR has2".replace("FROM f", "FROM o"),
    "page_markdown": _PAGES + "SELECT doc_id, turn AS page_idx, CASE WHEN has1 AND NOT header AND NOT furniture THEN text ELSE '' END AS markdown FROM o WHERE has1 OR has2",
    "page_route": _PAGES + "SELECT doc_id, turn AS page_idx, route, confidence, reasons FROM o",
    "route_promote": _SCAN + "SELECT o.doc_id, o.turn AS page_idx, s.now AS route, CASE WHEN s.now <> s.was THEN 0.65::DOUBLE ELSE o.confidence END AS confidence FROM s JOIN o USING (doc_id, i)",
    "route_split": _SCAN + "SELECT o.doc_id, o.turn AS page_number, CASE s.now WHEN 'vlm' THEN 'vlm' ELSE 'text' END AS part FROM s JOIN o USING (doc_id, i) WHERE s.now <> 'skip'",
    "section_inherit": _SECTIONS + "SELECT doc_id, i::INTEGER AS block_idx, section_idx, section, section_type FROM s WHERE kind = 'SectionHeader'",
    "chunks": _CHUNKS + "SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i, late)::INTEGER AS ordinal, chunk_id, section, section_type, chunk_type, word_count, pages, greatest(1, length(content) // 4)::INTEGER AS tokens FROM k",
    "dedupe_chunks": _CHUNKS + "SELECT chunk_id, min(doc_id) AS doc_id, count(DISTINCT doc_id) AS n_docs, min(word_count)::BIGINT AS word_count FROM k GROUP BY chunk_id",
    "ids": """
SELECT doc_id, substr(sha1(text), 1, 16) AS chunk_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-0000-000000000000' AS point_id,
  '2301.' || lpad((doc_id % 100000)::VARCHAR, 5, '0') AS arxiv_id, substr(h, 1, 12) AS paper_key FROM (SELECT *, substr(sha1(text), 1, 16) AS h FROM documents)
""",
    "target_fields": _prompt_chars(),
    "merge_scalars": _partials("union") + "SELECT * FROM m",
    "merge_last_wins": _partials("last_wins") + "SELECT * FROM m",
    "merge_lists": _ITEMS + "SELECT doc_id, field, (row_number() OVER (PARTITION BY doc_id, field ORDER BY turn) - 1)::INTEGER AS pos, item FROM g",
    "validate": _partials("union") + "SELECT doc_id, CASE WHEN NOT regexp_matches(title, '\\S') THEN 'title is blank' WHEN NOT regexp_matches(problem_statement, '\\S') THEN 'problem_statement is blank' ELSE '' END AS reason FROM m",
    "node_upsert": "SELECT 'Nation' AS label, c_nationkey::VARCHAR AS key, arg_max(c_mktsegment, c_custkey) FILTER (c_custkey % 3 = 0) AS segment, arg_max(c_name, c_custkey) FILTER (c_custkey % 3 <> 0) AS name FROM customer GROUP BY c_nationkey",
    "edge_upsert": "SELECT DISTINCT 'AUTHORED_BY' AS rel_type, l_orderkey::VARCHAR AS src_key, l_suppkey::VARCHAR AS dst_key, l_linenumber::VARCHAR AS author_order FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey WHERE s_acctbal > 0",
    "coauthors": """
WITH e AS (SELECT DISTINCT l_orderkey, l_suppkey, l_linenumber FROM lineitem)
SELECT b.l_suppkey::VARCHAR AS coauthor, count(*) AS paths FROM e a JOIN e b USING (l_orderkey) WHERE a.l_suppkey = 1 AND b.l_suppkey <> 1 GROUP BY 1
""",
    "related_2hop": _related(_AUTHORED, 2),
    "related_trail_3hop": _related(_BUILDS, 3),
    "related_shortest": _related(_BUILDS, 3, least=True),
    "papers_by_dataset": """
SELECT DISTINCT l_orderkey::VARCHAR AS paper, 'order ' || l_orderkey AS title, p_name || '#' || p_partkey AS dataset FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey
WHERE contains(lower(p_name || '#' || p_partkey), '#1')
""",
    "papers_by_method": """
SELECT DISTINCT l_orderkey::VARCHAR AS paper, 'order ' || l_orderkey AS title, p_type AS method FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey
WHERE contains(lower(p_type), 'stan')
""",
    "comparison": """
WITH f AS (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 3),
u AS (SELECT DISTINCT l_orderkey, p_type, p_name || '#' || p_partkey AS ds FROM lineitem JOIN f ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey),
n AS (SELECT 'Method' AS label, p_type AS item, count(DISTINCT l_orderkey) AS n_papers FROM u GROUP BY p_type UNION ALL SELECT 'Dataset', ds, count(DISTINCT l_orderkey) FROM u GROUP BY ds)
SELECT *, CASE n_papers WHEN (SELECT count(*) FROM f) THEN 'shared' WHEN 1 THEN 'unique' ELSE 'partial' END AS status FROM n
""",
    "schema_mapping": """
WITH f AS (SELECT DISTINCT c_mktsegment AS field_name FROM customer UNION ALL SELECT r_name FROM region),
s AS (SELECT field_name, t, 1 - levenshtein(lower(field_name), lower(t))::DOUBLE / greatest(length(field_name), length(t)) AS s FROM f, unnest(['Machine', 'Automobiles', 'Building', 'Europe', 'Asia Minor']) x(t)),
b AS (SELECT field_name, arg_max(t, s) AS t, max(s) AS s FROM s GROUP BY field_name)
SELECT field_name, CASE WHEN s >= 0.7 THEN t END AS mapped_type, round(s, 9) AS confidence FROM b
""",
    "context_budget": """
WITH t AS (SELECT conv_id, turn, text, role, greatest(1, length(text) // 4) AS k, row_number() OVER (PARTITION BY conv_id ORDER BY length(text) DESC, turn::VARCHAR) AS r FROM conversations),
s AS (SELECT *, (SELECT sum(k) FROM t x WHERE x.conv_id = t.conv_id AND x.r <= t.r) AS total FROM t)
SELECT conv_id, count(*) AS n_chunks, max(total)::BIGINT AS tokens, (sum(length(text) + length(role) + length(r::VARCHAR) + 4) + 2 * (count(*) - 1))::BIGINT AS chars FROM s WHERE total <= 300 GROUP BY conv_id
""",
    "context_recall": "SELECT source AS sample_id, round(avg((doc_id IN (SELECT doc_id FROM labels))::INT), 9) AS context_recall FROM documents GROUP BY source",
    "value_in_source": _VALUE + "SELECT doc_id, supported FROM r",
    "hallucination_rate": _VALUE + "SELECT source, round(count(*) FILTER (NOT supported)::DOUBLE / count(*), 9) AS rate FROM r GROUP BY source",
    "consistency_findings": _MERGED_RESULTS + _NAMES + "SELECT doc_id, inconsistency_type, count(*) AS n FROM findings GROUP BY ALL",
    "consistency_scores": _MERGED_RESULTS
    + _NAMES
    + f"""
, n AS (SELECT doc_id, count(*) AS n, sum(CASE inconsistency_type {" ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in SEVERITY.items())} END) AS s FROM findings GROUP BY doc_id)
SELECT DISTINCT p.doc_id, coalesce(n.n, 0) AS n_inconsistencies, round(1 - least(coalesce(n.s, 0), 1), 9) AS score FROM p LEFT JOIN n ON n.doc_id = p.doc_id
""",
    "g_eval": """
WITH s AS (SELECT conv_id AS doc_id, turn % 2 = 0 AS r, avg(CASE WHEN length(text) % 3 = 2 THEN 1.0::DOUBLE ELSE length(text) % 5 + 1 END) / 5 AS x FROM conversations GROUP BY ALL)
SELECT doc_id, round(sum(CASE WHEN r THEN 2 ELSE 1 END * x) / sum(CASE WHEN r THEN 2 ELSE 1 END), 9) AS overall FROM s GROUP BY doc_id
""",
    "ingest_new": "SELECT doc_id, source, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
}

from foliospark.plans import paper_queries  # noqa: E402  its SQL is built from this module's

ORACLES |= paper_queries._sql()
