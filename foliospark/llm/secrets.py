"""Secret scans with DataFrame functions only: base patterns, and sliding-window entropy over candidate strings.

Base spans are the leftmost non-overlapping matches of each kind of BASE; matches that fail the kind's test go. A
candidate is a run of key characters of at least WINDOW; its character class is a key of THRESHOLDS. A window of
WINDOW characters slides over it: entering and leaving characters change their counts and the sum of n * log2(n),
from which the window's Shannon entropy follows. Windows at or above their class's threshold merge into spans of
kind entropy; windows that overlap a match of the allow-list don't. With outside, of spans that overlap base spans the
stretches outside them are kept, of any length; op1 has it so. Without, such spans go whole, with what stands
beside the base span.

Regular expressions find the texts that need more work; all else runs on those texts alone. Positions are code
points, end exclusive.

Defined results: a null or empty text has no spans; hash and spans are those of an empty list. Repeated rows are
scanned alike. Whole texts and candidates of any length are scanned. Input columns named like an output are
replaced; others stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import read_table

#: Fixed values of the contract: kinds in order with their patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"  # AKIA[A-Z0-9]+ of 18 characters or more: a shorter run has no longer match inside
HEX = r"[0-9a-f]{16,}"  # [0-9a-f]+ of 16 characters or more: runs are maximal

KINDS = ("assign", "access", "hex", "entropy")
WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Least entropy in bits of a window, by character class: mixed has letters and digits, words letters with separators,
#: digits may have separators. Separators alone are rules and have no class. README has the miss rates.
THRESHOLDS = {"hex": 3.0, "letters": 3.7, "mixed": 3.6, "words": 3.8, "digits": 2.6}
#: Strings of high entropy that are no secrets; ^ and $ are the candidate's ends. The first is a published sample key.
ALLOW = [
    r"wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY",
    r"(?i)example",
    r"(?i)abcdefghijklmnopqrst",
    r"(?i)0123456789abcdef",
    r"(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$",
]

_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _none() -> F.Column:
    return F.array().cast(_SPAN)


#: Elements that a list grows by before it is put aside, so that long lists aren't copied for each element.
GROWS = 128


def _grown(rows, element: str, start: F.Column, step) -> F.Column:
    """The array that step adds to for each row: step(at, row) gives the next position and an array of new elements."""
    none = F.array().cast(f"array<{element}>")
    first = F.struct(start.alias("at"), F.array().cast(f"array<array<{element}>>").alias("done"), none.alias("last"))

    def add(acc, x):
        at, new = step(acc["at"], x)
        full = F.size(acc["last"]) >= GROWS
        done = F.when(full, F.concat(acc["done"], F.array(acc["last"]))).otherwise(acc["done"])
        return F.struct(at.alias("at"), done.alias("done"), F.concat(F.when(full, none).otherwise(acc["last"]), new).alias("last"))

    return F.aggregate(rows, first, add, lambda acc: F.flatten(F.concat(acc["done"], F.array(acc["last"]))))


def _spans(text, pattern: str, kind: int, group: int | None = None, least: int = 0) -> F.Column:
    """Spans of the pattern's matches; with a group, those where it has so many characters at least."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    groups = matches if group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), matches.alias("match"), groups.alias("group"))
    rows = F.transform(F.filter(zipped, lambda x: x["match"].isNotNull()), lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["match"]).alias("size"), F.length(x["group"]).alias("g")))

    def step(at, x):
        begin = at + x["gap"]
        end = begin + x["size"]
        return end, F.when(x["g"] >= least, F.array(F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end")))).otherwise(_none())

    return _grown(rows, _SPAN[6:-1], F.lit(0), step)


def _windows_over(text: F.Column, begin: F.Column, least: F.Column, allowed: F.Column) -> F.Column:
    """Merged spans of the windows of one candidate that reach the least entropy and overlap no allowed span of it."""
    zeros = F.array(*[F.lit(0)] * len(ALPHABET))
    enter = F.split(text, "")
    leave = F.slice(F.concat(F.array_repeat(F.lit(None).cast("string"), WINDOW), enter), F.lit(1), F.size(enter))
    steps = F.transform(F.arrays_zip(enter.alias("c"), leave.alias("d")), lambda x: F.struct(F.position(x["c"], F.lit(ALPHABET)).alias("c"), F.position(x["d"], F.lit(ALPHABET)).alias("d")))
    part = lambda n: F.when(n > 0, n * F.log2(n.cast("double"))).otherwise(F.lit(0.0))
    start = F.struct(F.lit(0).alias("i"), zeros.alias("counts"), F.lit(0.0).alias("sum"), _none().alias("spans"))

    def step(acc, x):
        gone = F.coalesce(F.get(acc["counts"], x["d"] - 1), F.lit(0))
        less = F.when(x["d"].isNotNull(), part(gone - 1) - part(gone)).otherwise(F.lit(0.0))
        had = F.get(acc["counts"], x["c"] - 1) - F.when(x["c"] == x["d"], 1).otherwise(0)
        more = part(had + 1) - part(had)
        counts = F.transform(acc["counts"], lambda n, k: n + F.when(k == x["c"] - 1, 1).otherwise(0) - F.when(k == F.coalesce(x["d"], F.lit(0)) - 1, 1).otherwise(0))
        total = acc["sum"] + less + more
        n = acc["i"] + 1
        clear = ~F.exists(allowed, lambda a: (a["start"] < n) & (n - WINDOW < a["end"]))
        hit = (n >= WINDOW) & (F.log2(F.lit(float(WINDOW))) - total / WINDOW >= least) & clear
        span = F.struct((begin + n - WINDOW).alias("start"), F.lit(3).alias("kind"), (begin + n).alias("end"))
        last = F.element_at(acc["spans"], -1)
        joins = (F.size(acc["spans"]) > 0) & (last["end"] >= begin + n - WINDOW)
        longer = F.concat(F.slice(acc["spans"], F.lit(1), F.size(acc["spans"]) - 1), F.array(F.struct(last["start"].alias("start"), F.lit(3).alias("kind"), (begin + n).alias("end"))))
        spans = F.when(~hit, acc["spans"]).when(joins, longer).otherwise(F.concat(acc["spans"], F.array(span)))
        return F.struct(n.alias("i"), counts.alias("counts"), total.alias("sum"), spans.alias("spans"))

    return F.aggregate(steps, start, step, lambda acc: acc["spans"])


def _entropy_spans(text) -> F.Column:
    matches = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    zipped = F.filter(F.arrays_zip(F.split(text, CANDIDATE, -1).alias("gap"), matches.alias("match")), lambda x: x["match"].isNotNull())

    def step(at, x):
        begin = at + F.length(x["gap"])
        return begin + F.length(x["match"]), F.array(F.struct(x["match"].alias("m"), begin.alias("at")))

    found = _grown(zipped, "struct<m:string,at:int>", F.lit(0), step)
    allowed = lambda m: F.when(m.rlike("|".join(f"(?:{p})" for p in ALLOW)), F.concat(*[_spans(m, p, 3) for p in ALLOW])).otherwise(_none())
    least = lambda m: (
        F.when(m.rlike(r"^[0-9a-fA-F]*$") & m.rlike("[a-fA-F]") & m.rlike("[0-9]"), F.lit(THRESHOLDS["hex"]))
        .when(m.rlike(r"^[A-Za-z]*$"), F.lit(THRESHOLDS["letters"]))
        .when(m.rlike("[A-Za-z]") & m.rlike("[0-9]"), F.lit(THRESHOLDS["mixed"]))
        .when(m.rlike("[A-Za-z]"), F.lit(THRESHOLDS["words"]))
        .when(m.rlike("[0-9]"), F.lit(THRESHOLDS["digits"]))
    )
    judged = F.filter(F.transform(found, lambda x: F.struct(x["m"].alias("m"), x["at"].alias("at"), least(x["m"]).alias("least"), allowed(x["m"]).alias("allowed"))), lambda x: x["least"].isNotNull())
    return F.flatten(F.transform(judged, lambda x: _windows_over(x["m"], x["at"], x["least"], x["allowed"])))


def _outside(span: F.Column, base) -> F.Column:
    """The stretches of a span that no base span covers; base is sorted by start."""
    piece = lambda a, b: F.when(a < b, F.array(F.struct(a.alias("start"), F.lit(3).alias("kind"), b.alias("end")))).otherwise(_none())
    start = F.struct(span["start"].alias("at"), _none().alias("spans"))

    def step(acc, b):
        return F.struct(F.greatest(acc["at"], b["end"]).alias("at"), F.concat(acc["spans"], piece(acc["at"], F.least(b["start"], span["end"]))).alias("spans"))

    return F.aggregate(base, start, step, lambda acc: F.concat(acc["spans"], piece(acc["at"], span["end"])))


def scan_secrets(df: DataFrame, *, text_col: str = "text", outside: bool = False) -> DataFrame:
    """df with base_spans and secret_spans (all): arrays of (start, kind number in KINDS, end), by start, then kind."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = F.array_sort(
        F.concat(
            F.when(text.rlike(ASSIGN), _spans(text, ASSIGN, 0, 2, ASSIGN_LEAST)).otherwise(_none()),
            F.when(text.contains("AKIA"), _spans(text, ACCESS, 1)).otherwise(_none()),
            F.when(text.rlike(HEX), _spans(text, HEX, 2)).otherwise(_none()),
        )
    )
    found = df.drop("base_spans", "secret_spans").withColumn("base_spans", base)
    found = found.withColumn("entropy_spans", F.when(text.rlike(CANDIDATE), _entropy_spans(text)).otherwise(_none()))
    if outside:
        clear = F.flatten(F.transform("entropy_spans", lambda e: _outside(e, F.col("base_spans"))))
    else:
        clear = F.filter("entropy_spans", lambda e: ~F.exists("base_spans", lambda b: (b["start"] < e["end"]) & (e["start"] < b["end"])))
    return found.withColumn("secret_spans", F.array_sort(F.concat("base_spans", clear))).drop("entropy_spans")


def as_text(spans) -> F.Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def op1_secret_scans(spark, sf_dir: str) -> DataFrame:
    found = scan_secrets(read_table(spark, sf_dir, "documents").select("doc_id", "text"), outside=True)
    of = lambda k: lambda x: x["kind"] == k
    counts = [F.size(F.filter("base_spans", of(k))).cast("long").alias(f"n_{KINDS[k]}") for k in range(3)]
    return found.select("doc_id", *counts, F.sha2(as_text(F.col("base_spans")), 256).alias("base_sha256"), as_text(F.col("secret_spans")).alias("spans"))


def _found_sql(name: str, source: str, text: str, pattern: str, where: str = "true") -> str:
    """A CTE name(key, b, e, m) of a pattern's matches m in a source's text: from b to e, in code points."""
    quoted = "'" + pattern.replace("'", "''") + "'"
    return f"""
{name}_ AS (
  SELECT key, unnest(string_split_regex({text}, {quoted})) AS gap, unnest(regexp_extract_all({text}, {quoted})) AS m, generate_subscripts(string_split_regex({text}, {quoted}), 1) AS i FROM {source} WHERE regexp_matches({text}, {quoted})
), {name} AS (
  SELECT key, e - length(m) AS b, e, m FROM (SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY key ORDER BY i) AS e FROM {name}_ WHERE m IS NOT NULL) WHERE {where}
)"""


def _op1_sql() -> str:
    """Windows one by one with their entropy, where the operator counts incrementally; positions one by one for what base spans leave."""
    group = ASSIGN.replace("'", "''")
    long_enough = f"length(regexp_extract(m, '{group}', 2)) >= {ASSIGN_LEAST}"
    allow = [_found_sql(f"l{k}", "c", "x", p) for k, p in enumerate(ALLOW)]
    t = THRESHOLDS
    return f"""
WITH t AS (SELECT doc_id AS key, coalesce(text, '') AS x FROM documents),
{_found_sql("ba", "t", "x", ASSIGN, long_enough)},
{_found_sql("bk", "t", "x", ACCESS)},
{_found_sql("bh", "t", "x", HEX)},
base AS (SELECT key, b, 0 AS kind, e FROM ba UNION ALL SELECT key, b, 1, e FROM bk UNION ALL SELECT key, b, 2, e FROM bh),
{_found_sql("cand", "t", "x", CANDIDATE)},
c AS (
  SELECT key AS doc, b AS pos, row_number() OVER () AS key, m AS x, CASE
    WHEN regexp_matches(m, '^[0-9a-fA-F]*$') AND regexp_matches(m, '[a-fA-F]') AND regexp_matches(m, '[0-9]') THEN {t["hex"]}
    WHEN regexp_matches(m, '^[A-Za-z]*$') THEN {t["letters"]} WHEN regexp_matches(m, '[A-Za-z]') AND regexp_matches(m, '[0-9]') THEN {t["mixed"]}
    WHEN regexp_matches(m, '[A-Za-z]') THEN {t["words"]} WHEN regexp_matches(m, '[0-9]') THEN {t["digits"]} END::DOUBLE AS least FROM cand
),
{",".join(allow)},
allowed AS ({" UNION ALL ".join(f"SELECT key, b, e FROM l{k}" for k in range(len(ALLOW)))}),
w AS (SELECT doc, pos, key, least, x, unnest(range(0, length(x) - {WINDOW - 1})) AS i FROM c WHERE least IS NOT NULL),
hit AS (
  SELECT doc, key, pos + i AS b FROM w WHERE list_aggregate(string_split(substr(x, i + 1, {WINDOW}), ''), 'entropy') >= least
    AND NOT EXISTS (SELECT 1 FROM allowed a WHERE a.key = w.key AND a.b < w.i + {WINDOW} AND w.i < a.e)
),
near AS (SELECT *, coalesce(b - lag(b) OVER (PARTITION BY key ORDER BY b) > {WINDOW}, true) AS fresh FROM hit),
isle AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY key ORDER BY b) AS g FROM near),
span AS (SELECT doc, key, g, min(b) AS b, max(b) + {WINDOW} AS e FROM isle GROUP BY ALL),
place AS (SELECT doc, key, g, unnest(range(b::BIGINT, e::BIGINT)) AS p FROM span),
free AS (SELECT *, p - row_number() OVER (PARTITION BY key, g ORDER BY p) AS h FROM place WHERE NOT EXISTS (SELECT 1 FROM base WHERE base.key = place.doc AND base.b <= p AND p < base.e)),
spans AS (SELECT * FROM base UNION ALL SELECT doc, min(p), 3, max(p) + 1 FROM free GROUP BY doc, key, g, h),
named AS (SELECT key, b, kind, e, {list(KINDS)}[kind + 1] || ':' || b::BIGINT || ':' || e::BIGINT AS s FROM spans),
joined AS (
  SELECT key, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    string_agg(s, ',' ORDER BY b, kind, e) FILTER (kind < 3) AS base, string_agg(s, ',' ORDER BY b, kind, e) AS spans FROM named GROUP BY key
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN joined ON key = doc_id
"""


OP1_SQL = _op1_sql()
