"""URL filters: a trie over reversed host labels, with a trie over path segments at each host node.

Rules are (verdict, host, path). A rule fits its host and all its subdomains if the URL's path starts with the
rule's path. Of the rules that fit, the one with the most host labels wins, then the one with the longest path;
an allow entry and a block entry for the same place are settled in favour of block.

Up to MAX_TRIE_RULES rules the trie is a broadcast variable of bounded size. Longer lists stay a table and meet
the pages by an equi-join on every host suffix and path prefix that rules can have (judge_urls_by_table).

Defined results: a null URL, or one without "://", has an empty host and path; only a rule with an empty host
could fit, and none is accepted, so it gets the default verdict. Repeated rows are judged alike. Input columns
named like an output column are replaced; others are kept.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliospark.llm.common import append_columns, text_of

MAX_TRIE_RULES = 200_000
MAX_RULE_CHARS = 2_000

Rule = tuple[str, str, str]

#: Fixed values of the contract.
RULES: list[Rule] = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
_TO_LOWER = str.maketrans(UPPER, LOWER)


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path."""
    if url is None:
        return "", ""
    at = url.find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    for mark in "?#":
        rest = rest.partition(mark)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_TO_LOWER), slash + path


class _HostNode:
    """A host label: the labels before it, and the paths of its rules."""

    __slots__ = ("labels", "site")

    def __init__(self):
        self.labels, self.site = {}, None


class _PathNode:
    """A place after a slash: the whole segments that go on, and last segments of rules, which are prefixes of a URL's."""

    __slots__ = ("segments", "ends", "longest")

    def __init__(self):
        self.segments, self.ends, self.longest = {}, {}, 0


class UrlTrie:
    """Host labels from the last one down, and at each host with rules their path segments."""

    def __init__(self, rules: Iterable[Rule]):
        self.root = _HostNode()
        for verdict, host, path in rules:
            if verdict not in ("allow", "block") or not host:
                raise ValueError(f"not a rule: {(verdict, host, path)}")
            node = self.root
            for label in reversed(host.translate(_TO_LOWER).split(".")):
                node = node.labels.setdefault(label, _HostNode())
            node.site = node.site or _PathNode()
            place = node.site
            *whole, last = path.split("/")
            for segment in whole:
                place = place.segments.setdefault(segment, _PathNode())
            if place.ends.get(last, ("",))[0] != "block":
                place.ends[last] = (verdict, host + path)
                place.longest = max(place.longest, len(last))

    @staticmethod
    def _path(site: _PathNode, segments: list[str]) -> tuple[str, str] | None:
        """Deepest rule whose path is a prefix of the path with these segments."""
        best, node = None, site
        for segment in segments:
            if node.ends:
                for n in range(min(len(segment), node.longest), -1, -1):
                    if (hit := node.ends.get(segment[:n])) is not None:
                        best = hit
                        break
            node = node.segments.get(segment)
            if node is None:
                break
        return best

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """(verdict, rule) of the longest match."""
        if not host:
            return None
        best, node, segments = None, self.root, path.split("/")
        for label in reversed(host.split(".")):
            node = node.labels.get(label)
            if node is None:
                break
            if node.site is not None:
                best = self._path(node.site, segments) or best
        return best


FIELDS = [T.StructField(c, T.StringType()) for c in ("host", "path", "rule", "verdict")]


def judge_urls(pages: DataFrame, rules: Iterable[Rule] = RULES, *, url_col: str = "url", default: str = "allow") -> DataFrame:
    """pages with host, path, rule (null if none fits) and verdict."""
    rules = list(rules)
    if len(rules) > MAX_TRIE_RULES or any(len(h) + len(p) > MAX_RULE_CHARS for _, h, p in rules):
        table = pages.sparkSession.createDataFrame(rules, "verdict string, host string, path string")
        return judge_urls_by_table(pages, table, url_col=url_col, default=default)
    trie = pages.sparkSession.sparkContext.broadcast(UrlTrie(rules))

    def make():
        match = trie.value.match

        def compute(batch: pa.RecordBatch):
            parts = [split_url(u) for u in text_of(batch, url_col)]
            hits = [match(h, p) for h, p in parts]
            columns = ([h for h, _ in parts], [p for _, p in parts], [x and x[1] for x in hits], [x[0] if x else default for x in hits])
            return [pa.array(c, pa.string()) for c in columns]

        return compute

    return append_columns(pages, FIELDS, make)


def _url_parts(url) -> tuple[F.Column, F.Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(F.substring_index(url.substr(F.instr(url, "://") + 3, F.length(url)), "?", 1), "#", 1))
    host = F.coalesce(F.translate(F.substring_index(rest, "/", 1), UPPER, LOWER), F.lit(""))
    return host, F.coalesce(F.when(F.instr(rest, "/") > 0, rest.substr(F.instr(rest, "/"), F.length(rest))), F.lit(""))


def judge_urls_by_table(pages: DataFrame, rules: DataFrame, *, url_col: str = "url", default: str = "allow") -> DataFrame:
    """The same for rules of any number: distinct URLs, exploded to (host suffix, path prefix) keys, joined with the rules."""
    host, path = _url_parts(F.col("_u"))
    urls = pages.select(F.col(url_col).alias("_u")).distinct().select("_u", host.alias("host"), path.alias("path"))
    lengths = rules.select(F.length("path").alias("n")).distinct().agg(F.sort_array(F.collect_set("n")).alias("lengths"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    keys = (
        urls.where("host <> ''")
        .crossJoin(F.broadcast(lengths))  # one row
        .select("_u", F.explode(suffixes).alias("h"), "path", "lengths")
        .select("_u", "h", F.explode(F.filter("lengths", lambda n: n <= F.length("path"))).alias("n"), "path")
        .select("_u", "h", F.expr("substring(path, 1, n)").alias("p"))
    )
    order = F.struct(F.size(F.split("h", r"\.")).alias("labels"), F.length("p").alias("n"), (F.col("verdict") == "block").alias("block"))
    best = (
        keys.join(rules.select(F.translate("host", UPPER, LOWER).alias("h"), F.col("path").alias("p"), "verdict"), ["h", "p"])
        .groupBy("_u")
        .agg(F.max_by(F.struct("verdict", F.concat("h", "p").alias("rule")), order).alias("hit"))
    )
    judged = urls.join(best, "_u", "left").select("_u", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", F.lit(default)).alias("verdict"))
    kept = pages.drop("host", "path", "rule", "verdict")
    return kept.join(judged, kept[url_col].eqNullSafe(judged["_u"]), "left").drop("_u")


def op7_url_filters(spark, sf_dir: str) -> DataFrame:
    from foliospark.llm.common import read_table

    return judge_urls(read_table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


OP7_SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*', 0)) + 1), '^[^?#]*', 0) AS path
  FROM u
), r AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/' END AS rule
  FROM p
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict FROM r
"""
