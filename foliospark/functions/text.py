"""Text expressions with Unicode-aware white space, on which JVM defaults and the data model differ."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the code points that count as white space when words are split and strings are stripped.
WHITE = r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x) -> Column:
    """x without white space at its ends (null stays null)."""
    return F.regexp_replace(_col(x), f"^[{WHITE}]+|[{WHITE}]+\\z", "")


def is_blank(x) -> Column:
    """True if x is null, empty or white space only."""
    return ~F.coalesce(_col(x).rlike(f"[^{WHITE}]"), F.lit(False))


def word_count(x) -> Column:
    return F.coalesce(F.regexp_count(_col(x), F.lit(f"[^{WHITE}]+")), F.lit(0))


def strip_html(x) -> Column:
    """x without tags, stripped; null gives an empty string. Entities stay."""
    return F.coalesce(strip(F.regexp_replace(_col(x), "<[^>]+>", "")), F.lit(""))


def estimate_tokens(x) -> Column:
    """A quarter of the code points, at least 1."""
    return F.greatest(F.lit(1), F.floor(F.length(_col(x)) / F.lit(4.0)).cast("int"))


def short_hash(x, size: int = 16) -> Column:
    """The first hex digits of the SHA-1 of the UTF-8 text."""
    return F.substring(F.sha1(_col(x).cast("binary")), 1, size)


def clean_arxiv_id(x, strict: bool = True) -> Column:
    """The first new-style arXiv id anywhere in x, without its version; none: an error, or null if not strict."""
    found = F.regexp_extract(_col(x), r"(?U)(\d{4}\.\d{4,5})", 1)
    other = F.raise_error(F.concat(F.lit("no arXiv id in: "), F.coalesce(_col(x), F.lit("null")))) if strict else F.lit(None)
    return F.when(found != "", found).otherwise(other.cast("string"))


def point_id(x) -> Column:
    """UUID form of a hex id of up to 32 digits, padded with zeros on the right; other ids raise an error."""
    x = _col(x)
    padded = F.regexp_replace(F.rpad(F.lower(x), 32, "0"), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.when(x.rlike("^[0-9a-fA-F]{1,32}$"), padded).otherwise(F.raise_error(F.concat(F.lit("not a hex id: "), F.coalesce(x, F.lit("null")))).cast("string"))


def numbers_in(x) -> Column:
    """All decimal numbers of a text as doubles."""
    found = F.regexp_extract_all(_col(x), F.lit(r"([0-9]+(?:\.[0-9]+)?)"), F.lit(1))
    return F.transform(found, lambda n: n.cast("double"))


def similarity(a, b) -> Column:
    """1 - Levenshtein distance / longer length, ignoring case and outer white space."""
    a, b = F.lower(strip(a)), F.lower(strip(b))
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer == 0, F.lit(1.0)).otherwise(F.lit(1.0) - F.levenshtein(a, b) / longer)
