"""Generic string predicates and rule compilation.

Keyword lists are compiled into one expression per rule group so a rule pack
costs one pass over the string, inside whole-stage codegen.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_alternation(keywords: Iterable[str]) -> str:
    """Java-regex alternation matching any keyword as a literal substring."""
    parts = [r"\Q" + k + r"\E" for k in dict.fromkeys(keywords) if k != ""]
    return "|".join(parts) if parts else "(?!)"


def matches_any(c, keywords: Iterable[str]) -> Column:
    """``contains_any`` as one quoted regex alternation: for lambda bodies,
    which are interpreted, so that one compiled regex beats a chain of nodes."""
    terms = [k for k in dict.fromkeys(keywords) if k != ""]
    return F.coalesce(_c(c).rlike(literal_alternation(terms)), F.lit(False)) if terms else F.lit(False)


def contains_any(c, keywords: Iterable[str]) -> Column:
    """True when the string holds any keyword as a substring (null -> false):
    a short-circuit OR of ``contains`` (a byte search per keyword, faster in
    generated code than an alternation tried at every position)."""
    terms = [k for k in dict.fromkeys(keywords) if k != ""]
    col = _c(c)
    if not terms:
        return F.lit(False)
    hit = None
    for k in terms:
        h = col.contains(k)
        hit = h if hit is None else hit | h
    return F.coalesce(hit, F.lit(False))


def count_contained(c, keywords: Sequence[str]) -> Column:
    """How many distinct keywords occur in the string (null string -> 0)."""
    s = F.coalesce(_c(c), F.lit(""))
    terms = list(dict.fromkeys(keywords))
    return sum((F.when(F.instr(s, F.lit(k)) > 0, 1).otherwise(0) for k in terms), F.lit(0))


def rule_chain(c, rules: Sequence[tuple[str, Sequence[str]]], default) -> Column:
    """Ordered (label, keywords) rules; first group with a substring hit wins."""
    expr = None
    for label, kws in rules:
        cond = contains_any(c, kws)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    dflt = default if isinstance(default, Column) else F.lit(default)
    return dflt if expr is None else expr.otherwise(dflt)


def py_strip(c) -> Column:
    """Strip leading/trailing whitespace of any kind (Spark ``trim`` only drops blanks)."""
    return F.regexp_replace(_c(c), r"(?U)^\s+|\s+$", "")


def collapse_ws(c) -> Column:
    """strip, then collapse every whitespace run to one blank."""
    return F.regexp_replace(py_strip(c), r"(?U)\s+", " ")


def std_lower(c) -> Column:
    """TRIM(LOWER(x))."""
    return F.trim(F.lower(_c(c)))


def slugify(c, sep: str = "_") -> Column:
    """non-alphanumerics -> separator, separators stripped from the ends."""
    body = F.regexp_replace(F.lower(_c(c)), r"[^a-z0-9]+", sep)
    return F.regexp_replace(body, "^" + re.escape(sep) + "+|" + re.escape(sep) + "+$", "")


def strip_trailing_dash(c) -> Column:
    """drop a trailing `` -`` from scraped company text."""
    return F.regexp_replace(_c(c), r"\s*-\s*$", "")


def nonempty_or_null(c) -> Column:
    return F.nullif(_c(c), F.lit(""))


def first_nonempty(*cols) -> Column:
    """First alternative that is neither null nor empty."""
    return F.coalesce(*[nonempty_or_null(x) for x in cols])


def title_case(c) -> Column:
    """``initcap`` (Python ``.title()`` differs after digits/hyphens)."""
    return F.initcap(_c(c))


def url_encode_blank20(c) -> Column:
    """URL-encode free text, blanks as ``%20``."""
    return F.replace(F.url_encode(_c(c)), F.lit("+"), F.lit("%20"))


def absolute_url(c, host: str) -> Column:
    """F51 (part 1): prefix the host when the link is relative."""
    col = _c(c)
    return F.when(col.startswith("http"), col).otherwise(F.concat(F.lit(host), col))


def id_from_url(c) -> Column:
    """F51 (part 2): id after ``/jobs/p/`` else the last path segment."""
    col = _c(c)
    m = nonempty_or_null(F.regexp_extract(col, r"/jobs/p/([^/?#]+)", 1))
    path = F.regexp_replace(col, r"[?#].*$", "")
    last = F.element_at(F.split(F.regexp_replace(path, r"/+$", ""), "/"), -1)
    return F.coalesce(m, last)
