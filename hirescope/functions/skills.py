"""Skill-list cleaning (F13-F20, F47, F48): higher-order array functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirescope.functions import rules as R
from hirescope.functions.text import _c, contains_any, count_contained, literal_alternation, matches_any, py_strip

BULLETS = ["·", "•", "✔"]


def parse_list_literal(c) -> Column:
    """Python-style list literal text -> array<string>; unparseable -> []."""
    parsed = F.from_json(_c(c), "array<string>", {"allowSingleQuotes": "true"})
    return F.coalesce(parsed, F.array().cast("array<string>"))


def first_of_list_literal(c, default: str = "unknown") -> Column:
    """first element of a list literal, else a default."""
    return F.coalesce(F.try_element_at(parse_list_literal(c), F.lit(1)), F.lit(default))


def is_tech_skill(skill) -> Column:
    """vocabulary substring match (one compiled alternation)."""
    return contains_any(F.lower(_c(skill)), R.TECH_SKILLS_VOCAB)


def clean_skills_list(arr, bullet: str = "strip", vocabulary: bool = True,
                      markers=None, min_len: int = 0, noise=None) -> Column:
    """F13 (and F18 via ``markers`` / ``vocabulary=False``).

    Per element: strip; drop if longer than 50, holding a sentence marker, a
    noise word, or >= 2 title words; optionally keep only tech vocabulary.
    A leading bullet is removed; ``bullet='drop'`` drops such a skill instead.
    """
    markers = R.SKILL_SENTENCE_MARKERS if markers is None else markers
    noise = R.SKILL_NOISE if noise is None else noise
    s = F.transform(F.coalesce(_c(arr), F.array().cast("array<string>")),
                    lambda x: py_strip(F.coalesce(x, F.lit("None"))))
    if bullet == "strip":
        s = F.transform(s, lambda x: py_strip(F.regexp_replace(x, r"^[·•✔]\s*", "")))
        markers = [m for m in markers if m not in BULLETS]

    # Higher-order-function bodies are interpreted (no codegen): there one
    # compiled regex per keyword list beats a chain of ``contains`` nodes.
    def keep(x):
        low = F.lower(x)
        ok = ((F.length(x) <= R.SKILL_MAX_LEN)
              & ~matches_any(x, markers)
              & ~low.isin(list(noise))
              & (count_contained(low, R.SKILL_TITLE_WORDS) < 2))
        if min_len:
            ok = ok & (F.length(x) >= min_len)
        if vocabulary:
            ok = ok & matches_any(low, R.TECH_SKILLS_VOCAB)
        return ok

    return F.filter(s, keep)


def clean_skills_regex(arr, noise_patterns: list[str], min_len: int = 3) -> Column:
    """drop elements matching any noise regex (case-insensitive, anchored
    at the start) or shorter than ``min_len``; de-duplicate."""
    rx = "(?i)^(?:" + "|".join(noise_patterns) + ")"
    s = F.filter(F.coalesce(_c(arr), F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != ""))
    s = F.transform(s, lambda x: py_strip(x))
    return F.array_distinct(F.filter(s, lambda x: ~x.rlike(rx) & (F.length(x) >= min_len)))


def clean_skills_policy(arr, exact_drop: list[str], bullet: str = "drop", min_len: int = 2) -> Column:
    """Case-sensitive exact-match drop set; a bullet-prefixed skill
    is dropped (v2) or has its bullet removed (final: ``'· '`` -> rest as is,
    ``'·'`` -> rest stripped); dash-suffixed and shorter than ``min_len``
    dropped; empty / null skipped; de-duplicated."""
    s = F.filter(F.coalesce(_c(arr), F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != ""))
    s = F.transform(s, lambda x: py_strip(x))
    if bullet == "strip":
        s = F.transform(s, lambda x: F.when(x.startswith("· "), F.substring(x, 3, 1 << 30))
                        .when(x.startswith("·"), py_strip(F.substring(x, 2, 1 << 30))).otherwise(x))

    def keep(x):
        ok = ~x.isin(list(exact_drop)) & ~x.endswith("-") & (F.length(x) >= min_len)
        if bullet == "drop":
            ok = ok & ~x.startswith("·")
        return ok

    return F.array_distinct(F.filter(s, keep))


def list_to_text(arr) -> Column:
    """array -> JSON text for text sinks."""
    return F.to_json(_c(arr))


def normalized_skills(arr) -> Column:
    """F47 native mode: trim + lower every element, drop blanks / one-letter items,
    de-duplicate within the row (so later counts need no DISTINCT shuffle)."""
    s = F.transform(_c(arr), lambda v: F.trim(F.lower(v)))
    return F.array_distinct(F.filter(s, lambda v: v.isNotNull() & (F.length(v) >= R.SKILL_MIN_LEN)))


__all__ = ["parse_list_literal", "first_of_list_literal", "is_tech_skill", "clean_skills_list",
           "clean_skills_regex", "clean_skills_policy", "list_to_text",
           "normalized_skills", "literal_alternation"]
