"""Keyword rules as a table, evaluated in one pass over a text.

A rule is a row ``pack, priority, label, keyword``: a text that holds the keyword
as a substring may take the label; of a pack's rules the least priority wins.
Rules are read from any DataFrame, so they change without a code change.  They
are checked, then compiled into one expression for all packs at once: a single
regular expression, a trie of all keywords, reports at every position the
longest keyword that begins there.  Every other keyword that begins there is a
beginning of that one, so nothing is lost, and a text is read once whatever
the number of rules.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.functions import rules as R
from hirescope.functions.text import _c

SCHEMA = "pack string, priority int, label string, keyword string"
#: Rules are compiled on the driver: more than this is data, not rules.
MAX_RULES = 20_000


def _trie_pattern(words: Iterable[str]) -> str:
    """Java regex for the longest of ``words`` at a position."""
    trie: dict = {}
    for word in words:
        node = trie
        for char in word:
            node = node.setdefault(char, {})
        node[""] = {}

    def write(node: dict) -> str:
        ends = "" in node
        arms = []
        for char, below in sorted((k, v) for k, v in node.items() if k):
            text = re.escape(char)
            while len(below) == 1 and "" not in below:
                (char, below), = below.items()
                text += re.escape(char)
            arms.append(text + write(below))
        if not arms:
            return ""
        return f"(?:{'|'.join(arms)})" + ("?" if ends else "")

    return write(trie)


@dataclass(frozen=True)
class RuleSet:
    """Checked rules, sorted by pack and priority."""

    rows: tuple[tuple[str, int, str, str], ...]

    @classmethod
    def of(cls, table: DataFrame) -> RuleSet:
        """Read and check a rule table; keywords are compared in lower case."""
        rows = [tuple(r) for r in table.select("pack", F.col("priority").cast("int"), "label", "keyword").limit(MAX_RULES + 1).collect()]
        if len(rows) > MAX_RULES:
            raise ValueError(f"more than {MAX_RULES} rules")
        seen: dict[tuple[str, int], str] = {}
        for pack, priority, label, keyword in rows:
            if pack is None or priority is None or label is None or not keyword:
                raise ValueError(f"incomplete rule: {(pack, priority, label, keyword)}")
            if keyword != keyword.lower():
                raise ValueError(f"keyword is not in lower case: {keyword}")
            if seen.setdefault((pack, priority), label) != label:
                raise ValueError(f"two labels of one priority in {pack}: {seen[pack, priority]}, {label}")
        return cls(tuple(sorted(set(rows))))

    def _pack(self, pack: str) -> list[tuple[int, str, str]]:
        found = [(p, label, k) for name, p, label, k in self.rows if name == pack]
        if not found:
            raise ValueError(f"no such rule pack: {pack}")
        return found

    def _by_hit(self, pack: str) -> dict[str, list[tuple[int, str, str]]]:
        """Per reportable keyword, the pack's rules that hold where it is found."""
        rules = self._pack(pack)
        words = {k for *_, k in self.rows}
        by = {w: [r for r in rules if w.startswith(r[2])] for w in words}
        return {w: r for w, r in by.items() if r}

    def hits(self, text) -> Column:
        """The keywords found in a text, as an array to ask the packs about; null for a null text."""
        pattern = f"(?=({_trie_pattern({k for *_, k in self.rows})}))"
        return F.array_distinct(F.regexp_extract_all(F.lower(_c(text)), F.lit(pattern), 1))

    def label(self, hits, pack: str, default: str | Column) -> Column:
        """The label of least priority; ``default`` if no rule of the pack holds."""
        best: dict[str, int] = {w: min(p for p, *_ in rules) for w, rules in self._by_hit(pack).items()}
        names = {p: label for p, label, _ in self._pack(pack)}
        found = F.array_min(F.transform(_c(hits), lambda h: F.try_element_at(_map(best), h)))
        return F.coalesce(F.try_element_at(_map(names), found), default if isinstance(default, Column) else F.lit(default))

    def any(self, hits, pack: str) -> Column:
        """Whether any rule of the pack holds (false for a null text)."""
        return F.coalesce(F.arrays_overlap(_c(hits), F.array(*[F.lit(w) for w in sorted(self._by_hit(pack))])), F.lit(False))

    def count(self, hits, pack: str) -> Column:
        """How many different keywords of the pack are found (0 for a null text)."""
        words = {w: sorted({k for *_, k in rules}) for w, rules in self._by_hit(pack).items()}
        lists = F.create_map(*[x for w, ks in sorted(words.items()) for x in (F.lit(w), F.array(*[F.lit(k) for k in ks]))])
        empty = F.array().cast("array<string>")
        found = F.flatten(F.transform(F.coalesce(_c(hits), empty), lambda h: F.coalesce(F.try_element_at(lists, h), empty)))
        return F.size(F.array_distinct(found))


def _map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in sorted(values.items()) for x in kv])


def ordered(pack: str, groups: Sequence[tuple[str, Sequence[str]]]) -> list[tuple[str, int, str, str]]:
    """Rows of an ordered list of (label, keywords): the first group that matches wins."""
    return [(pack, i, label, k) for i, (label, words) in enumerate(groups) for k in words if k]


def default_rules(spark: SparkSession) -> DataFrame:
    """The fixed rules of the library as a rule table."""
    rows = (ordered("category", R.CATEGORY_RULES) + ordered("category_wide", R.CATEGORY_RULES_WIDE)
            + ordered("reclassify", R.RECLASSIFY_OTHER_RULES) + ordered("level", R.LEVEL_TITLE_RULES)
            + ordered("relevant", [("relevant", R.TECH_TITLE_KEYWORDS)]) + ordered("tech", [("tech", R.TECH_SKILLS_VOCAB)])
            + ordered("foreign_url", [("foreign", R.NON_EGYPT_URL_PATTERNS)])
            + ordered("company", [("MNC", R.KNOWN_MNCS), ("Government", R.GOVERNMENT_KEYWORDS)])
            + ordered("startup", [("startup", R.STARTUP_KEYWORDS)]))
    return spark.createDataFrame(sorted(set((p, i, label, k.lower()) for p, i, label, k in rows)), SCHEMA)


def packs(spark: SparkSession, *names: str) -> RuleSet:
    """Some packs of the fixed rules."""
    return RuleSet.of(default_rules(spark).where(F.col("pack").isin(*names)))
