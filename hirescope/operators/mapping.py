"""Projections driven by a table.

A mapping is rows ``source, position, target, rule, argument``: column ``target`` of the
common schema comes from ``rule`` applied to the source's column ``argument``
(or, for ``literal``, to the text itself).  The table is checked and compiled to
one projection per source, so a source is added or changed by rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCHEMA = "source string, position int, target string, rule string, argument string"
MAX_ROWS = 10_000


def compile_mapping(table: DataFrame, rules: Mapping[str, Callable[[Column], Column]]) -> dict[str, list[tuple[str, str, str]]]:
    """Checked ``source -> [(target, rule, argument)]``; every source has the same targets, in one order."""
    rows = table.select("source", "position", "target", "rule", "argument").orderBy("source", "position").limit(MAX_ROWS + 1).collect()
    if len(rows) > MAX_ROWS:
        raise ValueError(f"more than {MAX_ROWS} mapping rows")
    out: dict[str, list[tuple[str, str, str]]] = {}
    for r in rows:
        if r["rule"] not in rules and r["rule"] != "literal":
            raise ValueError(f"unknown rule {r['rule']} for {r['source']}.{r['target']}")
        out.setdefault(r["source"], []).append((r["target"], r["rule"], r["argument"]))
    targets = {source: [t for t, *_ in cols] for source, cols in out.items()}
    first = next(iter(targets.values()), [])
    for source, names in targets.items():
        if len(set(names)) != len(names):
            raise ValueError(f"{source}: a target is given twice")
        if names != first:
            raise ValueError(f"{source} has other targets: {sorted(set(names) ^ set(first)) or 'another order'}")
    return out


def project(df: DataFrame, columns: list[tuple[str, str, str]], rules: Mapping[str, Callable[[Column], Column]],
            keep: tuple[str, ...] = ()) -> DataFrame:
    """One source in the common schema, with its columns ``keep`` beside it."""
    def made(rule: str, argument: str) -> Column:
        return F.lit(argument) if rule == "literal" else rules[rule](F.col(argument))
    return df.select(*keep, *[made(rule, argument).alias(target) for target, rule, argument in columns])
