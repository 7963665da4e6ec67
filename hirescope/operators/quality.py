"""Data-quality checks.

Every gate is computed in ONE aggregate pass (``count_if`` / ``min`` / ``max``
per check) and returned as a one-row-per-check DataFrame; nothing iterates
over rows on the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def relationship_failures(fact: DataFrame, rels: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per foreign key, the count of fact rows with a non-null key that is
    missing from the dimension.

    One aggregate for all keys: how often a key is tested and held.  The fact
    table is read once, equal keys are counted in every task before they move,
    and no dimension, however large, is copied to the tasks."""
    def cell(fk: str, column: str, tested: int) -> Column:
        return F.struct(F.lit(fk).alias("fk"), F.col(column).cast("string").alias("key"), F.lit(tested).alias("tested"), F.lit(1 - tested).alias("held"))
    keys = fact.select(F.explode(F.array(*[cell(fk, fk, 1) for fk in rels])).alias("x"))
    for fk, (dim, pk) in rels.items():
        keys = keys.unionByName(dim.select(cell(fk, pk, 0).alias("x")))
    per = (keys.select("x.*").where("key is not null").groupBy("fk", "key")
           .agg(F.sum("tested").alias("tested"), F.max("held").alias("held")).where("held = 0"))
    wide = per.groupBy().agg(*[F.coalesce(F.sum(F.when(F.col("fk") == fk, F.col("tested"))), F.lit(0)).alias(fk) for fk in rels])
    return _stack(wide, list(rels), "failures", "relationship")


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null count per column, long form (one aggregate pass)."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, null_count)")


def _stack(wide: DataFrame, names: Sequence[str], value_alias: str, name_alias: str = "check") -> DataFrame:
    stack = ", ".join(f"'{n}', CAST(`{n}` AS BIGINT)" for n in names)
    return wide.selectExpr(f"stack({len(names)}, {stack}) AS ({name_alias}, {value_alias})")


def quality_gate(df: DataFrame, as_of, required: Sequence[str], critical: Sequence[str], key: str,
                 accepted: Mapping[str, Sequence[str]], url_col: str, url_prefix: str,
                 date_col: str, max_span_days: int, list_col: str, max_empty_pct: float,
                 min_rows: int, max_rows: int | None = None) -> DataFrame:
    """Q1-Q11: every check of the runtime gate in ONE aggregate pass.

    Returns one row per check: ``check, failing, passed`` where ``failing``
    counts offending rows (or the offending value for range checks).  Null
    counts as invalid for accepted-value checks.  ``as_of`` is a Column
    (literal or scalar subquery) so re-runs are reproducible.  ``max_rows``
    None sets no upper bound.
    """
    missing = [c for c in required if c not in df.columns]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for c in critical:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"not_null_{c}"))
    aggs.append((F.count(F.lit(1)) - F.count_distinct(key)).alias(f"unique_{key}"))
    for c, vals in accepted.items():
        aggs.append(F.count_if(~F.coalesce(F.col(c).isin(list(vals)), F.lit(False))).alias(f"accepted_{c}"))
    aggs.append(F.count_if(~F.coalesce(F.col(url_col).startswith(url_prefix), F.lit(False))).alias("url_prefix"))
    aggs.append(F.datediff(as_of, F.min(date_col)).alias("_span"))
    aggs.append(F.datediff(F.max(date_col), as_of).alias("_ahead"))
    empty = F.coalesce(F.size(list_col), F.lit(0)) <= 0
    aggs.append(F.count_if(empty).alias("_empty"))
    a = df.agg(*aggs)
    a = a.select("*",
                 F.when((F.col("_rows") >= min_rows) & (F.lit(max_rows is None) | (F.col("_rows") <= (max_rows or 0))), 0)
                 .otherwise(F.col("_rows")).alias("row_count"),
                 F.lit(len(missing)).alias("required_columns"),
                 F.when(F.col("_span") > max_span_days, F.col("_span"))
                 .when(F.col("_ahead") > 0, F.col("_ahead")).otherwise(0).alias("date_range"),
                 F.when(F.col("_rows") == 0, 1)
                 .when(F.col("_empty") * 100.0 / F.col("_rows") > max_empty_pct, F.col("_empty"))
                 .otherwise(0).alias("empty_skills"))
    names = (["row_count", "required_columns"] + [f"not_null_{c}" for c in critical] + [f"unique_{key}"]
             + [f"accepted_{c}" for c in accepted] + ["url_prefix", "date_range", "empty_skills"])
    return _stack(a, names, "failing").withColumn("passed", F.col("failing") == 0)


def offenders(df: DataFrame, accepted: Mapping[str, Sequence[str]], k: int = 10) -> DataFrame:
    """Q5-Q7: the ``k`` commonest values that each accepted-value check refuses:
    ``check, value, n, rank`` (ties: the lesser value, null first).

    One pass for all checks.  Counts are combined in every task before they
    move, and only counted values are ranked, so a value that a third of all
    rows hold is one row per task."""
    from pyspark.sql import Window
    cases = [F.when(~F.coalesce(F.col(c).isin(list(vals)), F.lit(False)),
                    F.struct(F.lit(f"accepted_{c}").alias("check"), F.col(c).cast("string").alias("value")))
             for c, vals in accepted.items()]
    bad = df.select(F.explode(F.filter(F.array(*cases), lambda x: x.isNotNull())).alias("x")).select("x.*")
    counted = bad.groupBy("check", "value").agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy("check").orderBy(F.desc("n"), F.asc_nulls_first("value")))
    return counted.withColumn("rank", place.cast("bigint")).where(F.col("rank") <= k)


def gate_summary(checks: DataFrame) -> DataFrame:
    """Q11: passed / failed counts and overall status (one row)."""
    return checks.agg(F.count_if("passed").alias("checks_passed"), F.count_if(~F.col("passed")).alias("checks_failed")) \
        .withColumn("status", F.when(F.col("checks_failed") == 0, "PASSED").otherwise("FAILED"))


def raw_completeness(raw: DataFrame, file_col: str, id_col: str, fields: Sequence[str],
                     missing_tokens: Sequence[str], list_col: str) -> DataFrame:
    """Per file: total, ids seen more than once, empty skill lists,
    and missing count per field (null, '' or a placeholder)."""
    def missing(c):
        dt = dict(raw.dtypes)[c]
        if dt.startswith("array"):
            return F.col(c).isNull()
        return F.col(c).isNull() | F.col(c).cast("string").isin(list(missing_tokens))
    per = raw.groupBy(file_col).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.coalesce(F.size(list_col), F.lit(0)) <= 0).alias("empty_skills"),
        *[F.count_if(missing(c)).alias(f"missing_{c}") for c in fields])
    ids = raw.groupBy(file_col, id_col).agg(F.count(F.lit(1)).alias("_n"))
    dups = ids.groupBy(file_col).agg(F.count_if(F.col("_n") > 1).alias("duplicates"))
    return per.join(dups, file_col)


def top_values_per_group(df: DataFrame, group: str, col: str, k: int = 5) -> DataFrame:
    """A17 top-k: most common values per group (ties by value), computed on
    the (group, value) aggregate so the window is bounded by distinct values."""
    from pyspark.sql import Window
    c = df.groupBy(group, col).agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy(group).orderBy(F.desc("count"), F.asc(col))
    return c.withColumn("rank", F.row_number().over(w).cast("bigint")).filter(F.col("rank") <= k)


def model_tests(tables: Mapping[str, DataFrame], not_null: Sequence[tuple[str, str]],
                unique: Sequence[tuple[str, str]], accepted: Sequence[tuple[str, str, Sequence[str]]],
                relationships: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Q12: declarative model tests -> one row per test with its failing-row
    count.  not_null / accepted tests of a table share one aggregate; all unique
    and relationship tests of all tables share another: keys are counted per
    (test, key), on the tested side and on the side that must hold them."""
    rows = []
    by_table: dict[str, list] = {}
    for t, c in not_null:
        by_table.setdefault(t, []).append((f"not_null_{t}_{c}", F.count_if(F.col(c).isNull())))
    for t, c, vals in accepted:
        by_table.setdefault(t, []).append(
            (f"accepted_values_{t}_{c}", F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(list(vals)))))
    for t, specs in by_table.items():
        wide = tables[t].agg(*[e.alias(n) for n, e in specs])
        rows.append(_stack(wide, [n for n, _ in specs], "failures", "test"))
    # How often each key is tested and held, per test.
    asked: dict[str, list[tuple[str, str, int, int]]] = {}
    for t, c in unique:
        asked.setdefault(t, []).append((f"unique_{t}_{c}", c, 1, 1))
    for t, c, dim, pk in relationships:
        asked.setdefault(t, []).append((f"relationships_{t}_{c}", c, 1, 0))
        asked.setdefault(dim, []).append((f"relationships_{t}_{c}", pk, 0, 1))
    keys = None
    for t, specs in asked.items():
        cells = F.array(*[F.struct(F.lit(n).alias("test"), F.col(c).cast("string").alias("key"), F.lit(a).alias("tested"),
                                   F.lit(b).alias("held")) for n, c, a, b in specs])
        part = tables[t].select(F.explode(cells).alias("x")).select("x.*").where("key is not null")
        keys = part if keys is None else keys.unionByName(part)
    if keys is not None:
        per = keys.groupBy("test", "key").agg(F.sum("tested").alias("tested"), F.sum("held").alias("held"))
        bad = F.when(F.col("test").startswith("unique_"), (F.col("tested") > 1).cast("long")).when(F.col("held") == 0, F.col("tested")).otherwise(0)
        names = sorted({n for specs in asked.values() for n, *_ in specs})
        wide = per.groupBy().agg(*[F.coalesce(F.sum(F.when(F.col("test") == n, bad)), F.lit(0)).alias(n) for n in names])
        rows.append(_stack(wide, names, "failures", "test"))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def audit_profile(df: DataFrame, exact: bool = True, rsd: float = 0.01) -> DataFrame:
    """Q14: per column -- type, nulls, distinct values, min / max as text --
    from ONE aggregate pass.  Exact distinct counts make Spark expand every
    row once per column before the shuffle; ``exact=False`` uses HyperLogLog
    sketches (``approx_count_distinct``, relative error ``rsd``), which merge
    map-side and shuffle only the sketches -- the right choice at 100 TB."""
    simple = [f for f in df.schema.fields if f.dataType.typeName() not in ("array", "map", "struct")]
    aggs = []
    for f in simple:
        c = F.col(f"`{f.name}`")
        distinct = F.count_distinct(c) if exact else F.approx_count_distinct(c, rsd)
        aggs += [F.count_if(c.isNull()).alias(f"{f.name}__n"), distinct.alias(f"{f.name}__d"),
                 F.min(c).cast("string").alias(f"{f.name}__lo"), F.max(c).cast("string").alias(f"{f.name}__hi")]
    wide = df.agg(F.count(F.lit(1)).alias("__rows"), *aggs)
    parts = ", ".join(f"'{f.name}', '{f.dataType.simpleString()}', `{f.name}__n`, `{f.name}__d`, `{f.name}__lo`, `{f.name}__hi`"
                      for f in simple)
    return wide.selectExpr("__rows AS row_count",
                           f"stack({len(simple)}, {parts}) AS (column_name, data_type, null_count, distinct_count, min_value, max_value)")
