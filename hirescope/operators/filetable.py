"""Upserts that rewrite files, not tables.

One folder holds a few named tables as plain Parquet files and one log.  A
commit is one log entry: the files it adds and the files it takes out of use,
for all tables at once, so readers see the tables of one commit together.

* An upsert finds the files that hold the delta's keys (the scan reads the key
  column only, and row-group statistics skip files outside the delta's key
  range), and rewrites those.  All other files stay as they are.  Rows are written
  in ranges of the ``cluster`` columns, as many tasks as the rows need, so no
  task holds a share that grows with the table.
* An entry is written under a temporary name and renamed where no entry of its
  number exists: of two writers that started from the same parent one gets
  ``CommitConflict``, and a writer that dies leaves nothing that others read.
* A version (a day, a micro-batch) that is committed is not applied again.
* Every ``SNAPSHOT_EVERY`` commits the log is folded, so a read costs a bounded
  number of small files.

File names meet on the driver, as in any Parquet scan; rows never do.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.operators.dedup import keep_last
from hirescope.operators.upsert import commit_entry, log_rows
from hirescope.session import written

ROWS_PER_FILE = 1 << 20
#: Keys that a join may copy to every task; more are shuffled.
SMALL_DELTA = 1 << 16


@dataclass
class Change:
    """What a commit does to one table.  ``applied`` are the delta's rows that
    take effect, ``replaced`` the stored rows they replace (None: there are none)."""

    entries: list[dict] = field(default_factory=list)
    applied: DataFrame | None = None
    replaced: DataFrame | None = None
    updated: int = 0
    appended: int = 0
    late: int = 0
    rewritten: list[str] = field(default_factory=list)


def live_files(spark: SparkSession, base: str, table: str = "data") -> list[str]:
    """The files that make up a table now."""
    last: dict[str, tuple] = {}
    for r in log_rows(spark, base).where(F.col("label") == table).collect():
        if r["path"] not in last or r["seq"] >= last[r["path"]][0]:
            last[r["path"]] = (r["seq"], bool(r["gone"]))
    return sorted(p for p, (_, gone) in last.items() if not gone)


def read(spark: SparkSession, base: str, table: str = "data") -> DataFrame | None:
    """The rows of a table now; None before its first commit."""
    files = live_files(spark, base, table)
    return spark.read.parquet(*files) if files else None


def _write(df: DataFrame, base: str, table: str, cluster: Sequence[str], rows: int, rows_per_file: int) -> list[dict]:
    folder = f"{base.rstrip('/')}/{table}/{uuid.uuid4().hex}"
    parts = max(1, math.ceil(rows / rows_per_file))
    df.repartitionByRange(parts, *cluster).sortWithinPartitions(*cluster).write.parquet(folder)
    return [{"label": table, "path": p, "gone": False} for p in df.sparkSession.read.parquet(folder).inputFiles()]


def _keys(df: DataFrame, rows: int) -> DataFrame:
    """``df`` as a side of a join by key.  Its rows were counted, so the join needn't trust the
    size of its files: of keys that compress well Spark would send a whole delta through
    the driver to every task."""
    return df if rows <= SMALL_DELTA else df.hint("merge")


def plan_append(df: DataFrame, base: str, table: str, cluster: Sequence[str], rows_per_file: int = ROWS_PER_FILE) -> Change:
    """Add rows without looking at those there are."""
    return Change(_write(df, base, table, cluster, df.count(), rows_per_file))


def plan_replace(df: DataFrame, base: str, table: str, cluster: Sequence[str], rows_per_file: int = ROWS_PER_FILE) -> Change:
    """Rows in place of all that a table holds."""
    old = live_files(df.sparkSession, base, table)
    made = _write(df, base, table, cluster, df.count(), rows_per_file)
    return Change(made + [{"label": table, "path": p, "gone": True} for p in old], rewritten=old)


def plan_upsert(source: DataFrame, base: str, key: str, order: Sequence[str], table: str = "data",
                cluster: Sequence[str] | None = None, newer_only: bool = False, rows_per_file: int = ROWS_PER_FILE) -> Change:
    """Merge ``source`` by ``key``: several rows of a key count as one, the last by
    ``order``; stored rows of its keys are replaced, new keys are inserted.

    ``newer_only``: a row takes effect only if it comes after the stored row in
    ``order`` (nulls first); rows that come earlier, or are equal, are late and
    change nothing.  Then the result doesn't depend on the order in which
    deltas arrive, or on how often.  Rows with a null key are left out.
    """
    spark = source.sparkSession
    cluster = cluster or [key]
    src = written(keep_last(source.where(F.col(key).isNotNull()), [key], order))
    low, high, given = src.agg(F.min(key), F.max(key), F.count("*")).first()
    if not given:
        return Change(applied=src)
    files = live_files(spark, base, table)
    if not files:
        return Change(_write(src, base, table, cluster, given, rows_per_file), src, None, 0, given)
    place = F.struct(*[F.col(c) for c in order])
    named = {p.rsplit("/", 1)[1]: p for p in files}
    stored = spark.read.parquet(*files).where(F.col(key).between(low, high))
    held = (stored.select(key, place.alias("_then"), F.element_at(F.split("_metadata.file_path", "/"), -1).alias("_file"))
            .join(_keys(src.select(key, place.alias("_now")), given), key))
    takes = F.col("_now") > F.col("_then") if newer_only else F.lit(True)
    held = written(held.select(key, "_file", takes.alias("_takes")))
    found = held.groupBy("_file").agg(F.count_if("_takes").alias("n"), F.count_if(~F.col("_takes")).alias("late")).collect()
    late = sum(r["late"] for r in found)
    touched = [named[r["_file"]] for r in found if r["n"]]
    updated = sum(r["n"] for r in found)
    applied = src.join(_keys(held.where(~F.col("_takes")).select(key), late), key, "left_anti") if late else src
    n_new = given - late
    if not n_new:
        return Change(applied=applied, late=late)
    if not touched:
        return Change(_write(applied, base, table, cluster, n_new, rows_per_file), applied, None, 0, n_new, late)
    old = spark.read.parquet(*touched)
    kept = old.join(_keys(applied.select(key), given - late), key, "left_anti")
    replaced = old.join(_keys(applied.select(key), given - late), key, "left_semi")
    made = _write(kept.unionByName(applied.select(*old.columns)), base, table, cluster, old.count() + n_new - updated, rows_per_file)
    gone = [{"label": table, "path": p, "gone": True} for p in touched]
    return Change(made + gone, applied, replaced, updated, n_new - updated, late, touched)


def commit(spark: SparkSession, base: str, version: int | str, parent: int, changes: Sequence[Change]) -> int:
    """Make changes planned from commit ``parent`` visible together."""
    return commit_entry(spark, base, version, parent, [e for c in changes for e in c.entries] or [{"path": None}])


def upsert(source: DataFrame, base: str, key: str, order: Sequence[str], version: int | str | None = None,
           **options) -> Change:
    """``plan_upsert`` and ``commit``; a committed ``version`` is not applied again."""
    spark = source.sparkSession
    version = uuid.uuid4().hex if version is None else version
    log = log_rows(spark, base)
    parent, done = log.agg(F.coalesce(F.max("seq"), F.lit(0)), F.count_if(F.col("version") == str(version))).first()
    if done:
        return Change()
    change = plan_upsert(source, base, key, order, **options)
    commit(spark, base, version, parent, [change])
    return change
