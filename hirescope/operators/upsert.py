"""Upserts (J5-J7) and the incremental slice (P17) without a row-level table format.

A MERGE by key is expressed as ``target LEFT ANTI source  UNION  source``:
two scans, one shuffle on the key (AQE turns it into a broadcast when the
delta is small, which is the normal daily case).

Tables are versioned.  Every write goes to a fresh folder; a commit adds one
entry to the table's log, numbered in sequence and naming its parent.  A
folder in the log is never written again: a committed version is not written
twice, an attempt that dies leaves a folder nobody reads, and of two writers
that started from the same parent only the first commits.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirescope.operators.dedup import keep_last


def merge_by_key(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 order: Sequence[str] | None = None) -> DataFrame:
    """Matched keys take the source row, unmatched source rows are inserted,
    other target rows are kept.  Source keys are de-duplicated first (last by
    ``order``) so one key can never insert twice."""
    src = keep_last(source, keys, order) if order else source.dropDuplicates(list(keys))
    kept = target.join(src.select(*keys), list(keys), "left_anti")
    return kept.unionByName(src.select(*target.columns))


def merge_counts(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows affected by a J5 merge: updated (key in both), appended (new key),
    and the resulting table total -- one aggregate over a full outer join of
    the key sets."""
    t = target.select(*keys).distinct().withColumn("_t", F.lit(1))
    s = source.select(*keys).distinct().withColumn("_s", F.lit(1))
    j = t.join(s, list(keys), "full_outer")
    return j.agg(
        F.count_if(F.col("_t").isNotNull() & F.col("_s").isNotNull()).alias("updated_count"),
        F.count_if(F.col("_t").isNull()).alias("appended_count"),
        F.count(F.lit(1)).alias("total_rows"))


def fieldwise_update(existing: DataFrame, new: DataFrame, key: str, order: Sequence[str] | None = None) -> DataFrame:
    """``existing[id].update(job)`` -- a full outer join on the key where a
    new row replaces every field it brings, nulls included; fields it does not
    bring keep their value, fields only it has are added (null elsewhere).
    Several new rows of a key count as one, the last by ``order``."""
    src = keep_last(new, [key], order) if order else new.dropDuplicates([key])
    cols = [c for c in existing.columns if c != key] + [c for c in new.columns if c not in existing.columns]
    e = existing.select(key, *[F.col(c).alias(f"_o_{c}") for c in cols if c in existing.columns])
    n = src.select(key, F.lit(True).alias("_given"), *[F.col(c).alias(f"_n_{c}") for c in cols if c in new.columns])
    j = e.join(n, key, "full_outer")

    def field(c: str):
        old = F.col(f"_o_{c}") if c in existing.columns else F.lit(None)
        return F.when(F.col("_given"), F.col(f"_n_{c}")).otherwise(old) if c in new.columns else old
    return j.select(key, *[field(c).alias(c) for c in cols])


def incremental_slice(source: DataFrame, existing: DataFrame, col: str, strict: bool = False) -> DataFrame:
    """Rows newer than the target's high-water mark.  The mark is a scalar
    subquery (one ``max``), so the predicate is a literal at run time and can
    prune partitions / row groups of ``source``.  Default ``>=`` plus a key
    merge is idempotent; ``strict`` reproduces ``>`` exactly."""
    mark = existing.select(F.max(col)).scalar()
    cond = (F.col(col) > mark) if strict else (F.col(col) >= mark)
    return source.filter(cond | mark.isNull())


class CommitConflict(RuntimeError):
    """Somebody else committed since this write read its parent."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


_LOG = "seq LONG, version STRING, parent LONG, path STRING, label STRING, gone BOOLEAN"
SNAPSHOT_EVERY = 50


def _log_path(base: str) -> str:
    return f"{base.rstrip('/')}/_versions"


def log_rows(spark: SparkSession, base: str) -> DataFrame:
    """The commit log (empty before the first commit): the last folded snapshot
    and the entries after it.  Empty entries are those of writers that died."""
    fs, p = _fs(spark, _log_path(base))
    if not fs.exists(p):
        return spark.createDataFrame([], _LOG)
    names = [(f.getPath().getName(), f.getLen()) for f in fs.listStatus(p)]
    folded = max((n.split(".")[0] for n, _ in names if n.endswith(".snapshot")
                  and path_exists(spark, f"{_log_path(base)}/{n}/_SUCCESS")), default="")
    files = [n for n, size in names if n.endswith(".json") and size and n.split(".")[0] > folded]
    paths = [f"{_log_path(base)}/{n}" for n in files + ([f"{folded}.snapshot"] if folded else [])]
    return spark.read.schema(_LOG).json(paths) if paths else spark.createDataFrame([], _LOG)


committed_versions = log_rows


def head(spark: SparkSession, base: str) -> int:
    """Sequence number of the last commit; 0 before the first."""
    return log_rows(spark, base).agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0]


def is_committed(spark: SparkSession, base: str, version: int | str) -> bool:
    return not log_rows(spark, base).filter(F.col("version") == str(version)).isEmpty()


def commit_entry(spark: SparkSession, base: str, version: int | str, parent: int, entries: list[dict]) -> int:
    """Add entry ``parent + 1`` to the log.

    It is written under a temporary name and renamed, which fails where the
    entry is there already, so of two writers one fails and a reader never
    sees half an entry.  An empty entry (of a writer that died while it wrote in
    place) counts as not there.
    """
    seq = parent + 1
    text = "".join(json.dumps({"seq": seq, "version": str(version), "parent": parent, **e}) + "\n" for e in entries)
    fs, final = _fs(spark, f"{_log_path(base)}/{seq:012d}.json")
    jvm = spark.sparkContext._jvm
    temporary = jvm.org.apache.hadoop.fs.Path(f"{_log_path(base)}/.{uuid.uuid4().hex}.tmp")
    out = fs.create(temporary, False)
    out.write(bytearray(text.encode()))
    out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    dead = fs.exists(final) and fs.getFileStatus(final).getLen() == 0
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE if dead else rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(temporary), fs.makeQualified(final), how)
    except Py4JJavaError as e:
        fs.delete(temporary, False)
        if fs.exists(final):
            raise CommitConflict(f"{base}: commit {seq} was made by another writer") from e
        raise
    if seq % SNAPSHOT_EVERY == 0:
        _fold(spark, base, seq)
    return seq


def _fold(spark: SparkSession, base: str, seq: int) -> None:
    """Write the log as one table: every version, and every path as its last entry left it."""
    last = log_rows(spark, base).groupBy("path", "version").agg(F.max_by(F.struct("seq", "parent", "label", "gone"), "seq").alias("e"))
    keep = F.row_number().over(Window.partitionBy("path").orderBy(F.col("e.seq").desc()))
    rows = last.select("*", keep.alias("_n")).select(
        "e.seq", "version", "e.parent", F.when((F.col("_n") == 1) & ~F.coalesce("e.gone", F.lit(False)), F.col("path")).alias("path"),
        "e.label", "e.gone").distinct()
    rows.write.mode("overwrite").json(f"{_log_path(base)}/{seq:012d}.snapshot")


def write_version(df: DataFrame, base: str, version: int | str, parent: int | None = None) -> str:
    """Write a table to a fresh folder and commit it; returns its path.

    ``parent`` is the ``head`` that ``df`` was built from: if the log has moved
    on, ``CommitConflict`` is raised and nothing becomes visible.  A version
    that is committed already is left as it is and its path returned."""
    spark = df.sparkSession
    log = log_rows(spark, base)
    done = log.filter(F.col("version") == str(version)).first()
    if done:
        if done["path"] is None or not log.where((F.col("path") == done["path"]) & F.col("gone")).isEmpty():
            raise ValueError(f"{base}: version {version} has expired")
        return done["path"]
    parent = head(spark, base) if parent is None else parent
    path = f"{base.rstrip('/')}/v={version}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    commit_entry(spark, base, version, parent, [{"path": path}])
    return path


def commit_folder(spark: SparkSession, base: str, version: int | str, path: str, parent: int) -> None:
    """Commit a folder that is written already (several tables at once), built
    from commit ``parent``: of two builders of one parent the later fails."""
    commit_entry(spark, base, version, parent, [{"path": path}])


def latest_version(spark: SparkSession, base: str) -> str | None:
    """Path of the last committed version."""
    row = log_rows(spark, base).where("label is null and path is not null and not coalesce(gone, false)")
    row = row.agg(F.max_by("path", "seq").alias("p")).first()
    return row["p"] if row else None


def expire(spark: SparkSession, base: str, keep: int) -> list[str]:
    """Delete what no reader of the last ``keep`` commits needs: files that went
    out of use before them, and folders of earlier versions.  The log says so first."""
    log = log_rows(spark, base).where("path is not null")
    last = head(spark, base)
    each = log.groupBy("path").agg(F.max("seq").alias("seq"), F.max_by("gone", "seq").alias("gone"), F.max_by("label", "seq").alias("label"))
    old = each.where((F.col("seq") <= last - keep) & (F.coalesce("gone", F.lit(False)) | F.col("label").isNull())).collect()
    current = latest_version(spark, base)
    paths = [r["path"] for r in old if r["path"] != current]
    folders = [r["path"] for r in old if r["label"] is None and not r["gone"] and r["path"] != current]
    if folders:
        commit_entry(spark, base, f"expire-{uuid.uuid4().hex}", last, [{"path": p, "gone": True} for p in folders])
    for path in paths:
        fs, p = _fs(spark, path)
        fs.delete(p, True)
    return paths
