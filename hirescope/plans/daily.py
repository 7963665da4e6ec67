"""The daily run: raw files -> clean -> gate -> upsert -> models.

Mirrors the original task chain (scrape output in, cleaned table, quality
gate that stops the run, MERGE into the postings table, model rebuild) as
one Spark application.  Every hand-off is a stored table, so a failed or
re-run step starts from committed data:

* cleaned rows are stored once (gate and load read the same rows);
* the gate report is written before the run is stopped on failure;
* the upsert writes a new version and commits it to the table's log; a day
  that is committed already is not loaded again, so a retry goes on from there;
* marts are built from the committed version into a folder of their own and
  committed together, so readers see one day's marts or another's, never a mix.

``incremental`` is the layout for a large table and a small day (S16, P17):
postings, staging and the marts' partial sums are tables of one store
(``operators.filetable``).  A day rewrites the files that hold its keys, adds
its changes to the sums, and commits all of it at once; nothing is rebuilt.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.functions import rules as R
from hirescope.operators.quality import offenders, quality_gate
from hirescope.operators import filetable
from hirescope.operators.upsert import (commit_folder, head, is_committed, latest_version, merge_by_key,
                                        merge_counts, write_version)
from hirescope.plans import star
from hirescope.plans.postings import clean_postings
from hirescope.session import written
from hirescope.sources.raw import corrupt_documents, load_raw_json, read_raw_documents
from hirescope.sources.sinks import observe_counts, write_quality_report


class GateFailed(RuntimeError):
    pass


def run_daily(spark: SparkSession, raw_paths: str | Sequence[str], base: str, version: str,
              scrape_date_mode: str = "row", fail_on_gate: bool = True,
              gate_bounds: tuple[int, int | None] = (R.GATE_MIN_ROWS, None),
              incremental: bool = False, bullet: str = "strip", as_of=None) -> dict:
    """Run one day; returns the stage counts (scraped, cleaned, affected, total,
    quarantined: files that could not be read, kept under ``quarantine``).

    ``incremental`` keeps postings, staging and marts in a store that a day
    changes in part (``load_day``), instead of new versions of all of them.
    """
    bad, unread = observe_counts(corrupt_documents(read_raw_documents(spark, raw_paths)), "unread")
    bad.write.mode("overwrite").json(f"{base}/quarantine/{version}")
    raw, scraped = observe_counts(load_raw_json(spark, raw_paths), "scraped")
    cleaned = written(clean_postings(raw, scrape_date_mode=scrape_date_mode, bullet=bullet, as_of=as_of))
    n_clean = cleaned.count()

    latest = cleaned.select(F.max("scrape_date")).scalar()
    accepted = {"experience_level": R.VALID_EXPERIENCE_LEVELS, "work_type": R.VALID_WORK_TYPES,
                "company_type": R.VALID_COMPANY_TYPES}
    checks = quality_gate(
        cleaned.withColumnRenamed("skills", "skills_list"), latest, R.GATE_REQUIRED_COLUMNS,
        R.GATE_CRITICAL_COLUMNS, "job_url", accepted,
        "job_url", R.GATE_URL_PREFIX, "posted_date", R.GATE_MAX_DATE_SPAN_DAYS, "skills_list",
        R.GATE_MAX_EMPTY_SKILLS_PCT, gate_bounds[0], gate_bounds[1])
    summary = write_quality_report(checks, f"{base}/reports/{version}", f"{base}/postings").first()
    offenders(cleaned, accepted).write.mode("overwrite").json(f"{base}/reports/{version}/offenders")
    if fail_on_gate and summary["checks_failed"]:
        raise GateFailed(f"quality gate failed: {summary['failures']}")

    if incremental:
        done = load_day(spark, cleaned, base, version)
        return {"scraped": scraped.get["rows"], "cleaned": n_clean, "quarantined": unread.get["rows"]} | done
    table = f"{base}/postings"
    if is_committed(spark, table, version):
        affected, path = 0, write_version(cleaned, table, version)
    else:
        parent, prev = head(spark, table), latest_version(spark, table)
        merged, affected = cleaned, n_clean
        if prev is not None:
            target = spark.read.parquet(prev)
            c = merge_counts(target, cleaned, ["job_url"]).first()
            affected = c.updated_count + c.appended_count
            merged = merge_by_key(target, cleaned, ["job_url"], ["scrape_date"])
        path = write_version(merged, table, version, parent)
    stored = spark.read.parquet(path)
    done = _build_marts(spark, stored, base, version, scraped.get["rows"], n_clean, affected, path)
    return done | {"quarantined": unread.get["rows"]}


def marts_path(spark: SparkSession, base: str) -> str | None:
    """Folder of the marts committed last."""
    return latest_version(spark, f"{base}/marts")


def _build_marts(spark, stored, base, version, scraped, n_clean, affected, path) -> dict:
    """Models from the committed postings table (never from the raw input); a
    day whose marts are committed builds nothing."""
    marts = f"{base}/marts"
    counts = {"scraped": scraped, "cleaned": n_clean, "affected": affected, "version_path": path}
    if is_committed(spark, marts, version):
        return counts | {"total": stored.count()}
    parent = head(spark, marts)
    folder = f"{marts}/build={version}-{uuid.uuid4().hex[:12]}"
    stg, total = observe_counts(star.stg_jobs(stored), "total")
    stg.write.parquet(f"{folder}/stg_jobs")
    stg = spark.read.parquet(f"{folder}/stg_jobs")
    for name, df in star.build_star(stg).items():
        if name != "stg_jobs":
            df.write.parquet(f"{folder}/{name}")
    commit_folder(spark, marts, version, folder, parent)
    return counts | {"total": total.get["rows"]}


# ------------------------------------------------------------ incremental layout
FOLD_FILES = 64     # files of partial sums before they are folded into one


def load_day(spark: SparkSession, cleaned: DataFrame, base: str, version: str, newer_only: bool = False,
             order: Sequence[str] = ("scrape_date",)) -> dict:
    """Apply one day's cleaned rows to the store and commit postings, staging and
    the marts' partial sums together.  A day that is committed changes nothing,
    so a retry after a loss is safe; a day that was not committed left only
    files that nobody reads."""
    store = f"{base}/store"
    if is_committed(spark, store, version):
        return {"affected": 0, "late": 0, "rewritten": 0, "total": _total(spark, base)}
    parent = head(spark, store)
    postings = filetable.plan_upsert(cleaned, store, "job_url", order, "postings", ("scrape_date", "job_url"), newer_only)
    stg = filetable.plan_upsert(star.stg_jobs(postings.applied), store, "job_id", ("scrape_date",), "stg_jobs", ("scrape_date", "job_id"))
    changes = [postings, stg]
    for name, state, fold, keys in (("skill_state", star.skill_state, star.fold_skills, ["skill_name"]),
                                    ("category_state", star.category_state, star.fold_category, ["job_category", "experience_level"])):
        delta = state(stg.applied, stg.replaced)
        old = filetable.live_files(spark, store, name)
        if len(old) < FOLD_FILES:
            changes.append(filetable.plan_append(delta, store, name, keys))
        else:
            changes.append(filetable.plan_replace(fold(spark.read.parquet(*old).unionByName(delta)), store, name, keys))
    filetable.commit(spark, store, version, parent, changes)
    return {"affected": postings.updated + postings.appended, "late": postings.late,
            "rewritten": len(postings.rewritten) + len(stg.rewritten), "total": _total(spark, base)}


def _total(spark: SparkSession, base: str) -> int:
    state = filetable.read(spark, f"{base}/store", "category_state")
    return 0 if state is None else state.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def incremental_star(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The models over the store: the metric marts from their partial sums,
    everything else as views of staging (S16)."""
    store = f"{base}/store"
    skills, categories = (filetable.read(spark, store, t) for t in ("skill_state", "category_state"))
    return star.build_star(filetable.read(spark, store, "stg_jobs")) | {
        "mart_job_metrics": star.skill_metrics_of(skills, categories),
        "category_metrics": star.category_metrics_of(categories)}
