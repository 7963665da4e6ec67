"""Readers, sinks and the streaming upsert (batch result == stream result)."""

import json
import os

from pyspark.sql import functions as F

from hirescope.plans.postings import clean_postings
from hirescope.sources import raw as RAW
from hirescope.sources import sinks
from hirescope.streaming import incremental


def _doc(keyword, jobs):
    return {"metadata": {"keyword": keyword, "total_jobs": len(jobs), "pages_scraped": 1,
                         "last_updated": "2026-05-14T10:56:04+00:00", "updated_count": 0,
                         "appended_count": len(jobs), "source": "wuzzuf.net"}, "jobs": jobs}


def _job(i, title="Middle Data Engineer", scraped="2026-05-14T10:49:31+00:00", **kw):
    j = {"job_id": f"id{i}-data-engineer-acme-cairo-egypt", "title": title, "company": "Acme Data Labs",
         "location": "Cairo, Egypt, On-site", "job_type": "Full Time", "experience": "· 2 - 4 Yrs of Exp",
         "skills": ["· Python", "SQL", "Apache Spark", "English"],
         "posted_date": f"{title}\nAcme - Cairo, Egypt\n{i} days ago",
         "url": f"https://wuzzuf.net/jobs/p/id{i}-data-engineer-acme-cairo-egypt", "scraped_at": scraped,
         "keyword": "data engineer"}
    j.update(kw)
    return j


def _write(path, doc):
    with open(path, "w", encoding="utf-8") as f:
        json.dump(doc, f, ensure_ascii=False, indent=2)


def test_raw_json_roundtrip(spark, tmp):
    src = os.path.join(tmp, "raw")
    os.makedirs(src)
    _write(f"{src}/a.json", _doc("data engineer", [_job(1), _job(2, company=None), _job(3)]))
    _write(f"{src}/b.json", _doc("data analyst", [_job(3, title="Senior Data Analyst"), _job(4)]))
    with open(f"{src}/broken.json", "w") as f:
        f.write("{not json")
    df = RAW.load_raw_json(spark, src)
    assert df.count() == 5
    assert df.filter(F.col("company_name").isNull()).count() == 0
    cleaned = clean_postings(df)
    rows = {r.job_url[-40:]: r for r in cleaned.collect()}
    assert len(rows) == 4
    r = [x for x in cleaned.collect() if "id3" in x.job_url][0]
    assert r.job_title == "Senior Data Analyst"   # last in (scraped_at, file, pos) order
    assert r.skills == ["Python", "SQL", "Apache Spark"]      # bullet removed, noise dropped
    assert r.city == "Cairo" and r.experience_level == "senior"

    flat = RAW.flatten(RAW.read_raw_documents(spark, f"{src}/a.json").select("metadata"))
    assert "metadata_keyword" in flat.columns

    out = os.path.join(tmp, "out")
    sinks.write_parquet(cleaned, f"{out}/pq")
    sinks.write_csv(cleaned, f"{out}/csv")
    sinks.write_json_records(cleaned, f"{out}/json", list_as_text=True)
    sinks.write_keyword_files(df.withColumnRenamed("job_category", "keyword"), f"{out}/kw")
    assert spark.read.parquet(f"{out}/pq").count() == 4
    back = spark.read.option("header", True).option("escape", '"').csv(f"{out}/csv")
    assert back.count() == 4 and back.first()["skills"].startswith("[")
    assert spark.read.json(f"{out}/kw/_batch_metadata").count() == 1   # every job carries one keyword


def test_csv_reader(spark, tmp):
    p = os.path.join(tmp, "jobs.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write(",".join(RAW.CSV_FIELDS) + "\n")
        f.write('https://wuzzuf.net/jobs/p/x1,wuzzuf,"[\'data analyst\', \'power bi\']",2026-04-17 10:00:00,'
                'Data Analyst,"Acme - Maadi, Cairo",2 days ago,Full Time,On-site,More Than 3 Years,,'
                '"[\'Data Analysis\', \'SQL\']","line one\nline two",\n')
    df = RAW.read_raw_csv(spark, p)
    r = df.first()
    assert r.skills == ["Data Analysis", "SQL"] and r.search_keywords[0] == "data analyst"
    assert "\n" in r.job_description
    aligned = RAW.csv_to_postings(df).first()
    assert aligned.company == "Acme" and aligned.keyword == "data analyst"


def test_stream_equals_batch(spark, tmp):
    src = os.path.join(tmp, "landing")
    os.makedirs(src)
    _write(f"{src}/day1.json", _doc("data engineer", [_job(1), _job(2)]))
    base, ckpt = os.path.join(tmp, "table"), os.path.join(tmp, "ckpt")
    q = incremental.start(spark, src, base, ckpt, available_now=True)
    q.awaitTermination(120)
    _write(f"{src}/day2.json", _doc("data engineer", [_job(2, title="Senior Data Engineer",
                                                            scraped="2026-05-15T10:00:00+00:00"), _job(5)]))
    q = incremental.start(spark, src, base, ckpt, available_now=True)
    q.awaitTermination(120)
    streamed = incremental.current_table(spark, base)
    batch = clean_postings(RAW.load_raw_json(spark, src))
    key = ["job_url", "job_title", "experience_level", "posted_date"]
    assert sorted(map(tuple, streamed.select(key).collect())) == sorted(map(tuple, batch.select(key).collect()))
    assert streamed.count() == 3


def test_stage_report_observe_lookup_combine(spark, tmp):
    from hirescope.operators.joins import lookup, map_table
    from hirescope.operators.quality import gate_summary
    from hirescope.plans.postings import combine_sources
    df = spark.createDataFrame([(1, "Maadi"), (2, "Giza"), (3, None)], "id long, d string")
    assert sinks.staged_write(spark, df, "stage_jobs_t") == 3
    sinks.drop_table(spark, "stage_jobs_t")
    assert not spark.catalog.tableExists("stage_jobs_t")
    counted, obs = sinks.observe_counts(df, "c")
    counted.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 3
    checks = spark.createDataFrame([("a", 0, True), ("b", 2, False)], "check string, failing long, passed boolean")
    summary = sinks.write_quality_report(checks, f"{tmp}/report", "x.parquet").first()
    assert (summary.checks_passed, summary.checks_failed, summary.status, summary.failures) == (1, 1, "FAILED", ["b"])
    assert gate_summary(checks).first().status == "FAILED"
    m = map_table(spark, {"Maadi": "Cairo", "Dokki": "Giza"})
    got = {r.id: r.city for r in lookup(df, "d", m, "key", "value", "city").collect()}
    assert got == {1: "Cairo", 2: "Giza", 3: None}
    j = spark.createDataFrame([("u1", "A", 1), ("u2", "B", 2)], "url string, title string, pos long")
    c = spark.createDataFrame([("u2", "B-csv", "x"), ("u3", "C", "y")], "url string, title string, salary string")
    out = {r.url: r.title for r in combine_sources(j, c).collect()}
    assert out == {"u1": "A", "u2": "B", "u3": "C"}
    assert "salary" in combine_sources(j, c).columns


def test_replayed_batch_is_skipped(spark, tmp):
    from hirescope.operators.upsert import committed_versions
    src = os.path.join(tmp, "landing")
    os.makedirs(src)
    _write(f"{src}/day1.json", _doc("data engineer", [_job(1), _job(2)]))
    base = os.path.join(tmp, "table")
    batch = spark.read.schema(RAW.RAW_DOC).option("multiLine", True).json(src)
    for name in ("one", "two"):      # two streams, each with the id its checkpoint holds
        os.makedirs(f"{tmp}/{name}")
        _write(f"{tmp}/{name}/metadata", {"id": name})
    run = incremental.upsert_batch(base, f"{tmp}/one")
    run(batch, 0)
    run(batch, 0)          # replay after a failure: already committed -> no-op
    run(batch, 1)          # next batch merges into its buckets -> same keys, no growth
    log = committed_versions(spark, base)
    assert sorted({r.version for r in log.collect()}) == ["one-000000000000", "one-000000000001"]
    assert incremental.current_table(spark, base).count() == 2
    _write(f"{src}/day1.json", _doc("data engineer", [_job(7), _job(8)]))
    incremental.upsert_batch(base, f"{tmp}/two")(spark.read.schema(RAW.RAW_DOC).option("multiLine", True).json(src), 0)
    assert incremental.current_table(spark, base).count() == 4     # batch 0 of another stream is not dropped


def test_daily_run_end_to_end(spark, tmp):
    from hirescope.plans.daily import GateFailed, marts_path, run_daily
    src = os.path.join(tmp, "raw")
    os.makedirs(src)
    _write(f"{src}/day1.json", _doc("data engineer", [_job(i) for i in range(12)]))
    base = os.path.join(tmp, "wh")
    r1 = run_daily(spark, f"{src}/day1.json", base, "20260514")
    assert (r1["scraped"], r1["cleaned"], r1["affected"], r1["total"]) == (12, 12, 12, 12)
    _write(f"{src}/day2.json", _doc("data engineer", [_job(i, title="Senior Data Engineer",
                                                            scraped="2026-05-15T09:00:00+00:00")
                                                       for i in range(8, 20)]))
    r2 = run_daily(spark, f"{src}/day2.json", base, "20260515")
    assert (r2["affected"], r2["total"]) == (12, 20)
    facts = spark.read.parquet(f"{marts_path(spark, base)}/fact_jobs")
    assert facts.count() == 20
    metrics = spark.read.parquet(f"{marts_path(spark, base)}/mart_job_metrics")
    assert {r.skill_name for r in metrics.collect()} == {"python", "sql", "apache spark"}
    again = run_daily(spark, f"{src}/day2.json", base, "20260515")     # a retry of a committed day
    assert (again["affected"], again["total"], again["version_path"]) == (0, 20, r2["version_path"])
    assert spark.read.parquet(r2["version_path"]).count() == 20 and again["quarantined"] == 0
    assert spark.read.json(f"{base}/reports/20260515/summary").first().status == "PASSED"
    try:                                     # too few rows for the gate -> the run stops
        _write(f"{src}/day3.json", _doc("data engineer", [_job(99)]))
        run_daily(spark, f"{src}/day3.json", base, "20260516")
        raise AssertionError("gate should fail")
    except GateFailed:
        pass
    assert spark.read.json(f"{base}/reports/20260516/summary").first().status == "FAILED"


def test_daily_run_incremental_equals_versioned(spark, tmp):
    from hirescope.operators import filetable
    from hirescope.plans.daily import incremental_star, marts_path, run_daily
    src = os.path.join(tmp, "raw")
    os.makedirs(src)
    later = {"title": "Senior Data Engineer", "scraped": "2026-05-15T09:00:00+00:00", "skills": ["SQL", "dbt", "Python"]}
    _write(f"{src}/d1.json", _doc("data engineer", [_job(i) for i in range(12)]))
    _write(f"{src}/d2.json", _doc("data engineer", [_job(i, **later) for i in range(8, 20)]))
    _write(f"{src}/d3.json", _doc("data engineer", [_job(i, location="Giza, Egypt, Remote", scraped="2026-05-16T09:00:00+00:00")
                                                     for i in range(30, 41)]))
    a, b = os.path.join(tmp, "v"), os.path.join(tmp, "i")
    kept = []
    for day, affected, total in (("1", 12, 12), ("2", 12, 20), ("3", 11, 31)):
        before = set(filetable.live_files(spark, f"{b}/store", "stg_jobs"))
        for base, mode in ((a, False), (b, True)):
            r = run_daily(spark, f"{src}/d{day}.json", base, day, incremental=mode)
            assert (r["affected"], r["total"]) == (affected, total)
        kept.append(before <= set(filetable.live_files(spark, f"{b}/store", "stg_jobs")))
        stored = incremental_star(spark, b)
        for name in ("fact_jobs", "stg_jobs", "dim_skills", "dim_company", "mart_job_metrics", "category_metrics"):
            want = spark.read.parquet(f"{marts_path(spark, a)}/{name}")
            got = stored[name].select(want.columns)
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), (day, name)
    assert kept == [True, False, True]              # a day of new postings leaves all stored files as they are
    again = run_daily(spark, f"{src}/d3.json", b, "3", incremental=True)
    assert (again["affected"], again["total"]) == (0, 31)


def test_stream_equals_batch_in_any_order(spark, tmp):
    """Files that are late, repeated or out of order leave what a batch job over all of them gives."""
    import random
    src = os.path.join(tmp, "all")
    os.makedirs(src)
    rng = random.Random(4)
    for n in range(6):
        _write(f"{src}/f{n}.json", _doc("data engineer", [
            _job(rng.randint(0, 9), title=f"Data Engineer {n}", scraped=f"2026-05-{10 + rng.randint(0, 4)}T10:00:00+00:00") for _ in range(5)]))
    key = ["job_url", "job_title", "posted_date", "scrape_date"]
    want = sorted(map(tuple, clean_postings(RAW.load_raw_json(spark, src)).select(key).collect()))
    for seed in (1, 2):
        order = [0, 1, 2, 3, 4, 5, 0, 3]
        random.Random(seed).shuffle(order)
        landing, base, ckpt = (os.path.join(tmp, f"{x}{seed}") for x in ("landing", "table", "ckpt"))
        os.makedirs(landing)
        for step, n in enumerate(order):
            os.makedirs(f"{landing}/step{step}")
            with open(f"{src}/f{n}.json") as f, open(f"{landing}/step{step}/f{n}.json", "w") as g:
                g.write(f.read())
            if step % 3 == 2 or step == len(order) - 1:
                incremental.start(spark, f"{landing}/*", base, ckpt).awaitTermination(120)
        got = incremental.current_table(spark, base)
        assert sorted(map(tuple, got.select(key).collect())) == want
