"""Joins and hand-offs that must not go through the driver, or be done again, as tables grow."""

import datetime as dt

from hirescope.operators import filetable
from hirescope.operators.quality import relationship_failures
from hirescope.plans import postings, stores


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(spark, start, stop, value):
    return spark.range(start, stop).selectExpr("lpad(cast(id as string), 9, '0') AS k", f"'{value}' AS v", "id AS o")


def test_a_large_delta_is_not_broadcast(spark, tmp):
    n = filetable.SMALL_DELTA + 1000 if hasattr(filetable, "SMALL_DELTA") else 70_000
    filetable.upsert(rows(spark, 0, n, "old"), tmp, "k", ["o"], "load")
    large = filetable.plan_upsert(rows(spark, 500, n + 500, "new"), tmp, "k", ["o"])
    assert "Broadcast" not in plan(large.replaced) and "SortMergeJoin" in plan(large.replaced)
    assert (large.updated, large.appended, large.replaced.count()) == (n - 500, 500, n - 500)
    small = filetable.plan_upsert(rows(spark, 0, 100, "new"), tmp, "k", ["o"])
    assert (small.updated, small.replaced.count()) == (100, 100)


def test_orphans_are_counted_without_a_join(spark):
    fact = spark.createDataFrame([("a", "x"), ("a", None), ("b", "y"), ("c", "y"), (None, "z")], "one string, two string")
    dim = spark.createDataFrame([("a",), ("a",), ("c",), (None,)], "id string")
    none = spark.createDataFrame([], "id string")
    df = relationship_failures(fact, {"one": (dim, "id"), "two": (none, "id")})
    assert {r.relationship: r.failures for r in df.collect()} == {"one": 1, "two": 4}
    assert "Join" not in plan(df)
    assert {r.failures for r in relationship_failures(fact.where("false"), {"one": (dim, "id")}).collect()} == {0}


def orders(spark, path, n=30):
    day = dt.datetime(2024, 5, 1)
    data = [(i, i % 7, "O", 1.0, day + dt.timedelta(days=i), "1-URGENT") for i in range(n)]
    spark.createDataFrame(data, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
                                "o_orderpriority string").write.parquet(f"{path}/orders.parquet")
    return path


def test_integrity_stores_only_what_keys_need(spark, tmp, monkeypatch):
    stored, write = [], postings.written
    monkeypatch.setattr(postings, "written", lambda df: stored.append(df.columns) or write(df))
    found = {r.relationship: r.failures for r in postings.integrity(spark, orders(spark, tmp)).collect()}
    assert found == {"company_id": 0, "location_id": 0, "date_id": 0, "job_id": 0}
    assert len(stored) == 1 and "skills" not in stored[0] and "experience_level" not in stored[0]


def test_streamed_documents_are_put_together_once(spark, tmp, monkeypatch):
    stored, write = [], stores.written
    monkeypatch.setattr(stores, "written", lambda df: stored.append(df.columns) or write(df))
    sf = orders(spark, tmp)
    urls = {r.job_url for r in stores.stream_postings(spark, sf).collect()}
    assert stored == [["doc", "metadata", "jobs"]]
    assert urls == {r.job_url for r in postings.cleaned_postings(spark, sf).collect()}
