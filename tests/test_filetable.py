"""Copy-on-write upserts: which files are rewritten, who wins, what is late."""

import random

import pytest

from hirescope.operators import filetable, upsert

ROWS = "k string, v string, o long"


def rows_of(spark, base, table="data"):
    return {r.k: (r.v, r.o) for r in filetable.read(spark, base, table).collect()}


def table(spark, n):
    return spark.range(n).selectExpr("lpad(cast(id as string), 6, '0') AS k", "'old' AS v", "0L AS o")


def test_small_delta_rewrites_few_files(spark, tmp):
    filetable.upsert(table(spark, 10_000), tmp, "k", ["o"], "load", rows_per_file=100)
    before = set(filetable.live_files(spark, tmp))
    assert 80 <= len(before) <= 120
    delta = spark.range(5000, 5100).selectExpr("lpad(cast(id as string), 6, '0') AS k", "'new' AS v", "1L AS o")     # 1 %, one range
    change = filetable.upsert(delta, tmp, "k", ["o"], "day", rows_per_file=100)
    after = set(filetable.live_files(spark, tmp))
    assert len(before - after) == len(change.rewritten) <= 5 and (change.updated, change.appended) == (100, 0)
    got = rows_of(spark, tmp)
    assert len(got) == 10_000 and got["005050"] == ("new", 1) and got["004999"] == ("old", 0)
    biggest = max(spark.read.parquet(p).count() for p in after)
    assert biggest <= 300                                       # a rewrite stays cut into files of bounded size
    again = filetable.upsert(delta, tmp, "k", ["o"], "day")     # a committed version
    assert (again.updated, again.entries) == (0, []) and set(filetable.live_files(spark, tmp)) == after
    upsert.expire(spark, tmp, 0)
    assert rows_of(spark, tmp) == got


def test_random_upserts_equal_a_dict(spark, tmp):
    rng, model = random.Random(1), {}
    for day in range(6):
        delta = [(rng.choice([None, *"abcdefghij"]), f"{day}-{i}", rng.randint(0, 9)) for i in range(8)]
        last = {}
        for k, v, o in delta:
            if k is not None and (k not in last or o > last[k][1]):
                last[k] = (v, o)
        ties = {k for k, _, o in delta for k2, v2, o2 in delta if k == k2 and o == o2 and (k, o) == (k2, o2)}
        del ties
        delta = [(k, v, o) for k, (v, o) in last.items()] + [(None, "x", 1)]
        change = filetable.upsert(spark.createDataFrame(delta, ROWS), tmp, "k", ["o"], str(day), rows_per_file=3)
        assert change.updated == len(set(last) & set(model)) and change.appended == len(set(last) - set(model))
        model |= last
        assert rows_of(spark, tmp) == model


def test_late_rows_change_nothing(spark, tmp):
    def put(version, *rows):
        return filetable.upsert(spark.createDataFrame(list(rows), ROWS), tmp, "k", ["o"], version, newer_only=True)
    put("1", ("a", "a5", 5), ("b", "b5", 5))
    change = put("2", ("a", "a3", 3), ("b", "b5 again", 5), ("c", "c1", 1), ("a", "a4", 4))
    assert (change.updated, change.appended, change.late) == (0, 1, 2) and change.rewritten == []
    change = put("3", ("a", "a6", 6), ("b", None, None))
    assert (change.updated, change.appended, change.late) == (1, 0, 1)
    assert rows_of(spark, tmp) == {"a": ("a6", 6), "b": ("b5", 5), "c": ("c1", 1)}
    assert put("4", ("a", "late", 0)).late == 1 and upsert.is_committed(spark, tmp, "4")
    assert put("5").entries == []


def test_commits_are_whole_and_exclusive(spark, tmp):
    one = filetable.plan_upsert(table(spark, 5), tmp, "k", ["o"], "left")
    two = filetable.plan_append(table(spark, 3), tmp, "right", ["k"])
    assert filetable.read(spark, tmp, "left") is None             # planned, not committed
    filetable.commit(spark, tmp, "v1", 0, [one, two])
    assert len(rows_of(spark, tmp, "left")) == 5 and len(rows_of(spark, tmp, "right")) == 3
    with pytest.raises(upsert.CommitConflict):
        filetable.commit(spark, tmp, "v2", 0, [one])
    swap = filetable.plan_replace(table(spark, 2), tmp, "right", ["k"])
    filetable.commit(spark, tmp, "v2", 1, [swap])
    assert len(rows_of(spark, tmp, "right")) == 2 and len(rows_of(spark, tmp, "left")) == 5
