"""Dedup, sequence, upsert and incremental queries over ``events`` / ``orders``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.operators import dedup, upsert
from hirescope.sources.tables import table

EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
INCREMENT_CUTOFF = "2024-01-16"
UPSERT_TARGET_BEFORE = "1998-01-01"
UPSERT_SOURCE_FROM = "1997-01-01"


def _events(spark, sf):
    return table(spark, sf, "events").select(*EVENT_COLS)


def latest_event_per_user(spark: SparkSession, sf: str) -> DataFrame:
    """Last event per user by (ts, event_id)."""
    return dedup.keep_last(_events(spark, sf), ["user_id"], ["ts", "event_id"])


def first_event_per_user(spark: SparkSession, sf: str) -> DataFrame:
    """First event per user by (ts, event_id)."""
    return dedup.keep_first(_events(spark, sf), ["user_id"], ["ts", "event_id"])


def repeated_user_day_type(spark: SparkSession, sf: str) -> DataFrame:
    """D3: every event whose (user, day, type) occurs more than once."""
    e = _events(spark, sf).select("event_id", "user_id", "event_type", F.to_date("ts").alias("day"))
    return dedup.duplicated_rows(e, ["user_id", "day", "event_type"])


def duplicate_user_count(spark: SparkSession, sf: str) -> DataFrame:
    """Rows minus distinct users (and whole-row duplicates)."""
    e = _events(spark, sf)
    return e.agg((F.count(F.lit(1)) - F.count_distinct("user_id")).alias("duplicates"),
                 (F.count(F.lit(1)) - F.count_distinct(*EVENT_COLS)).alias("duplicate_rows"))


def user_event_sequence(spark: SparkSession, sf: str) -> DataFrame:
    """Per user, distinct event types in first-seen order."""
    return dedup.ordered_distinct_list(_events(spark, sf), "user_id", "event_type", ["ts", "event_id"])


def first_type_per_user(spark: SparkSession, sf: str) -> DataFrame:
    """D5 new-unique count: users counted under the event type they first show."""
    return dedup.first_seen_per_key(_events(spark, sf), "user_id", "event_type", ["ts", "event_id"])


def event_props(spark: SparkSession, sf: str) -> DataFrame:
    """S3: JSON field extraction -- sum / count of props.k per event type."""
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    return (_events(spark, sf).groupBy("event_type")
            .agg(F.sum(k).alias("sum_k"), F.count(k).alias("n_k"), F.count(F.lit(1)).alias("n")))


def incremental_events(spark: SparkSession, sf: str) -> DataFrame:
    """P17 + J6: the target holds events before the cutoff (values stale);
    the increment is every source row at or after the target's high-water
    day; merged by event_id, increment wins."""
    src = _events(spark, sf).withColumn("day", F.to_date("ts"))
    target = (src.filter(F.col("ts") < F.lit(INCREMENT_CUTOFF).cast("timestamp_ntz"))
              .withColumn("value", F.lit(0.0)).withColumn("origin", F.lit("target")))
    inc = upsert.incremental_slice(src, target, "day").withColumn("origin", F.lit("increment"))
    return upsert.merge_by_key(target, inc, ["event_id"], ["ts"])


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                             "o_orderdate", "o_orderpriority")


def _upsert_sides(spark, sf):
    o = _orders(spark, sf)
    target = o.filter(F.col("o_orderdate") < F.lit(UPSERT_TARGET_BEFORE).cast("timestamp_ntz"))
    source = (o.filter(F.col("o_orderdate") >= F.lit(UPSERT_SOURCE_FROM).cast("timestamp_ntz"))
              .withColumn("o_orderstatus", F.lit("U"))
              .withColumn("o_totalprice", F.col("o_totalprice") + 1.0))
    return target, source


def upsert_orders(spark: SparkSession, sf: str) -> DataFrame:
    """MERGE source into target by order key."""
    target, source = _upsert_sides(spark, sf)
    return upsert.merge_by_key(target, source, ["o_orderkey"], ["o_orderdate"])


def upsert_order_counts(spark: SparkSession, sf: str) -> DataFrame:
    """J5 / J7 counts: updated, appended, resulting total."""
    target, source = _upsert_sides(spark, sf)
    return upsert.merge_counts(target, source, ["o_orderkey"])


def fieldwise_order_update(spark: SparkSession, sf: str) -> DataFrame:
    """Field-wise update -- new status where given, old price kept."""
    target, source = _upsert_sides(spark, sf)
    return upsert.fieldwise_update(target, source.select("o_orderkey", "o_orderstatus"), "o_orderkey")


def new_vs_known_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Within the last day's batch keep the first event of each
    (user, type, hour) key, then keep only keys never seen before that day
    (left-anti against the known history)."""
    e = _events(spark, sf).withColumns({"day": F.to_date("ts"), "hour": F.hour("ts").cast("bigint")})
    last = e.select(F.max("day")).scalar()
    keys = ["user_id", "event_type", "hour"]
    batch = e.filter(F.col("day") == last)
    known = e.filter(F.col("day") < last).select(*keys).distinct()
    first = dedup.keep_first(batch.select(*keys, "ts", "event_id"), keys, ["ts", "event_id"])
    return first.join(known, keys, "left_anti")
