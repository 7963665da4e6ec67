"""Statistics and dashboard reports.

Orders stand for postings, distinct parts of an order for its skills,
the order priority for the seniority level, the customer segment for the
category and the part brand for the skill name (SURVEY 7.3a).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirescope.operators import metrics as M
from hirescope.operators import stats as S
from hirescope.sources.tables import table


def _order_parts(spark, sf) -> DataFrame:
    """Distinct parts per order (the bridge), one partial+final aggregate."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    return li.groupBy("l_orderkey").agg(F.count_distinct("l_partkey").alias("skill_count"))


def segment_value_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Customers per segment with share."""
    return M.value_counts(table(spark, sf, "customer").select("c_mktsegment"), "c_mktsegment")


def priority_status_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Two-column value counts."""
    o = table(spark, sf, "orders").select("o_orderpriority", "o_orderstatus")
    return M.value_counts(o, ["o_orderpriority", "o_orderstatus"], share=False)


def distinct_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Nunique and date range in one aggregate."""
    o = table(spark, sf, "orders")
    return o.agg(F.count(F.lit(1)).alias("n_orders"), F.count_distinct("o_custkey").alias("n_customers"),
                 F.count_distinct("o_orderpriority").alias("n_priorities"),
                 F.to_date(F.min("o_orderdate")).alias("first_date"),
                 F.to_date(F.max("o_orderdate")).alias("last_date"))


def parts_per_order_anova(spark: SparkSession, sf: str) -> DataFrame:
    """F statistic of distinct parts per order across priorities."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    per = o.join(_order_parts(spark, sf), o.o_orderkey == F.col("l_orderkey"))
    return S.anova_oneway(per, "o_orderpriority", "skill_count")


def parts_per_order_by_level(spark: SparkSession, sf: str) -> DataFrame:
    """Mean and count of parts per order by priority."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    per = o.join(_order_parts(spark, sf), o.o_orderkey == F.col("l_orderkey"))
    return S.group_mean_count(per, "o_orderpriority", "skill_count")


def segment_correlation(spark: SparkSession, sf: str) -> DataFrame:
    """Correlation between postings per category and mean skills per
    posting in that category (category = customer segment)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    per = (o.join(_order_parts(spark, sf), o.o_orderkey == F.col("l_orderkey"))
           .join(c, o.o_custkey == c.c_custkey))
    cat = per.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("posting_count"),
                                          F.avg("skill_count").alias("avg_skill_count"))
    return S.pearson(cat, "posting_count", "avg_skill_count")


def brand_priority_cells(spark: SparkSession, sf: str, k: int = 20) -> DataFrame:
    """J8 + A16: (brand, priority) counts of the k most frequent brands.  The
    cells are counted once; the brands are ranked from the few cells."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    p = table(spark, sf, "part").select("p_partkey", "p_brand")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    pairs = li.join(p, li.l_partkey == p.p_partkey).join(o, li.l_orderkey == o.o_orderkey)
    cells = pairs.groupBy("p_brand", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    total = cells.withColumn("c", F.sum("n").over(Window.partitionBy("p_brand")))
    ranked = total.withColumn("r", F.dense_rank().over(Window.orderBy(F.desc("c"), "p_brand")))  # rows: brands x priorities
    return ranked.filter(F.col("r") <= k).select("p_brand", "o_orderpriority", "n")


def brand_priority_chi_square(spark: SparkSession, sf: str) -> DataFrame:
    """Chi-square statistic and dof of top-20 brand x priority."""
    return S.chi_square(brand_priority_cells(spark, sf), "p_brand", "o_orderpriority")


def weekly_velocity(spark: SparkSession, sf: str) -> DataFrame:
    """Postings per ISO week."""
    o = table(spark, sf, "orders").select("o_orderdate")
    d = F.to_date("o_orderdate")
    return (o.groupBy(F.year(F.date_trunc("week", d)).cast("bigint").alias("week_year"),
                      F.weekofyear(d).cast("bigint").alias("week_of_year"))
            .agg(F.count(F.lit(1)).alias("postings")))


def daily_velocity(spark: SparkSession, sf: str) -> DataFrame:
    """Postings per day."""
    o = table(spark, sf, "orders").select("o_orderdate")
    return o.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("postings"))


def monthly_share_change(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly share of one status (the remote share analogue) and its
    change from the previous month.  The window runs over the monthly
    aggregate (one row per month), never over raw rows."""
    o = table(spark, sf, "orders").select("o_orderdate", "o_orderstatus")
    m = o.groupBy(F.date_trunc("month", "o_orderdate").cast("date").alias("month")).agg(
        F.round(F.avg(F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)) * 100, 2).alias("share_pct"),
        F.count(F.lit(1)).alias("postings"))
    w = Window.orderBy("month")
    return m.withColumn("change_pct", F.round(F.col("share_pct") - F.lag("share_pct").over(w), 2))


def days_to_ship(spark: SparkSession, sf: str) -> DataFrame:
    """distribution of days between order and ship date."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return (j.groupBy(F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")).cast("bigint").alias("days_on_market"))
            .agg(F.count(F.lit(1)).alias("n")))


def top_customers(spark: SparkSession, sf: str, k: int = 10) -> DataFrame:
    """Top hiring companies (most postings, ties by name)."""
    o = table(spark, sf, "orders").select("o_custkey")
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    per = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("postings"))
    return M.top_k(per.join(c, per.o_custkey == c.c_custkey).select("c_name", "postings"), "c_name", "postings", k)


def priority_funnel(spark: SparkSession, sf: str) -> DataFrame:
    """Postings per level, ordered by level, with the running share."""
    o = table(spark, sf, "orders").select("o_orderpriority")
    w = Window.orderBy("o_orderpriority")  # one row per level
    return (M.value_counts(o, "o_orderpriority")
            .withColumn("running_share_pct", F.round(
                F.sum("count").over(w) * 100.0 / F.sum("count").over(w.rowsBetween(Window.unboundedPreceding,
                                                                                   Window.unboundedFollowing)), 2))
            .orderBy("o_orderpriority"))


def part_cooccurrence(spark: SparkSession, sf: str) -> DataFrame:
    """For every pair of parts, the number of orders with both.

    An order has a handful of lines, so the pairs grow with the line items;
    their counts are combined per task before the shuffle."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    baskets = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_set("l_partkey")).alias("parts"))
    first = baskets.select("parts", F.posexplode("parts").alias("i", "part_a"))
    rest = F.slice("parts", F.col("i") + 2, F.greatest(F.size("parts") - F.col("i") - 1, F.lit(0)))
    pairs = first.select("part_a", F.explode(rest).alias("part_b"))
    return pairs.groupBy("part_a", "part_b").agg(F.count(F.lit(1)).alias("n_orders"))


def hypothesis_test_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A18 / A20 with their p-values, one row per test."""
    t = hypothesis_tests(spark, sf)
    rows = [("anova", t["anova"]["f_stat"], t["anova"]["p_value"], t["anova"]["df_between"]),
            ("chi_square", t["chi_square"]["chi2"], t["chi_square"]["p_value"], t["chi_square"]["dof"])]
    return spark.createDataFrame(rows, "test string, statistic double, p_value double, dof long")


def hypothesis_tests(spark: SparkSession, sf: str) -> dict:
    """The statistics report: ANOVA of parts per order by priority, Pearson of
    postings vs mean parts per segment, chi-square of top-20 brands x priority."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    per = o.join(_order_parts(spark, sf), o.o_orderkey == F.col("l_orderkey"))
    return {"anova": S.anova_test(per, "o_orderpriority", "skill_count"),
            "pearson_r": segment_correlation(spark, sf).first().r,
            "chi_square": S.chi2_test(brand_priority_cells(spark, sf), "p_brand", "o_orderpriority")}
