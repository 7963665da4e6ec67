"""Surrogate keys (F44) and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirescope.functions.rules import SURROGATE_NULL_TOKEN, SURROGATE_SEPARATOR


def surrogate_key(*cols) -> Column:
    """MD5 over the '-'-joined string forms; null -> fixed token (macro contract)."""
    parts = [F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"),
                        F.lit(SURROGATE_NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *parts))


def date_parts(d) -> list[Column]:
    """day, month, year, quarter, ISO week, Sunday=0 weekday, full names."""
    d = F.col(d) if isinstance(d, str) else d
    return [
        F.dayofmonth(d).cast("bigint").alias("day"),
        F.month(d).cast("bigint").alias("month"),
        F.year(d).cast("bigint").alias("year"),
        F.quarter(d).cast("bigint").alias("quarter"),
        F.weekofyear(d).cast("bigint").alias("week_of_year"),
        (F.dayofweek(d) - 1).cast("bigint").alias("day_of_week"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "EEEE").alias("day_name"),
    ]
