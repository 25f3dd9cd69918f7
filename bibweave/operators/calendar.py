"""Counts per calendar period."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

STEP = {"year": "1 year", "quarter": "3 months", "month": "1 month", "week": "7 days"}


def counts_by_period(df: DataFrame, group: str, day: str, record: str, unit: str) -> DataFrame:
    """Distinct records per group and calendar unit (year, quarter, month, ISO week)."""
    return df.groupBy(group, F.trunc(day, unit).alias("period")).agg(F.count_distinct(record).alias("n"))


def fill_gaps(counts: DataFrame, group: str, period: str, value: str, step: str) -> DataFrame:
    """Add the missing periods of every group with value 0.

    The calendar is built from one row per group, so it never holds more than
    groups times periods."""
    span = counts.groupBy(group).agg(F.min(period).alias("__lo"), F.max(period).alias("__hi"))
    days = span.select(
        group, F.explode(F.expr(f"sequence(__lo, __hi, interval {step})")).alias(period)
    )
    return days.join(counts, [group, period], "left").withColumn(value, F.coalesce(value, F.lit(0)))


def last_days(df: DataFrame, day: str, as_of: dt.date, days: int = 30) -> DataFrame:
    """Rows per day of the last ``days`` days."""
    recent = df.where((F.col(day) > F.lit(as_of - dt.timedelta(days=days))) & (F.col(day) <= F.lit(as_of)))
    return recent.groupBy(F.col(day).alias("day")).agg(F.count(F.lit(1)).alias("n"))
