"""Calendar spine and the month spines derived from it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def days_between(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("date_key"))


def days_covering(rows: DataFrame, date: str) -> DataFrame:
    """One row per day of every calendar year that the rows touch."""
    first = F.trunc(F.min(date), "year").alias("first")
    last = F.last_day(F.add_months(F.trunc(F.max(date), "year"), 11)).alias("last")
    bounds = rows.agg(first, last).filter(F.col("first").isNotNull())
    return bounds.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("date_key"))


def calendar_attributes(days: DataFrame) -> DataFrame:
    day = F.col("date_key")
    iso_weekday = F.weekday(day) + 1
    quarter = F.quarter(day)

    def text(pattern: str) -> Column:
        return F.date_format(day, pattern)

    return days.select(
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        quarter.alias("quarter"),
        iso_weekday.alias("day_of_week"),
        F.trunc(day, "month").alias("start_of_month"),
        F.last_day(day).alias("end_of_month"),
        text("yyyy-MM").alias("year_month"),
        text("MMM yyyy").alias("month_year"),
        text("MMMM").alias("month_name"),
        text("EEEE").alias("day_name"),
        F.concat(F.lit("Q"), quarter.cast("string")).alias("quarter_name"),
        (iso_weekday >= 6).alias("is_weekend"),
    )


def salary_months(calendar: DataFrame, start: dt.date, as_of: dt.date) -> DataFrame:
    """Months from ``start`` that began at least one month before ``as_of``."""
    begun = F.col("start_of_month") <= F.add_months(F.lit(as_of), -1)
    months = calendar.filter((F.col("start_of_month") >= F.lit(start)) & begun)
    return months.select("start_of_month", "year", "month", "year_month").distinct()


def with_balance_months(df: DataFrame, start: dt.date, as_of: dt.date) -> DataFrame:
    """Each row once for every month that has begun by ``as_of``, the current one with its end still ahead.

    The months are generated per row, not joined.
    """
    first, last = start.replace(day=1), as_of.replace(day=1)
    span = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 month")) if start <= as_of else F.array()
    month = F.col("start_of_month")
    months = df.withColumn("start_of_month", F.explode(span.cast("array<date>")))
    return months.withColumns({"month_end_date": F.last_day(month), "year_month": F.date_format(month, "yyyy-MM")})
