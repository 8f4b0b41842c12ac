"""Date spine and calendar dimension."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.functions.keys import date_key

# Fixed value: the first day of a spine that no fact moves.
SPINE_START = date(2000, 1, 1)


def date_spine(spark: SparkSession, end: date, start: date = SPINE_START) -> DataFrame:
    """Consecutive days from ``start`` up to ``end``."""
    count = max(0, (end - start).days + 1)
    return spark.range(count).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("full_date")
    )


def spine_over(tables: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Every day from the first to the last found in the given (table, date column) pairs.

    Facts are reduced to two dates each before they meet.
    """
    ends = None
    for df, column in tables:
        day = F.col(column).cast("date")
        part = df.agg(F.min(day).alias("_from"), F.max(day).alias("_to"))
        ends = part if ends is None else ends.unionByName(part)
    return (
        ends.agg(F.min("_from").alias("_from"), F.max("_to").alias("_to"))
        .where(F.col("_from").isNotNull())
        .select(F.explode(F.sequence("_from", "_to")).alias("full_date"))
    )


def key_to_date(key: Column) -> Column:
    """The date of an integer day key."""
    return F.make_date(
        F.floor(key / 10000).cast("int"),
        F.pmod(F.floor(key / 100), F.lit(100)).cast("int"),
        F.pmod(key, F.lit(100)).cast("int"),
    )


def dim_calendar(spine: DataFrame) -> DataFrame:
    """Calendar attributes per day: ISO week, Sunday as day 0, three-letter names."""
    day = F.col("full_date")
    weekday = F.dayofweek(day) - 1
    return spine.select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(day), F.lit("-"), F.year(day)).alias("quarter_name"),
        F.month(day).alias("month"),
        F.date_format(day, "MMM").alias("month_name"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.dayofmonth(day).alias("day_of_month"),
        F.weekofyear(day).alias("week_of_year"),
        F.date_format(day, "EEE").alias("day_name"),
        weekday.alias("day_of_week"),
        weekday.isin(0, 6).alias("is_weekend"),
    )
