"""Calendar dimension and trading-day gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def dim_date(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per date in the closed range."""
    span = spark.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("date_key")
    )
    return with_attributes(span)


def dates_of(facts: DataFrame) -> DataFrame:
    """Calendar covering the first to the last business date of ``facts``."""
    ends = facts.agg(F.min("business_date").alias("first"), F.max("business_date").alias("last"))
    return with_attributes(ends.select(F.explode(F.sequence("first", "last")).alias("date_key")))


def with_attributes(dates: DataFrame) -> DataFrame:
    day = F.col("date_key")
    return dates.select(
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        (F.weekday(day) + 1).alias("day_of_week_num"),
    )


def trading_ranges(stores: DataFrame, dates: DataFrame) -> DataFrame:
    """(store_id, lo, hi): the days on which each store should have traded.

    From ``opened_on`` to ``closed_on`` (null: still open), as far as ``dates`` go. The facts have no say in it, so a store that never
    sent anything, or stopped sending, is expected like any other.
    """
    ends = dates.agg(F.min("date_key").alias("first"), F.max("date_key").alias("last")).first()
    first, last = (F.lit(ends[name]).cast("date") for name in ("first", "last"))
    closed = F.col("closed_on") if "closed_on" in stores.columns else F.lit(None).cast("date")
    ranges = stores.select("store_id", F.greatest("opened_on", first).alias("lo"), F.least(closed, last).alias("hi"))
    return ranges.where("lo <= hi")


def missing_days(facts: DataFrame, ranges: DataFrame) -> DataFrame:
    """(store_id, business_date) of the days in ``ranges`` (store_id, lo, hi) without any row."""
    traded = facts.select("store_id", "business_date").distinct()
    expected = ranges.select("store_id", F.explode(F.sequence("lo", "hi")).alias("business_date"))
    return expected.join(traded, ["store_id", "business_date"], "left_anti")
