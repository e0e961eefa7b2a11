"""Pipeline revenue against the monthly figures finance has signed off."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How far from the expected takings of the missing days a difference may be, as a share of them.
GAP_SLACK = Decimal("0.5")


def _difference(pipeline: str, finance: str) -> list[Column]:
    gap = F.col(pipeline) - F.col(finance)
    pct = F.try_divide(gap.cast("double") * 100, F.col(finance).cast("double"))
    return [
        F.round(gap, 2).cast("decimal(18,2)").alias("difference"),
        F.round(pct, 2).alias("difference_pct"),
    ]


def reconcile(monthly: DataFrame, finance: DataFrame) -> DataFrame:
    """Both figures per month. A month known to one side only stays, with a null on the other."""
    closed = finance.select("month", F.round("revenue_inr", 2).cast("decimal(18,2)").alias("finance_revenue"))
    joined = closed.join(monthly.select("month", "pipeline_revenue"), "month", "full_outer")
    return joined.select(
        "month", "finance_revenue", "pipeline_revenue", *_difference("pipeline_revenue", "finance_revenue")
    )


def reconcile_month(monthly: DataFrame, finance: DataFrame, month: str) -> DataFrame:
    one = reconcile(monthly.where(F.col("month") == month), finance.where(F.col("month") == month))
    return one.select("month", "finance_revenue", "pipeline_revenue", "difference")


def monthly_by_rule(revenues: DataFrame) -> DataFrame:
    """(month, one revenue column per rule) from rows (rule, business_date, revenue)."""
    rules = ("canonical", "fact_script", "cross_system")
    return revenues.groupBy(F.date_format("business_date", "yyyy-MM").alias("month")).agg(
        *[
            F.coalesce(F.round(F.sum(F.when(F.col("rule") == r, F.col("revenue"))), 2), F.lit(0))
            .cast("decimal(18,2)").alias(r)
            for r in rules
        ]
    )


def expected_takings(daily: DataFrame) -> DataFrame:
    """(store_id, day_of_week_num, expected): the median takings of a store on a weekday, which single odd days do not move."""
    per_day = daily.groupBy("store_id", "business_date").agg(F.round(F.sum("revenue"), 2).cast("double").alias("takings"))
    weekday = (F.weekday("business_date") + 1).alias("day_of_week_num")
    middle = F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY takings)")  # one of the takings, the lower of two in the middle
    return per_day.select("store_id", weekday, "takings").groupBy("store_id", "day_of_week_num").agg(
        middle.cast("decimal(18,2)").alias("expected"))


def gap_sizes(missing: DataFrame, expected: DataFrame) -> DataFrame:
    """(month, missing_store_days, expected_gap): what the missing days should have brought, by store and weekday.

    A day of a store and weekday without any takings to go by counts as a missing day and adds nothing.
    """
    days = missing.select(
        "store_id", (F.weekday("business_date") + 1).alias("day_of_week_num"), F.date_format("business_date", "yyyy-MM").alias("month"))
    return days.join(expected, ["store_id", "day_of_week_num"], "left").groupBy("month").agg(
        F.count("*").alias("missing_store_days"),
        F.coalesce(F.sum("expected"), F.lit(0)).cast("decimal(18,2)").alias("expected_gap"))


def label_causes(by_rule: DataFrame, finance: DataFrame, gaps: DataFrame, tolerance: str = "0.01") -> DataFrame:
    """Why a month differs; ``gaps`` is (month, missing_store_days, expected_gap).

    not_closed        finance has no figure for the month yet
    no_pipeline       finance has a figure, the pipeline has nothing
    match             the canonical figure equals finance
    definition:<rule> finance equals the revenue under another rule
    source_gap        finance is higher by what the missing days should have brought, give or take ``GAP_SLACK`` of it
    pipeline          none of these: look for a bug
    """
    joined = (
        finance.select("month", F.col("revenue_inr").cast("decimal(18,2)").alias("finance_revenue"))
        .join(by_rule, "month", "full_outer")
        .join(gaps, "month", "left")
        .withColumn("missing_store_days", F.coalesce("missing_store_days", F.lit(0)))
        .withColumn("expected_gap", F.coalesce("expected_gap", F.lit(0).cast("decimal(18,2)")))
    )
    near = lambda rule: F.abs(F.col(rule) - F.col("finance_revenue")) <= F.lit(tolerance).cast("decimal(18,2)")
    short = F.col("finance_revenue") - F.col("canonical")
    fits = (F.col("expected_gap") > 0) & (short > 0) & (F.abs(short - F.col("expected_gap")) <= F.col("expected_gap") * F.lit(GAP_SLACK))
    cause = (
        F.when(F.col("finance_revenue").isNull(), "not_closed")
        .when(F.col("canonical").isNull(), "no_pipeline")
        .when(near("canonical"), "match")
        .when(near("fact_script"), "definition:fact_script")
        .when(near("cross_system"), "definition:cross_system")
        .when(fits, "source_gap")
        .otherwise("pipeline")
    )
    return joined.select(
        "month", "finance_revenue", "canonical", "fact_script", "cross_system", "missing_store_days", "expected_gap",
        *_difference("canonical", "finance_revenue"), cause.alias("cause"),
    )
