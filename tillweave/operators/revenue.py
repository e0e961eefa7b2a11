"""Fact table and revenue slices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillweave.functions.money import RULE_TYPES, money_sum, revenue_expr
from tillweave.operators.joins import join_valid
from tillweave.operators.lines import without_void_bills
from tillweave.operators.products import BILL_LEVEL, NO_PRODUCT


def counted_lines(lines: DataFrame, rule: str) -> DataFrame:
    return lines.where(F.col("line_type").isin(*RULE_TYPES[rule]))


def fact_sales(lines: DataFrame, products: DataFrame, rule: str = "canonical") -> DataFrame:
    """Sales facts under one revenue rule.

    canonical keeps every counted line (no product: ``NO_PRODUCT`` / ``BILL_LEVEL``) and both sides
    of a void; fact_script drops void bills whole and lines without a product; cross_system drops
    only the VOID rows and lines without a product. Lines without a code, which is what bill-level discounts are, go around the
    join, where they would meet in one task.
    """
    valid = products.select("product_code", "product_sk", "category_id", "valid_from", "valid_to")
    source = without_void_bills(lines) if rule == "fact_script" else lines
    how = "left" if rule == "canonical" else "inner"
    counted = counted_lines(source, rule)
    joined = join_valid(
        counted.where("product_code IS NOT NULL"), valid, "product_code", "business_date", "valid_from", "valid_to", how
    )
    if how == "left":
        joined = joined.unionByName(counted.where("product_code IS NULL"), allowMissingColumns=True)
    return joined.select(
        "store_id", "business_date", "bill_no", "line_no",
        F.coalesce("product_sk", F.lit(NO_PRODUCT)).cast("bigint").alias("product_sk"),
        F.coalesce("category_id", F.lit(BILL_LEVEL)).alias("category_id"),
        "qty", "unit_price", "line_type", revenue_expr(rule).alias("revenue"), "ts", "source_file",
    )


def store_category_day(fact: DataFrame) -> DataFrame:
    """Pre-aggregate behind the dashboard: its size follows the dimensions, not the lines."""
    return fact.groupBy("store_id", "category_id", "business_date", "line_type").agg(
        F.sum("revenue").cast("decimal(24,5)").alias("revenue"), F.count("*").alias("rows")
    )


def revenue_by(daily: DataFrame, *cols: str) -> DataFrame:
    return daily.groupBy(*cols).agg(money_sum().alias("revenue"))


def revenue_by_calendar(daily: DataFrame, dates: DataFrame, *cols: str) -> DataFrame:
    """Revenue by date attributes: one row per date before the calendar is joined."""
    per_day = daily.groupBy("business_date").agg(F.sum("revenue").alias("revenue"))
    joined = per_day.join(dates, per_day.business_date == dates.date_key)
    return joined.groupBy(*cols).agg(money_sum().alias("revenue"))


def revenue_by_month_key(daily: DataFrame) -> DataFrame:
    return daily.groupBy(F.date_format("business_date", "yyyy-MM").alias("month")).agg(
        money_sum().alias("pipeline_revenue")
    )


def revenue_by_line_type(daily: DataFrame) -> DataFrame:
    return daily.groupBy("line_type").agg(F.sum("rows").alias("rows"), money_sum().alias("revenue"))


def revenue_between(daily: DataFrame, first: str, end: str) -> DataFrame:
    """Half-open date range, which the scan and the partitions can prune on."""
    day = F.col("business_date")
    return daily.where((day >= F.lit(first).cast("date")) & (day < F.lit(end).cast("date")))


def store_daily(daily: DataFrame, lines: DataFrame, store: str, first: str, last: str) -> DataFrame:
    """(business_date, rows, revenue) of one store: clean lines of every type and revenue per day, days with either."""
    mine = lambda df: df.where((F.col("store_id") == store) & F.col("business_date").between(first, last)).groupBy("business_date")
    counted = mine(lines).agg(F.count("*").alias("rows"))
    taken = mine(daily).agg(money_sum().alias("revenue"))
    return counted.join(taken, "business_date", "full_outer").select(
        "business_date", F.coalesce("rows", F.lit(0)).alias("rows"), "revenue")


def revenue_cube(daily: DataFrame) -> DataFrame:
    """Every combination of store, category, weekday and month, from the pre-aggregate.

    ``grouping`` has a bit for each of the four, store first, set where a null stands for all of them and not for a missing value.
    """
    small = daily.select(
        "store_id", "category_id",
        (F.weekday("business_date") + 1).alias("day_of_week_num"),
        F.date_format("business_date", "yyyy-MM").alias("month"),
        "revenue",
    )
    return small.cube("store_id", "category_id", "day_of_week_num", "month").agg(
        F.grouping_id().cast("bigint").alias("grouping"), money_sum().alias("revenue")
    )


def fact_cardinality(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count("*").alias("fact_rows"),
        F.countDistinct("store_id").alias("fact_stores"),
        F.countDistinct("category_id").alias("fact_categories"),
        F.countDistinct("business_date").alias("fact_dates"),
    )


def store_category_revenue(
    lines: DataFrame, stores: DataFrame, products: DataFrame, categories: DataFrame
) -> DataFrame:
    """Sales lines in Parquet against masters from another system, RETURN and DISCOUNT forced negative.

    Lines are summed per (store, code, date) before the validity join, names are joined to the sums.
    """
    rule = "cross_system"
    sums = (
        counted_lines(lines, rule)
        .select("store_id", "product_code", "business_date", revenue_expr(rule).alias("revenue"))
        .groupBy("store_id", "product_code", "business_date")
        .agg(F.sum("revenue").alias("revenue"))
    )
    valid = products.select("product_code", "category_id", "valid_from", "valid_to")
    filed = (
        join_valid(sums, valid, "product_code", "business_date", "valid_from", "valid_to")
        .groupBy("store_id", "category_id")
        .agg(money_sum().alias("revenue"))
    )
    return (
        filed.join(stores.select("store_id", "store_name"), "store_id")
        .join(categories.select("category_id", "category_name"), "category_id")
        .select("store_id", "store_name", "category_id", "category_name", "revenue")
    )


def named_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every named table, as rows (component, rows)."""
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("component"), "rows")
        for name, df in tables.items()
    ]
    result = counts[0]
    for one in counts[1:]:
        result = result.unionByName(one)
    return result


def scorecard(tables: dict[str, DataFrame], fact: DataFrame) -> DataFrame:
    """Dimension counts and fact cardinalities as one row."""
    card = fact_cardinality(fact)
    unpivoted = card.select(F.explode(F.map_from_arrays(
        F.array(*[F.lit(c) for c in card.columns]), F.array(*[F.col(c) for c in card.columns])
    )).alias("component", "rows"))
    rows = named_counts(tables).unionByName(unpivoted)
    names = [*tables, *card.columns]
    return rows.agg(*[F.max(F.when(F.col("component") == n, F.col("rows"))).alias(n) for n in names])
