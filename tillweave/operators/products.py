"""Date-valid products and prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillweave.operators.joins import join_valid

NO_PRODUCT = -1
BILL_LEVEL = "BILL"


def unmatched_lines(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Lines whose code is not valid on the business date (no code at all counts as unmatched)."""
    valid = products.select("product_code", "valid_from", "valid_to")
    return join_valid(lines, valid, "product_code", "business_date", "valid_from", "valid_to", "left_anti")


def unmatched_sales(lines: DataFrame, products: DataFrame) -> DataFrame:
    return _unmatched_by_code(lines, products).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("unmatched_sales")
    )


def unmatched_codes(lines: DataFrame, products: DataFrame) -> DataFrame:
    return _unmatched_by_code(lines, products)


def _unmatched_by_code(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Counts per (code, date) first: a hot code reaches the join as one row per date."""
    daily = lines.groupBy("product_code", "business_date").agg(F.count("*").alias("n"))
    return unmatched_lines(daily, products).groupBy("product_code").agg(F.sum("n").alias("rows"))


def price_as_of(products: DataFrame, revisions: DataFrame, date: str | Column) -> DataFrame:
    """List price of every product on one reporting date. Only the date differs between reports."""
    day = F.lit(date).cast("date") if isinstance(date, str) else date
    current = revisions.where(day.between(F.col("effective_from"), F.col("effective_to"))).select(
        "product_sk", F.col("selling_price").alias("historical_price")
    )
    return (
        products.select("product_sk", "product_code", "product_name")
        .join(current, "product_sk")
        .select(
            "product_sk", "product_code", "product_name",
            day.alias("reporting_date"), "historical_price",
        )
    )


def line_prices(lines: DataFrame, revisions: DataFrame) -> DataFrame:
    """Add the list price that applied on each line's business date; lines carry product_sk."""
    prices = revisions.select(
        "product_sk", F.col("selling_price").alias("list_price"), "effective_from", "effective_to"
    )
    return join_valid(
        lines, prices, "product_sk", "business_date", "effective_from", "effective_to"
    ).drop("effective_from", "effective_to")


def price_variance(priced: DataFrame) -> DataFrame:
    """Per store: item lines, lines printed off the list price, their share and the amount."""
    off = F.col("unit_price") != F.col("list_price")
    return priced.groupBy("store_id").agg(
        F.count("*").alias("lines"),
        F.sum(off.cast("int")).alias("off_list"),
        F.round(F.avg(off.cast("int")) * 100, 4).alias("off_list_pct"),
        F.round(F.sum((F.col("unit_price") - F.col("list_price")) * F.col("qty")), 2)
        .cast("decimal(18,2)").alias("amount_difference"),
    )


def price_change_count(products: DataFrame, revisions: DataFrame, n: int = 20) -> DataFrame:
    """Products with more than one revision, most revised first."""
    counts = revisions.groupBy("product_sk").agg(F.count("*").alias("revision_count")).where("revision_count > 1")
    return (
        products.select("product_sk", "product_code", "product_name")
        .join(counts, "product_sk")
        .orderBy(F.desc("revision_count"), "product_sk")
        .limit(n)
    )
