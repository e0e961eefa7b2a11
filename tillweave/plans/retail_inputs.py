"""Retail inputs derived from the TPC-H style driver tables.

The till exports themselves are not available, so each lineitem row stands for one item on a bill.
Everything is derived row by row from one scan: no shuffle happens before the line-level dedup.

bill      store, ship date and order key
VOID      mirror of every item of orders whose key divides by 50
bill rows DISCOUNT, TAX and TENDER next to the first line of a bill that is not void
re-send   orders whose key divides by 17; odd orders were re-sent without their later lines
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


MONEY, QTY = "decimal(12,2)", "decimal(12,3)"


def table(spark: SparkSession, sf_dir: str, name: str, parallelism: int | None = None) -> DataFrame:
    """A driver table, as it is read or, for one that lies in too few row groups, dealt to ``parallelism`` tasks."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df if parallelism is None else df.repartition(parallelism)


def _cents(value: Column) -> Column:
    return F.round(value * 100).cast("bigint")


def _money(cents: Column, kind: str = MONEY) -> Column:
    return (cents.cast("decimal(16,0)") * F.lit(Decimal("0.01"))).cast(kind)


def sales_lines(spark: SparkSession, sf_dir: str, parallelism: int | None = None) -> DataFrame:
    """Normalised lines of all files, re-sends included."""
    col = F.col
    item = table(spark, sf_dir, "lineitem", parallelism).select(
        F.concat(F.lit("S"), F.lpad((col("l_suppkey") % 12 + 1).cast("string"), 2, "0")).alias("store_id"),
        col("l_shipdate").cast("date").alias("business_date"),
        col("l_orderkey").alias("order_key"),
        col("l_linenumber").alias("item_no"),
        F.concat(F.lit("P"), col("l_partkey").cast("string")).alias("code"),
        col("l_quantity").cast("bigint").alias("pieces"),
        _cents(col("l_extendedprice")).alias("total"),
        F.round(col("l_discount") * 100).cast("bigint").alias("discount_pct"),
        F.round(col("l_tax") * 100).cast("bigint").alias("tax_pct"),
        (col("l_returnflag") == "R").alias("returned"),
        F.expr(
            "cast(l_shipdate as timestamp_ntz)"
            " + make_dt_interval(0, 0, 0, (l_orderkey * 37 + l_linenumber * 61) % 93600)"
        ).alias("ts"),
    )
    day = F.date_format("business_date", "yyyyMMdd")
    void = col("order_key") % 50 == 0
    first = (col("item_no") == 1) & ~col("returned")
    words = lambda *names: F.array(*[F.lit(n) for n in names])
    kinds = (
        F.when(void, words("ITEM", "VOID"))
        .when(first & (col("discount_pct") > 0), words("ITEM", "DISCOUNT", "TAX", "TENDER"))
        .when(first, words("ITEM", "TAX", "TENDER"))
        .otherwise(words("ITEM"))
    )
    resent = (col("order_key") % 17 == 0) & ((col("order_key") % 2 == 0) | (col("item_no") == 1))
    copies = F.when(resent, words("", "__R1")).otherwise(words(""))

    rows = item.withColumn("kind", F.explode(kinds)).withColumn("copy", F.explode(copies))
    kind = col("kind")
    is_item = kind.isin("ITEM", "VOID")
    signed = F.when(col("returned"), -col("pieces")).otherwise(col("pieces"))
    discount = F.expr("total * discount_pct div 100")
    tax = F.expr("total * tax_pct div 100")
    price = (
        F.when(is_item, F.expr("total div pieces"))
        .when(kind == "DISCOUNT", -discount)
        .when(kind == "TAX", tax)
        .otherwise(col("total") - discount + tax)
    )
    step = (
        F.when(kind == "ITEM", 0).when(kind == "VOID", 1).when(kind == "DISCOUNT", 2)
        .when(kind == "TAX", 3).otherwise(4)
    )
    return rows.select(
        "store_id",
        "business_date",
        F.concat_ws("-", "store_id", day, col("order_key").cast("string")).alias("bill_no"),
        (col("item_no") * 10 + step).cast("int").alias("line_no"),
        F.when(is_item, col("code")).alias("product_code"),
        F.when(kind == "ITEM", signed).when(kind == "VOID", -signed).otherwise(F.lit(1)).cast(QTY).alias("qty"),
        _money(price).alias("unit_price"),
        F.when((kind == "ITEM") & col("returned"), "RETURN").when(kind == "ITEM", "SALE").otherwise(kind)
        .alias("line_type"),
        "ts",
        F.concat(F.lit("SALES_"), "store_id", F.lit("_"), day, "copy", F.lit(".csv")).alias("source_file"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One store per lineitem store number, and S13, which never sends anything.

    The name comes from the first supplier behind it. A store opens thirty days after the one before.
    """
    number = (F.col("s_suppkey") % 12 + 1).alias("number")
    named = table(spark, sf_dir, "supplier").groupBy(number).agg(F.min("s_name").alias("name"))
    named = named.unionByName(spark.range(1).select(F.lit(13).cast("bigint").alias("number"), F.lit("to be").alias("name")))
    return named.select(
        F.concat(F.lit("S"), F.lpad(F.col("number").cast("string"), 2, "0")).alias("store_id"),
        F.concat(F.lit("Store "), "name").alias("store_name"),
        F.date_add(F.lit("1995-01-01").cast("date"), (F.col("number") * 30).cast("int")).alias("opened_on"),
    )


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fourteen categories; the product size decides which one a part belongs to."""
    number = F.explode(F.array(F.col("p_size") % 14 + 1, (F.col("p_size") + 5) % 14 + 1)).alias("n")
    numbers = table(spark, sf_dir, "part").select(number).distinct()
    return numbers.select(
        _category(F.col("n")).alias("category_id"),
        F.concat(F.lit("Category "), F.col("n").cast("string")).alias("category_name"),
    )


def _category(number: Column) -> Column:
    return F.concat(F.lit("C"), F.lpad(number.cast("string"), 2, "0"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as date-valid products: every 50th code is reissued in another category on 1998-06-01,
    every 97th code only starts in 1996."""
    part = table(spark, sf_dir, "part")
    reissued = F.col("p_partkey") % 50 == 0
    versions = F.when(reissued, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = part.withColumn("version", F.explode(versions))
    new = F.col("version") == 1
    start = F.when(F.col("p_partkey") % 97 == 0, "1996-01-01").otherwise("1990-01-01")
    return rows.select(
        (F.col("p_partkey") * 2 + F.col("version")).alias("product_sk"),
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("product_code"),
        F.when(new, F.concat(F.col("p_name"), F.lit(" (reissued)"))).otherwise(F.col("p_name")).alias("product_name"),
        _category(F.when(new, (F.col("p_size") + 5) % 14 + 1).otherwise(F.col("p_size") % 14 + 1)).alias("category_id"),
        F.col("p_brand").alias("brand"),
        F.when(new, "1998-06-01").otherwise(start).cast("date").alias("valid_from"),
        F.when(reissued & ~new, "1998-05-31").otherwise("9999-12-31").cast("date").alias("valid_to"),
        (new | ~reissued).alias("is_current"),
    )


def price_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One to three contiguous price intervals per product, from the part's retail price."""
    base = products(spark, sf_dir).select("product_sk", F.expr("product_sk div 2").alias("p_partkey"))
    priced = table(spark, sf_dir, "part").select("p_partkey", _cents(F.col("p_retailprice")).alias("cents"))
    steps = F.when(F.col("p_partkey") % 3 == 0, F.array(F.lit(0))).when(
        F.col("p_partkey") % 3 == 1, F.array(F.lit(0), F.lit(1))
    ).otherwise(F.array(F.lit(0), F.lit(1), F.lit(2)))
    rows = base.join(priced, "p_partkey").withColumn("step", F.explode(steps))
    step, last = F.col("step"), F.col("step") == F.col("p_partkey") % 3
    selling = F.expr("cents * (100 + step * 4) div 100")
    ends = F.when(last, "9999-12-31").when(step == 0, "1997-04-14").otherwise("1999-08-19")
    starts = F.when(step == 0, "1990-01-01").when(step == 1, "1997-04-15").otherwise("1999-08-20")
    return rows.select(
        (F.col("product_sk") * 3 + step).alias("revision_id"),
        "product_sk",
        _money(F.expr("cents * (110 + step * 4) div 100")).alias("mrp"),
        _money(selling).alias("selling_price"),
        starts.cast("date").alias("effective_from"),
        ends.cast("date").alias("effective_to"),
    )


def finance_monthly(by_rule: DataFrame, gaps: DataFrame) -> DataFrame:
    """Signed-off figures with planted differences.

    Every month divisible by 4 follows another revenue rule, every month that leaves 1 holds an amount the tills never sent.
    In 1998-07 the stores phoned in what the missing days should have brought, 2001-03 was not closed yet, and 1994-12 lies before the
    first export.
    """
    number = F.substring("month", 6, 2).cast("int")
    figure = (
        F.when(F.col("month") == "1998-07", F.col("canonical") + F.coalesce("expected_gap", F.lit(0)))
        .when(number % 4 == 0, F.col("cross_system"))
        .when(number % 4 == 1, F.col("canonical") + F.lit(Decimal("12345.67")))
        .otherwise(F.col("canonical"))
    )
    figures = by_rule.join(gaps, "month", "left").where(F.col("month") != "2001-03").select(
        "month", figure.cast("decimal(18,2)").alias("revenue_inr"))
    early = by_rule.sparkSession.range(1).select(
        F.lit("1994-12").alias("month"), F.lit(Decimal("1000.00")).cast("decimal(18,2)").alias("revenue_inr"))
    return figures.unionByName(early).select(
        "month",
        F.date_add(F.last_day(F.to_date("month", "yyyy-MM")), 9).alias("closed_on"),
        "revenue_inr",
        F.lit("finance").alias("signed_off_by"),
    )
