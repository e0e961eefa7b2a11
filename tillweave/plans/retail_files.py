"""Nightly load from till exports to the star schema: a full build, and a refresh after new files or late re-sends.

Clean lines, facts and the daily pre-aggregate lie under year/month/store. A bill number holds the store and the business date, so all
copies of a line belong to one such partition, and a partition that is built alone has the same winners as in a full build.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillweave.operators.lines import dedup_lines
from tillweave.operators.revenue import fact_sales, store_category_day
from tillweave.session import tune
from tillweave.sources.sales_files import (
    LANDING, PARTITIONS, in_partitions, land_sales, list_files, read_landed, read_lines, write_partitioned,
)
from tillweave.sources.tables import read_table, replace, versions

TABLES = ("clean", "fact_sales", "store_category_day")


def load(spark: SparkSession, exports: str, products: DataFrame, warehouse: str) -> None:
    """Land all exports, keep one row per line, build facts and the daily pre-aggregate.

    Every table is replaced (whole or by touched partition), so any number of runs gives the same rows.
    """
    tune(spark)
    seen = listing(spark, exports)
    land_sales(spark, exports, f"{warehouse}/landed")
    landed = read_lines(spark, f"{warehouse}/landed").drop(*LANDING)
    write_partitioned(dedup_lines(landed), f"{warehouse}/clean")
    clean = clean_lines(spark, warehouse)
    write_partitioned(fact_sales(clean, products), f"{warehouse}/fact_sales")
    fact = read_landed(spark, f"{warehouse}/fact_sales")
    write_partitioned(store_category_day(fact), f"{warehouse}/store_category_day")
    replace(seen, f"{warehouse}/files")


def clean_lines(spark: SparkSession, warehouse: str) -> DataFrame:
    return read_landed(spark, f"{warehouse}/clean").drop(*PARTITIONS)


def listing(spark: SparkSession, exports: str) -> DataFrame:
    """(source_file, bytes, modified, year, month, store) of every export that has a partition."""
    files = list_files(spark, exports).where("store_id IS NOT NULL AND business_date IS NOT NULL")
    day = lambda form: F.date_format("business_date", form)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("source_file"), "bytes", "modified",
        day("yyyy").alias("year"), day("MM").alias("month"), F.col("store_id").alias("store"))


def changed_files(seen: DataFrame, known: DataFrame) -> DataFrame:
    """Files that are new, or have another size or time than when they were last landed."""
    return seen.join(known.select("source_file", "bytes", "modified"), ["source_file", "bytes", "modified"], "left_anti")


def refresh(spark: SparkSession, exports: str, products: DataFrame, warehouse: str) -> DataFrame:
    """Land the exports that have changed since the last run and build the partitions that they belong to again.

    Returns the changed files. The result is what a full build would give. A warehouse that was never built is built whole.
    The driver holds the names of one run's changed files.
    """
    tune(spark)
    if not versions(spark, f"{warehouse}/files"):
        load(spark, exports, products, warehouse)
        return read_table(spark, f"{warehouse}/files")
    known = read_table(spark, f"{warehouse}/files")
    seen = listing(spark, exports)
    fresh = changed_files(seen, known).collect()
    changed = spark.createDataFrame(fresh, known.schema)
    if not fresh:
        return changed
    land_sales(spark, exports, f"{warehouse}/landed", sorted({r["source_file"] for r in fresh}))
    touched = sorted({(r["year"], r["month"], r["store"]) for r in fresh})
    landed = in_partitions(read_lines(spark, f"{warehouse}/landed"), touched).drop(*LANDING)
    _rebuild(dedup_lines(landed), f"{warehouse}/clean", touched)
    clean = in_partitions(read_landed(spark, f"{warehouse}/clean"), touched).drop(*PARTITIONS)
    _rebuild(fact_sales(clean, products), f"{warehouse}/fact_sales", touched)
    fact = in_partitions(read_landed(spark, f"{warehouse}/fact_sales"), touched)
    _rebuild(store_category_day(fact), f"{warehouse}/store_category_day", touched)
    rest = known.join(changed.select("source_file"), "source_file", "left_anti")
    replace(rest.unionByName(changed), f"{warehouse}/files")
    return changed


def _rebuild(rows: DataFrame, table: str, touched: list[tuple[str, str, str]]) -> None:
    """Replace the touched partitions of a table; those that have no rows any more are deleted."""
    spark = rows.sparkSession
    write_partitioned(rows, table, "dynamic")
    by = [F.date_format("business_date", "yyyy"), F.date_format("business_date", "MM"), F.col("store_id")]
    left = {tuple(r) for r in rows.select(*by).distinct().collect()}
    for part in touched:
        if part not in left:
            place = spark._jvm.org.apache.hadoop.fs.Path("/".join([table, *[f"{c}={v}" for c, v in zip(PARTITIONS, part)]]))
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
