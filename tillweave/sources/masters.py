"""Master tables and finance closings: schemas, CSV load, JDBC scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Column names and types of the operational tables.
SCHEMAS = {
    "stores": "store_id string, store_name string, address_line string, city string, state string, "
              "region string, floor_area_sqft int, opened_on date",
    "product_categories": "category_id string, category_name string, department string, gst_rate decimal(4,3)",
    "products": "product_sk bigint, product_code string, product_name string, category_id string, brand string, "
                "pack_size string, uom string, valid_from date, valid_to date, is_current boolean",
    "price_revisions": "revision_id bigint, product_sk bigint, mrp decimal(12,2), selling_price decimal(12,2), "
                       "effective_from date, effective_to date",
}
FINANCE_SCHEMA = "month string, closed_on date, revenue_inr decimal(18,2), signed_off_by string"
OPEN_END = "9999-12-31"


def read_csv_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return (
        spark.read.schema(schema).option("header", "true").option("enforceSchema", "false")
        .option("escape", '"').option("mode", "FAILFAST").csv(path)
    )


def read_finance(spark: SparkSession, path: str) -> DataFrame:
    return read_csv_table(spark, path, FINANCE_SCHEMA)


def load_masters(spark: SparkSession, source: str, dest: str) -> dict[str, DataFrame]:
    """Replace the four master tables below ``dest`` from ``<source>/<table>.csv``; open ends get the far date."""
    loaded = {}
    for name, schema in SCHEMAS.items():
        df = read_csv_table(spark, f"{source}/{name}.csv", schema)
        for end in ("valid_to", "effective_to"):
            if end in df.columns:
                df = df.withColumn(end, F.coalesce(end, F.lit(OPEN_END).cast("date")))
        df.write.mode("overwrite").parquet(f"{dest}/{name}")
        loaded[name] = spark.read.schema(df.schema).parquet(f"{dest}/{name}")
    return loaded


def jdbc_options(url: str, table: str, key: str | None = None, bounds: tuple[int, int] | None = None,
                 partitions: int = 1, **more: str) -> dict[str, str]:
    """Options of a JDBC scan; with a numeric ``key`` and its bounds the scan is split into ranges."""
    options = {"url": url, "dbtable": table, "fetchsize": "10000", "pushDownPredicate": "true", **more}
    if key and bounds and partitions > 1:
        options |= {
            "partitionColumn": key, "lowerBound": str(bounds[0]), "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """Master table straight from the operational database; filters and columns are pushed to it.

    Spark joins it to the lake tables in one query, so neither side is copied first.
    """
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()
