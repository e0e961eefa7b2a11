"""Sales lines: re-send handling, duplicate evidence, checksums, void bills."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillweave.functions.digest import digest_words, row_text
from tillweave.functions.money import VOID

LINE_KEY = ("bill_no", "line_no")
LINE_COLUMNS = (
    "store_id", "business_date", "bill_no", "line_no", "product_code",
    "qty", "unit_price", "line_type", "ts", "source_file",
)
CONTENT_COLUMNS = ("store_id", "business_date", "product_code", "qty", "unit_price", "line_type", "ts")


def dedup_lines(
    lines: DataFrame, keys: Sequence[str] = LINE_KEY, order: Sequence[str] = ("source_file",)
) -> DataFrame:
    """One row per key: the first by ``order``, then by every other column.

    ``row_number() = 1`` becomes a group limit that also runs before the exchange, so a key with
    very many copies leaves one row per map task.
    """
    ties = [c for c in lines.columns if c not in (*keys, *order)]
    first = Window.partitionBy(*keys).orderBy(*order, *ties)
    return lines.withColumn("rn", F.row_number().over(first)).where("rn = 1").drop("rn")


def duplicate_keys(lines: DataFrame, keys: Sequence[str] = LINE_KEY) -> DataFrame:
    repeated = lines.groupBy(*keys).count().where("count > 1")
    return repeated.agg(F.count("*").alias("duplicate_keys"))


def conflicting_keys(
    lines: DataFrame, keys: Sequence[str] = LINE_KEY, cols: Sequence[str] = CONTENT_COLUMNS
) -> DataFrame:
    """Keys whose copies disagree. More than one distinct digest means min and max differ."""
    high, low = digest_words(cols)
    spread = (
        lines.select(*keys, high.alias("high"), low.alias("low"))
        .groupBy(*keys)
        .agg(
            F.min("high").alias("high_min"), F.max("high").alias("high_max"),
            F.min("low").alias("low_min"), F.max("low").alias("low_max"),
        )
        .where("high_min <> high_max or low_min <> low_max")
    )
    return spread.agg(F.count("*").alias("conflicting_keys"))


def table_checksum(df: DataFrame, cols: Sequence[str] = LINE_COLUMNS) -> DataFrame:
    """Row count and a checksum that depends on the rows and not on their order.

    The row digests are added up, so the work is one partial aggregate per task and repeated rows
    count as often as they occur.
    """
    high, low = digest_words(cols)
    total = df.select(high.alias("high"), low.alias("low")).agg(
        F.count("*").alias("row_count"),
        F.coalesce(F.sum(F.col("high").cast("decimal(28,0)")), F.lit(0)).alias("high"),
        F.coalesce(F.sum(F.col("low").cast("decimal(28,0)")), F.lit(0)).alias("low"),
    )
    return total.select(
        "row_count",
        F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in ("row_count", "high", "low")])).alias("checksum"),
    )


def _digest_of(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """(keys, digest, rows): the digest of a group's digests in order."""
    listed = F.array_sort(F.collect_list(F.struct(*order, "digest")))
    return rows.groupBy(*keys).agg(
        F.md5(F.array_join(F.transform(listed, lambda r: r["digest"]), "")).alias("digest"), F.sum("rows").alias("rows"))


def ordered_checksum(
    df: DataFrame, cols: Sequence[str] = LINE_COLUMNS, store: str = "store_id", day: str = "business_date",
    order: Sequence[str] = LINE_KEY,
) -> DataFrame:
    """Row count and a checksum of the rows in the order of (store, day, ``order``).

    A tree of digests: rows in order give the digest of a store's day, days in order that of the store, stores in order that of
    the table. The largest group is one store's day, or the days of one store; equal rows are ordered by their digests.
    """
    rows = df.select(store, day, *order, F.md5(row_text(cols)).alias("digest"), F.lit(1).cast("bigint").alias("rows"))
    days = _digest_of(rows, [store, day], order)
    stores = _digest_of(days, [store], [day])
    table = stores.agg(F.array_sort(F.collect_list(F.struct(store, "digest"))).alias("listed"), F.sum("rows").alias("rows"))
    return table.select(
        F.coalesce("rows", F.lit(0)).alias("row_count"),
        F.md5(F.array_join(F.transform("listed", lambda r: r["digest"]), "")).alias("checksum"))


def prove_rerun(job: Callable[[], DataFrame], times: int = 3) -> DataFrame:
    """Run a loading job ``times`` times; one row (run, row_count, checksum) for each."""
    log = []
    for run in range(1, times + 1):
        table = job()
        row = table_checksum(table).first()
        log.append((run, row["row_count"], row["checksum"]))
    return table.sparkSession.createDataFrame(log, "run int, row_count bigint, checksum string")


def line_type_counts(lines: DataFrame) -> DataFrame:
    return lines.groupBy("line_type").agg(F.count("*").alias("rows"))


def void_bill_numbers(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("line_type") == VOID).select("bill_no").distinct()


def void_bills(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("line_type") == VOID).agg(F.countDistinct("bill_no").alias("void_bills"))


def void_profile(lines: DataFrame) -> DataFrame:
    """Void bills, and how many of them also hold a SALE line.

    One pass per bill instead of a join of the table with itself.
    """
    kinds = lines.groupBy("bill_no").agg(
        F.max((F.col("line_type") == VOID).cast("int")).alias("has_void"),
        F.max((F.col("line_type") == "SALE").cast("int")).alias("has_sale"),
    )
    return kinds.where("has_void = 1").agg(
        F.count("*").alias("void_bills"),
        F.coalesce(F.sum("has_sale"), F.lit(0)).cast("bigint").alias("void_bills_with_sale"),
    )


def without_void_bills(lines: DataFrame) -> DataFrame:
    """Drop every line of a bill that has a VOID row."""
    return lines.join(void_bill_numbers(lines), "bill_no", "left_anti").select(*lines.columns)
