"""Constraint checks on master tables, reported as rows (check, violations)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations")


def not_unique(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return _count(df.groupBy(*keys).count().where("count > 1"), name)


def null_in(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    missing = F.col(cols[0]).isNull()
    for c in cols[1:]:
        missing = missing | F.col(c).isNull()
    return _count(df.where(missing), name)


def orphans(child: DataFrame, parent: DataFrame, key: str, name: str) -> DataFrame:
    return _count(child.select(key).join(parent.select(key), key, "left_anti"), name)


def interval_overlaps(df: DataFrame, key: str, lo: str, hi: str, name: str) -> DataFrame:
    return _count(_with_previous(df, key, lo, hi).where(F.col(lo) <= F.col("previous_hi")), name)


def interval_gaps(df: DataFrame, key: str, lo: str, hi: str, name: str) -> DataFrame:
    return _count(_with_previous(df, key, lo, hi).where(F.col(lo) > F.date_add("previous_hi", 1)), name)


def _with_previous(df: DataFrame, key: str, lo: str, hi: str) -> DataFrame:
    by_key = Window.partitionBy(key).orderBy(lo, hi)
    return df.select(key, lo, hi, F.lag(hi).over(by_key).alias("previous_hi"))


def interval_quality(products: DataFrame, revisions: DataFrame, categories: DataFrame) -> DataFrame:
    checks = [
        not_unique(products, ["product_sk"], "product_sk unique"),
        not_unique(revisions, ["revision_id"], "revision_id unique"),
        not_unique(categories, ["category_id"], "category_id unique"),
        null_in(products, ["product_code", "category_id", "valid_from", "valid_to"], "product columns set"),
        null_in(revisions, ["product_sk", "selling_price", "effective_from", "effective_to"], "revision columns set"),
        orphans(products, categories, "category_id", "product category known"),
        orphans(revisions, products, "product_sk", "revision product known"),
        interval_overlaps(products, "product_code", "valid_from", "valid_to", "validity overlap"),
        interval_gaps(products, "product_code", "valid_from", "valid_to", "validity gap"),
        interval_overlaps(revisions, "product_sk", "effective_from", "effective_to", "price overlap"),
        interval_gaps(revisions, "product_sk", "effective_from", "effective_to", "price gap"),
    ]
    result = checks[0]
    for check in checks[1:]:
        result = result.unionByName(check)
    return result
