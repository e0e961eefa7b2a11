"""Joins to tables whose rows are valid over a closed date interval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_valid(
    facts: DataFrame, dim: DataFrame, key: str, date: str | Column, lo: str, hi: str, how: str = "inner"
) -> DataFrame:
    """Join ``facts`` to the row of ``dim`` with the same ``key`` that is valid on ``date``.

    The equality keeps this a hash or sort-merge join with the interval as residual condition;
    whether ``dim`` is broadcast is left to its measured size.
    """
    day = F.col(date) if isinstance(date, str) else date
    other = dim.withColumnRenamed(key, "_dim_key")
    joined = facts.join(
        other, (F.col(key) == F.col("_dim_key")) & day.between(F.col(lo), F.col(hi)), how
    )
    return joined if how in ("left_anti", "left_semi") else joined.drop("_dim_key")


def insert_if_absent(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` plus the rows of ``new`` whose key is not there yet; one row per new key.

    Copies of a key inside ``new`` must agree on the other columns or the smallest row wins.
    """
    rest = [c for c in new.columns if c not in keys]
    fresh = new.join(old.select(*keys), keys, "left_anti")
    if rest:
        fresh = fresh.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("row")).select(*keys, "row.*")
    else:
        fresh = fresh.dropDuplicates(keys)
    return old.unionByName(fresh.select(*old.columns))


def upsert(new: DataFrame, old: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """``new`` replaces the rows of ``old`` with the same key.

    Of several new rows of one key the last one by ``order`` stays, and by all other columns where that does not decide.
    """
    rest = [c for c in new.columns if c not in keys]
    if rest:
        last = F.max_by(F.struct(*rest), F.struct(*(order or []), *rest))
        new = new.groupBy(*keys).agg(last.alias("row")).select(*keys, "row.*")
    else:
        new = new.dropDuplicates(keys)
    kept = old.join(new.select(*keys), keys, "left_anti").select(*old.columns)
    return kept.unionByName(new.select(*old.columns))
