"""Small DataFrame helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillweave import session

# Rows in one Arrow batch. Texts are a few kB on average and may be very long, so batches are kept short.
ARROW_ROWS = "1000"


def ready(spark: SparkSession) -> SparkSession:
    """Runtime settings the operators count on: adaptive plans and short Arrow batches."""
    session.tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


_recording: list[list[str]] = []


def store(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{session.shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"
    session.write_parquet(df, path)
    for paths in _recording:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def recording(paths: list[str]):
    """Note the tables stored inside the block in ``paths``."""
    _recording.append(paths)
    try:
        yield
    finally:
        _recording.remove(paths)


def delete(spark: SparkSession, paths: list[str]) -> None:
    """Delete stored tables. What was derived from them must have been written."""
    while paths:
        session.delete(spark, paths.pop())


def remainder(key: str, modulus: int) -> Column:
    """crc32 of the key written as text, modulo ``modulus``; -1 for a null key."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % modulus, F.lit(-1))


def unit_hash(key: Column, seed: int = 0) -> Column:
    """A number in [0, 1) that only depends on the key: the first 13 hex digits of an MD5 digest."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


@contextmanager
def batch_rows(spark: SparkSession, rows: str):
    """Arrow batches of another length for the tables written inside the block."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
