"""Result sinks, and Parquet tables whose versions are lists of folders.

A table is a folder with data folders, each written once, and numbered manifests that list the data folders of a version. A new
version is first written whole and then appears with its manifest, by one rename. A reader takes the newest manifest, or the one
it names, and keeps seeing that version until it is expired.
"""

from __future__ import annotations

import io
import json
import uuid
from contextlib import redirect_stdout

from pyspark.sql import DataFrame, SparkSession

from tillweave.operators.joins import insert_if_absent, upsert

MANIFESTS = "_manifests"


class VersionConflict(RuntimeError):
    """Another job has made the version that was about to be made."""


def _path(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that can be read, oldest first."""
    place, files = _path(spark, f"{path}/{MANIFESTS}")
    if not files.exists(place):
        return []
    names = [status.getPath().getName() for status in files.listStatus(place)]
    return sorted(int(name) for name in names if name.isdigit())


def folders(spark: SparkSession, path: str, version: int) -> list[str]:
    place, files = _path(spark, f"{path}/{MANIFESTS}/{version:012d}")
    stream = files.open(place)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of a table, the newest by default."""
    known = versions(spark, path)
    if not known:
        raise FileNotFoundError(f"no version of {path}")
    parts = folders(spark, path, known[-1] if version is None else version)
    return spark.read.parquet(*[f"{path}/{part}" for part in parts])


def _commit(spark: SparkSession, path: str, version: int, parts: list[str]) -> None:
    target, files = _path(spark, f"{path}/{MANIFESTS}/{version:012d}")
    draft, _ = _path(spark, f"{path}/{MANIFESTS}/draft-{uuid.uuid4().hex}")
    out = files.create(draft, False)
    out.write(bytearray(json.dumps(parts).encode()))
    out.close()
    if files.exists(target) or not files.rename(draft, target):
        files.delete(draft, False)
        raise VersionConflict(f"version {version} of {path} exists")


def _write(df: DataFrame, path: str) -> str:
    part = f"data-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{part}")
    return part


def replace(df: DataFrame, path: str) -> int:
    """Make ``df`` the next version of the table and return its number. Written once, also if ``df`` reads the table itself."""
    spark = df.sparkSession
    version = (versions(spark, path) or [0])[-1] + 1
    _commit(spark, path, version, [_write(df, path)])
    return version


def append(df: DataFrame, path: str) -> int:
    """The next version: the newest one and the rows of ``df``, which are all that is written."""
    spark = df.sparkSession
    last = versions(spark, path)[-1]
    part = _write(df, path)
    if spark.read.schema(df.schema).parquet(f"{path}/{part}").isEmpty():
        _path(spark, path)[1].delete(_path(spark, f"{path}/{part}")[0], True)
        return last
    _commit(spark, path, last + 1, [*folders(spark, path, last), part])
    return last + 1


def expire(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Drop all versions but the newest ``keep``, and data folders that no version left lists."""
    known = versions(spark, path)
    held = {part for version in known[-keep:] for part in folders(spark, path, version)}
    listed = {part for version in known for part in folders(spark, path, version)}
    place, files = _path(spark, path)
    for version in known[:-keep]:
        files.delete(_path(spark, f"{path}/{MANIFESTS}/{version:012d}")[0], False)
    for part in listed - held:
        files.delete(_path(spark, f"{path}/{part}")[0], True)


def append_absent(new: DataFrame, path: str, keys: list[str]) -> int:
    """Append the rows whose key the table does not hold yet; running it again appends nothing."""
    stored = read_table(new.sparkSession, path)
    fresh = insert_if_absent(new, stored.where("false").select(*stored.columns), keys)
    return append(fresh.join(stored.select(*keys), keys, "left_anti").select(*stored.columns), path)


def upsert_table(new: DataFrame, path: str, keys: list[str]) -> int:
    """Rows of ``new`` replace stored rows with the same key."""
    return replace(upsert(new, read_table(new.sparkSession, path), keys), path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header, one file per task."""
    df.write.mode("overwrite").option("header", "true").csv(path)


def plan_text(df: DataFrame) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def plan_evidence(df: DataFrame) -> list[str]:
    """The lines of the physical plan that say where work is done: scans, pushed filters, joins, aggregates."""
    marks = ("Scan ", "PushedFilters", "PartitionFilters", "ReadSchema", "Join", "Aggregate", "Exchange")
    return [line.strip() for line in plan_text(df).splitlines() if any(m in line for m in marks)]
