"""Session settings and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the jobs count on. Hot join keys are split by AQE even where the split costs
# one more exchange; broadcasts are left to size statistics, never hinted.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Texts and their digests come in short Arrow batches, so a worker's memory does not follow the size of its task.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    # Small files of CPU-heavy texts are cut into splits for all cores at the scan.
    "spark.sql.files.openCostInBytes": "1m",
}

# For jobs that sort the lines they scan: a task of small splits does so in memory, whatever the size of the tables.
SMALL_SPLITS = {"spark.sql.files.maxPartitionBytes": "16m"}

# Whether the shuffle files of a query go when it has ended; if not, they stay until the driver happens to collect its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_written: dict[tuple[str, str, str], str] = {}


def build(app: str = "tillweave", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession, more: dict[str, str] | None = None) -> SparkSession:
    """Apply the runtime settings, and ``more`` of them, to a session made elsewhere."""
    for key, value in {**RUNTIME_CONF, **(more or {})}.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only in local mode."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    made = tempfile.mkdtemp(prefix="tillweave-")
    sc.setCheckpointDir(made)
    return sc.getCheckpointDir()


@contextmanager
def freeing(spark: SparkSession) -> Iterator[None]:
    """Every write inside the block deletes its shuffle files at its end. It has a plan of its own, so nothing reads them again."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def write_parquet(df: DataFrame, path: str) -> None:
    with freeing(df.sparkSession):
        df.write.parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a stored table or folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def write_through(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage, keeps statistics."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"
    write_parquet(df, path)
    return spark.read.schema(df.schema).parquet(path)


def stage(spark: SparkSession, source: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """Named stage table of a job over ``source``, written once per application and then only read."""
    key = (spark.sparkContext.applicationId, source, name)
    if key not in _written:
        df = make()
        path = f"{shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"
        write_parquet(df, path)
        _written[key] = path
    return spark.read.parquet(_written[key])


def forget_stages() -> None:
    """Make the next use of every stage build it again (new input, or an honest timing)."""
    _written.clear()
