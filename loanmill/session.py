"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from loanmill.sources import files

# Settings a cluster job should carry; sizes are left to spark-submit.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Wide parsing projections make methods above the JVM's 8000-byte compile limit, which then run
    # interpreted; below this limit Spark falls back to smaller generated methods that do get compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Stored rows are a tenth of their size in memory, so splits are a quarter of the default for tasks that sort them.
    "spark.sql.files.maxPartitionBytes": str(32 << 20),
    # A fifth smaller than the default, and no slower to write.
    "spark.sql.parquet.compression.codec": "zstd",
    # Files of an exchange go when the job that made it ends, not when the driver happens to collect garbage: a load of many
    # jobs needs the disk of the largest, not of all. What is read again is written by `written`.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
# A split never cuts a row group, so row groups of intermediate tables are smaller than a split.
ROW_GROUP_BYTES = 16 << 20

_local_dirs: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting that holds for the body."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (`spark.checkpoint.dir`).

    A local-master session that names none gets a private temporary folder, since there the driver's
    disk is every executor's disk. A cluster session that names none is an error: a machine-local
    folder would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="loanmill-")
    return _local_dirs[app]


# Folder below the application's own that intermediate tables go to; a run may have one of its own.
_run: ContextVar[str] = ContextVar("run", default="")


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/loanmill/{spark.sparkContext.applicationId}" + (f"/{_run.get()}" if _run.get() else "")


@contextmanager
def own_scratch(spark: SparkSession, name: str):
    """Intermediate tables of the body go to a folder of their own, below that of a body around it, which is deleted behind it,
    also if it fails. Nothing that the body returns may still read them."""
    token = _run.set(f"{_run.get()}/{name}".lstrip("/"))
    try:
        yield
    finally:
        drop_scratch(spark)
        _run.reset(token)


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application, or of the run that is under way, once no frame built from
    them is needed any more."""
    files.delete(spark, _scratch_root(spark))


def written(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and return the table read back.

    Cuts lineage in a way that survives executor loss, and gives Catalyst the true size of the result,
    so small tables are broadcast and large ones are not, without hints.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def measured(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Observation]:
    """`df`, and the metrics that become known while it is written: no job of their own. Observe the rows right before
    they are written, where a task counts once even if executors are lost."""
    seen = Observation()
    return df.observe(seen, *[metric.alias(name) for name, metric in metrics.items()]), seen


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for an input with fewer splits than cores; larger inputs pass through untouched."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def side_by_side(*jobs: Callable[[], object]) -> list:
    """Run independent Spark jobs at the same time, so one's tail does not leave executors idle."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [future.result() for future in [pool.submit(copy_context().run, job) for job in jobs]]
