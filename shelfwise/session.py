"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

from shelfwise.sources.folders import remove_folder

CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}
_RUN: ContextVar[str | None] = ContextVar("run", default=None)


def build_session(app: str, master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: there the driver
    and the executors are one machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    made = tempfile.mkdtemp(prefix="shelfwise-")
    sc.setCheckpointDir(made)
    return made


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make sure long lineages (ALS iterations) are cut on reliable storage."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder of the run, or the shared folder outside of one."""
    return f"{_RUN.get() or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for all that a job writes on its way, removed when the job is over or has failed.

    Nothing lazy that reads it may leave the block. What a killed driver left is a folder
    ``run-…`` below the shared one, and may be removed once the driver is gone.
    """
    path = scratch_path(spark, "run")
    token = _RUN.set(path)
    try:
        yield path
    finally:
        _RUN.reset(token)
        remove_folder(spark, path)


def collect_garbage(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files and cached blocks of what the driver has dropped; it waits for a collection, else for up to half an hour."""
    gc.collect()
    spark._jvm.System.gc()
