"""The shared folder for materialised steps."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_SCOPE: ContextVar[str | None] = ContextVar("scope", default=None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a local session without one gets a temporary folder."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="meterwatch-"))
        folder = sc.getCheckpointDir()
    return folder


@contextmanager
def run_scope(spark: SparkSession) -> Iterator[str]:
    """A folder for the stored tables of one run, which is removed when the run is over."""
    folder = f"{ensure_checkpoint_dir(spark)}/{spark.sparkContext.applicationId}/run-{uuid.uuid4().hex}"
    token = _SCOPE.set(folder)
    try:
        yield folder
    finally:
        _SCOPE.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a frame as Parquet to the shared folder and scan it from there.

    Unlike a checkpoint, readers still prune columns and push filters down. Every call has a path of its own, so that
    runs in one application do not disturb each other. Within `run_scope` the table lives as long as the run.
    """
    spark = df.sparkSession
    folder = _SCOPE.get() or f"{ensure_checkpoint_dir(spark)}/{spark.sparkContext.applicationId}"
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
