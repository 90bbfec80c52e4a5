"""Cutting lineage through reliable storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder the session names in `spark.checkpoint.dir`, shared by all executors.

    Only a session whose executor is the driver itself, without that setting, gets a folder of
    its own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        in_driver = context.master == "local" or context.master.startswith("local[")
        if named is None and not in_driver:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="logbraid-"))
    return context.getCheckpointDir()


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A path no one has used yet, under the checkpoint folder or the run's folder there."""
    return f"{_run_folder.get() or checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """One folder for all that is materialized within; it is removed in the end.

    Frames built within must have been written by then.
    """
    path = f"{checkpoint_dir(spark)}/run-{uuid.uuid4().hex}"
    token = _run_folder.set(path)
    try:
        yield path
    finally:
        _run_folder.reset(token)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Compute `df` once, into a table under the checkpoint folder, and read it from there.

    A lost executor then costs no recomputation. Unlike a checkpointed frame the table can be
    read by column and by partition, and Spark knows its size.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
