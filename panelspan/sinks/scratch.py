"""Folders for intermediate tables, removed when the program ends."""

from __future__ import annotations

import atexit
import tempfile
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from panelspan.sinks.files import Files, shared_folder


def scratch_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, which every executor can reach.

    Only a session on this machine may go without that setting. The folder goes
    when the program ends, as results are computed from it until then.
    """
    folder = shared_folder(spark)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("Set spark.checkpoint.dir to a folder that all executors share.")
        folder = tempfile.mkdtemp(prefix="panelspan-")
    atexit.register(_remove, spark, folder)
    return folder


def staged(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a table into a scratch folder and read it back: it is computed once,
    and a lost executor costs none of it."""
    folder = scratch_folder(df.sparkSession)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _remove(spark: SparkSession, folder: str) -> None:
    try:
        Files(spark).delete(folder)
    except Exception:  # the JVM may have gone before us
        pass
