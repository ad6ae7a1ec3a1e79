"""The names of a series shape in blocks, kept within its dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelspan.sinks.files import Files

#: Readers of the dataset pass over folders that begin so.
NAMES_FOLDER = "_names"


def load_series_names(spark: SparkSession, path: str) -> DataFrame | None:
    """The series of a published shape in blocks, with the block and column of each; None
    where the shape names its columns itself. ``series_cells`` takes both."""
    folder = f"{path}/{NAMES_FOLDER}"
    return spark.read.parquet(folder) if Files(spark).exists(folder) else None
