"""Rewrite a published dataset into few large files."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspan.functions import column
from panelspan.sinks.files import Files
from panelspan.sinks.names import NAMES_FOLDER, load_series_names
from panelspan.sinks.publication import Publication

# Bytes of the source that go into one file; the same rows take several times more as CSV.
SOURCE_BYTES_PER_FILE = {"parquet": 1024 * 1024 * 1024, "csv": 256 * 1024 * 1024}
# Bytes of rows, at their full length, that move to the task of one file. Parquet may hold the
# same rows in a tenth of that, so the source's size alone does not bound the task.
ROW_BYTES_PER_FILE = 512 * 1024 * 1024


def export_dataset(
    spark: SparkSession,
    source: str,
    target: str,
    format: str = "parquet",
    files: int | None = None,
    source_bytes_per_file: int | None = None,
) -> int:
    """Compact a Parquet dataset into ZSTD Parquet or CSV; return the number of files aimed at.

    The target is a folder of files. By default it is sharded: one file for each
    ``source_bytes_per_file`` of the source (1 GiB for Parquet, 256 MiB for CSV), and more
    where a file would get over 512 MiB of rows, measured at their full length in a scan of the texts.
    ``files`` asks for an exact number, however large they become; one file is written by
    one task. The source is read by as many tasks as it has splits, and rows are dealt out in
    turn, so that files are of about equal size whatever the parts of the source were. The
    names of a series shape in blocks go with it.
    """
    with Publication(spark) as publication:
        return stage_export(
            publication, spark, source, target, format, files, source_bytes_per_file
        )


def stage_export(
    publication: Publication,
    spark: SparkSession,
    source: str,
    target: str,
    format: str = "parquet",
    files: int | None = None,
    source_bytes_per_file: int | None = None,
) -> int:
    """Stage an export as one output among others of a publication."""
    if format not in SOURCE_BYTES_PER_FILE:
        raise ValueError(f"Unknown format {format!r}: use parquet or csv")
    if files is not None and files < 1:
        raise ValueError("files must be at least 1")
    rows = spark.read.parquet(str(source))
    if files is None:
        share = source_bytes_per_file or SOURCE_BYTES_PER_FILE[format]
        files = max(1, math.ceil(Files(spark).total_bytes(source) / share))
        if source_bytes_per_file is None:
            files = max(files, math.ceil(_row_bytes(rows) / ROW_BYTES_PER_FILE))
    rows = rows.repartition(files)
    if format == "parquet":
        staged = publication.stage_parquet(rows, target, compression="zstd")
    else:
        staged = publication.stage_csv(rows, target)
    names = load_series_names(spark, source)
    if names is not None:
        publication.stage_inside(names, f"{staged}/{NAMES_FOLDER}", format)
    return files


def _row_bytes(rows: DataFrame) -> int:
    """Bytes of all rows at their full length. Only columns without a fixed length are read."""
    fixed = (T.NumericType, T.BooleanType, T.DatetimeType, T.NullType)
    texts = [field.name for field in rows.schema if not isinstance(field.dataType, fixed)]
    lengths = [F.sum(F.octet_length(column(name).cast("string"))) for name in texts]
    n, *sums = rows.agg(F.count(F.lit(1)), *lengths).first()
    return 8 * len(rows.columns) * n + sum(found or 0 for found in sums)
