"""CSV source of a series dimension."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspan.errors import MissingColumns
from panelspan.functions import quoted
from panelspan.operators.lookup import fits_broadcast
from panelspan.sinks.files import Files
from panelspan.sinks.scratch import staged
from panelspan.sources.records import split_records
from panelspan.spec import DIMENSION, DimensionSpec, check_columns

# How quotes are written in the CSV files this package reads and writes.
CSV_QUOTING = {"quote": '"', "escape": '"'}


MOST_HEADERS = 100

#: A file beyond this is read by several tasks, also where fields hold line breaks.
SPLIT_BYTES = 128 * 1024 * 1024


def load_dimension(
    spark: SparkSession,
    path: str,
    names: DimensionSpec = DIMENSION,
    columns: Sequence[str] | None = None,
    multi_line: bool = True,
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """Read a CSV file, or a folder of them, with a header; every column is text.

    Fields may hold quotes, commas and line breaks. Up to ``split_bytes`` in all, each file
    is read by one task; beyond, files are read in splits, which takes two passes more and
    balanced quotes (see ``split_records``) and gives the same rows. Without line
    breaks in fields ``multi_line=False`` needs neither. With ``columns`` the header
    need not be looked up first; a file whose header differs is then an error, and files
    that are read in splits must agree on it in any case.
    """
    if multi_line and Files(spark).total_bytes(path) > split_bytes:
        dimension = _from_splits(spark, path, columns)
    else:
        reader = spark.read.options(header=True, multiLine=multi_line, **CSV_QUOTING)
        if columns is not None:
            reader = reader.schema(_texts(columns)).option("enforceSchema", False)
        dimension = reader.csv(str(path))
    check_columns(dimension, [names.key, names.topic])
    return dimension


def _texts(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def _from_splits(spark: SparkSession, path: str, columns: Sequence[str] | None) -> DataFrame:
    records = staged(split_records(spark, path))
    place = F.struct("split", "place")
    headers = records.groupBy("file").agg(
        F.min(place).alias("first"), F.min_by("record", place).alias("record")
    )
    # Files of one dataset have one header; more than a few spellings of it are an error.
    spelled = [r[0] for r in headers.select("record").distinct().limit(MOST_HEADERS).collect()]
    found = {tuple(next(csv.reader([text.removeprefix("\ufeff")]))) for text in spelled}
    if len(found) > 1 or (columns is not None and found - {tuple(columns)}):
        raise MissingColumns(f"Headers of {path} differ: {sorted(found)}")
    header = columns if columns is not None else next(iter(found), ())
    firsts = headers.select("file", "first.split", "first.place")
    body = records.join(
        F.broadcast(firsts) if fits_broadcast(firsts) else firsts,
        ["file", "split", "place"],
        "left_anti",
    )
    options = {"multiLine": "true", **CSV_QUOTING}
    schema = ", ".join(f"{quoted(name)} STRING" for name in header)
    row = F.from_csv("record", schema, options).alias("row")
    return body.select(row).select("row.*") if header else spark.createDataFrame([], _texts(()))
