"""Records of CSV files with line breaks inside fields, read by as many tasks as there are splits.

Whether a line break ends a record depends on all quotes before it in the file. Each split
numbers its lines twice, as if it began outside and as if it began inside a field; the
parity of quotes per split, summed over the splits before, then says which numbering holds.
Lines before a split's first record go to the last record that began earlier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspan.operators.lookup import fits_broadcast
from panelspan.sinks.scratch import staged

QUOTE = '"'


def split_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of a CSV file, or of a folder of them: ``file``, ``split``, ``place``, ``record``.

    ``split`` and ``place`` give the order of a file's records; empty lines are none. Lines
    end with a line feed, or a carriage return and a line feed. Quotes must be balanced: a
    quote within a field is doubled, and fields that are not quoted have none.

    Lines are written once, as the splits of a file need not be the same in a second scan.
    """
    inside = "(PARTITION BY file, split ORDER BY line ROWS UNBOUNDED PRECEDING)"
    lines = staged(
        spark.read.option("lineSep", "\n")
        .text(str(path))
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("line"),
            (F.length("value") - F.length(F.replace("value", F.lit(QUOTE)))).alias("quotes"),
            "value",
        )
        .withColumn("parity", F.expr(f"(sum(quotes) OVER {inside} - quotes) % 2"))
        .withColumns(
            {
                "outside": F.expr(f"sum(1 - parity) OVER {inside}"),
                "inside": F.expr(f"sum(parity) OVER {inside}"),
            }
        )
    )
    before = "(PARTITION BY file ORDER BY split ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    splits = (
        lines.groupBy("file", "split")
        .agg(
            F.sum("quotes").alias("quotes"),
            F.max("outside").alias("outside"),
            F.max("inside").alias("inside"),
        )
        .withColumn("odd", F.expr(f"coalesce(sum(quotes) OVER {before}, 0) % 2 = 1"))
        .withColumn("begun", F.when(F.col("odd"), F.col("inside")).otherwise(F.col("outside")))
        .withColumn(
            "open",
            F.expr(f"last(IF(begun > 0, struct(split, begun), null), true) OVER {before}"),
        )
        .select("file", "split", "odd", "open")
    )
    # One row for each split of a file.
    if fits_broadcast(splits):
        splits = F.broadcast(splits)
    number = F.when(F.col("odd"), F.col("inside")).otherwise(F.col("outside"))
    own = F.struct(F.col("split").alias("split"), number.alias("begun"))
    owner = F.when(number > 0, own).otherwise(F.col("open"))
    parts = lines.join(splits, ["file", "split"]).select(
        "file",
        owner["split"].alias("of"),
        owner["begun"].alias("place"),
        F.struct("split", "line", "value").alias("part"),
    )
    whole = parts.groupBy("file", "of", "place").agg(F.sort_array(F.collect_list("part")).alias("p"))
    text = F.array_join(F.transform("p", lambda x: x["value"]), "\n")
    records = whole.select(
        "file", F.col("of").alias("split"), "place", F.regexp_replace(text, r"\r\z", "").alias("record")
    )
    return records.filter("record <> ''")
