"""The panel job as a program for spark-submit.

    spark-submit panel_job.py RAW_PARQUET DIMENSION_CSV OUTPUT_FOLDER [--export FOLDER]
        [--export-files N] [--single-dimension-file] [--max-headers N]

Publishes ``long.parquet``, ``series_wide.parquet``, ``period_wide.parquet`` and
``dimension.csv`` under the output folder; with ``--export`` also a compacted
Parquet and CSV copy of each of the three datasets, all of which appear together.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

import panelspan as ps

DATASETS = ("long", "series_wide", "period_wide")


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(description="Check, clean, enrich, reshape and publish.")
    parser.add_argument("raw", help="Parquet dataset with the raw panel")
    parser.add_argument("dimension", help="CSV file or folder with the series dimension")
    parser.add_argument("output", help="folder for the published outputs")
    parser.add_argument("--export", help="folder for compacted copies")
    parser.add_argument("--export-files", type=int, help="files of each copy")
    parser.add_argument("--single-dimension-file", action="store_true")
    parser.add_argument("--max-headers", type=int, help="most columns of a wide shape")
    options = parser.parse_args(arguments)

    spark = spark or SparkSession.builder.appName("panelspan").getOrCreate()
    outputs = ps.PanelOutputs(
        *[f"{options.output}/{name}.parquet" for name in DATASETS],
        dimension=f"{options.output}/dimension.csv",
    )
    ps.publish_panel(
        spark,
        spark.read.parquet(options.raw),
        ps.load_dimension(spark, options.dimension),
        outputs,
        single_dimension_file=options.single_dimension_file,
        max_headers=options.max_headers,
    )
    if options.export:
        with ps.Publication(spark) as publication:
            for name in DATASETS:
                source = f"{options.output}/{name}.parquet"
                for format in ("parquet", "csv"):
                    target = f"{options.export}/{name}.{format}"
                    ps.stage_export(
                        publication, spark, source, target, format, options.export_files
                    )


if __name__ == "__main__":
    main()
