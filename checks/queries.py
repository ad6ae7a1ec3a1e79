"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import panelspan as ps
from checks import fixtures as fx
from checks.scratch import scratch_folder, staged
from panelspan.functions import quoted

Query = Callable[[SparkSession, str], DataFrame]


def canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ps.canonicalize(fx.raw_panel(spark, sf_dir), fx.ORDERS)


def selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    observed = ps.observed_only(canonical(spark, sf_dir), fx.ORDERS)
    return ps.exclude_entities(observed, fx.ORDERS, fx.EXCLUDED)


def long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ps.long_panel(
        fx.raw_panel(spark, sf_dir),
        fx.priority_topics(spark, sf_dir),
        fx.ORDERS,
        excluded=fx.EXCLUDED,
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ps.canonicalize(fx.sales_panel(spark, sf_dir), fx.ORDERS)


def sales_long(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return ps.enrich(sales(spark, sf_dir), fx.catalog(spark, sf_dir), fx.ORDERS, **options)


# Sources


def panel_canonical_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.raw_panel(spark, sf_dir)
    as_bytes = raw.select([F.col(name).cast("binary").alias(name) for name in raw.columns])
    return ps.canonicalize(as_bytes, fx.ORDERS)


def panel_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical(spark, sf_dir)


def panel_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_folder(spark)}/raw.parquet"
    fx.raw_panel(spark, sf_dir).write.parquet(path)
    return ps.load_panel(spark, path, fx.ORDERS)


def panel_scan_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = ps.load_panel(spark, f"{sf_dir}/lineitem.parquet", fx.LINES)
    return ps.observed_only(panel, fx.LINES)


def dimension_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_folder(spark)}/catalog.csv"
    ps.publish(fx.catalog(spark, sf_dir), path, format="csv")
    return ps.load_dimension(spark, path)


def dimension_scan_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_folder(spark)}/catalog.csv"
    ps.publish(fx.catalog(spark, sf_dir), path, "csv", single_file=True, order_by=["id"])
    return ps.load_dimension(spark, path, split_bytes=0)


# Checks


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ps.quality_report(fx.dirty_panel(spark, sf_dir), fx.ORDERS)


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = ps.rejected_rows(fx.dirty_panel(spark, sf_dir), fx.ORDERS)
    return rejected.withColumn("reasons", F.array_join("reasons", ","))


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = [fx.ORDERS.series_code, fx.ORDERS.period]
    return ps.duplicate_keys(fx.raw_panel(spark, sf_dir), keys)


def duplicate_cells_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    repeated = ps.canonicalize(fx.duplicated_panel(spark, sf_dir), fx.ORDERS)
    return ps.duplicate_series_cells(repeated, fx.ORDERS)


def duplicate_cells_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    repeated = ps.canonicalize(fx.duplicated_panel(spark, sf_dir), fx.ORDERS)
    return ps.duplicate_period_cells(repeated, fx.ORDERS)


# Filters


def filter_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ps.observed_only(canonical(spark, sf_dir), fx.ORDERS)


def filter_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ps.exclude_entities(canonical(spark, sf_dir), fx.ORDERS, fx.EXCLUDED)


def filter_entities_anti(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    codes = fx.overdrawn_codes(spark, sf_dir)
    panel = canonical(spark, sf_dir)
    return ps.exclude_listed_entities(panel, codes, "code", fx.ORDERS, **options)


def filter_entities_anti_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_entities_anti(spark, sf_dir, broadcast_bytes=0)


# Dimension


def dimension_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ps.clean_dimension(fx.catalog(spark, sf_dir), fx.ORDERS)


def dimension_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ps.dimension_conflicts(fx.sales_topics(spark, sf_dir), fx.ORDERS)


def enrich_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ps.enrich(canonical(spark, sf_dir), fx.priority_topics(spark, sf_dir), fx.ORDERS)


def enrich_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_long(spark, sf_dir)


def enrich_catalog_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_long(spark, sf_dir, broadcast_bytes=0)


def enrich_crowded_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = ps.canonicalize(fx.crowded_panel(spark, sf_dir), fx.ORDERS)
    return ps.enrich(panel, fx.catalog(spark, sf_dir), fx.ORDERS, broadcast_bytes=0)


def unmapped_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ps.unmapped_series(sales(spark, sf_dir), fx.catalog(spark, sf_dir), fx.ORDERS)


def unmapped_priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics = fx.priority_topics(spark, sf_dir)
    return ps.unmapped_series(selected(spark, sf_dir), topics, fx.ORDERS)


def used_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    final = sales_long(spark, sf_dir)
    return ps.used_dimension(fx.catalog(spark, sf_dir), final, fx.ORDERS)


def used_dimension_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    final = sales_long(spark, sf_dir)
    catalog = fx.catalog(spark, sf_dir)
    return ps.used_dimension(catalog, final, fx.ORDERS, broadcast_bytes=0)


# Reshape


def distinct_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = fx.ORDERS.series_name
    headers = ps.pivot_headers(canonical(spark, sf_dir), name)
    return spark.createDataFrame([(header,) for header in headers], f"{name} string")


def series_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ps.pivot_series(long(spark, sf_dir), fx.ORDERS)


def series_wide_no_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ps.pivot_series(selected(spark, sf_dir), fx.ORDERS)


def series_wide_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = ps.canonicalize(fx.daily_events(spark, sf_dir), fx.DAYS)
    return ps.pivot_series(events, fx.DAYS)


def series_wide_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = staged(sales_long(spark, sf_dir))
    headers = ps.series_headers(panel, fx.ORDERS)
    return _cells(ps.pivot_series(panel, fx.ORDERS, headers=headers or None), headers)


def series_wide_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = staged(sales_long(spark, sf_dir))
    headers = ps.topic_headers(panel, fx.ORDERS)
    shapes = ps.pivot_series_by_topic(panel, fx.ORDERS, headers=headers).values()
    if headers is not None:
        # Blocks have the same columns in every topic: one join names all their cells.
        shapes = [reduce(DataFrame.union, shapes)]
    return reduce(DataFrame.union, [_cells(wide, headers) for wide in shapes])


def _cells(wide: DataFrame, headers: DataFrame | list[str] | None) -> DataFrame:
    """One row per filled cell of a shape in one table, or in blocks with a table of names."""
    if isinstance(headers, DataFrame):
        return ps.series_cells(wide, headers, fx.ORDERS)
    return _unpivoted(wide, 4, fx.ORDERS.series_name)


def _unpivoted(wide: DataFrame, keys: int, header: str) -> DataFrame:
    """A wide table whose columns depend on the scale, as one row per filled cell.

    Rows are read by position, one array for each: thousands of columns make slow plans.
    """
    named = wide.columns
    cells = F.array(*[F.col(quoted(name)) for name in named[keys:]])
    names = F.array(*[F.lit(name) for name in named[keys:]])
    return (
        wide.select(*named[:keys], F.inline(F.arrays_zip(names.alias("h"), cells.alias("v"))))
        .toDF(*named[:keys], header, "value")
        .filter("value IS NOT NULL")
    )


def period_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ps.pivot_period(long(spark, sf_dir), fx.ORDERS)


def period_wide_no_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ps.pivot_period(selected(spark, sf_dir), fx.ORDERS)


def period_wide_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ps.pivot_period(sales_long(spark, sf_dir), fx.ORDERS)


# Sinks and the job


def publish_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_folder(spark)}/long"
    ps.publish(long(spark, sf_dir), path)
    return spark.read.parquet(path)


def publish_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_folder(spark)}/catalog.csv"
    ps.publish(fx.catalog(spark, sf_dir), path, "csv", single_file=True, order_by=["id"])
    return ps.load_dimension(spark, path, columns=fx.CATALOG.published)


def _exported(spark: SparkSession, sf_dir: str, format: str) -> str:
    folder = scratch_folder(spark)
    canonical(spark, sf_dir).write.parquet(f"{folder}/parts")
    ps.export_dataset(spark, f"{folder}/parts", f"{folder}/export", format)
    return f"{folder}/export"


def export_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_exported(spark, sf_dir, "parquet"))


def export_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A null is written as nothing and an empty text as "". Spark reads both as null
    # unless the null value is set to something else.
    options = {"header": True, "quote": '"', "escape": '"', "nullValue": "\\N"}
    schema = canonical(spark, sf_dir).schema
    return spark.read.options(**options).schema(schema).csv(_exported(spark, sf_dir, "csv"))


def _job(spark: SparkSession, sf_dir: str) -> ps.PanelOutputs:
    folder = scratch_folder(spark)
    topics = fx.priority_topics(spark, sf_dir)
    unknown = F.lit(None).cast("string")
    others = [c for c in fx.CATALOG.published if c not in topics.columns]
    outputs = ps.PanelOutputs(
        long=f"{folder}/long",
        series_wide=f"{folder}/series_wide",
        period_wide=f"{folder}/period_wide",
        dimension=f"{folder}/dimension.csv",
    )
    ps.publish_panel(
        spark,
        fx.raw_panel(spark, sf_dir),
        topics.withColumns({name: unknown for name in others}),
        outputs,
        fx.ORDERS,
        excluded=fx.EXCLUDED,
    )
    return outputs


def _catalog_job(spark: SparkSession, sf_dir: str, **options) -> ps.PanelOutputs:
    """The job over the sales panel with its whole catalog, all six columns of it."""
    folder = scratch_folder(spark)
    outputs = ps.PanelOutputs(
        long=f"{folder}/long",
        series_wide=f"{folder}/series_wide",
        period_wide=f"{folder}/period_wide",
        dimension=f"{folder}/dimension.csv",
    )
    ps.publish_panel(
        spark,
        fx.sales_panel(spark, sf_dir),
        fx.catalog(spark, sf_dir),
        outputs,
        fx.ORDERS,
        excluded=(),
        **options,
    )
    return outputs


def job_catalog_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_catalog_job(spark, sf_dir).long)


def job_catalog_long_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_catalog_job(spark, sf_dir, broadcast_bytes=0).long)


def job_catalog_series_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _catalog_job(spark, sf_dir).series_wide
    return _cells(spark.read.parquet(target), ps.load_series_names(spark, target))


def job_catalog_series_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _catalog_job(spark, sf_dir, series_wide_by_topic=True).series_wide
    names = ps.load_series_names(spark, target)
    wide = spark.read.option("mergeSchema", names is None).parquet(target)
    keys = fx.ORDERS.series_shape_keys(wide)
    ordered = [*keys, *[name for name in wide.columns if name not in keys]]
    return _cells(wide.select(*map(quoted, ordered)), names)


def job_catalog_period_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_catalog_job(spark, sf_dir).period_wide)


def job_catalog_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ps.load_dimension(
        spark, _catalog_job(spark, sf_dir).dimension, columns=fx.CATALOG.published
    )


def panel_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long(spark, sf_dir)


def job_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_job(spark, sf_dir).long)


def job_series_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_job(spark, sf_dir).series_wide)


def job_period_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_job(spark, sf_dir).period_wide)


def job_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ps.load_dimension(spark, _job(spark, sf_dir).dimension).select("id", "topic")


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        panel_canonical,
        panel_canonical_binary,
        panel_scan,
        panel_scan_native,
        dimension_scan,
        dimension_scan_splits,
        quality_report,
        rejected_rows,
        duplicate_keys,
        duplicate_cells_series,
        duplicate_cells_period,
        filter_observed,
        filter_entities,
        filter_entities_anti,
        filter_entities_anti_shuffled,
        dimension_clean,
        dimension_conflicts,
        enrich_topics,
        enrich_catalog,
        enrich_catalog_shuffled,
        enrich_crowded_shuffled,
        unmapped_series,
        unmapped_priorities,
        used_dimension,
        used_dimension_shuffled,
        distinct_series,
        series_wide,
        series_wide_no_topic,
        series_wide_events,
        series_wide_catalog,
        series_wide_topics,
        period_wide,
        period_wide_no_topic,
        period_wide_catalog,
        panel_long,
        publish_roundtrip,
        publish_csv_roundtrip,
        export_compact,
        export_csv,
        job_long,
        job_series_wide,
        job_period_wide,
        job_dimension,
        job_catalog_long,
        job_catalog_long_shuffled,
        job_catalog_series_wide,
        job_catalog_series_topics,
        job_catalog_period_wide,
        job_catalog_dimension,
    )
}
