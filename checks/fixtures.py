"""Raw panels and dimensions that Spark derives from the given tables.

No row of a table is left out (only ``overdrawn_codes`` filters, as that is its feature).
Keys decide how untidy a derived row is (blank codes, padded text, missing values), so
that every rule has rows to act on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspan import DimensionSpec, PanelSpec

ORDERS = PanelSpec(
    entity_name="entity_name",
    entity_code="entity_code",
    series_name="series_name",
    series_code="series_code",
    period="period",
    value="value",
    topic="topic",
    period_pattern="^[0-9]{4}$",
)

# The lineitem table is itself a typed panel: one row per order, part and line.
LINES = PanelSpec(
    entity_name="l_orderkey",
    entity_code="l_suppkey",
    series_name="l_partkey",
    series_code="l_returnflag",
    period="l_linenumber",
    value="l_extendedprice",
    period_pattern="^[0-9]$",
)

DAYS = PanelSpec(
    entity_name="user_name",
    entity_code="user_id",
    series_name="event_type",
    series_code="event_code",
    period="day",
    value="value",
    period_pattern="^[0-9]{1,2}$",
)

CATALOG = DimensionSpec()

EXCLUDED = ("WLD", "EUU")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(value: Column) -> Column:
    return value.cast("string")


def _raw_from_orders(rows: DataFrame, customers: DataFrame) -> DataFrame:
    """Untidy all-text panel from (o_custkey, o_orderpriority, y, v) rows."""
    joined = rows.join(customers, rows["o_custkey"] == customers["c_custkey"])
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    code = (
        F.when(key % 17 == 0, "")
        .when(key % 19 == 0, None)
        .when(nation % 5 == 0, " wld ")
        .otherwise(F.concat(F.lit("C"), _text(key), F.lit(" ")))
    )
    value = (
        F.when((key % 11 == 0) & (F.col("y") == 1997), None)
        .when(key % 13 == 0, "  ")
        .otherwise(_text(F.col("v").cast("decimal(18,2)")))
    )
    digit = F.substring("o_orderpriority", 1, 1)
    return joined.select(
        F.concat(F.lit(" "), "c_name", F.lit(" ")).alias("entity_name"),
        code.alias("entity_code"),
        F.col("o_orderpriority").alias("series_name"),
        F.concat(F.lit(" P."), digit, F.lit(" ")).alias("series_code"),
        F.concat(_text(F.col("y")), F.lit(" ")).alias("period"),
        value.alias("value"),
    )


def _dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_custkey",
        "o_orderpriority",
        F.year("o_orderdate").alias("y"),
        F.col("o_totalprice").alias("v"),
    )


def raw_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer x priority x year. Orders are aggregated before they meet the customers."""
    cells = (
        _dated_orders(spark, sf_dir)
        .groupBy("o_custkey", "o_orderpriority", "y")
        .agg(F.max("v").alias("v"))
    )
    return _raw_from_orders(cells, table(spark, sf_dir, "customer"))


def duplicated_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``raw_panel`` with one row per order, so that cells repeat."""
    return _raw_from_orders(_dated_orders(spark, sf_dir), table(spark, sf_dir, "customer"))


def dirty_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``raw_panel`` with rows that break each quality rule."""
    code = F.col("entity_code")
    return raw_panel(spark, sf_dir).withColumns(
        {
            "series_name": F.when(code.like("C%23 "), " ").otherwise(F.col("series_name")),
            "period": F.when(code.like("C%29 "), "n/a")
            .when(code.like("C%37 "), "20231")
            .otherwise(F.col("period")),
            "value": F.when(code.like("C%31 "), "abc").otherwise(F.col("value")),
        }
    )


def priority_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untidy (id, topic) rows: one per order for the priorities, one per nation unused."""
    digit = F.substring("o_orderpriority", 1, 1)
    open_order = F.col("o_orderstatus") == "O"
    padded = F.concat(F.lit(" P."), digit, F.lit(" "))
    topic = (
        F.when(digit == "1", "High")
        .when((digit == "2") & open_order, " High ")
        .when(digit == "2", "High")
        .when(digit == "3", "Medium")
        .when(digit == "4", " ")
    )
    orders = table(spark, sf_dir, "orders").select(
        F.when(open_order, padded).otherwise(F.concat(F.lit("P."), digit)).alias("id"),
        topic.alias("topic"),
    )
    nations = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("N."), _text(F.col("n_nationkey"))).alias("id"),
        F.col("n_name").alias("topic"),
    )
    return orders.unionAll(nations)


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full dimension from the parts: padded ids, blank topics, copies, quotes, line breaks."""
    part = table(spark, sf_dir, "part")
    key, size = F.col("p_partkey"), F.col("p_size")
    plain = F.concat(F.lit("S"), _text(key))
    padded = F.concat(F.lit(" S"), _text(key), F.lit(" "))
    rows = part.select(
        F.when(key % 3 == 0, padded).otherwise(plain).alias("id"),
        F.concat("p_name", F.lit(', "'), "p_type", F.lit('"\n')).alias("name"),
        _text(size).alias("source_id"),
        F.col("p_brand").alias("source"),
        F.when(size % 10 == 0, None)
        .otherwise(F.concat(F.lit(" "), "p_brand", F.lit(" ")))
        .alias("source_organization"),
        F.when(key % 13 == 0, " ")
        .when(key % 17 == 0, None)
        .otherwise(F.col("p_type"))
        .alias("topic"),
    )
    copies = part.filter(size > 25).select(
        padded.alias("id"),
        F.col("p_name").alias("name"),
        _text(size).alias("source_id"),
        F.col("p_brand").alias("source"),
        F.lit(None).cast("string").alias("source_organization"),
        F.concat(F.lit(" "), "p_type", F.lit(" ")).alias("topic"),
    )
    return rows.unionAll(copies)


def sales_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, topic) per order line; parts sold both in bulk and otherwise conflict."""
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat(F.lit(" S"), _text(F.col("l_partkey"))).alias("id"),
        F.when(F.col("l_quantity") >= 49, " Bulk").otherwise(F.col("p_brand")).alias("topic"),
    )


def sales_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier x part x year with a native value; the series are as many as the parts."""
    cells = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", "l_partkey", F.year("l_shipdate").alias("y"))
        .agg(F.max("l_extendedprice").alias("v"))
    )
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    part_key = F.col("l_partkey")
    unknown = F.concat(F.lit("U"), _text(part_key))
    known = F.concat(F.lit(" S"), _text(part_key))
    return cells.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("s_name").alias("entity_name"),
        F.concat(F.lit("E"), _text(F.col("l_suppkey")), F.lit(" ")).alias("entity_code"),
        F.concat(F.lit("Part "), _text(part_key)).alias("series_name"),
        F.when(part_key % 7 == 0, unknown).otherwise(known).alias("series_code"),
        F.col("y").alias("period"),
        F.col("v").alias("value"),
    )


def crowded_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales panel, with one series code for the rows of every third supplier."""
    crowded = F.regexp_extract("entity_code", "[0-9]+", 0).cast("long") % 3 == 0
    code = F.when(crowded, " S1").otherwise(F.col("series_code"))
    return sales_panel(spark, sf_dir).withColumn("series_code", code)


def overdrawn_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity codes to exclude, as a table that grows with the customers."""
    return (
        table(spark, sf_dir, "customer")
        .filter(F.col("c_acctbal") < 0)
        .select(F.concat(F.lit(" c"), _text(F.col("c_custkey"))).alias("code"))
    )


def daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User x event type x day, typed: codes bigint, period int, value double."""
    return (
        table(spark, sf_dir, "events")
        .groupBy("user_id", "event_type", F.dayofmonth("ts").alias("day"))
        .agg(F.max("value").alias("value"))
        .select(
            F.concat(F.lit("User "), _text(F.col("user_id"))).alias("user_name"),
            "user_id",
            "event_type",
            F.upper("event_type").alias("event_code"),
            "day",
            "value",
        )
    )
