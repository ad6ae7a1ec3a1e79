"""Small panels and readable results for the tests."""

from pyspark.sql import DataFrame

import panelspan as ps

RAW = "`Country Name` string, `Country Code` string, `Series Name` string, " \
    "`Series Code` string, `Year` string, `Value` string"
LONG = RAW.replace("`Year` string, `Value` string", "`Year` int, `Value` double")
TOPICAL = LONG + ", `Topic` string"


def rows(df: DataFrame) -> list[tuple]:
    """All rows as tuples, in a stable order."""
    return sorted((tuple(row) for row in df.collect()), key=repr)


def records(df: DataFrame) -> list[dict]:
    return sorted((row.asDict() for row in df.collect()), key=repr)


def raw(spark, *values) -> DataFrame:
    return spark.createDataFrame(list(values), RAW)


def long(spark, *values) -> DataFrame:
    return spark.createDataFrame(list(values), LONG)


def topical(spark, *values) -> DataFrame:
    return spark.createDataFrame(list(values), TOPICAL)


def dimension(spark, *pairs) -> DataFrame:
    return spark.createDataFrame(list(pairs), "id string, topic string")


def full_dimension(spark, *pairs) -> DataFrame:
    values = [(key, f"name of {key}", "2", "src", "org", topic) for key, topic in pairs]
    schema = ", ".join(f"{name} string" for name in ps.DIMENSION.published)
    return spark.createDataFrame(values, schema)


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().toString()


def executed_plan(df: DataFrame) -> str:
    """The physical plan after adaptive execution."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
