"""Column expressions: names, text, safe numbers. No Python runs on the executors.

Numeric columns keep their type: a trip through text would hide
``value IS NOT NULL`` from the Parquet reader. Float is the exception, since
widening it to double directly changes the decimal digits (0.1 becomes
0.10000000149), and so takes the text route.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXACT_NUMBERS = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.DecimalType,
    T.DoubleType,
)
INT_SIZED = (T.ByteType, T.ShortType, T.IntegerType)


def quoted(name: str) -> str:
    """A column name as Spark SQL must see it, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """The column with exactly this name; dots are not field access."""
    return F.col(quoted(name))


def text(name: str) -> Column:
    """The column as text without outer spaces; null becomes empty."""
    return F.trim(F.coalesce(column(name).cast("string"), F.lit("")))


def is_blank(name: str) -> Column:
    """Null, empty or only spaces."""
    return text(name) == ""


def trimmed(name: str) -> Column:
    """The column as text without outer spaces; null stays null."""
    return F.trim(column(name).cast("string"))


def has_exact_number(df: DataFrame, name: str) -> bool:
    """Whether the column's type converts to double without a trip through text."""
    return isinstance(df.schema[name].dataType, EXACT_NUMBERS)


def as_number(df: DataFrame, name: str) -> Column:
    """The column as double; null where it is blank or not a number."""
    if has_exact_number(df, name):
        return column(name).cast("double")
    return F.trim(column(name).cast("string")).try_cast("double")


def as_period(df: DataFrame, name: str) -> Column:
    """The column as int; null where it is not one."""
    if isinstance(df.schema[name].dataType, INT_SIZED):
        return column(name).cast("int")
    return F.trim(column(name).cast("string")).try_cast("int")
