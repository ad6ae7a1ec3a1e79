"""Joins of a large table with a table that has few rows per key.

The keyed side is broadcast only after its size was measured. Beyond the limit both
sides are shuffled by the key and a salt. A frequency sketch over hashes of the keys, taken
in one scan of the key column, tells which keys have more rows than an average partition
should hold: those are spread over salts, four for each such share, and only their rows of
the keyed side are copied. All other keys have the salt 0 and one copy.

The salt stays part of the partitioning, so where some key is hot no later grouping
reuses it, and adaptive execution is free to split a partition that is still too large.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspan.functions import column, quoted

BROADCAST_BYTES = 128 * 1024 * 1024
ROW_OVERHEAD_BYTES = 64

#: The sketch returns at most this many keys, and follows some times as many.
MOST_HOT_KEYS = 10_000
FOLLOWED_PER_KEY = 8
#: Pieces as large as a partition would often meet in one; smaller ones even out.
PIECES_PER_PARTITION = 4

#: Bits of a bitmap of hashed keys: for each key, and of a bitmap at least and at most.
BITS_PER_KEY = 16
FEWEST_BITS, MOST_BITS = 15, 30

BUCKET, BITS = "_bucket", "_bits"
SALT, CODE, SALTS = "_salt", "_code", "_salts"


@dataclass(frozen=True)
class TableSize:
    rows: int
    bytes: int


def size_columns(names: Sequence[str]) -> list:
    """Aggregates that measure a table: its rows and the bytes of its text."""
    row_bytes = F.lit(ROW_OVERHEAD_BYTES).cast("long")
    for name in names:
        row_bytes = row_bytes + F.coalesce(
            F.octet_length(column(name).cast("string")), F.lit(0)
        ).cast("long")
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(row_bytes), F.lit(0).cast("long")).alias("bytes"),
    ]


def measure(df: DataFrame) -> TableSize:
    """Count the rows and bytes of a table in one distributed job."""
    row = df.agg(*size_columns(df.columns)).first()
    return TableSize(row["rows"], row["bytes"])


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the table's measured size is within the limit."""
    return measure(df).bytes <= limit


@dataclass(frozen=True)
class HotKeys:
    """Hashes of keys with more than ``share`` rows, and the salts that each is spread over."""

    rows: int
    share: int
    salts: dict[int, int]


def hot_keys(large: DataFrame, key: str, partitions: int | None = None) -> HotKeys:
    """The keys of ``large`` that hold more than their share of its rows. One job.

    A share is what an average partition of the join gets; ``partitions`` is Spark's number
    for a shuffle by default. Fewer keys than partitions can exceed it, so the result is
    bounded, and so is the sketch, whose counts may be too low by some
    rows / (6 x partitions); a key just above one share may be missed, a larger one not.
    """
    if partitions is None:
        partitions = shuffle_partitions(large.sparkSession)
    most = max(1, min(partitions, MOST_HOT_KEYS))
    sketch = f"approx_top_k({CODE}, {most}, {most * FOLLOWED_PER_KEY})"
    found = (
        large.select(F.xxhash64(column(key)).alias(CODE))
        .agg(F.count(F.lit(1)).alias("rows"), F.expr(sketch).alias("top"))
        .first()
    )
    share = max(1, math.ceil(found["rows"] / partitions))
    salts = {
        item["item"]: math.ceil(PIECES_PER_PARTITION * item["count"] / share)
        for item in found["top"] or []
        if item["count"] > share
    }
    return HotKeys(found["rows"], share, salts)


def counted_hot_keys(
    counts: DataFrame, key: str, rows: str, partitions: int | None = None
) -> HotKeys:
    """As ``hot_keys``, of a table that has each key and its number of rows."""
    if partitions is None:
        partitions = shuffle_partitions(counts.sparkSession)
    total = counts.agg(F.coalesce(F.sum(rows), F.lit(0))).first()[0]
    share = max(1, math.ceil(total / partitions))
    listed = (
        counts.filter(column(rows) > share)
        .select(F.xxhash64(column(key)).alias(CODE), column(rows))
        .orderBy(column(rows).desc(), CODE)
        .limit(MOST_HOT_KEYS)
        .collect()
    )
    salts = {row[0]: math.ceil(PIECES_PER_PARTITION * row[1] / share) for row in listed}
    return HotKeys(total, share, salts)


def shuffle_partitions(spark) -> int:
    """How many partitions a shuffle starts with."""
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    return int(spark.conf.get(name, None) or spark.conf.get("spark.sql.shuffle.partitions"))


def listed_bits(listed: DataFrame, key: str, rows: int) -> DataFrame:
    """A bitmap of the hashed keys of a table, in rows of 32,768 bits: ``_bucket``, ``_bits``.

    It has some 16 bits for each of ``rows`` keys, which is 2 bytes a key, 128 MiB at most;
    beyond, more keys share a bit, and fewer rows are ruled out.
    """
    bits = 1 << min(MOST_BITS, max(FEWEST_BITS, (BITS_PER_KEY * max(1, rows) - 1).bit_length()))
    at = F.pmod(F.xxhash64(column(key)), F.lit(bits))
    return (
        listed.filter(column(key).isNotNull())
        .select((at + 1).alias("_at"))
        .groupBy(F.bitmap_bucket_number("_at").alias(BUCKET))
        .agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias(BITS),
            F.lit(bits).alias("_of"),
        )
    )


def maybe_listed(rows: DataFrame, key: str, bitmap: DataFrame) -> DataFrame:
    """The rows whose key may be in the table that a bitmap was made of; none of its keys is
    ever left out. Rows do not move: the bitmap is broadcast."""
    first = bitmap.select("_of").first()
    if first is None:
        return rows.filter(F.lit(False))
    names = [quoted(name) for name in rows.columns]
    at = (F.pmod(F.xxhash64(column(key)), F.lit(first["_of"])) + 1).alias("_at")
    byte = "conv(hex(substring(_bits, CAST(bitmap_bit_position(_at) div 8 AS INT) + 1, 1)), 16, 10)"
    return (
        rows.select("*", at)
        .withColumn(BUCKET, F.bitmap_bucket_number("_at"))
        .join(F.broadcast(bitmap), BUCKET)
        .filter(f"getbit(CAST({byte} AS INT), CAST(bitmap_bit_position(_at) % 8 AS INT)) = 1")
        .select(*names)
    )


def lookup(
    large: DataFrame,
    keyed: DataFrame,
    key: str,
    how: str,
    small: bool,
    spread_by: Sequence[str],
    salts: int | None = None,
    hot: HotKeys | None = None,
    hashed: bool = False,
) -> DataFrame:
    """Join ``large`` with ``keyed`` on ``key``: inner, left, left_semi or left_anti.

    ``small`` says that ``keyed`` was measured and may be broadcast. Otherwise rows of hot
    keys get a salt hashed from ``spread_by`` (the same in every retry) and their rows in
    ``keyed`` one copy per salt, so each row meets its key exactly once. Finding hot keys
    is one more job over the key column, unless ``hot`` has them; ``salts`` gives every key
    that number instead. ``hashed`` says that memory has room for the rows of ``keyed`` in any
    partition, so that neither side is sorted.
    """
    if small:
        return large.join(F.broadcast(keyed), key, how)
    if salts is None:
        many = (hot or hot_keys(large, key)).salts
        salted, copies = _salted(large, key, many, spread_by), _copied(keyed, key, many)
    else:
        salted = large.withColumn(SALT, _spread(spread_by, F.lit(salts)))
        copies = keyed.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    # The hint keeps Spark from broadcasting on an estimate that knows nothing of the copies.
    hint = "shuffle_hash" if hashed else "shuffle_merge"
    return salted.join(copies.hint(hint), [key, SALT], how).drop(SALT)


def _spread(spread_by: Sequence[str], salts: Column) -> Column:
    return F.pmod(F.xxhash64(*[column(name) for name in spread_by]), salts).cast("int")


def _none(key: str) -> Column:
    """The salt 0, as a value that stays part of the partitioning."""
    return F.pmod(F.xxhash64(column(key)), F.lit(1)).cast("int")


def _salted(
    large: DataFrame, key: str, hot: dict[int, int], spread_by: Sequence[str]
) -> DataFrame:
    if not hot:
        return large.withColumn(SALT, _none(key))
    marked = _with_salts(large, key, hot)
    salt = F.when(column(SALTS).isNull(), 0).otherwise(_spread(spread_by, column(SALTS)))
    return marked.withColumn(SALT, salt).drop(SALTS)


def _copied(keyed: DataFrame, key: str, hot: dict[int, int]) -> DataFrame:
    if not hot:
        return keyed.withColumn(SALT, _none(key))
    last = F.coalesce(column(SALTS), F.lit(1)) - 1
    marked = _with_salts(keyed, key, hot)
    return marked.withColumn(SALT, F.explode(F.sequence(F.lit(0), last))).drop(SALTS)


def _with_salts(rows: DataFrame, key: str, hot: dict[int, int]) -> DataFrame:
    """Rows with the number of salts of their key, null for keys that are not hot.

    The list of hot keys has at most ``MOST_HOT_KEYS`` pairs of numbers.
    """
    listed = rows.sparkSession.createDataFrame(list(hot.items()), f"{CODE} long, {SALTS} int")
    coded = rows.withColumn(CODE, F.xxhash64(column(key)))
    names = [quoted(name) for name in rows.columns]
    return coded.join(F.broadcast(listed), CODE, "left").select(*names, SALTS)
