"""Column names that cannot clash, and table reading, for the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspan.operators.lookup import fits_broadcast
from panelspan.sinks.scratch import staged

SMALL_BATCH = 256
COPY_BLOCK = 4096


def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches in slices of few rows, so that little is copied out of them at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, SMALL_BATCH):
            yield batch.slice(at, SMALL_BATCH)
        pa.default_memory_pool().release_unused()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **wanted: str) -> DataFrame:
    """The wanted columns (new name = present name).

    Columns are found by position, so others may have names that differ only in case.
    """
    return _moved(df).select(*_found(df, wanted))


def pack(df: DataFrame, **wanted: str) -> DataFrame:
    """The wanted columns beside all columns, which are named by position (``_0``, ...).

    Names chosen later, without a leading ``_``, cannot clash with the table's own.
    """
    return _moved(df).select("*", *_found(df, wanted))


def _moved(df: DataFrame) -> DataFrame:
    return df.toDF(*[f"_{i}" for i in range(len(df.columns))])


def _found(df: DataFrame, wanted: dict[str, str]) -> list[Column]:
    return [F.col(f"_{_place(df, x)}").alias(name) for name, x in wanted.items()]


def _place(df: DataFrame, name: str) -> int:
    if name in df.columns:
        return df.columns.index(name)
    alike = [i for i, x in enumerate(df.columns) if x.lower() == name.lower()]
    if len(alike) != 1:
        raise ValueError(f"No column {name!r} among {df.columns}")
    return alike[0]


def unpack(packed: DataFrame, columns: Sequence[str], **added: Column) -> DataFrame:
    """The columns of a packed table under their own names, then the added ones.

    An added column replaces one of the same name.
    """
    taken = {name.lower() for name in added}
    kept = [(i, name) for i, name in enumerate(columns) if name.lower() not in taken]
    flat = packed.select(
        *[F.col(f"_{i}") for i, _ in kept],
        *[value.alias(f"_new{i}") for i, value in enumerate(added.values())],
    )
    return flat.toDF(*[name for _, name in kept], *added)


def contents(df: DataFrame) -> Column:
    """A 128-bit hash of all columns of a row, in hexadecimal; null differs from every text."""
    each = [F.coalesce(F.md5(F.col(name).cast("string")), F.lit("-")) for name in df.columns]
    return F.md5(F.concat_ws("|", *each))


def number_copies(rows: DataFrame, identity: Column) -> DataFrame:
    """The rows with ``identity`` and ``occurrence``, from 1 among the rows of one identity.

    Rows of one identity must be equal, so it does not matter which has which number. Only
    repeated ones move: they become one row with a count before any shuffle, and are dealt
    out again in blocks, so that no task holds all copies of a row.
    """
    named = rows.withColumn("identity", identity)
    again = staged(
        named.groupBy("identity")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("identity")
    )
    if again.isEmpty():
        return named.withColumn("occurrence", F.lit(1).cast("long"))
    once, repeated = None, named
    if fits_broadcast(again):
        once = named.join(F.broadcast(again), "identity", "left_anti")
        repeated = named.join(F.broadcast(again), "identity", "left_semi")
    dealt = deal_copies(repeated, ["identity"])
    if once is None:
        return dealt
    return once.withColumn("occurrence", F.lit(1).cast("long")).unionByName(dealt)


def deal_copies(repeated: DataFrame, by: list[str]) -> DataFrame:
    """The rows with ``occurrence``, from 1 among those that agree in ``by`` and so in all.

    They become one row with a count, and are dealt out again in blocks.
    """
    counted = repeated.groupBy(*by).agg(
        *[F.first(name).alias(name) for name in repeated.columns if name not in by],
        F.count(F.lit(1)).alias("_n"),
    )
    blocks = counted.withColumn(
        "_block", F.explode(F.expr(f"sequence(0L, (_n - 1) div {COPY_BLOCK})"))
    ).repartition(*by, "_block")
    place = f"explode(sequence(1L, least(_n - _block * {COPY_BLOCK}, {COPY_BLOCK}))) AS _place"
    return blocks.select("*", F.expr(place)).select(
        *repeated.columns, (F.col("_block") * COPY_BLOCK + F.col("_place")).alias("occurrence")
    )


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """The table, marked for broadcast if its measured size allows it."""
    return F.broadcast(df) if fits_broadcast(df) else df
