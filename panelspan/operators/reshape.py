"""From the long shape to one column per series or one column per period.

A pivot normally shuffles twice, and by the second shuffle every cell has become
a row as wide as the whole result. Here narrow rows are moved once, by the row
key, and all of the pivot runs in place: no wide row ever crosses the network. A
cell with several observations raises in the same aggregation, and so does an
observation whose header was not asked for.

A schema is held by the driver and by every task, so one table has room for some thousands
of columns. Beyond, a wide shape is made in blocks of columns, in one table: a row for each
row key and block in which it has an observation, with the columns ``0``, ``1``, ... of the
block. A second table tells which series has which column of which block.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspan.errors import InvalidHeaders
from panelspan.functions import column, quoted
from panelspan.operators.lookup import (
    counted_hot_keys,
    fits_broadcast,
    lookup,
    measure,
    shuffle_partitions,
)
from panelspan.sinks.scratch import staged
from panelspan.spec import PANEL, PanelSpec

DUPLICATE_CELL = "DUPLICATE_CELL"
UNLISTED_HEADER = "UNLISTED_HEADER"

SHAPE, BUCKET, PLACE, REPEATED = "_shape", "_bucket", "_place", "_repeated"
#: The columns of a shape in blocks, and of the table of its names.
BLOCK, COLUMN, OBSERVATIONS = "_block", "_column", "_observations"
NAME, AT, PART, START = "_name", "_at", "_part", "_start"

#: The most series with columns in one table, by default.
MOST_COLUMNS = 2_000
#: Columns of a block. Few rows of a wide panel are full, and each cell that is empty beside a
#: filled one costs time: where nearly all rows of a block have one observation, the work is the
#: observations times this.
BLOCK_COLUMNS = 32
#: Columns whose observations one number marks, a bit for each.
MARKED_COLUMNS = 32
#: What a partition of wide rows may take in memory, and the most partitions. Each row has
#: its key, and each observation its own row key until it is pivoted.
WIDE_BYTES_PER_PARTITION = 64 * 1024 * 1024
CELL_BYTES, KEY_BYTES = 8, 160
MOST_PARTITIONS = 20_000
#: Up to so many columns every observation is taken to have a wide row of its own.
FEW_COLUMNS = 32
#: A table of names is broadcast by way of the driver, so up to a lower size than others.
NAMES_BROADCAST_BYTES = 16 * 1024 * 1024
#: The most bytes of names in a partition that a join holds in memory in place of sorting cells.
NAMES_HASHED_BYTES = 32 * 1024 * 1024


def pivot_headers(panel: DataFrame, name: str, max_headers: int | None = None) -> list[Any]:
    """The distinct values of a column, ascending: the columns of a wide shape.

    They become a schema and so must reach the driver. ``max_headers`` raises instead
    when there are more, before they are fetched.
    """
    return shape_headers(panel, [name], max_headers)[name]


def _headers_and_rows(
    panel: DataFrame, name: str, max_headers: int | None
) -> tuple[list[Any], int]:
    """The headers of ``pivot_headers``, and the number of rows, from one pass."""
    found = panel.groupBy(column(name).alias(NAME)).agg(F.count(F.lit(1)).alias("n"))
    if max_headers is not None:
        found = found.limit(max_headers + 1)
    listed = {row[NAME]: row["n"] for row in found.collect()}
    return _checked(name, list(listed), max_headers), sum(listed.values())


def _checked(name: str, headers: list[Any], max_headers: int | None) -> list[Any]:
    """The headers, ascending; raises on a null, and on more than ``max_headers``."""
    if None in headers:
        raise InvalidHeaders(f"Column {name!r} holds nulls, which cannot become a column.")
    if max_headers is not None and len(headers) > max_headers:
        raise InvalidHeaders(
            f"Column {name!r} has more than {max_headers} distinct values (max_headers)."
        )
    return sorted(headers)


def shape_headers(
    panel: DataFrame, names: Sequence[str], max_headers: int | None = None
) -> dict[str, list[Any]]:
    """The distinct values of several columns, ascending, from one pass over the panel."""
    types = [panel.schema[name].dataType for name in names]

    def value(i: int, j: int) -> Column:
        return (column(names[i]) if i == j else F.lit(None).cast(types[i])).alias(f"v{i}")

    places = range(len(names))
    each = F.array(
        *[F.struct(F.lit(j).alias("j"), *[value(i, j) for i in places]) for j in places]
    )
    found = panel.select(F.inline(each)).distinct()
    if max_headers is not None:
        found = found.limit(max_headers * len(names) + 1)
    values: dict[str, list[Any]] = {name: [] for name in names}
    for row in found.collect():
        values[names[row["j"]]].append(row[f"v{row['j']}"])
    return {name: _checked(name, headers, max_headers) for name, headers in values.items()}


def series_headers(
    panel: DataFrame,
    spec: PanelSpec = PANEL,
    max_headers: int | None = None,
    most_columns: int = MOST_COLUMNS,
    stage: Callable[..., DataFrame] = staged,
) -> list[str] | DataFrame:
    """The headers for ``pivot_series``: the series names, ascending, or beyond
    ``most_columns`` the table of ``series_blocks``. No more names than that are fetched."""
    name = spec.series_name
    counted = stage(_counted(panel, [name]))
    if counted.count() <= most_columns:
        found = [row[0] for row in counted.select(column(name)).collect()]
        return _checked(name, found, max_headers)
    return _blocks(panel, spec, counted, [name], BLOCK_COLUMNS, max_headers, stage)


def topic_headers(
    panel: DataFrame,
    spec: PanelSpec = PANEL,
    max_headers: int | None = None,
    most_columns: int = MOST_COLUMNS,
    stage: Callable[..., DataFrame] = staged,
) -> DataFrame | None:
    """The headers for ``pivot_series_by_topic``: None while every topic has room in one
    table, beyond ``most_columns`` in one of them the table of ``series_blocks``."""
    names = [spec.topic, spec.series_name]
    counted = stage(_counted(panel, names))
    counts = counted.groupBy(column(spec.topic)).count()
    if (counts.agg(F.max("count")).first()[0] or 0) <= most_columns:
        return None
    return _blocks(panel, spec, counted, names, BLOCK_COLUMNS, max_headers, stage)


def series_blocks(
    panel: DataFrame,
    spec: PanelSpec = PANEL,
    by_topic: bool = False,
    width: int = BLOCK_COLUMNS,
    max_headers: int | None = None,
    stage: Callable[..., DataFrame] = staged,
) -> DataFrame:
    """Which column of which block each series has: its name (with ``by_topic`` the topic
    before it), ``_block``, ``_column``, and its number of observations.

    Names are dealt in ascending order, ``width`` to a block. They are sorted and numbered
    by many tasks, and none reaches the driver. Raises ``InvalidHeaders`` as one table would.
    """
    names = [spec.topic, spec.series_name] if by_topic else [spec.series_name]
    return _blocks(panel, spec, _counted(panel, names), names, width, max_headers, stage)


def _counted(panel: DataFrame, names: Sequence[str]) -> DataFrame:
    """The distinct names, each with its number of observations."""
    return panel.groupBy(*[column(name) for name in names]).agg(
        F.count(F.lit(1)).alias(OBSERVATIONS)
    )


def _blocks(
    panel: DataFrame,
    spec: PanelSpec,
    counted: DataFrame,
    names: Sequence[str],
    width: int,
    max_headers: int | None,
    stage: Callable[..., DataFrame],
) -> DataFrame:
    """``series_blocks`` of names that were counted."""
    named = [column(name) for name in names]
    listed = stage(counted.orderBy(*named).withColumn(AT, F.monotonically_increasing_id()))
    # The id holds the part of the table in its upper bits and the row within in the lower.
    part = F.shiftright(AT, 33)
    if max_headers is not None and listed.count() > max_headers:
        raise InvalidHeaders(f"There are more than {max_headers} series (max_headers).")
    _check_names(panel, spec, listed, names)
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    start = (
        listed.groupBy(part.alias(PART))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(PART, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(START))
    )
    index = column(START) + column(AT).bitwiseAND(F.lit((1 << 33) - 1))
    placed = listed.withColumn(PART, part).join(F.broadcast(start), PART)
    return stage(
        placed.select(
            *named,
            F.floor(index / width).cast("int").alias(BLOCK),
            (index % width).cast("int").alias(COLUMN),
            OBSERVATIONS,
        )
    )


def _check_names(
    panel: DataFrame, spec: PanelSpec, listed: DataFrame, names: Sequence[str]
) -> None:
    """Raise on names that are null, and on those that ``check_headers`` would not take."""
    for name in names:
        if not listed.filter(column(name).isNull()).isEmpty():
            raise InvalidHeaders(f"Column {name!r} holds nulls, which cannot become a column.")
    cased = panel.sparkSession.conf.get("spark.sql.caseSensitive") == "true"

    def folded(name: Column) -> Column:
        return name if cased else F.lower(name)

    *topic, series = [column(name) for name in names]
    keys = [folded(F.lit(key)) for key in spec.series_shape_keys(panel)]
    alike = (
        listed.groupBy(*topic, folded(series).alias(NAME))
        .agg(F.min(series).alias("a"), F.max(series).alias("b"))
        .filter((F.col("a") != F.col("b")) | column(NAME).isin(*keys))
        .first()
    )
    if alike:
        raise InvalidHeaders(f"Columns {alike['a']!r} and {alike['b']!r} would collide.")


def check_headers(panel: DataFrame, keys: Sequence[str], headers: Sequence[Any]) -> None:
    """Raise if a wide shape would have two columns that Spark cannot tell apart."""
    cased = panel.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    seen: dict[str, str] = {}
    for name in [*keys, *map(str, headers)]:
        folded = name if cased else name.lower()
        if folded in seen:
            raise InvalidHeaders(f"Columns {seen[folded]!r} and {name!r} would collide.")
        seen[folded] = name


def _guarded(keys: list[str], header: str, value: str, known: Column | None) -> Column:
    """The value of a cell; raises on a second one, and on a header that is not listed."""
    unlisted, duplicate = _errors(keys, header)
    cell = F.when(F.count(F.lit(1)) > 1, duplicate)
    if known is not None:
        cell = cell.when(~F.bool_and(known), unlisted)
    return cell.otherwise(F.first(column(value)))


def _errors(keys: Sequence[str], header: str) -> tuple[Column, Column]:
    """What raises on a header that is not listed, and on a second observation."""
    what = ", ".join([*keys, header])
    unlisted = f"{UNLISTED_HEADER}: {header!r} has a value not in headers"
    duplicate = f"{DUPLICATE_CELL}: several observations for one ({what})"
    return F.raise_error(F.lit(unlisted)), F.raise_error(F.lit(duplicate))


def _widen(
    panel: DataFrame,
    keys: list[str],
    header: str,
    value: str,
    headers: Sequence[Any] | None,
    max_headers: int | None,
    partitions: int | None,
) -> DataFrame:
    listed = headers
    key_columns = [column(name) for name in keys]
    if headers is None:
        headers, rows = _headers_and_rows(panel, header, max_headers)
        if not headers:
            return panel.select(*key_columns).distinct()
        partitions = partitions or shape_partitions(panel, keys, len(headers), rows)
    elif not headers:
        raise InvalidHeaders("The list of headers is empty.")
    check_headers(panel, keys, headers)
    known = None
    if listed is not None:
        known = F.coalesce(column(header).isin(list(listed)), F.lit(False))
    cells = panel.select(*key_columns, column(header), column(value))
    moved = [partitions, *key_columns] if partitions else key_columns
    return (
        cells.repartition(*moved)
        .groupBy(*key_columns)
        .pivot(quoted(header), list(headers))
        .agg(_guarded(keys, header, value, known))
    )


def shape_partitions(
    panel: DataFrame, keys: Sequence[str], width: int, rows: int
) -> int | None:
    """How many partitions ``rows`` observations need, so that no task holds many wide rows;
    None if one would do. A number is kept by adaptive execution, which would otherwise join
    partitions by the size of narrow rows.

    The row keys are counted (roughly, in one more job) only where they matter.
    """
    least = shuffle_partitions(panel.sparkSession)

    def needed(wide_rows: int) -> int:
        held = rows * KEY_BYTES + wide_rows * (KEY_BYTES + width * CELL_BYTES)
        return min(MOST_PARTITIONS, math.ceil(held / WIDE_BYTES_PER_PARTITION))

    wide_rows = rows
    if needed(rows) > least and width > FEW_COLUMNS:
        key = F.xxhash64(*[column(name) for name in keys])
        wide_rows = min(rows, panel.agg(F.approx_count_distinct(key)).first()[0])
    return max(least, needed(wide_rows)) if needed(wide_rows) > 1 else None


def _widen_blocks(
    panel: DataFrame, spec: PanelSpec, listed: DataFrame, partitions: int | None
) -> DataFrame:
    """One row per row key and block, pivoted by the column that each series has in its block.

    Spark's pivot aggregates four times, and slowly where it has many columns. Here one
    aggregation has a maximum for each column, and marks the columns that it has seen: as many
    observations as marks means one for each cell.
    """
    keys = spec.series_shape_keys(panel)
    key_columns = [column(name) for name in keys]
    total = listed.agg(F.sum(OBSERVATIONS).alias("rows"), F.max(COLUMN).alias("last")).first()
    width = (total["last"] or 0) + 1
    places = range(width)
    check_headers(panel, keys, [BLOCK, *places])
    # A row may have no more than one observation.
    wide_bytes = (total["rows"] or 0) * (KEY_BYTES + width * CELL_BYTES)
    parts = max(
        partitions or 0,
        shuffle_partitions(panel.sparkSession),
        min(MOST_PARTITIONS, math.ceil(wide_bytes / WIDE_BYTES_PER_PARTITION)),
    )
    names = _named(spec, listed)
    # A block with many observations is dealt to several partitions by row key.
    share = F.sum(OBSERVATIONS).over(Window.partitionBy(BLOCK)) / F.lit(total["rows"])
    columns = listed.select(
        names.alias(NAME), BLOCK, COLUMN, F.ceil(share * parts).cast("int").alias(BUCKET)
    )
    cells = _lookup_names(
        panel.select(*key_columns, column(spec.value), names.alias(NAME)),
        columns,
        NAME,
        "left",
        listed.select(names.alias(NAME), OBSERVATIONS),
        spread_by=keys,
    )
    bucket = F.pmod(F.xxhash64(*key_columns), column(BUCKET)).cast("int")
    dealt = cells.drop(NAME).withColumn(BUCKET, bucket).repartition(parts, BLOCK, BUCKET)
    value, at = column(spec.value), column(COLUMN)
    mark = F.expr(f"shiftleft(1L, {COLUMN} % {MARKED_COLUMNS})")
    marks = [
        F.bit_or(F.when(F.floor(at / MARKED_COLUMNS) == n, mark))
        for n in range(math.ceil(width / MARKED_COLUMNS))
    ]
    seen = sum((F.coalesce(F.bit_count(mark), F.lit(0)) for mark in marks), F.lit(0))
    # The bucket is one of the grouped columns: the grouping runs where the rows were dealt.
    wide = dealt.groupBy(*key_columns, BLOCK, BUCKET).agg(
        *[F.max(F.when(at == place, value)).alias(str(place)) for place in places],
        (F.count(F.lit(1)) > seen).alias(REPEATED),
    )
    unlisted, duplicate = _errors(keys, spec.series_name)
    sound = (
        F.when(column(BLOCK).isNull(), unlisted.cast("boolean"))
        .when(column(REPEATED), duplicate.cast("boolean"))
        .otherwise(True)
    )
    return wide.filter(sound).drop(BUCKET, REPEATED)


def _named(spec: PanelSpec, listed: DataFrame) -> Column:
    """The name of a series, or its topic and name, as ``listed`` has them."""
    names = [column(c) for c in (spec.topic, spec.series_name) if c in listed.columns]
    return names[0] if len(names) == 1 else F.struct(*names)


def _lookup_names(
    cells: DataFrame,
    columns: DataFrame,
    key: str,
    how: str,
    counts: DataFrame,
    spread_by: Sequence[str],
) -> DataFrame:
    """Join cells with the table of names. ``counts`` has the key and observations of each, so
    that the keys with many are known without a pass over the cells."""
    size = measure(columns).bytes
    if size <= NAMES_BROADCAST_BYTES:
        return lookup(cells, columns, key, how, small=True, spread_by=spread_by)
    hot = counted_hot_keys(counts, key, OBSERVATIONS)
    hashed = size / shuffle_partitions(cells.sparkSession) <= NAMES_HASHED_BYTES
    return lookup(
        cells, columns, key, how, small=False, spread_by=spread_by, hot=hot, hashed=hashed
    )


def series_cells(wide: DataFrame, headers: DataFrame, spec: PanelSpec = PANEL) -> DataFrame:
    """The filled cells of a series shape in blocks, one row for each, under their names."""
    keys = wide.columns[: wide.columns.index(BLOCK)]
    places = wide.columns[len(keys) + 1 :]
    names = [spec.series_name]
    key_columns = [column(name) for name in keys]
    cells = wide.select(
        *key_columns,
        BLOCK,
        F.posexplode(F.array(*[column(name) for name in places])).alias(COLUMN, spec.value),
    ).filter(column(spec.value).isNotNull())
    place = (column(BLOCK).cast("long") * len(places) + column(COLUMN)).alias(AT)
    return _lookup_names(
        cells.select(*key_columns, column(spec.value), place),
        headers.select(place, *[column(name) for name in names]),
        AT,
        "inner",
        headers.select(place, OBSERVATIONS),
        spread_by=keys,
    ).select(*key_columns, *[column(name) for name in names], column(spec.value))


def pivot_series(
    panel: DataFrame,
    spec: PanelSpec = PANEL,
    headers: Sequence[str] | DataFrame | None = None,
    max_headers: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """One row per entity and period (and topic, if present), one column per series name.

    Without ``headers`` one job finds the series names; there is no limit on them
    but ``max_headers``. That job computes the panel a first time, so give a written
    table. With ``headers``, an observation of another series raises. Two
    observations for one cell raise too; both do when the result is computed.
    ``partitions`` is the number that rows are dealt to by row key, if Spark's
    setting is not enough.

    With the table of ``series_blocks`` as ``headers`` the shape comes in blocks of columns,
    for any number of series: the row keys, ``_block``, and the columns of a block. A row
    key has a row in each block where it has observations. ``series_headers`` gives either
    list or table; ``series_cells`` turns the blocks back into named cells.
    """
    if isinstance(headers, DataFrame):
        return _widen_blocks(panel, spec, headers, partitions)
    keys = spec.series_shape_keys(panel)
    return _widen(
        panel, keys, spec.series_name, spec.value, headers, max_headers, partitions
    )


def pivot_period(
    panel: DataFrame,
    spec: PanelSpec = PANEL,
    headers: Sequence[int] | None = None,
    max_headers: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """One row per entity and series (and topic, if present), one column per period.

    Parameters as for ``pivot_series``.
    """
    keys = spec.period_shape_keys(panel)
    return _widen(panel, keys, spec.period, spec.value, headers, max_headers, partitions)


def pivot_series_by_topic(
    panel: DataFrame,
    spec: PanelSpec = PANEL,
    max_headers: int | None = None,
    partitions: int | None = None,
    stage: Callable[..., DataFrame] = staged,
    headers: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """For each topic, ``pivot_series`` of its rows: only columns of series it has.

    A row of the wide shape belongs to one topic, so all its cells under other topics'
    series are empty; with many topics one table for all is nearly empty. One pass finds the
    series of every topic and one exchange feeds all shapes: cells are dealt by topic and row
    key, as many partitions to a topic as it has rows, and pivoted by the place of their
    series within the topic. That table has as many columns as the largest topic. It is
    written by topic, and each part gets its own names.

    ``max_headers`` bounds the series of all topics together, before they are fetched. Two
    observations for one cell raise while the table is written. Give a written panel, as
    it is read twice. ``stage`` writes a table, partitioned, and reads it back.

    With ``headers`` from ``topic_headers`` each shape comes in blocks, as ``pivot_series``
    makes them.
    """
    keys = spec.series_shape_keys(panel)
    if spec.topic not in keys:
        raise InvalidHeaders(f"The panel has no column {spec.topic!r}.")
    if headers is not None:
        return _blocks_by_topic(panel, spec, headers, partitions, stage)
    topics, rows = _series_by_topic(panel, spec, max_headers)
    for headers in topics.values():
        check_headers(panel, keys, headers)
    parts = partitions or shuffle_partitions(panel.sparkSession)
    total = sum(rows.values()) or 1
    listed = [
        (topic, name, shape, place, math.ceil(parts * rows[topic] / total))
        for shape, (topic, headers) in enumerate(topics.items())
        for place, name in enumerate(headers)
    ]
    columns = panel.sparkSession.createDataFrame(
        listed, f"{quoted(spec.topic)} string, {quoted(spec.series_name)} string, "
        f"{SHAPE} int, {PLACE} int, {BUCKET} int"
    )
    if fits_broadcast(columns):
        columns = F.broadcast(columns)
    key_columns = [column(name) for name in keys]
    cells = panel.select(*key_columns, column(spec.series_name), column(spec.value)).join(
        columns, [spec.topic, spec.series_name]
    )
    # The bucket is one of the grouped columns: both groupings run where the rows were dealt.
    bucket = F.pmod(F.xxhash64(*key_columns), column(BUCKET)).cast("int")
    dealt = cells.withColumn(BUCKET, bucket).repartition(parts, SHAPE, BUCKET)
    row_key = [*key_columns, column(SHAPE), column(BUCKET)]
    widest = max(map(len, topics.values()), default=0)
    if not widest:
        return {}
    whole = (
        dealt.groupBy(*row_key)
        .pivot(PLACE, list(range(widest)))
        .agg(_guarded(keys, spec.series_name, spec.value, None))
        .drop(BUCKET)
    )
    table = stage(whole, partition_by=[SHAPE])
    places = [quoted(str(place)) for place in range(widest)]
    names = [quoted(name) for name in keys]
    return {
        topic: table.filter(column(SHAPE) == shape)
        .select(*names, *places[: len(headers)])
        .toDF(*keys, *headers)
        for shape, (topic, headers) in enumerate(topics.items())
    }


def _blocks_by_topic(
    panel: DataFrame,
    spec: PanelSpec,
    headers: DataFrame,
    partitions: int | None,
    stage: Callable[..., DataFrame],
) -> dict[str, DataFrame]:
    topic = column(spec.topic)
    topics = sorted(row[0] for row in headers.select(topic).distinct().collect())
    wide = _widen_blocks(panel, spec, headers, partitions)
    # Topics are numbered, as the names of folders do not keep every text.
    number = F.array_position(F.array(*map(F.lit, topics)), topic).cast("int")
    table = stage(wide.withColumn(SHAPE, number), partition_by=[SHAPE])
    return {
        name: table.filter(column(SHAPE) == shape).drop(SHAPE)
        for shape, name in enumerate(topics, start=1)
    }


def _series_by_topic(
    panel: DataFrame, spec: PanelSpec, max_headers: int | None
) -> tuple[dict[str, list[str]], dict[str, int]]:
    """The series names of each topic, ascending, and the topic's rows."""
    found = panel.groupBy(column(spec.topic), column(spec.series_name)).agg(
        F.count(F.lit(1)).alias("rows")
    )
    if max_headers is not None:
        found = found.limit(max_headers + 1)
    topics: dict[str, list[str]] = {}
    rows: dict[str, int] = {}
    listed = sorted(found.collect(), key=repr)
    if max_headers is not None and len(listed) > max_headers:
        raise InvalidHeaders(f"There are more than {max_headers} series by topic (max_headers).")
    for topic, name, n in listed:
        if topic is None or name is None:
            raise InvalidHeaders(f"{spec.topic!r} and {spec.series_name!r} must not hold nulls.")
        topics.setdefault(topic, []).append(name)
        rows[topic] = rows.get(topic, 0) + n
    return {topic: sorted(names) for topic, names in sorted(topics.items())}, rows
