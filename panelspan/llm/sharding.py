"""Sharding by histogram sort: shards of near equal bytes, cut from one sorted order.

Rows are ordered by a hash of the text, then a hash of the key and the rest of the row, so
equal texts lie next to each other and the order does not depend on partitions. Rows that
are equal in all columns share a place; where a boundary falls among them, or they are very
many, they are numbered, and the number cuts them.
Candidate boundaries are the prefixes of that 128-bit order. One pass counts the exact
bytes and rows of every prefix of the first digit; each further pass counts the next
digit below those prefixes alone that a splitter still has to be found in. A splitter
is done when a boundary lies within the tolerance of its target. Then rows move once,
to the piece of their shard that holds their place in the order.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspan.llm.frames import contents, deal_copies, pack, unpack
from panelspan.sinks.scratch import staged

WORD = 64
LOWEST = -(1 << 63)
DIGIT = 8
ROW_BYTES = 8
PIECE_BYTES = 64 * 1024 * 1024
FEWEST_BITS, MOST_BITS = 8, 16
#: How far a boundary may lie from its target, as a share of a shard's bytes.
TOLERANCE = 0.001


@dataclass
class Splitter:
    """A boundary being searched for, inside the prefix of ``depth`` bits."""

    target: float
    below: int
    prefix: int = 0
    depth: int = 0
    #: The first place behind it, and how many of the rows at that place are before it.
    cut: tuple[int, int] | None = None


def shard_documents(
    docs: DataFrame,
    shards: int,
    text: str = "text",
    key: str = "doc_id",
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """Each row with ``size`` (UTF-8 bytes of the text, plus 8), ``shard`` and ``slot``.

    Shards differ from the mean by at most ``tolerance`` of it at each end, or by as much
    as the row at that end makes unavoidable. Rows of equal text stay in one shard where
    that keeps within the tolerance; else their group is cut. Slots count from 0 in each
    shard, without gaps, in the sorted order.

    A null text has no bytes and sorts as an empty one; a null key is a key like others.
    Equal rows are told apart by number, so any group of rows can be cut; of a very large
    group slots follow those of rows near it. With fewer rows than shards some shards are
    empty; an empty table gives no rows. Input columns named ``size``,
    ``shard`` or ``slot`` are replaced.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    spark = docs.sparkSession
    packed = pack(docs, text=text, key=key)
    placeable = _ordered(packed.withColumn("rest", contents(packed.drop("text", "key"))))
    order = staged(placeable.select("k1", "k2", "size"))
    total, rows = order.agg(F.sum("size"), F.count(F.lit(1))).first()
    bits = _bits(total or 0)
    limit = max(rows >> bits, 1)
    cuts = find_splitters(order, shards, total or 0, bits, tolerance)
    hot = _hot_texts(order, limit)
    lookup = _lookup(spark, cuts, hot, bits)
    groups = {cut for cut, inside in cuts if inside} | _large_groups(order, hot, limit)
    listed = [(_signed(g >> WORD), _signed(g & ((1 << WORD) - 1))) for g in sorted(groups)]

    def placed(frame: DataFrame) -> DataFrame:
        return _placed(_numbered(frame, listed, limit), lookup, bits)

    piece = ["shard", "r1", "segment", "part", "run"]
    pieces = placed(order).groupBy(*piece).agg(F.count(F.lit(1)).alias("n"))
    starts = pieces.withColumn(
        "start",
        F.expr(
            "sum(n) OVER (PARTITION BY shard ORDER BY r1, segment, part, run "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n"
        ),
    ).drop("n")
    numbered = placed(placeable).join(F.broadcast(starts), piece).withColumn(
        "slot",
        F.expr(
            "start + row_number() OVER "
            f"(PARTITION BY {', '.join(piece)} ORDER BY k1, k2, occurrence) - 1"
        ),
    )
    return unpack(
        numbered, docs.columns, size=F.col("size"), shard=F.col("shard"), slot=F.col("slot")
    )


def _ordered(docs: DataFrame) -> DataFrame:
    content = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumns(
        {
            "k1": F.xxhash64(content),
            "k2": F.xxhash64(
                F.lit("row"), F.col("key").cast("string"), F.col("rest")
            ),
            "size": F.octet_length(content).cast("long") + ROW_BYTES,
        }
    ).drop("text", "key", "rest")


def _bits(total: int) -> int:
    """Bits of the first digit: about one piece for each PIECE_BYTES, in fixed bounds."""
    wanted = math.ceil(math.log2(max(1, total / PIECE_BYTES)))
    return min(MOST_BITS, max(FEWEST_BITS, wanted))


def _top(word: str, bits: int) -> Column:
    """The first bits of a hash in unsigned order (the order of the signed value)."""
    return F.shiftrightunsigned(F.col(word).bitwiseXOR(F.lit(LOWEST)), WORD - bits)


def _signed(unsigned: int) -> int:
    return unsigned + LOWEST


def find_splitters(
    order: DataFrame, shards: int, total: int, bits: int, tolerance: float
) -> list[tuple[int, int]]:
    """The first 128-bit place of each shard but the first, in ascending order, and how many
    of the rows at that place belong to the shards before.

    Each pass brings at most (shards - 1) * 256 counts to the driver, the first 2 ** bits.
    """
    mean = total / shards
    splitters = [Splitter(mean * i, 0) for i in range(1, shards)]
    depth, width = 0, bits
    while open_ones := [s for s in splitters if s.cut is None]:
        counts = _histogram(order, {s.prefix for s in open_ones}, depth, width)
        depth += width
        for splitter in open_ones:
            _refine(splitter, counts.get(splitter.prefix, []), depth, width, mean * tolerance)
        width = min(DIGIT, WORD - depth % WORD)
    cuts, last = [], (0, 0)
    for splitter in splitters:
        last = max(last, splitter.cut)
        cuts.append(last)
    return cuts


def _histogram(
    order: DataFrame, prefixes: set[int], depth: int, width: int
) -> dict[int, list[tuple[int, int, int]]]:
    """Bytes and rows of each value of the next digit below each of the prefixes."""
    first = depth < WORD
    word, done = ("k1", depth) if first else ("k2", depth - WORD)
    digit = _top(word, done + width).bitwiseAND(F.lit((1 << width) - 1))
    if depth == 0:
        inside, prefix = F.lit(True), F.lit("0")
    elif first:
        prefix = _top("k1", depth).cast("string")
        inside = prefix.isin([str(p) for p in prefixes])
    else:
        text_of = F.col("k1").cast("string")
        prefix = F.concat_ws(":", text_of, _top("k2", done).cast("string")) if done else text_of
        named = {_name(p, done): p for p in prefixes}
        inside = prefix.isin(list(named))
    found = (
        order.filter(inside)
        .groupBy(prefix.alias("prefix"), digit.alias("digit"))
        .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
        .collect()
    )
    counts: dict[int, list[tuple[int, int, int]]] = {}
    for row in found:
        at = named[row["prefix"]] if depth >= WORD else int(row["prefix"])
        counts.setdefault(at, []).append((row["digit"], row["bytes"], row["rows"]))
    return {at: sorted(values) for at, values in counts.items()}


def _name(prefix: int, done: int) -> str:
    text_of = str(_signed(prefix >> done))
    return f"{text_of}:{prefix & ((1 << done) - 1)}" if done else text_of


def _refine(splitter: Splitter, digits, depth: int, width: int, allowed: float) -> None:
    """Move a splitter into the digit that holds its target, or settle it at a boundary."""
    below = splitter.below
    for value, size, rows in digits:
        if below + size < splitter.target:
            below += size
            continue
        prefix = (splitter.prefix << width) + value
        before, after = splitter.target - below, below + size - splitter.target
        if min(before, after) <= allowed or rows == 1:
            ahead = prefix if before <= after else prefix + 1
            splitter.cut = ahead << (2 * WORD - depth), 0
        elif depth == 2 * WORD:
            # Rows at one place are equal, and so of one size.
            splitter.cut = prefix, round(before / (size / rows))
        else:
            splitter.prefix, splitter.depth, splitter.below = prefix, depth, below
        return
    splitter.cut = 1 << (2 * WORD), 0


def _hot_texts(order: DataFrame, limit: int) -> dict[int, int]:
    """Texts with more rows than the limit, and how many bits of the row hash split each.

    At most rows / limit texts can have so many.
    """
    counted = order.groupBy("k1").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit)
    return {row["k1"]: math.ceil(math.log2(row["n"] / limit)) for row in counted.collect()}


def _large_groups(order: DataFrame, hot: dict[int, int], limit: int) -> set[int]:
    """The places that more rows than the limit share, of which there are rows / limit."""
    if not hot:
        return set()
    listed = order.sparkSession.createDataFrame([(k,) for k in hot], "k1 long")
    counted = (
        order.join(F.broadcast(listed), "k1")
        .groupBy("k1", "k2")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > limit)
    )
    return {((r["k1"] - LOWEST) << WORD) + r["k2"] - LOWEST for r in counted.collect()}


def _numbered(rows: DataFrame, groups: list[tuple[int, int]], limit: int) -> DataFrame:
    """Rows with ``occurrence`` among equal ones and ``run``, its block; both matter only in
    the given groups, whose rows alone are moved for it."""
    if not groups:
        return rows.withColumns({"occurrence": F.lit(1).cast("long"), "run": F.lit(0).cast("long")})
    listed = F.broadcast(rows.sparkSession.createDataFrame(groups, "k1 long, k2 long"))
    once = rows.join(listed, ["k1", "k2"], "left_anti").select(*rows.columns)
    repeated = rows.join(listed, ["k1", "k2"], "left_semi").select(*rows.columns)
    dealt = deal_copies(repeated, ["k1", "k2"])
    every = once.withColumn("occurrence", F.lit(1).cast("long")).unionByName(dealt)
    return every.withColumn("run", F.expr(f"(occurrence - 1) div {limit}"))


def _lookup(spark: SparkSession, cuts: list[tuple[int, int]], hot: dict[int, int], bits: int) -> DataFrame:
    """For each first digit: the shard it begins in, the cuts inside it, its hot texts.

    It has 2 ** bits rows, with one entry for each cut and hot text.
    """
    room = 2 * WORD - bits
    inside: dict[int, list] = {}
    for cut, before in cuts:
        inside.setdefault(cut >> room, []).append((cut, before))
    hot_at: dict[int, list] = {}
    for text_of, parts in sorted(hot.items()):
        hot_at.setdefault((text_of - LOWEST) >> (WORD - bits), []).append((text_of, parts))
    rows, begun, low = [], 0, (1 << WORD) - 1
    for value in range(1 << bits):
        here = inside.get(value, [])
        rows.append(
            (
                value,
                begun,
                [(_signed(cut >> WORD), _signed(cut & low), before) for cut, before in here],
                hot_at.get(value, []),
            )
        )
        begun += len(here)
    return spark.createDataFrame(
        rows,
        "r1 long, base int, cuts array<struct<c1 long, c2 long, c3 long>>, "
        "hot array<struct<k1 long, parts int>>",
    )


def _placed(rows: DataFrame, lookup: DataFrame, bits: int) -> DataFrame:
    """Shard of each row, and the piece of the shard that it belongs to.

    A piece is a first digit; a hot text in it is a segment of its own, split further by
    the row hash. Pieces sort as the rows in them.
    """
    return (
        rows.withColumn("r1", _top("k1", bits))
        .join(F.broadcast(lookup), "r1")
        .withColumns(
            {
                "shard": F.expr(
                    "base + size(filter(cuts, c -> k1 > c.c1 OR (k1 = c.c1 AND"
                    " (k2 > c.c2 OR (k2 = c.c2 AND occurrence > c.c3)))))"
                ),
                "own": F.expr("get(filter(hot, h -> h.k1 = k1), 0).parts"),
                "segment": F.expr(
                    "2 * size(filter(hot, h -> h.k1 < k1))"
                    " + IF(exists(hot, h -> h.k1 = k1), 1, 0)"
                ),
            }
        )
        .withColumn(
            "part",
            F.expr(
                f"IF(coalesce(own, 0) = 0, 0L,"
                f" shiftrightunsigned(k2 ^ CAST('{LOWEST}' AS LONG), {WORD} - own))"
            ),
        )
        .drop("base", "cuts", "hot", "own")
    )
