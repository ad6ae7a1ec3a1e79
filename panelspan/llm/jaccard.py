"""N-gram Jaccard join: documents whose shingle sets are alike, in components.

Equal sets are one class from the start, with one text to stand for it. Classes meet by
prefix filtering, twice. First in the order of the hashes, which needs no counts: two
sets that are alike share some shingles among the first of each, so classes that share
fewer with all others are alike to none and go. For those that stay, shingles are
counted, and the prefix is taken again in order of rareness, where common passages come
last. Pairs that share a rare-first prefix shingle pass the length, positional and suffix
filters and are verified on the whole sets.

Nothing lists all pairs of a group. Each prefix shingle first links its classes with the
one that has least of its own; what that connects is one component. After that, only
pairs of classes that share a prefix shingle and are still in different components are
compared, unless what they share with that one class shows that they cannot be alike.

Shingles travel packed, one row for a chunk of documents and a part of the hash space. A
chunk sends a shingle that many of its documents have once; the few that very many
documents have are listed beforehand and never sent.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspan.llm.components import components
from panelspan.llm.frames import pack, pick, small, unpack
from panelspan.llm.shingles import mixed, shingle_sets
from panelspan.operators.lookup import fits_broadcast, lookup
from panelspan.sinks.scratch import staged

CHUNK_SHINGLES = 1 << 19
CHUNK_SETS = 60_000
PART_SHINGLES = 500_000
PART_BYTES = 16 * 1024 * 1024
#: Parts are powers of two. The upper bound is where a part's bits and a shingle's 40 fill
#: a number: 64 TiB of text, in parts of PART_BYTES.
FEWEST_BITS, MOST_BITS = 5, 22
#: With very many parts a chunk grows with them, so that rows keep some shingles each.
USUAL_BITS, MOST_CHUNK = 14, 1 << 22
ID_BITS = 40
MANY = np.uint16(0xFFFF)
NONE = np.zeros(0, np.int64)
#: One in so many shingles is sent in the first pass beyond those that must hold one.
MORE = 10
LOCAL_HOT = 64
HOT = 4096
#: Classes of one shingle that are compared with each other in one group.
BLOCK = 512
#: Leaders are broadcast up to this; beyond, hot shingles alone are salted.
LEADER_BYTES = 8 * 1024 * 1024
#: Documents without a key to themselves are numbered from here, beyond the usual keys.
OWN_KEYS = 1 << 62
MOST_HOT = 1 << 20
RANGES = 32

DOC, LIKELY, COUNT = -1, -2, -3
SKETCH = "part int, doc long, text_hash long, n long, f1 long, f2 long, payload binary"


@dataclass(frozen=True)
class Rule:
    """Shingles of ``size`` words; alike if 100 * shared >= ``percent`` * all distinct."""

    size: int = 5
    percent: int = 80

    def __post_init__(self) -> None:
        if self.size < 1 or not 0 < self.percent <= 100:
            raise ValueError("size must be positive, percent from 1 to 100")

    def prefix(self, n: int) -> int:
        """How many first shingles of n must hold one that an alike set shares."""
        return n - -(-self.percent * n // 100) + 1

    def first_prefix(self, n: int) -> int:
        """How many of n, in any order, must hold as many of an alike set's first ones as
        :meth:`first_shared` says: the first k they share are among n - least + k of each.
        """
        return self.prefix(n) - 1 + max(1, n // MORE)

    def first_shared(self, n: str) -> Column:
        """An alike set may be smaller, and so send fewer first ones."""
        return F.expr(f"greatest(1, (({n} * {self.percent} + 99) div 100) div {MORE})")


def jaccard_components(
    docs: DataFrame, rule: Rule = Rule(), text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Per row: ``key``, ``text_hash`` (xxhash64 of the text, null as empty), ``n_shingles``
    and ``component``, the smallest key that it is connected with by links, its own included.

    A null text, and one without words, has no shingles and is linked with nothing. Equal
    non-empty sets are linked. A row whose key is null is linked with nothing and has a
    null component. Rows that repeat a key are one document if their texts are equal, else
    documents of their own that share a key. Keys must be whole numbers.
    """
    rows = pick(docs, doc=key, text=text).withColumn("doc", F.col("doc").cast("long"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = _part_bits(size / PART_BYTES)
    hashed = rows.select("doc", "text", _text_hash(F.col("text")))
    sketch = staged(hashed.mapInArrow(_sketcher(rule, bits), SKETCH))
    found = sketch.filter(F.col("part") == DOC)
    classes = staged(
        found.filter("n > 0 AND doc IS NOT NULL")
        .groupBy("n", "f1", "f2")
        .agg(F.min("doc").alias("rep"))
    )
    links = _links(rows, sketch, classes, rule)
    # A class is named by its hash, a component by the smallest key of its classes.
    roots = components(links)
    named = (
        roots.join(classes.select(F.col("f1").alias("node"), "rep"), "node")
        .groupBy("root")
        .agg(F.min("rep").alias("component"))
    )
    joined = roots.join(named, "root").select(F.col("node").alias("f1"), "component")
    best = (
        classes.join(joined, "f1", "left")
        .withColumn("component", F.coalesce("component", "rep"))
        .select("n", "f1", "f2", "component")
    )
    if fits_broadcast(best):
        best = F.broadcast(best)
    else:
        best = best.hint("shuffle_merge")
    return (
        found.join(best, ["n", "f1", "f2"], "left")
        .select(
            F.col("doc").alias("key"),
            "text_hash",
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component"))
            .otherwise(F.col("doc"))
            .alias("component"),
        )
        .withColumn("component", F.when(F.col("key").isNotNull(), F.col("component")))
    )


def drop_near_copies(
    docs: DataFrame, rule: Rule = Rule(), text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """The rows whose key names their component: one document of each stays.

    Rows with a null key stay, as they are linked with nothing; so do documents without
    words. A row that repeats stays as often as it is; of texts that share a key, each stays
    or goes on its own.
    """
    gone = staged(
        jaccard_components(docs, rule, text, key)
        .filter("component <> key")
        .select(F.col("key").alias("gone"), F.col("text_hash").alias("gone_hash"))
        .distinct()
    )
    if fits_broadcast(gone):
        gone = F.broadcast(gone)
    rows = pack(docs, key=key, text=text).select(
        "*", F.col("key").cast("long").alias("number"), _text_hash(F.col("text"))
    )
    same = (F.col("number") == F.col("gone")) & (F.col("text_hash") == F.col("gone_hash"))
    return unpack(rows.join(gone, same, "left_anti"), docs.columns)


def one_of_each(
    docs: DataFrame, rule: Rule = Rule(), text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """One row of each component, whatever keys its rows have or share.

    As :func:`drop_near_copies`, but of rows that repeat key and text one stays, and rows
    with a null key, or one that other texts have too, take part as documents of their own.
    Those stay where no row of their component has a key to itself. Rows that have neither
    words nor a key all stay.
    """
    rows = pack(docs, key=key, text=text).select(
        "*",
        F.col("key").cast("long").alias("number"),
        _text_hash(F.col("text")),
        F.coalesce(F.col("text").rlike(r"\S"), F.lit(False)).alias("worded"),
    )
    pairs = rows.groupBy("number", "text_hash", "worded").agg(F.count(F.lit(1)).alias("n"))
    pairs = staged(pairs.select(F.struct("number", "text_hash").alias("pair"), "worded", "n"))
    pair = F.struct("number", "text_hash")
    again = pairs.filter("n > 1 AND (worded OR pair.number IS NOT NULL)").select("pair")
    shared = (
        pairs.filter("pair.number IS NOT NULL")
        .groupBy(F.col("pair.number").alias("number"))
        .agg(F.count(F.lit(1)).alias("texts"))
        .filter("texts > 1")
        .select("number", F.lit(True).alias("shared"))
    )
    again, shared = (F.broadcast(x) if fits_broadcast(x) else x for x in (again, shared))
    rows = rows.withColumn("pair", pair)
    kept = [c for c in rows.columns if c != "pair"]
    once = rows.join(again, "pair", "left_anti").select(kept)
    first = (
        rows.join(again, "pair", "left_semi")
        .groupBy("pair")
        .agg(F.min_by(F.struct(kept), F.to_json(F.struct(kept))).alias("row"))
        .select("row.*")
    )
    own = F.expr(f"{OWN_KEYS} + (xxhash64(number, text_hash) & {OWN_KEYS - 1})")
    named = once.union(first).join(shared, "number", "left").withColumn(
        "own", F.when(F.col("number").isNull() | F.col("shared"), own).otherwise(F.col("number"))
    )
    return unpack(drop_near_copies(named, rule, "text", "own"), docs.columns)


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash")


def _part_bits(parts: float) -> int:
    """Bits of a power of two of parts."""
    return min(MOST_BITS, max(FEWEST_BITS, math.ceil(math.log2(max(1, parts)))))


def _chunk_shingles(bits: int) -> int:
    """Shingles of a chunk: at least some 32 for each part, up to a bound."""
    return min(MOST_CHUNK, CHUNK_SHINGLES << max(0, bits - USUAL_BITS))


def _cuts(numbers: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each number that occurs, with the places where it does."""
    if not len(numbers):
        return
    order = np.argsort(numbers, kind="stable")
    found, starts = np.unique(numbers[order], return_index=True)
    yield from zip(found.tolist(), np.split(order, starts[1:]), strict=True)


# -- first pass: a fingerprint of every set, and the classes that may be alike to others


def _sketcher(rule: Rule, bits: int):
    most = _chunk_shingles(bits)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: list[np.ndarray] = []
        names: list[int] = []
        held = 0
        for batch in small(batches):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            docs, hashes = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            n, one, two = [], [], []
            for doc, found in zip(docs, shingle_sets(texts, rule.size), strict=True):
                n.append(len(found))
                one.append(int(mixed(found).sum(dtype=np.uint64).view(np.int64)))
                again = mixed(found ^ np.uint64(0x5851F42D4C957F2D))
                two.append(int(again.sum(dtype=np.uint64).view(np.int64)))
                if doc is not None and len(found):
                    sets.append(found)
                    names.append(one[-1])
                    held += len(found)
                if held >= most or len(sets) >= CHUNK_SETS:
                    yield _rows(_first_chunk(sets, names, rule, bits))
                    sets, names, held = [], [], 0
            yield _rows(
                [(DOC, *row, None) for row in zip(docs, hashes, n, one, two, strict=True)]
            )
        if sets:
            yield _rows(_first_chunk(sets, names, rule, bits))

    return sketch


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ["part", "doc", "text_hash", "n", "f1", "f2", "payload"]
    kinds = [pa.int32(), *[pa.int64()] * 5, pa.binary()]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _packed_row(part: int, payload: bytes) -> tuple:
    return (part, None, None, None, None, None, payload)


def _first_chunk(
    sets: list[np.ndarray], names: list[int], rule: Rule, bits: int
) -> list[tuple]:
    """Packed prefixes of a chunk of sets, its own likely classes, its frequent shingles."""
    rows: list[tuple] = []
    table, which = np.unique(np.array(names, np.int64), return_inverse=True)
    _, once = np.unique(which, return_index=True)
    sets = [sets[i] for i in once]
    every, counts = np.unique(np.concatenate(sets), return_counts=True)
    often = counts >= LOCAL_HOT
    if often.any():
        payload = pickle.dumps((every[often].view(np.int64), counts[often].astype(np.int64)))
        rows.append(_packed_row(COUNT, payload))
    prefixes = [s[: rule.first_prefix(len(s))] for s in sets]
    owner = np.repeat(np.arange(len(sets)), [len(p) for p in prefixes]).astype(np.uint16)
    tokens = np.concatenate(prefixes)
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    opens = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
    sizes = np.diff(np.append(opens, len(tokens)))
    shared = sizes > 1
    local, times = np.unique(owner[np.repeat(shared, sizes)], return_counts=True)
    if len(local):
        rows.append(_packed_row(LIKELY, pickle.dumps((table[local], times))))
    tokens, owner = tokens[opens], np.where(shared, MANY, owner[opens])
    for p, here in _cuts((tokens & np.uint64((1 << bits) - 1)).astype(np.int64)):
        rows.append(_packed_row(p, _packed(tokens[here], owner[here], table, bits)))
    return rows


def _packed(tokens: np.ndarray, owner: np.ndarray, table: np.ndarray, bits: int) -> bytes:
    """Shingles as 40-bit numbers above their part's bits, and who has them."""
    used, again = np.unique(owner[owner != MANY], return_inverse=True)
    local = np.full(len(owner), MANY)
    local[owner != MANY] = again.astype(np.uint16)
    numbers = (tokens >> np.uint64(bits)) & np.uint64((1 << ID_BITS) - 1)
    five = numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()
    return pickle.dumps((five, local.tobytes(), table[used].tobytes()))


def _unpacked(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers, their owners' names, and which of them many sets of the chunk have."""
    five, local, table = pickle.loads(payload)
    wide = np.zeros((len(five) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(five, np.uint8).reshape(-1, 5)
    owner = np.frombuffer(local, np.uint16)
    many = owner == MANY
    names = np.append(np.frombuffer(table, np.int64), 0)
    return (
        wide.reshape(-1).view("<u8").astype(np.int64),
        names[np.where(many, len(names) - 1, owner)],
        many,
    )


def _likely(group: pd.DataFrame) -> pd.DataFrame:
    """How many of a class's first shingles other classes have among theirs."""
    numbers, names, many = map(np.concatenate, zip(*map(_unpacked, group["payload"]), strict=True))
    order = np.argsort(numbers, kind="stable")
    numbers, names, many = numbers[order], names[order], many[order]
    opens = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1]))
    sizes = np.diff(np.append(opens, len(numbers)))
    high, low = np.maximum.reduceat(names, opens), np.minimum.reduceat(names, opens)
    shared = (high != low) | np.logical_or.reduceat(many, opens)
    kept = np.repeat(shared, sizes) & ~many
    found, times = np.unique(names[kept], return_counts=True)
    return pd.DataFrame({"f1": found, "times": times})


def _hot_list(sketch: DataFrame, total: int) -> list[tuple[int, int]]:
    """The shingles of very many sets, with counts: at most total / limit of them."""
    limit = max(HOT, total // MOST_HOT)

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column(0).to_pylist():
                tokens, counts = pickle.loads(payload)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens), pa.array(counts)], names=["token", "n"]
                )

    counts = sketch.filter(F.col("part") == COUNT).select("payload")
    summed = (
        counts.mapInArrow(opened, "token long, n long")
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= limit)
    )
    return [(r["token"], r["n"]) for r in summed.collect()]


# -- second pass: counts of the shingles of likely classes, and rare-first prefixes


def _links(rows: DataFrame, sketch: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of classes (a, b) that connect all classes that are alike."""
    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column(0).to_pylist():
                names, times = pickle.loads(payload)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names), pa.array(times)], names=["f1", "times"]
                )

    counted = "f1 long, times long"
    local = sketch.filter(F.col("part") == LIKELY).select("payload").mapInArrow(opened, counted)
    met = (
        sketch.filter(F.col("part") >= 0)
        .select("part", "payload")
        .groupBy("part")
        .applyInPandas(_likely, counted)
    )
    shared = local.union(met).groupBy("f1").agg(F.sum("times").alias("times"))
    likely = staged(
        classes.join(shared, "f1").filter(F.col("times") >= rule.first_shared("n")).drop("times")
    )
    total = likely.agg(F.sum("n")).first()[0] or 0
    prefixes = staged(_prefixes(rows, likely, _hot_list(sketch, total), total, rule))
    first = _verified(rows, likely, staged(_to_leaders(prefixes, rule)), rule)
    first = staged(first)
    linked = components(first.filter("alike").select("a", "b"))
    rest = staged(_across(prefixes, linked, first, rule))
    second = _verified(rows, likely, rest, rule)
    return first.union(second).filter("alike").select("a", "b")


def _texts(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """The text that stands for each class, as (f1, text)."""
    wanted = classes.select(F.col("rep").alias("doc"), "f1")
    if fits_broadcast(wanted):
        wanted = F.broadcast(wanted)
    return rows.join(wanted, "doc").select("f1", "text")


def _prefixes(
    rows: DataFrame, likely: DataFrame, hot: list[tuple[int, int]], total: int, rule: Rule
) -> DataFrame:
    """The rare-first prefix shingles that other classes have too: (token, f1, n, alone,
    place, ranges), where ``alone`` counts the shingles that no other class has.
    """
    bits = _part_bits(total / PART_SHINGLES)
    hot = sorted(hot, key=lambda x: (x[1], x[0]))
    tokens = np.array([x[0] for x in hot], np.int64).view(np.uint64)
    by_token = np.argsort(tokens, kind="stable")
    context = rows.sparkSession.sparkContext
    shared = context.broadcast((tokens[by_token], by_token.astype(np.int64)))
    packs = _texts(rows, likely).mapInArrow(
        _counter(rule, bits, shared), "part int, payload binary"
    )
    answers = packs.groupBy("part").applyInPandas(
        _answer(bits), "bucket int, payload binary"
    )
    return answers.groupBy("bucket").applyInPandas(
        _rare_first(rule), "token long, f1 long, n int, alone int, place int, ranges array<int>"
    )


def _counter(rule: Rule, bits: int, shared):
    most = _chunk_shingles(bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, rank = shared.value
        sets: list[np.ndarray] = []
        names: list[int] = []
        held = 0
        for batch in small(batches):
            expected = batch.column(0).to_pylist()
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for name, found in zip(expected, shingle_sets(texts, rule.size), strict=True):
                # Another text under the same key stands for a class of its own.
                if int(mixed(found).sum(dtype=np.uint64).view(np.int64)) == name:
                    sets.append(found)
                    names.append(name)
                    held += len(found)
                if held >= most or len(sets) >= CHUNK_SETS:
                    yield _second_chunk(sets, names, hot, rank, bits)
                    sets, names, held = [], [], 0
        if sets:
            yield _second_chunk(sets, names, hot, rank, bits)

    return count


def _second_chunk(sets, names, hot, rank, bits) -> pa.RecordBatch:
    """All shingles of a chunk but the hot ones, by part, with what each set has besides."""
    parts = 1 << bits
    low = np.uint64(parts - 1)
    table = np.array(names, np.int64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets]).astype(np.uint16)
    tokens = np.concatenate(sets)
    at = np.minimum(np.searchsorted(hot, tokens), max(len(hot) - 1, 0))
    is_hot = hot[at] == tokens if len(hot) else np.zeros(len(tokens), bool)
    hot_rank = np.split(
        rank[at[is_hot]] if len(hot) else np.zeros(0, np.int64),
        np.cumsum(np.bincount(owner[is_hot], minlength=len(sets)))[:-1],
    )
    sent, owner = tokens[~is_hot], owner[~is_hot]
    home: dict[int, list] = {}
    for i, found in enumerate(sets):
        ranges = np.minimum(
            np.bincount((found >> np.uint64(59)).astype(np.int64), minlength=RANGES), 1 << 30
        )
        mask = np.uint64((1 << (ID_BITS + bits)) - 1)
        ids = (hot[np.isin(hot, found)] if len(hot) else np.zeros(0, np.uint64)) & mask
        ranks = hot_rank[i]
        home.setdefault(names[i] & (parts - 1), []).append(
            (names[i], len(found), ids.astype(np.int64), ranks, ranges.astype(np.int32))
        )
    out = []
    places = dict(_cuts((sent & low).astype(np.int64)))
    for p in sorted(places.keys() | home.keys()):
        here = places.get(p, NONE)
        packed = _packed(sent[here], owner[here], table, bits)
        out.append((p, pickle.dumps((packed, home.get(p, [])))))
    return pa.RecordBatch.from_arrays(
        [pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary())],
        names=["part", "payload"],
    )


def _answer(bits: int):
    """Which of its shingles other classes have as well, and how many, for every class."""
    buckets = 1 << bits

    def answer(group: pd.DataFrame) -> pd.DataFrame:
        part = int(group["part"].iloc[0])
        opened = [pickle.loads(x) for x in group["payload"]]
        numbers, names, _ = map(
            np.concatenate, zip(*(_unpacked(packed) for packed, _ in opened), strict=True)
        )
        order = np.lexsort((names, numbers))
        numbers, names = numbers[order], names[order]
        fresh = np.append(True, (numbers[1:] != numbers[:-1]) | (names[1:] != names[:-1]))
        fresh = fresh[: len(numbers)]
        numbers, names = numbers[fresh], names[fresh]
        opens = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1])[: len(numbers)])
        counts = np.diff(np.append(opens, len(numbers)))
        count = np.repeat(counts, counts)
        kept = count > 1
        level = np.minimum(255, np.round(8 * np.log2(np.maximum(count[kept], 1))))
        tokens, names = (numbers[kept] << bits) | part, names[kept]
        bucket = (names >> 20) & (buckets - 1)
        homes: dict[int, list] = {}
        for _, home in opened:
            for item in home:
                homes.setdefault((item[0] >> 20) & (buckets - 1), []).append(item)
        places = dict(_cuts(bucket))
        rows = []
        for b in sorted(places.keys() | homes.keys()):
            here = places.get(b, NONE)
            by_name = here[np.argsort(names[here], kind="stable")]
            owners, sizes = np.unique(names[by_name], return_counts=True)
            body = (
                owners, sizes, tokens[by_name], level.astype(np.uint8)[by_name],
                homes.get(b, []),
            )
            rows.append((b, pickle.dumps(body)))
        return pd.DataFrame(rows, columns=["bucket", "payload"])

    return answer


def _rare_first(rule: Rule):
    """The shingles in each class's prefix, rarest first, that another class has too."""

    def prefix(group: pd.DataFrame) -> pd.DataFrame:
        names, tokens, levels = [], [], []
        about: dict[int, tuple] = {}
        for payload in group["payload"]:
            owners, sizes, token, level, homes = pickle.loads(payload)
            names.append(np.repeat(owners, sizes))
            tokens.append(token)
            levels.append(level.astype(np.int64))
            for name, n, hot_ids, hot_ranks, ranges in homes:
                if name not in about:
                    about[name] = (n, len(hot_ids), ranges)
                    names.append(np.full(len(hot_ids), name))
                    tokens.append(hot_ids)
                    levels.append(256 + np.asarray(hot_ranks))
        name, token, level = map(np.concatenate, (names, tokens, levels))
        order = np.lexsort((token, level, name))
        name, token = name[order], token[order]
        owners, starts, sizes = np.unique(name, return_index=True, return_counts=True)
        out: list[tuple] = []
        for owner, start, size in zip(owners.tolist(), starts, sizes, strict=True):
            n, _, ranges = about[owner]
            alone = n - size
            for i in range(min(size, rule.prefix(n) - alone)):
                out.append((token[start + i], owner, n, alone, alone + i + 1, ranges.tolist()))
        return pd.DataFrame(out, columns=["token", "f1", "n", "alone", "place", "ranges"])

    return prefix


# -- candidates and verification


def _needed(rule: Rule) -> str:
    """SQL of the least number of shingles that x and y must share."""
    return (
        f"CAST(({rule.percent}L * (x.n + y.n) + {99 + rule.percent}L)"
        f" div {100 + rule.percent}L AS INT)"
    )


def _passes(rule: Rule) -> str:
    """The length, positional and suffix filters of two prefix entries x and y, as SQL.

    Shingles that one of them has alone are in neither's share. The suffix filter cuts the
    hash space in ranges: the sets differ by at least the sum of the differences of their
    counts in each.
    """
    needed = _needed(rule)
    return (
        f"100L * least(x.n, y.n) >= {rule.percent}L * greatest(x.n, y.n)"
        f" AND 1 + least(x.n - x.place, y.n - y.place) >= {needed}"
        f" AND x.n + y.n - x.alone - y.alone >= 2 * {needed}"
        " AND aggregate(zip_with(x.ranges, y.ranges, (p, q) -> abs(p - q)), 0,"
        f" (s, d) -> s + d) <= x.n + y.n - 2 * {needed}"
    )


def _pairs(joined: DataFrame) -> DataFrame:
    """Pairs from entries x and y, each once."""
    return joined.select(
        F.least("x.f1", "y.f1").alias("a"), F.greatest("x.f1", "y.f1").alias("b")
    ).distinct()


def _leaders(prefixes: DataFrame) -> DataFrame:
    """For each shingle that several classes have, the one with the least alone, as ``y``."""
    return (
        prefixes.groupBy("token")
        .agg(
            F.min(F.struct("alone", "f1", "n", "place", "ranges")).alias("y"),
            F.count(F.lit(1)).alias("k"),
        )
        .filter("k > 1")
        .drop("k")
    )


def _with_leaders(entries: DataFrame, leaders: DataFrame) -> DataFrame:
    """Entries with what is known of their token's leader, also where most have one token."""
    small = fits_broadcast(leaders, LEADER_BYTES)
    return lookup(entries, leaders, "token", "inner", small, spread_by=["f1"])


def _to_leaders(prefixes: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of each class with the leader of a prefix shingle."""
    entries = prefixes.select(
        "token", "f1", F.struct("alone", "f1", "n", "place", "ranges").alias("x")
    )
    joined = _with_leaders(entries, staged(_leaders(prefixes)))
    return _pairs(joined.filter(f"x.f1 <> y.f1 AND {_passes(rule)}"))


def _across(
    prefixes: DataFrame, linked: DataFrame, done: DataFrame, rule: Rule
) -> DataFrame:
    """Pairs that share a prefix shingle, are in different components, and not yet done.

    What x and y share is at most what both share with the leader of the shingle, and what
    both have besides that is neither the leader's nor their own alone. ``held`` and
    ``beside`` are these two counts; where the leader was not compared, both are what the
    class does not have alone.
    """
    known = (
        _with_leaders(
            prefixes.join(linked.withColumnRenamed("node", "f1"), "f1", "left"),
            staged(_leaders(prefixes).select("token", F.col("y.f1").alias("leader"))),
        )
        .withColumns(
            {
                "root": F.coalesce("root", "f1"),
                "a": F.least("f1", "leader"),
                "b": F.greatest("f1", "leader"),
            }
        )
        .join(done.select("a", "b", "shared"), ["a", "b"], "left")
        .withColumns(
            {
                "held": F.expr("IF(f1 = leader, n, coalesce(shared, n - alone))"),
                "beside": F.expr("IF(f1 = leader, 0, n - alone - coalesce(shared, 0))"),
            }
        )
        .drop("a", "b", "leader", "shared")
    )
    known = staged(known)
    split = (
        known.groupBy("token")
        .agg(
            F.min("root").alias("low"),
            F.max("root").alias("high"),
            F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"),
        )
        .filter("low <> high")
        .select("token", "blocks")
    )
    open_ones = staged(known.join(split, "token"))
    # The classes of a token are dealt to blocks, and blocks are compared two by two.
    entry = F.struct("f1", "n", "alone", "place", "held", "beside", "root", "ranges")
    own = F.pmod(F.xxhash64("f1"), F.col("blocks")).cast("int")
    every = F.explode(F.expr("sequence(0, blocks - 1)"))
    ones = open_ones.select("token", own.alias("one"), every.alias("two"), entry.alias("x"))
    others = open_ones.select(
        F.col("token").alias("t"), every.alias("o"), own.alias("w"), entry.alias("y")
    )
    pairs = ones.join(
        others,
        F.expr(
            "token = t AND one = o AND two = w AND x.root < y.root"
            f" AND least(x.held, y.held) + least(x.beside, y.beside) >= {_needed(rule)}"
            f" AND {_passes(rule)}"
        ),
    )
    return _pairs(pairs).join(done.select("a", "b"), ["a", "b"], "left_anti")


def _verified(rows: DataFrame, likely: DataFrame, pairs: DataFrame, rule: Rule) -> DataFrame:
    """Pairs with ``alike`` and how many shingles they share, from the whole sets."""
    needed = pairs.select(F.col("a").alias("f1")).union(pairs.select("b")).distinct()
    sets = staged(
        _texts(rows, likely.join(needed, "f1"))
        .mapInArrow(_whole_sets(rule), "f1 long, items binary")
        .dropDuplicates(["f1"])
    )
    both = pairs.join(sets.toDF("a", "items_a"), "a").join(sets.toDF("b", "items_b"), "b")
    return both.mapInArrow(_compare(rule), "a long, b long, alike boolean, shared int")


def _whole_sets(rule: Rule):
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            expected = batch.column(0).to_pylist()
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            names, items = [], []
            for name, found in zip(expected, shingle_sets(texts, rule.size), strict=True):
                if int(mixed(found).sum(dtype=np.uint64).view(np.int64)) == name:
                    names.append(name)
                    items.append(found.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(items, pa.binary())],
                names=["f1", "items"],
            )

    return whole


def _compare(rule: Rule):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            frame = {name: batch.column(name).to_pylist() for name in batch.schema.names}
            alike, counts = [], []
            for x, y in zip(frame["items_a"], frame["items_b"], strict=True):
                one, two = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                shared = len(np.intersect1d(one, two, assume_unique=True))
                alike.append(100 * shared >= rule.percent * (len(one) + len(two) - shared))
                counts.append(shared)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(frame["a"], pa.int64()),
                    pa.array(frame["b"], pa.int64()),
                    pa.array(alike, pa.bool_()),
                    pa.array(counts, pa.int32()),
                ],
                names=["a", "b", "alike", "shared"],
            )

    return compare
