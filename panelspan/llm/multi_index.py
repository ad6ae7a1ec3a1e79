"""Approximate nearest neighbours by an inverted multi-index.

Each vector is cut in two halves, and each half is quantised by a codebook of its own, so
two codebooks of K make K * K cells. A query sorts the centroids of each half by
distance and visits pairs in order of summed distance, by a heap, until the cells visited
hold their share of all vectors; everything in them is scored on the original vectors.

The largest inner product is made the smallest distance by one more coordinate, which
brings all vectors to the same length. Codebooks are fitted on a bounded sample. The same
sample gives each query a score that its last neighbour reaches at least, so cells whose
vectors cannot reach it, by their centroids, radii and lengths, are never visited, without
any loss. Of the others so many are visited as the sample's own queries needed.
Vectors lie in bands of length, each with codebooks of its own: where few long
vectors win, the bands of the many short ones drop out as a whole.
The index itself holds every vector.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspan.llm.frames import pick
from panelspan.sinks.scratch import staged

#: The sample goes to the driver: so many vectors, of so many components in all.
FIT_VECTORS = 20_000
FIT_COMPONENTS = 4_000_000
FIT_QUERIES = 512
#: Sampled vectors that every query is scored with, for a bound on its last neighbour.
FLOOR_VECTORS = 4096
ROUNDS = 12
#: Centroids of a half, in all bands together by the root of their squares.
MOST_CENTROIDS = 512
#: Lengths in one band differ by less than this factor, but for the last band.
BAND_RATIO, MOST_BANDS = 1.5, 8
#: Of the sample's queries, the part that sees the wanted part of their neighbours; each
#: of them sees LEAST_SEEN of its own.
CERTAIN, LEAST_SEEN = 0.9, 0.85
#: Entries that share one list of queries, and entries or queries scored in one group.
GROUP, BLOCK = 2048, 8192
STRIP = 256
MERGES = 64


@dataclass(frozen=True)
class Codebooks:
    """Centroids of both halves, band after band; the second half ends with the coordinate
    that is added. ``first_of`` and ``second_of`` say where each band's begin."""

    first: np.ndarray
    second: np.ndarray
    first_of: list[int]
    second_of: list[int]
    bands: np.ndarray
    longest: float
    share: float

    @property
    def cut(self) -> int:
        return self.first.shape[1]

    def grids(self) -> list[tuple[slice, slice]]:
        """The centroids of each band, which make its cells."""
        pairs = zip(self.first_of, self.first_of[1:], self.second_of, self.second_of[1:])
        return [(slice(a, b), slice(c, d)) for a, b, c, d in pairs]

    def codes(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lifted = _lifted(vectors, self.longest)
        band = np.searchsorted(self.bands, _bands(vectors, self.longest))
        band = np.minimum(band, len(self.bands) - 1)
        i, j = np.zeros(len(vectors), np.int64), np.zeros(len(vectors), np.int64)
        for b, (firsts, seconds) in enumerate(self.grids()):
            rows = np.flatnonzero(band == b)
            if len(rows):
                one, two = lifted[rows, : self.cut], lifted[rows, self.cut :]
                i[rows] = firsts.start + _distances(one, self.first[firsts]).argmin(axis=1)
                j[rows] = seconds.start + _distances(two, self.second[seconds]).argmin(axis=1)
        return i, j

    def query_distances(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lifted = np.column_stack([queries, np.zeros(len(queries))])
        return (
            _distances(lifted[:, : self.cut], self.first),
            _distances(lifted[:, self.cut :], self.second),
        )


def _lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", vectors, vectors))


def _lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with the coordinate that brings them to the longest one's length."""
    rest = longest**2 - np.einsum("ij,ij->i", vectors, vectors)
    return np.column_stack([vectors, np.sqrt(np.maximum(rest, 0.0))])


def _bands(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Bands of length, the longest vectors first."""
    ratio = longest / np.maximum(_lengths(vectors), 1e-300)
    band = np.floor(np.log(np.maximum(ratio, 1.0)) / np.log(BAND_RATIO) + 1e-9)
    return np.minimum(band, MOST_BANDS - 1).astype(int)


def _distances(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of every row to every centroid."""
    return (
        np.einsum("ij,ij->i", rows, rows)[:, None]
        - 2.0 * rows @ centroids.T
        + np.einsum("ij,ij->i", centroids, centroids)[None, :]
    )


def _kmeans(rows: np.ndarray, k: int) -> np.ndarray:
    random = np.random.default_rng(0)
    centroids = rows[random.choice(len(rows), k, replace=False)].copy()
    for _ in range(ROUNDS):
        nearest = _distances(rows, centroids).argmin(axis=1)
        counts = np.bincount(nearest, minlength=k)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, rows)
        full = counts > 0
        centroids[full] = sums[full] / counts[full, None]
        if not full.all():
            centroids[~full] = rows[random.choice(len(rows), int((~full).sum()))]
    return centroids


def visit(grids: list[tuple[np.ndarray, np.ndarray, np.ndarray]], wanted: int) -> float:
    """Cells in order of summed distance, until they hold the wanted vectors.

    A grid has the distances of both halves and the vectors of each cell that count. Returns
    the largest sum visited. The heap holds, for every first centroid that was begun, its
    next pair; a first centroid is begun when the one before it was visited.
    """
    sides, heap = [], []
    for g, (first, second, counts) in enumerate(grids):
        by_first, by_second = first.argsort(kind="stable"), second.argsort(kind="stable")
        near, far = first[by_first].tolist(), second[by_second].tolist()
        sides.append((near, far, counts[np.ix_(by_first, by_second)].tolist()))
        heap.append((near[0] + far[0], g, 0, 0))
    heapq.heapify(heap)
    total, reach = 0, -np.inf
    while heap and total < wanted:
        reach, g, r, s = heap[0]
        near, far, held = sides[g]
        total += held[r][s]
        if s + 1 < len(far):
            heapq.heapreplace(heap, (near[r] + far[s + 1], g, r, s + 1))
        else:
            heapq.heappop(heap)
        if s == 0 and r + 1 < len(near):
            heapq.heappush(heap, (near[r + 1] + far[0], g, r + 1, 0))
    return reach


@dataclass(frozen=True)
class Cells:
    """How many vectors each cell holds, and the length of its longest."""

    counts: np.ndarray
    longest: np.ndarray

    def grids(self, books: Codebooks, first, second, length: float, floor: float) -> list:
        """For ``visit``: cells whose longest vector cannot reach the floor count nothing."""
        found = []
        for firsts, seconds in books.grids():
            reached = self.longest[firsts, seconds] * length >= floor - 1e-9 * abs(floor)
            counts = np.where(reached, self.counts[firsts, seconds], 0)
            found.append((first[firsts], second[seconds], counts))
        return found


def fit(
    sample: np.ndarray, rows: int, longest: float, neighbours: int, recall: float
) -> Codebooks:
    """Codebooks for so many rows, and the share of them to visit."""
    cut = sample.shape[1] // 2
    lifted, band = _lifted(sample, longest), _bands(sample, longest)
    firsts, seconds = [], []
    bands = np.unique(band)
    for b in bands:
        own = lifted[band == b]
        part = len(own) / len(sample)
        k = min(MOST_CENTROIDS * np.sqrt(part), np.sqrt(rows * part) / 3, len(own))
        k = max(1, round(k))
        firsts.append(_kmeans(own[:, :cut], k))
        seconds.append(_kmeans(own[:, cut:], k))
    starts = [0, *np.cumsum([len(c) for c in firsts]).tolist()]
    books = Codebooks(
        np.concatenate(firsts), np.concatenate(seconds), starts, starts, bands, longest, 1.0
    )
    return replace(books, share=_share(books, sample, neighbours, recall))


def _share(books: Codebooks, sample: np.ndarray, neighbours: int, recall: float) -> float:
    """The part of the sample to visit so that its queries see enough of their neighbours.

    Most (``CERTAIN``) see the wanted part of them, and all of them ``LEAST_SEEN``.
    """
    step = max(1, len(sample) // FIT_QUERIES)
    i, j = books.codes(sample)
    wide = len(books.second)
    cells, own, counts = np.unique(i * wide + j, return_inverse=True, return_counts=True)
    length = np.zeros(len(cells))
    np.maximum.at(length, own, _lengths(sample))
    queries = sample[::step]
    first, second = books.query_distances(queries)
    most, least = [], []
    for q, query in enumerate(queries):
        scores = sample @ query
        scores[q * step] = -np.inf
        best = np.argsort(-scores, kind="stable")[: min(neighbours, len(sample) - 1)]
        if not len(best):
            continue
        floor = scores[best[-1]]
        reached = length * np.sqrt(query @ query) >= floor - 1e-9 * abs(floor)
        sums = np.where(reached, first[q][cells // wide] + second[q][cells % wide], np.inf)
        order = np.argsort(sums, kind="stable")
        seen = np.empty(len(order))
        seen[order] = np.cumsum(np.where(reached, counts, 0)[order]) / len(sample)
        needed = np.sort(seen[own[best]])
        most.append(needed[int(np.ceil(recall * len(best))) - 1])
        least.append(needed[int(np.ceil(LEAST_SEEN * len(best))) - 1])
    if not most:
        return 1.0
    return float(max(np.quantile(most, CERTAIN), max(least)))


def nearest(
    vectors: DataFrame,
    queries: str,
    neighbours: int = 20,
    recall: float = 0.95,
    vector: str = "embedding",
    key: str = "vec_id",
) -> DataFrame:
    """For each query (rows where the SQL condition on the column ``id`` holds) the nearest
    others.

    Returns ``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``, the inner product of
    the original vectors in double precision; ties go to the smaller id. A query has fewer
    rows only if there are fewer other vectors.

    Vectors that are null, empty or zero, or hold null or non-finite components, take no
    part; nor do those of another length than most have, nor rows with a null id. Rows that
    repeat an id count once, with the smallest of their vectors. ``recall`` is the part of
    the true neighbours that the visited share found on the sample.
    """
    spark = vectors.sparkSession
    whole = _valid(pick(vectors, id=key, vector=vector))
    rows = staged(whole.groupBy("id").agg(F.min("vector").alias("vector")))
    lengths = rows.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), "size").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if most is None or most["n"] < 2:
        return spark.createDataFrame([], schema)
    size, n = most["size"], most["n"]
    rows = rows.filter(F.size("vector") == size)
    longest = rows.agg(
        F.max(F.expr("sqrt(aggregate(vector, 0D, (s, x) -> s + x * x))"))
    ).first()[0]
    taken = max(2, min(FIT_VECTORS, FIT_COMPONENTS // size))
    drawn = rows.orderBy(F.xxhash64("id"), "id").limit(taken).collect()
    sample = np.array([row["vector"] for row in drawn])
    books = fit(sample, n, longest, neighbours, recall)
    index = staged(rows.mapInArrow(_coded(books), "id long, i int, j int, length double, items binary"))
    held = index.groupBy("i", "j").agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("length"))
    shape = (len(books.first), len(books.second))
    cells = Cells(np.zeros(shape, np.int64), np.zeros(shape))
    for cell in held.collect():
        cells.counts[cell["i"], cell["j"]] = cell["n"]
        cells.longest[cell["i"], cell["j"]] = cell["length"]
    # Neighbouring first centroids with few entries are one group, so queries are copied less.
    sizes = cells.counts.sum(axis=1)
    group = (np.cumsum(sizes) - sizes) // GROUP
    e_parts = np.maximum(1, -(-np.bincount(group, sizes).astype(int) // BLOCK))
    known = [row["id"] for row in drawn[:FLOOR_VECTORS]], sample[:FLOOR_VECTORS]
    wanted = int(max(neighbours + 1, np.ceil(books.share * n)))
    probing = _probing(books, cells, group, known, neighbours, wanted)
    probes = staged(
        index.filter(queries)
        .select("id", "items")
        .mapInArrow(probing, "id long, g int, reach double, items binary")
    )
    # One row for each group, of which there are no more than first centroids.
    parts = probes.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("q_parts"))
    listed = spark.createDataFrame(
        [(int(g), int(e_parts[g])) for g in np.unique(group)], "g int, e_parts long"
    )
    parts = F.broadcast(parts.join(F.broadcast(listed), "g"))
    grouped = spark.createDataFrame(
        [(i, int(g)) for i, g in enumerate(group)], "i int, g int"
    )
    placed = index.drop("length").join(F.broadcast(grouped), "i")
    entries = _dealt(placed.join(parts, "g"), "e_parts", "e_part", "q_parts", "q_part")
    asking = _dealt(probes.join(parts, "g"), "q_parts", "q_part", "e_parts", "e_part")
    by = ["g", "e_part", "q_part"]
    found = (
        asking.groupBy(by)
        .cogroup(entries.groupBy(by))
        .applyInPandas(
            _scored(books, neighbours),
            "query_id long, merge int, best array<struct<less: double, id: long>>",
        )
    )
    best = F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, neighbours).alias("best")
    # A query that visits very many blocks has its lists merged in two steps.
    merged = found.groupBy("query_id", "merge").agg(best).groupBy("query_id").agg(best)
    return merged.select("query_id", F.posexplode("best").alias("place", "x")).select(
        "query_id",
        (F.col("place") + 1).alias("rank"),
        F.col("x.id").alias("vec_id"),
        (-F.col("x.less")).alias("score"),
    )


def _valid(rows: DataFrame) -> DataFrame:
    usable = (
        "id IS NOT NULL AND vector IS NOT NULL AND size(vector) > 0"
        " AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
        " AND exists(vector, x -> x <> 0)"
    )
    wide = rows.select(
        F.col("id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector")
    )
    return wide.filter(usable)


def _dealt(rows: DataFrame, own: str, own_part: str, other: str, other_part: str) -> DataFrame:
    """Rows dealt to one part of their side, copied for every part of the other."""
    return (
        rows.withColumn(own_part, F.pmod(F.xxhash64("id"), F.col(own)).cast("int"))
        .withColumn(other_part, F.explode(F.sequence(F.lit(0), (F.col(other) - 1).cast("int"))))
        .drop(own, other)
    )


def _matrix(items: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(items), np.float64).reshape(len(items), -1)


def _coded(books: Codebooks):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            vectors = flat.reshape(batch.num_rows, -1)
            i, j = books.codes(vectors)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(i, pa.int32()),
                    pa.array(j, pa.int32()),
                    pa.array(_lengths(vectors), pa.float64()),
                    pa.array([v.tobytes() for v in vectors], pa.binary()),
                ],
                names=["id", "i", "j", "length", "items"],
            )

    return code


def _probing(books: Codebooks, cells: Cells, group: np.ndarray, known, neighbours: int, wanted: int):
    """For each query, the groups of cells it visits and how far its visit goes.

    The slack is above the rounding of distances, whose terms are of this size.
    """
    slack = 1e-9 * books.longest**2
    known_ids, known_vectors = np.array(known[0], np.int64), known[1]

    def floors(ids: np.ndarray, queries: np.ndarray) -> np.ndarray:
        """A score that as many others as are wanted reach, among those that are known."""
        scores = queries @ known_vectors.T
        scores[ids[:, None] == known_ids[None, :]] = -np.inf
        if scores.shape[1] < neighbours:
            return np.full(len(ids), -np.inf)
        return np.partition(scores, -neighbours, axis=1)[:, -neighbours]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, items = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(ids), STRIP):
                strip = items[at : at + STRIP]
                queries = _matrix(strip)
                first, second = books.query_distances(queries)
                least = np.array(floors(np.array(ids[at : at + STRIP]), queries))
                lengths = _lengths(queries)
                out: list[tuple] = []
                for q, item in enumerate(strip):
                    floor = least[q] if np.isfinite(least[q]) else -np.finfo(float).max
                    grids = cells.grids(books, first[q], second[q], lengths[q], floor)
                    reach = visit(grids, wanted) + slack
                    visited = [
                        group[firsts][one + two.min() <= reach]
                        for (firsts, _), (one, two, _) in zip(books.grids(), grids)
                    ]
                    for g in np.unique(np.concatenate(visited)).tolist():
                        out.append((ids[at + q], g, reach, item))
                kinds = (pa.int64(), pa.int32(), pa.float64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                    names=["id", "g", "reach", "items"],
                )

    return probe


def _scored(books: Codebooks, neighbours: int):
    """The best of one block of entries for each query that visits it."""

    def score(asking: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(asking) and len(entries):
            entries = entries.sort_values("id")
            ids = entries["id"].to_numpy()
            i, j = entries["i"].to_numpy(), entries["j"].to_numpy()
            vectors = _matrix(entries["items"].tolist())
            merge = int(entries["g"].iloc[0] + entries["e_part"].iloc[0]) % MERGES
            for at in range(0, len(asking), STRIP):
                strip = asking.iloc[at : at + STRIP]
                queries = _matrix(strip["items"].tolist())
                first, second = books.query_distances(queries)
                rough = queries @ vectors.T
                beyond = first[:, i] + second[:, j] > strip["reach"].to_numpy()[:, None]
                rough[beyond] = -np.inf
                rough[strip["id"].to_numpy()[:, None] == ids[None, :]] = -np.inf
                for q, asked in enumerate(strip["id"].tolist()):
                    best = _best(queries[q], vectors, ids, rough[q], neighbours)
                    out.append((asked, merge, best))
        return pd.DataFrame(out, columns=["query_id", "merge", "best"])

    return score


def _best(query, vectors, ids, rough, neighbours) -> list[dict]:
    """The best entries in exact order: equal vectors get equal scores, whatever the block."""
    kept = np.flatnonzero(rough > -np.inf)
    if len(kept) > neighbours:
        least = np.partition(rough[kept], len(kept) - neighbours)[len(kept) - neighbours]
        kept = kept[rough[kept] >= least - 1e-9 * max(1.0, abs(least))]
    exact = np.einsum("ij,j->i", vectors[kept], query)
    order = np.lexsort((ids[kept], -exact))[:neighbours]
    return [
        {"less": -float(s), "id": int(v)}
        for s, v in zip(exact[order], ids[kept][order], strict=True)
    ]
