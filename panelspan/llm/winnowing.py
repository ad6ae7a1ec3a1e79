"""Benchmark decontamination by winnowing.

A text's fingerprints are the least hashes of k words in every window of so many k-grams
as make up the shared length. Two texts that share that many words in a row share the
window, and so its least hash: no shared span can be missed. Documents meet the
benchmark on fingerprints alone; a hit is then extended to the windows it stands for,
which are compared word by word.

Benchmark items shorter than the shared length are one window each. Their fingerprints
are taken with windows of that item's length, so the guarantee holds for them as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspan.llm.frames import broadcast_if_small, pack, pick, unpack
from panelspan.llm.wording import grams, windowed_least, words
from panelspan.operators.lookup import fits_broadcast
from panelspan.sinks.scratch import staged

GRAM = 5
SHARED_WORDS = 10


def _fingerprints(length: int) -> str:
    """SQL of the fingerprint of every window of ``length`` words, from array ``hashes``."""
    size = min(GRAM, length)
    return windowed_least(f"grams_{size}", length - size + 1)


def _with_grams(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """Rows with ``words`` and the k-gram hashes that the lengths need."""
    hashed = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    for size in sorted({min(GRAM, length) for length in lengths}):
        hashed = hashed.withColumn(f"grams_{size}", F.expr(grams("hashes", size)))
    return hashed


def _marked_windows(length: int) -> str:
    """SQL of all windows of ``length`` words, as structs with their fingerprint."""
    return (
        f"IF(size(words) < {length},"
        " CAST(array() AS ARRAY<STRUCT<start INT, length INT, phrase STRING, mark BIGINT>>),"
        f" transform({_fingerprints(length)}, (mark, i) -> struct(i AS start, {length} AS length,"
        f" array_join(slice(words, i + 1, {length}), ' ') AS phrase, mark AS mark)))"
    )


def _runs(length: int) -> str:
    """SQL of the runs of windows that follow each other and have one fingerprint, as structs."""
    begins = (
        "filter(transform(m, (mark, i) -> struct(mark AS mark, i AS start)),"
        " x -> x.start = 0 OR m[x.start - 1] <> x.mark)"
    )
    ended = (
        "transform(s, (x, j) -> struct(x.mark AS mark, x.start AS start,"
        f" IF(j + 1 < size(s), s[j + 1].start, size(m)) AS stop, {length} AS length))"
    )
    return (
        f"transform(array({_fingerprints(length)}), m -> transform(array({begins}),"
        f" s -> {ended})[0])[0]"
    )


def benchmark_windows(
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    shared: int = SHARED_WORDS,
    unnamed: bool = False,
) -> DataFrame:
    """Every distinct window of the benchmark: ``phrase``, ``length``, ``mark``, ``items``.

    Rows without an id are left out, unless ``unnamed``: then null is an item like others.
    """
    rows = pick(benchmark, text=text, item=item).select(
        F.col("item").cast("string").alias("item"), words(F.col("text")).alias("words")
    )
    rows = rows.filter(F.size("words") > 0)
    rows = staged(rows if unnamed else rows.filter(F.col("item").isNotNull()))
    length = F.least(F.size("words"), F.lit(shared))
    lengths = [r[0] for r in rows.select(length).distinct().collect()]
    if not lengths:
        schema = "phrase string, length int, mark bigint, items array<string>"
        return benchmark.sparkSession.createDataFrame([], schema)
    own = ", ".join(f"IF({value} = length, {_marked_windows(value)}, null)" for value in lengths)
    return (
        _with_grams(rows.withColumn("length", length), lengths)
        .select("item", F.explode(F.expr(f"coalesce({own})")).alias("w"))
        .groupBy("w.phrase", "w.length", "w.mark")
        .agg(F.collect_set(F.struct("item")).alias("items"))
        .withColumn("items", F.sort_array(F.col("items.item")))
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    item_text: str = "text",
    item: str = "item_id",
    shared: int = SHARED_WORDS,
    unnamed: bool = False,
) -> DataFrame:
    """Per document: ``key``, ``text_hash``, ``n_words``, ``spans`` and ``items``.

    ``spans`` are the merged word ranges (start, end exclusive) that occur in the
    benchmark, ``items`` the sorted ids, as text, of the items with a window there.

    A null or empty text has no words; a null key is a key like others. Rows that repeat
    key and text give one row, rows that repeat the key alone one row for each text.
    Benchmark rows without words are left out. So are those without an id, unless ``unnamed``:
    then their windows count, and ``items`` has a null for them. An empty benchmark hits
    nothing.
    """
    bench = staged(benchmark_windows(benchmark, item_text, item, shared, unnamed))
    lengths = sorted(r[0] for r in bench.select("length").distinct().collect())
    rows = pick(docs, key=key, text=text).withColumn(
        "text_hash", F.xxhash64(F.coalesce("text", F.lit("")))
    )
    if not lengths:
        none = "CAST(array() AS ARRAY<STRUCT<start INT, end INT>>)"
        return rows.select(
            "key", "text_hash",
            F.size(words(F.col("text"))).cast("long").alias("n_words"),
            F.expr(none).alias("spans"), F.expr("CAST(array() AS ARRAY<STRING>)").alias("items"),
        ).distinct()
    found = staged(_marked(rows, bench, lengths))
    hit = _extended(rows, found.filter("size(marks) > 0"), bench, lengths)
    same = found["key"].eqNullSafe(hit["hit_key"]) & (found["text_hash"] == hit["hit_hash"])
    return found.join(hit, same, "left").select(
        "key",
        "text_hash",
        "n_words",
        F.expr("coalesce(spans, array())").alias("spans"),
        F.expr("coalesce(items, array())").alias("items"),
    )


def _marked(rows: DataFrame, bench: DataFrame, lengths: list[int]) -> DataFrame:
    """Each document once, with the fingerprints it shares with the benchmark."""
    marks = bench.select("mark").distinct().withColumn("known", F.lit(True))
    if fits_broadcast(marks):
        marks = F.broadcast(marks)
    each = ", ".join(_fingerprints(length) for length in lengths)
    return (
        _with_grams(rows.withColumn("words", words(F.col("text"))), lengths)
        .select(
            "key",
            "text_hash",
            F.size("words").cast("long").alias("n_words"),
            F.explode_outer(F.expr(f"array_distinct(concat({each}))")).alias("mark"),
        )
        .join(marks, "mark", "left")
        .groupBy("key", "text_hash", "n_words")
        .agg(F.collect_set(F.when(F.col("known"), F.col("mark"))).alias("marks"))
    )


def _extended(
    rows: DataFrame, found: DataFrame, bench: DataFrame, lengths: list[int]
) -> DataFrame:
    """Spans and items of the documents that share a fingerprint, compared word by word.

    First the runs of windows with a known fingerprint are found, by a join, then the windows
    of those runs alone are compared: the work grows with the words of a document, whatever
    part of it is shared. Items join last, once for each set of them that a document has.
    """
    wanted = found.select(F.col("key").alias("hit_key"), F.col("text_hash").alias("hit_hash"))
    runs = ", ".join(_runs(length) for length in lengths)
    placed = staged(
        _with_grams(_chosen(rows, wanted), lengths)
        .select("hit_key", "hit_hash", F.expr(f"inline(concat({runs}))"))
        .join(broadcast_if_small(bench.select("mark").distinct()), "mark", "left_semi")
        .groupBy("hit_key", "hit_hash")
        .agg(F.collect_set(F.struct("start", "stop", "length")).alias("runs"))
    )
    windows = (
        "flatten(transform(runs, r -> transform(sequence(r.start, r.stop - 1), i -> struct("
        "i AS start, r.length AS length,"
        " array_join(slice(words, i + 1, r.length), ' ') AS phrase))))"
    )
    phrases = bench.select("phrase", F.md5(F.to_json("items")).alias("set"))
    hits = staged(
        _chosen(rows, placed)
        .select("hit_key", "hit_hash", F.expr(f"inline({windows})"))
        .join(broadcast_if_small(phrases), "phrase")
        .groupBy("hit_key", "hit_hash")
        .agg(
            F.collect_set(F.expr("struct(start, start + length AS end)")).alias("at"),
            F.collect_set("set").alias("sets"),
        )
        .withColumn("hit", F.expr(_COVERED))
        .select("hit_key", "hit_hash", F.expr(_MERGED).alias("spans"), "sets")
    )
    sets = bench.select(F.md5(F.to_json("items")).alias("set"), "items").dropDuplicates(["set"])
    listed = (
        hits.select("hit_key", "hit_hash", F.explode("sets").alias("set"))
        .join(broadcast_if_small(sets), "set")
        .groupBy(F.col("hit_key").alias("of_key"), F.col("hit_hash").alias("of_hash"))
        .agg(F.collect_set("items").alias("items"))
        .withColumn("items", F.sort_array(F.array_distinct(F.flatten("items"))))
    )
    same = F.col("hit_key").eqNullSafe(F.col("of_key")) & (F.col("hit_hash") == F.col("of_hash"))
    return hits.join(listed, same).select("hit_key", "hit_hash", "spans", "items")


def _chosen(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The words of the documents in a list, which has a row for each."""
    same = F.col("key").eqNullSafe(F.col("hit_key")) & (F.col("text_hash") == F.col("hit_hash"))
    return rows.join(broadcast_if_small(wanted), same).withColumn("words", words(F.col("text")))


#: Word positions in a window, each once, as ranges without gaps.
_COVERED = "sort_array(array_distinct(flatten(transform(at, x -> sequence(x.start, x.end - 1)))))"
_MERGED = """
zip_with(
  filter(hit, (p, i) -> IF(i = 0, true, hit[i - 1] <> p - 1)),
  filter(hit, (p, i) -> IF(i = size(hit) - 1, true, hit[i + 1] <> p + 1)),
  (first, last) -> struct(first AS start, last + 1 AS end))
"""


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    shared: int = SHARED_WORDS,
) -> DataFrame:
    """The rows whose text holds no window of the benchmark, unchanged.

    Windows of benchmark rows without an id count like others.
    """
    dirty = (
        contamination(docs, benchmark, text, key, shared=shared, unnamed=True)
        .filter("size(spans) > 0")
        .select(F.col("key").alias("dirty_key"), F.col("text_hash").alias("dirty_hash"))
    )
    dirty = staged(dirty)
    if fits_broadcast(dirty):
        dirty = F.broadcast(dirty)
    rows = pack(docs, key=key, text=text).withColumn(
        "text_hash", F.xxhash64(F.coalesce("text", F.lit("")))
    )
    same = F.col("key").eqNullSafe(F.col("dirty_key")) & (
        F.col("text_hash") == F.col("dirty_hash")
    )
    return unpack(rows.join(dirty, same, "left_anti"), docs.columns)


WINNOWING_ORACLE = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM (SELECT DISTINCT doc_id, text FROM documents)
),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
),
bw AS (
  SELECT DISTINCT item_id, l, array_to_string(w[i:i + l - 1], ' ') AS phrase
  FROM (SELECT item_id, w, l, unnest(range(1, len(w) - l + 2)) AS i
        FROM (SELECT *, least(10, len(w)) AS l FROM b WHERE len(w) > 0))
),
dw AS (
  SELECT doc_id, i, l, array_to_string(w[i:i + l - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i
        FROM d, (SELECT DISTINCT l FROM bw) WHERE len(w) >= l)
),
hit AS (SELECT doc_id, i, dw.l, item_id FROM dw JOIN bw USING (phrase, l)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM hit) GROUP BY doc_id
),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""
