"""Mixing sources to target weights by Poisson replication.

Each source gets a repetition rate: its share of the wanted rows over the rows it has.
A document's number of copies is drawn from the Poisson distribution with that mean, by
inverting the distribution at a number hashed from the seed, the row's contents and its
number among equal rows, so it does not depend on partitions, order or retries, and rows
without a key, or with the same one, are drawn each on their own. Copies are then dealt to
partitions by a hash of their own and sorted by it: a global shuffle that needs no sampling.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspan.llm.frames import contents, number_copies, pack, pick, unpack
from panelspan.operators.lookup import fits_broadcast, lookup
from panelspan.sinks.scratch import staged

#: A rate above this is drawn as a sum of independent draws of equal smaller rates.
LARGEST_DRAW = 32
UNIT_HEX, UNIT = 13, float(1 << 52)


def source_rates(
    docs: DataFrame,
    weights: Mapping[str, float] | None,
    temper: float,
    rows: int | None,
    source: str = "source",
) -> DataFrame:
    """One row per source: ``name``, ``n``, ``rate``, ``draws`` and ``cdf`` of one draw.

    ``cdf[k]`` is the probability of at most k copies. It ends where the remaining
    probability is below what the hash can resolve.
    """
    counts = staged(
        pick(docs, source=source)
        .groupBy(_name("source").alias("name"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if weights is None:
        weighted = counts.withColumn("weight", F.pow(F.col("n"), F.lit(float(temper))))
    else:
        if any(w < 0 for w in weights.values()):
            raise ValueError("Weights cannot be negative")
        given = docs.sparkSession.createDataFrame(
            [(_named(k), float(w)) for k, w in weights.items()], "name string, weight double"
        )
        weighted = counts.join(given, "name", "left").withColumn(
            "weight", F.coalesce("weight", F.lit(0.0))
        )
    all_weight, all_rows = weighted.agg(F.sum("weight"), F.sum("n")).first()
    wanted = float((all_rows or 0) if rows is None else rows)
    rates = (
        weighted.withColumn(
            "rate", F.col("weight") / F.lit(all_weight or 1.0) * F.lit(wanted) / F.col("n")
        )
        .withColumn("draws", F.greatest(F.ceil(F.col("rate") / LARGEST_DRAW), F.lit(1)))
        .withColumn("mean", F.col("rate") / F.col("draws"))
    )
    return rates.select("name", "n", "rate", "draws", _poisson_cdf().alias("cdf"))


def _poisson_cdf() -> Column:
    step = (
        "struct(s.p * mean / k AS p, s.c + s.p * mean / k AS c,"
        " concat(s.cdf, array(s.c + s.p * mean / k)) AS cdf)"
    )
    return F.expr(
        "aggregate(sequence(1, CAST(ceil(mean + 12 * sqrt(mean) + 20) AS INT)),"
        " struct(exp(-mean) AS p, exp(-mean) AS c, array(exp(-mean)) AS cdf),"
        f" (s, k) -> {step}, s -> s.cdf)"
    )


def _name(column: str) -> Column:
    """Null apart from every text."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def _named(value: str | None) -> str:
    return "" if value is None else f"={value}"


def _hashed(*parts: Column) -> Column:
    """The first 52 bits of an MD5, as a long."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]))
    return F.conv(F.substring(digest, 1, UNIT_HEX), 16, 10).cast("long")


def poisson_mix(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    temper: float = 0.5,
    rows: int | None = None,
    seed: int = 0,
    source: str = "source",
) -> DataFrame:
    """The rows repeated to the target weights, in shuffled order.

    ``weights`` gives each source's share of the result (any positive scale; a source
    that is not named gets none); without it a source weighs its rows to the power
    ``temper``. ``rows`` is the expected size of the result, as many as there are by
    default. Each row gets ``copies`` (how often it occurs in the result), ``copy`` (from
    1) and ``shuffle_key``, by which partitions are dealt and sorted.

    A null source is a source like others (named None in ``weights``). Every row is drawn
    on its own, equal rows by their number. An empty table, or weights that are all 0, give
    no rows. Input columns of the added names are replaced.
    """
    rates = source_rates(docs, weights, temper, rows, source).select("name", "draws", "cdf")
    small = fits_broadcast(rates)
    packed = pack(docs, source=source)
    drawn = (
        lookup(
            number_copies(packed, contents(packed.drop("source"))).withColumn(
                "name", _name("source")
            ),
            rates, "name", "inner", small, spread_by=["identity", "occurrence"],
        )
        .withColumn("copies", _copies(seed))
        .filter("copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .withColumn(
            "shuffle_key",
            _hashed(F.lit(seed), F.col("identity"), F.col("occurrence"), F.col("copy")),
        )
    )
    order = ("shuffle_key", "identity", "occurrence", "copy")
    mixed = drawn.repartition("shuffle_key").sortWithinPartitions(*order)
    added = {name: F.col(name) for name in ("copies", "copy", "shuffle_key")}
    return unpack(mixed, docs.columns, **added)


def _copies(seed: int) -> Column:
    """Sum over a document's draws of the least k whose cdf is above the hashed number."""
    digest = f"md5(concat_ws('|', '{seed}', identity, occurrence, 'draw', i))"
    unit = f"CAST(conv(substr({digest}, 1, {UNIT_HEX}), 16, 10) AS DOUBLE) / {UNIT}D"
    draw = f"transform(array({unit}), u -> size(filter(cdf, c -> c <= u)))[0]"
    return F.expr(
        f"aggregate(sequence(1, CAST(draws AS INT)), 0L, (n, i) -> n + CAST({draw} AS LONG))"
    )


MIX_ORACLE = """
WITH named AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY identity) AS occurrence, identity
  FROM (
    SELECT *, md5(concat_ws('|', coalesce(md5(doc_id::VARCHAR), '-'), coalesce(md5(text), '-'),
                            coalesce(md5(lang), '-'), coalesce(md5(source), '-'),
                            coalesce(md5(n_chars::VARCHAR), '-'))) AS identity
    FROM documents
  )
),
n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rate AS (
  SELECT source, pow(n, 0.5) / (SELECT sum(pow(n, 0.5)) FROM n)
         * (SELECT sum(n) FROM n) / n AS rate
  FROM n
),
cut AS (
  SELECT source, k, ceil(rate / 32) AS draws,
         sum(exp(-rate / ceil(rate / 32) + k * ln(rate / ceil(rate / 32)) - lgamma(k + 1)))
           OVER (PARTITION BY source ORDER BY k) AS cdf
  FROM rate, (SELECT unnest(range(0, 140)) AS k)
),
draw AS (
  SELECT d.*, i, ('0x' || substr(md5('17|' || identity || '|' || occurrence || '|draw|' || i),
                                 1, 13))::BIGINT / 4503599627370496.0 AS u
  FROM named d
  JOIN (SELECT source, unnest(range(1, draws::BIGINT + 1)) AS i FROM cut WHERE k = 0) c
    ON c.source IS NOT DISTINCT FROM d.source
),
drawn AS (
  SELECT doc_id, source, identity, occurrence, sum(copies)::BIGINT AS copies
  FROM (
    SELECT doc_id, draw.source, identity, occurrence, i, count(*) FILTER (cdf <= u) AS copies
    FROM draw JOIN cut ON cut.source IS NOT DISTINCT FROM draw.source
    GROUP BY ALL
  ) GROUP BY ALL
),
copied AS (
  SELECT *, unnest(range(1, copies + 1)) AS copy FROM drawn
)
SELECT doc_id, source, copies, copy,
       ('0x' || substr(md5('17|' || identity || '|' || occurrence || '|' || copy), 1, 13))::BIGINT
         AS shuffle_key
FROM copied
"""
