"""URL filters: rules for hosts and paths, and a character model for what no rule names.

The URLs that rules accept and those that they reject are the two training sets. Each
gives a variable-order Markov model of characters: the longest context that its set has
seen often enough predicts, smoothed by the shorter ones (Witten-Bell). A URL's score is the
difference of its log-likelihoods under both, by character. The threshold is calibrated
on scores from models that have not counted the URL.

Everything is counting, joining and summing of character n-grams. Logarithms are summed as
whole numbers, so the scores do not depend on the order of the rows.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspan.llm.frames import pack, pick, unpack
from panelspan.operators.lookup import fits_broadcast, lookup
from panelspan.sinks.scratch import staged

ALLOW, BLOCK = "allow", "block"
REJECTED, ACCEPTED = 0, 1

#: Characters of the longest context, and how often a context must have been seen.
CONTEXT = 4
LEAST_SEEN = 2
FOLDS = 4
#: What a character has that no context predicts.
UNSEEN = 1 / 65536
#: Log-likelihoods are summed in units of 1 / SCALE, thresholds lie on steps of 1 / STEPS.
SCALE = 1 << 32
STEPS = 256

# They stand before and after a URL.
START, END = "\x02", "\x03"


@dataclass(frozen=True)
class HostRule:
    """``verdict`` for the host and its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the query.
RULES = (
    HostRule(ALLOW, "org", "/"),
    HostRule(BLOCK, "example.org", "/es/"),
    HostRule(BLOCK, "example.org", "/en/1"),
    HostRule(ALLOW, "com", "/fr/"),
    HostRule(BLOCK, "com", "/de/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty for a null URL or one without ``://``."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise("")
    shape = r"(?s)^([^/?#]*)([^?#]*)"
    host = F.translate(
        F.regexp_extract(rest, shape, 1), string.ascii_uppercase, string.ascii_lowercase
    )
    return host, F.regexp_extract(rest, shape, 2)


def rule_of(host: Column, path: Column, rules: Sequence[HostRule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null where none does.

    Of rules of one length the one with the longer host counts, then the blocking one.
    """
    ordered = sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.verdict != BLOCK))
    name = verdict = F.when(F.lit(False), "")
    for rule in ordered:
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name, verdict = name.when(fits, rule.name), verdict.when(fits, rule.verdict)
    return name, verdict


def filter_urls(
    pages: DataFrame,
    rules: Sequence[HostRule] = RULES,
    url: str = "url",
    key: str = "page_id",
    context: int = CONTEXT,
    folds: int = FOLDS,
) -> DataFrame:
    """The rows with ``host``, ``path``, ``rule``, ``score`` and ``verdict``.

    ``rule`` is the longest that fits, or null. ``score`` is above 0 where a URL is more
    like the accepted ones; it is null where a rule decides. Without a rule a URL is blocked
    if its score is below the threshold, which makes the least errors, by share of each
    class, on the URLs that rules decide.

    Repeated URLs are counted once and judged alike. A null or empty URL has no score and is
    allowed, and so is every URL without a rule where the rules accept none or reject none.
    ``key`` only spreads the rows of a URL that very many rows have. An empty table gives
    no rows; input columns of the added names are replaced.
    """
    host, path = host_and_path(F.col("url"))
    judged = pack(pages, url=url, key=key).withColumns({"host": host, "path": path})
    rule, ruled = rule_of(F.col("host"), F.col("path"), rules)
    judged = judged.withColumns({"rule": rule, "ruled": ruled})
    known = judged.filter("url <> ''").groupBy("url").agg(
        F.first("ruled").alias("ruled")
    )
    label = F.when(F.col("ruled") == ALLOW, ACCEPTED).when(F.col("ruled") == BLOCK, REJECTED)
    scores = score_urls(known.select("url", label.alias("label")), context, folds)
    verdicts = scores.filter("label IS NULL").select(
        "url",
        "score",
        F.when(F.col("score") < threshold(scores), BLOCK).otherwise(ALLOW).alias("modelled"),
    )
    joined = lookup(
        judged, verdicts, "url", "left", fits_broadcast(verdicts), spread_by=["key"]
    )
    return unpack(
        joined,
        pages.columns,
        host=F.col("host"),
        path=F.col("path"),
        rule=F.col("rule"),
        score=F.col("score"),
        verdict=F.coalesce("ruled", "modelled", F.lit(ALLOW)),
    )


def score_urls(urls: DataFrame, context: int = CONTEXT, folds: int = FOLDS) -> DataFrame:
    """``url``, ``label`` and ``score`` of distinct URLs (label 1 accepted, 0 rejected, else null).

    URLs without a label are scored by models of all labelled ones, labelled ones by
    models that leave out their fold, which a hash of the URL says. Where a class has no
    URL, scores are null.
    """
    fold = F.when(F.col("label").isNotNull(), _bucket(folds))
    rows = staged(
        pick(urls, url="url", label="label")
        .filter("url <> ''")
        .withColumn("fold", F.coalesce(fold, F.lit(folds)).cast("int"))
    )
    classes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()
    if not {REJECTED, ACCEPTED} <= {r["label"] for r in classes}:
        return rows.select("url", "label", F.lit(None).cast("double").alias("score"))
    grams = rows.select("url", "label", "fold", F.explode(F.expr(_grams(context))).alias("gram"))
    differences = staged(_differences(staged(_counts(grams, folds)), context, folds))
    found = lookup(
        grams, differences, "gram", "inner", fits_broadcast(differences), spread_by=["url"]
    )
    by_url = found.groupBy("url").agg(
        F.first("label").alias("label"),
        F.sum(F.expr("differences[fold]")).alias("total"),
        F.count(F.lit(1)).alias("n"),
    )
    score = F.col("total") / F.lit(float(SCALE)) / F.col("n")
    return staged(by_url.select("url", "label", score.alias("score")))


def _bucket(folds: int) -> Column:
    """A number below ``folds`` from the URL's MD5."""
    return F.conv(F.substring(F.md5("url"), 1, 8), 16, 10).cast("long") % folds


def _grams(context: int) -> str:
    """Every character with the ``context`` before it, and the end of the URL, as SQL."""
    padded = f"split(concat('{START * context}', url, '{END}'), '')"
    items = ", ".join(f"c[i + {j}]" for j in range(context + 1))
    return (
        f"flatten(transform(array({padded}), c ->"
        f" transform(sequence(0, size(c) - {context + 1}), i -> concat({items}))))"
    )


def _counts(grams: DataFrame, folds: int) -> DataFrame:
    """How often each gram occurs in the labelled URLs, by class and fold."""
    return grams.groupBy("gram").agg(
        *[
            F.count_if((F.col("label") == of) & (F.col("fold") == fold)).alias(f"n{of}_{fold}")
            for of in (REJECTED, ACCEPTED)
            for fold in range(folds)
        ]
    )


def _differences(counts: DataFrame, context: int, folds: int) -> DataFrame:
    """Log-probability of each gram's last character among the accepted URLs less that among
    the rejected, in units of 1 / SCALE: without each fold, then from all."""
    kinds = [(of, left_out) for of in (REJECTED, ACCEPTED) for left_out in range(folds + 1)]
    lower = None
    for order in range(context + 1):
        # Witten-Bell: a context gives as much to the shorter one as it has successors.
        level = counts
        if order < context:
            level = counts.groupBy(F.expr(f"right(gram, {order + 1})").alias("gram")).agg(
                *[F.sum(name).alias(name) for name in counts.columns if name != "gram"]
            )
        before = F.expr(f"left(gram, {order})") if order else F.lit("")
        together = Window.partitionBy("before")
        level = level.select(
            "gram",
            before.alias("before"),
            *[
                sum(F.col(f"n{of}_{fold}") for fold in range(folds) if fold != out).alias(
                    f"n{of}_{out}"
                )
                for of, out in kinds
            ],
        ).select(
            "gram",
            F.expr(f"right(gram, {order})").alias("shorter") if order else F.lit("").alias("shorter"),
            *[f"n{of}_{out}" for of, out in kinds],
            *[
                F.sum(f"n{of}_{out}").over(together).alias(f"all{of}_{out}") for of, out in kinds
            ],
            *[
                F.sum((F.col(f"n{of}_{out}") > 0).cast("long"))
                .over(together)
                .alias(f"next{of}_{out}")
                for of, out in kinds
            ],
        )
        if lower is None:
            level = level.withColumns({f"p{of}_{out}": F.lit(UNSEEN) for of, out in kinds})
        else:
            level = level.join(lower.withColumnRenamed("gram", "shorter"), "shorter")
        lower = level.select(
            "gram",
            *[
                F.expr(
                    f"IF(all{k} >= {LEAST_SEEN}, (n{k} + next{k} * p{k}) / (all{k} + next{k}), p{k})"
                ).alias(f"p{k}")
                for k in (f"{of}_{out}" for of, out in kinds)
            ],
        )
    logs = ", ".join(
        f"CAST(round((ln(p{ACCEPTED}_{out}) - ln(p{REJECTED}_{out})) * {SCALE}D) AS BIGINT)"
        for out in range(folds + 1)
    )
    return lower.select("gram", F.expr(f"array({logs})").alias("differences"))


def threshold(scores: DataFrame) -> float:
    """The score below which a URL is blocked: the least sum of both classes' error shares.

    Of equal ones the nearest to 0. The driver gets one count for each step and class; a
    step is 1 / 256, and no score is beyond some 11, the logarithm of 1 / ``UNSEEN``.
    """
    counted = (
        scores.filter("label IS NOT NULL AND score IS NOT NULL")
        .groupBy("label", F.floor(F.col("score") * STEPS).alias("step"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    of: dict[int, dict[int, int]] = {REJECTED: {}, ACCEPTED: {}}
    for row in counted:
        of[row["label"]][row["step"]] = row["n"]
    if not of[REJECTED] or not of[ACCEPTED]:
        return 0.0
    all_rejected, all_accepted = (sum(of[c].values()) for c in (REJECTED, ACCEPTED))
    steps = {0, *of[REJECTED], *of[ACCEPTED]}
    best, kept, lost = None, all_rejected, 0
    for step in range(min(steps), max(steps) + 2):
        errors = kept * all_accepted + lost * all_rejected
        if best is None or (errors, abs(step)) < best[0]:
            best = (errors, abs(step)), step
        kept -= of[REJECTED].get(step, 0)
        lost += of[ACCEPTED].get(step, 0)
    return best[1] / STEPS


def url_oracle(rules: Sequence[HostRule] = RULES) -> str:
    """DuckDB SQL for the query: the same rules, models and threshold."""
    listed = ", ".join(f"('{r.name}', '{r.verdict}', '{r.host}', '{r.path}')" for r in rules)
    levels = []
    for order in range(CONTEXT + 1):
        joined = f"JOIN p{order - 1} s ON s.gram = right(l.gram, {order}) AND s.k = l.k"
        lower = "s.p" if order else str(UNSEEN)
        levels.append(
            f"""
p{order} AS (
  SELECT l.gram, l.k, CASE WHEN everything >= {LEAST_SEEN}
         THEN (n + followers * {lower}) / (everything + followers) ELSE {lower} END AS p
  FROM (SELECT *, sum(n) OVER w AS everything, count(*) FILTER (n > 0) OVER w AS followers
        FROM (SELECT right(gram, {order + 1}) AS gram, k, sum(n)::DOUBLE AS n
              FROM counted GROUP BY ALL)
        WINDOW w AS (PARTITION BY left(gram, {order}), k)) l {joined if order else ""}
)"""
        )
    return f"""
WITH rules(name, verdict, host, path) AS (VALUES {listed}),
parts AS (
  SELECT page_id, url, translate(regexp_extract(rest, '(?s)^([^/?#]*)([^?#]*)', 1),
           '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
         regexp_extract(rest, '(?s)^([^/?#]*)([^?#]*)', 2) AS path
  FROM (SELECT *, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3)
                  ELSE '' END AS rest FROM pages)
),
fits AS (
  SELECT p.*, r.name AS rule, r.verdict AS ruled
  FROM parts p LEFT JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host))
                                AND starts_with(p.path, r.path)
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(r.name) DESC) = 1
),
known AS (
  SELECT url, any_value(CASE ruled WHEN 'allow' THEN 1 WHEN 'block' THEN 0 END) AS label
  FROM fits WHERE url <> '' GROUP BY url
),
grams AS (
  SELECT url, label, fold, unnest(list_transform(range(1, length(s) - {CONTEXT} + 1),
                                  lambda i: substr(s, i, {CONTEXT + 1}))) AS gram
  FROM (SELECT url, label, repeat(chr(2), {CONTEXT}) || url || chr(3) AS s,
               CASE WHEN label IS NULL THEN {FOLDS}
               ELSE ('0x' || substr(md5(url), 1, 8))::BIGINT % {FOLDS} END AS fold FROM known)
),
counted AS (
  SELECT gram, of * 100 + without AS k,
         count(*) FILTER (label = of AND fold <> without) AS n
  FROM grams, (VALUES (0), (1)) c(of), (SELECT unnest(range({FOLDS + 1})) AS without) f
  GROUP BY gram, k
),{",".join(levels)},
differences AS (
  SELECT r.gram, r.k AS fold, round((ln(a.p) - ln(r.p)) * {SCALE})::BIGINT AS d
  FROM p{CONTEXT} r JOIN p{CONTEXT} a ON a.gram = r.gram AND a.k = r.k + 100
),
scores AS (
  SELECT url, any_value(label) AS label, sum(d)::DOUBLE / {SCALE} / count(*) AS score
  FROM grams JOIN differences USING (gram, fold) GROUP BY url
),
steps AS (
  SELECT floor(score * {STEPS})::BIGINT AS step, label FROM scores WHERE label IS NOT NULL
),
edges AS (
  SELECT unnest(range(least(0, min(step)), greatest(0, max(step)) + 2)) AS edge FROM steps
),
cut AS (
  SELECT edge / {STEPS}.0 AS cut
  FROM edges, steps GROUP BY edge
  ORDER BY count(*) FILTER (label = 0 AND step >= edge)
             * (SELECT count(*) FROM steps WHERE label = 1)
         + count(*) FILTER (label = 1 AND step < edge)
             * (SELECT count(*) FROM steps WHERE label = 0), abs(edge), edge
  LIMIT 1
)
SELECT page_id, host, path, rule,
       coalesce(ruled, CASE WHEN score < (SELECT cut FROM cut) THEN 'block' END,
                'allow') AS verdict
FROM fits LEFT JOIN scores USING (url)
"""
