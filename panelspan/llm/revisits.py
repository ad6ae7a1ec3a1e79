"""WARC revisits: what a "not modified" record stands for.

A revisit has no payload. It is joined, as of its time, with the latest earlier full
response of the same canonical URL; if their validators agree, the payload is that
response's, and the headers are its own, updated with those that a 304 may change.

The as-of join is a window over light rows (times and validators); payloads join last,
by record. A URL with very many records is cut into blocks of time, and each block is
told the last full response before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspan.llm.frames import broadcast_if_small, pick
from panelspan.operators.lookup import fits_broadcast, lookup
from panelspan.sinks.scratch import staged

# Header fields that a 304 response may update, and tracking parameters.
PERMITTED = (
    "age", "cache-control", "content-location", "date", "etag", "expires", "last-modified",
    "vary",
)
TRACKING = r"^(utm_[^=]*|gclid|fbclid)(=|$)"

HOT_URL_ROWS = 1_000_000
MOST_BLOCKS = 1024


def canonical_url(url: Column) -> Column:
    """Host, path and query without what does not change the page.

    Scheme, ``www.``, default port, fragment, trailing slashes and tracking parameters go;
    the host is in lower case, parameters are sorted.
    """
    bare = F.regexp_replace(F.trim(url), r"(?s)#.*$", "")
    bare = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    shape = r"(?s)^([^/?]*)([^?]*)\??(.*)$"
    host = F.lower(F.regexp_extract(bare, shape, 1))
    host = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, shape, 2), r"/+$", "")
    kept = F.filter(
        F.split(F.regexp_extract(bare, shape, 3), "&"),
        lambda p: (p != "") & ~p.rlike(TRACKING),
    )
    query = F.array_join(F.array_sort(kept), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def lower_headers(headers: str) -> str:
    """SQL of a header map with names in lower case; of equal names the last one counts."""
    entries = (
        f"transform(map_entries(coalesce({headers}, CAST(map() AS MAP<STRING, STRING>))),"
        " e -> struct(lower(trim(e.key)) AS key, e.value AS value))"
    )
    return (
        f"transform(array({entries}), a -> map_from_entries(filter(a, (x, i) ->"
        " NOT exists(slice(a, i + 2, size(a)), y -> y.key = x.key))))[0]"
    )


def resolve_revisits(
    records: DataFrame,
    record_id: str = "record_id",
    url: str = "url",
    time: str = "time",
    status: str = "status",
    headers: str = "headers",
    payload: str = "payload",
    hot_rows: int = HOT_URL_ROWS,
) -> DataFrame:
    """One row per revisit (status 304): ``record_id``, ``canonical_url``, ``time``,
    ``response_id``, ``outcome``, ``headers`` and ``payload``.

    Full responses have status 200. The response is the latest with a smaller time; of
    equal times the larger id counts as later. Outcomes: ``resolved``;
    ``no_response`` (none is earlier, or URL or time is null); ``mismatch`` (the
    validators differ: ETags by weak comparison if both have one, else Last-Modified);
    ``no_validator`` (they have none in common). Unresolved revisits keep their own headers
    and have a null payload; ``response_id`` names the response that was looked at.

    Records with another or no status are neither. A full response without an id is no
    response. Of responses that share an id one counts: that of the least time (null last),
    then of the least digest of payload, URL and headers; the others are not looked at.
    Repeated revisits, and those without an id, give a row each. Null headers are no
    headers. Only responses that resolve a revisit are read for their payload.
    """
    picked = pick(
        records, record_id=record_id, url=url, time=time, status=status,
        headers=headers, payload=payload,
    ).withColumns(
        {"headers": F.expr(lower_headers("headers")), "url": canonical_url(F.col("url"))}
    )
    picked = picked.filter(F.col("status").isin(200, 304)).withColumn("body", _body())
    light = staged(
        picked.select(
            "record_id",
            "url",
            "time",
            (F.col("status") == 200).alias("full"),
            "body",
            F.when(F.col("status") == 304, F.col("headers")).alias("headers"),
            F.expr("regexp_replace(headers['etag'], '^W/', '')").alias("etag"),
            F.expr("trim(headers['last-modified'])").alias("modified"),
        )
    )
    chosen = _chosen(light)
    seen = staged(
        _as_of(_without_others(light, chosen), hot_rows).select(
            "record_id",
            "url",
            "time",
            "headers",
            F.col("found.record_id").alias("response_id"),
            _outcome().alias("outcome"),
        )
    )
    resolved = seen.filter(RESOLVED)
    wanted = resolved.select("response_id").distinct()
    responses = picked.filter("status = 200").select(
        "record_id", "body", F.col("headers").alias("stored"), "payload",
        F.lit(True).alias("full"),
    )
    bodies = _without_others(responses, chosen).select(
        F.col("record_id").alias("response_id"), "stored", "payload"
    )
    # What no revisit stands for does not move, where the list of wanted ids is small.
    bodies = _once(bodies.join(broadcast_if_small(wanted), "response_id", "left_semi"), chosen)
    permitted = ", ".join(f"'{name}'" for name in PERMITTED)
    merged = F.expr(
        f"map_concat(map_filter(stored, (k, v) -> NOT (k IN ({permitted}) AND"
        " map_contains_key(headers, k))),"
        f" map_filter(headers, (k, v) -> k IN ({permitted})))"
    )
    joined = lookup(
        resolved, bodies, "response_id", "inner", False, spread_by=["record_id", "time"]
    )
    kept = ["record_id", F.col("url").alias("canonical_url"), "time", "response_id", "outcome"]
    none = F.lit(None).cast(bodies.schema["payload"].dataType).alias("payload")
    # Unresolved revisits have no part in the join.
    return joined.select(*kept, merged.alias("headers"), "payload").union(
        seen.filter(f"NOT ({RESOLVED})").select(*kept, "headers", none)
    )


RESOLVED = "outcome = 'resolved'"


def _body() -> Column:
    """What tells two full responses of one id apart, in the order in which one is chosen."""
    listed = F.expr("to_json(array_sort(map_entries(headers)))")
    digests = [F.md5(F.col("payload").cast("binary")), F.md5(F.col("url")), F.md5(listed)]
    digests = [F.coalesce(d, F.lit("-")) for d in digests]
    return F.when(F.col("status") == 200, F.concat_ws(" ", *digests))


def _chosen(light: DataFrame) -> DataFrame:
    """The one time and body that counts, of each id that several full responses have."""
    full = light.filter("full AND record_id IS NOT NULL")
    least = F.min(F.struct(F.col("time").isNull().alias("last"), "time", "body"))
    return staged(
        full.groupBy("record_id")
        .agg(F.count(F.lit(1)).alias("n"), least.alias("least"))
        .filter("n > 1")
        .select("record_id", F.col("least.body").alias("counts"), F.lit(True).alias("full"))
    )


def _without_others(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows without those full responses that another of the same id stands for."""
    if chosen.isEmpty():
        return rows
    marked = lookup(
        rows.withColumn("chosen_for", F.when(F.col("full"), F.col("record_id"))),
        chosen.select(F.col("record_id").alias("chosen_for"), "counts"),
        "chosen_for",
        "left",
        fits_broadcast(chosen),
        spread_by=["body"],
    )
    return marked.filter("counts IS NULL OR counts = body").drop("chosen_for", "counts")


def _once(bodies: DataFrame, chosen: DataFrame) -> DataFrame:
    """Each response once: equal copies of one that repeats are told by id alone."""
    if chosen.isEmpty():
        return bodies
    again = broadcast_if_small(chosen.select(F.col("record_id").alias("response_id")))
    repeated = bodies.join(again, "response_id", "left_semi").dropDuplicates(["response_id"])
    return bodies.join(again, "response_id", "left_anti").union(repeated)


def _as_of(light: DataFrame, hot_rows: int) -> DataFrame:
    """Each revisit with ``found``, the latest earlier full response of its URL."""
    full = F.when(
        F.col("full")
        & F.col("url").isNotNull()
        & F.col("time").isNotNull()
        & F.col("record_id").isNotNull(),
        F.struct("time", "record_id", "etag", "modified"),
    )
    # A null URL is no URL: such rows stay apart from each other.
    apart = F.coalesce("url", F.concat_ws(" ", F.lit(""), F.col("record_id").cast("string")))
    rows = light.withColumns({"response": full, "group": apart})
    rows = _blocks(rows, hot_rows)
    inside = rows.withColumn(
        "found",
        F.expr(
            "last(response, true) OVER (PARTITION BY group, block"
            " ORDER BY time, full, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        ),
    ).filter(~F.col("full"))
    if "carried" in rows.columns:
        inside = inside.withColumn("found", F.coalesce("found", "carried"))
    return inside


def _blocks(rows: DataFrame, hot_rows: int) -> DataFrame:
    """Rows of URLs with more than ``hot_rows`` records in blocks of time, others in one."""
    hot = staged(
        rows.filter("url IS NOT NULL")
        .groupBy("group")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > hot_rows)
    )
    most = hot.agg(F.max("n")).first()[0]
    if most is None:
        return rows.withColumn("block", F.lit(0))
    blocks = min(MOST_BLOCKS, -(-most // hot_rows) * 2)
    shares = [i / blocks for i in range(1, blocks)]
    # At most rows / hot_rows URLs are hot, each with a bounded list of cuts.
    cuts = staged(
        rows.join(broadcast_if_small(hot), "group")
        .groupBy("group")
        .agg(F.percentile_approx("time", shares, 10_000).alias("cuts"))
    )
    placed = rows.join(broadcast_if_small(cuts), "group", "left").withColumn(
        "block", F.expr("coalesce(size(filter(cuts, c -> c <= time)), 0)")
    ).withColumn("block", F.expr("greatest(block, 0)"))
    last = (
        placed.filter("cuts IS NOT NULL")
        .groupBy("group", "block")
        .agg(F.max("response").alias("last"))
    )
    carried = staged(last.select(
        "group",
        "block",
        F.expr(
            "last(last, true) OVER (PARTITION BY group ORDER BY block"
            " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        ).alias("carried"),
    ))
    return placed.drop("cuts").join(broadcast_if_small(carried), ["group", "block"], "left")


def _outcome() -> Column:
    return F.expr(
        "CASE WHEN found IS NULL THEN 'no_response'"
        " WHEN etag IS NOT NULL AND found.etag IS NOT NULL"
        " THEN IF(etag = found.etag, 'resolved', 'mismatch')"
        " WHEN modified IS NOT NULL AND found.modified IS NOT NULL"
        " THEN IF(modified = found.modified, 'resolved', 'mismatch')"
        " ELSE 'no_validator' END"
    )


_CANONICAL = r"""
  regexp_replace(regexp_replace(lower(regexp_extract(bare, '(?s)^([^/?]*)([^?]*)\??(.*)$', 1)),
                                '^www\.', ''), ':(80|443)$', '')
  || regexp_replace(regexp_extract(bare, '(?s)^([^/?]*)([^?]*)\??(.*)$', 2), '/+$', '')
  || CASE WHEN q = '' THEN '' ELSE '?' || q END
"""

REVISIT_ORACLE = rf"""
WITH p AS (
  SELECT page_id, md5(html) AS digest, {_CANONICAL} AS url
  FROM (
    SELECT *, array_to_string(list_sort(list_filter(string_split(
             regexp_extract(bare, '(?s)^([^/?]*)([^?]*)\??(.*)$', 3), '&'),
             lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|gclid|fbclid)(=|$)'))),
             '&') AS q
    FROM (SELECT page_id, html, regexp_replace(regexp_replace(trim(url), '(?s)#.*$', ''),
                 '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM pages)
  )
),
r AS (
  SELECT page_id * 2 AS record_id, url, page_id * 10 AS time, digest,
         CASE WHEN page_id % 13 <> 0 THEN digest END AS etag, 'v' || (page_id % 5) AS modified
  FROM p WHERE page_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY page_id
            ORDER BY coalesce(digest, '-'), coalesce(md5(url), '-')) = 1
),
v AS (
  SELECT row_number() OVER () AS place, page_id * 2 + 1 AS record_id, url,
         CASE WHEN page_id % 17 = 0 THEN page_id * 10 - 5 ELSE page_id * 10 + 20000 END AS time,
         CASE WHEN page_id % 11 = 0 THEN 'changed' WHEN page_id % 7 <> 0 THEN digest END AS etag,
         CASE WHEN page_id % 19 <> 0 THEN 'v' || (page_id % 5) END AS modified
  FROM p
),
j AS (
  SELECT v.*, r.record_id AS response_id, r.etag AS r_etag, r.modified AS r_modified, r.digest,
         row_number() OVER (PARTITION BY v.place ORDER BY r.time DESC, r.record_id DESC) AS n
  FROM v LEFT JOIN r ON r.url = v.url AND r.time < v.time
),
o AS (
  SELECT *, CASE WHEN response_id IS NULL THEN 'no_response'
         WHEN etag IS NOT NULL AND r_etag IS NOT NULL
         THEN CASE WHEN etag = r_etag THEN 'resolved' ELSE 'mismatch' END
         WHEN modified IS NOT NULL AND r_modified IS NOT NULL
         THEN CASE WHEN modified = r_modified THEN 'resolved' ELSE 'mismatch' END
         ELSE 'no_validator' END AS outcome
  FROM j WHERE n = 1
)
SELECT record_id, url AS canonical_url, response_id, outcome,
       CASE WHEN outcome = 'resolved' THEN digest END AS payload_md5,
       CASE WHEN outcome = 'resolved' THEN 'text/html' END AS content_type,
       'revisit-' || ((record_id - 1) // 2) AS date
FROM o
"""
