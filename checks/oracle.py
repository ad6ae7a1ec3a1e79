"""The same results as ``checks.queries``, in SQL over the given tables."""

from __future__ import annotations

COLUMNS = "entity_name, entity_code, series_name, series_code, period, value"

# The headers that the derived panels have at every scale.
YEARS = tuple(range(1995, 2002))
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
MAPPED_PRIORITIES = PRIORITIES[:3]
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")

CATALOG_COLUMNS = "id, name, source_id, source, source_organization, topic"


def _raw(source: str) -> str:
    return f"""
    SELECT ' ' || c_name || ' ' AS entity_name,
           CASE WHEN c_custkey % 17 = 0 THEN ''
                WHEN c_custkey % 19 = 0 THEN NULL
                WHEN c_nationkey % 5 = 0 THEN ' wld '
                ELSE 'C' || CAST(c_custkey AS VARCHAR) || ' ' END AS entity_code,
           o_orderpriority AS series_name,
           ' P.' || substr(o_orderpriority, 1, 1) || ' ' AS series_code,
           CAST(y AS VARCHAR) || ' ' AS period,
           CASE WHEN c_custkey % 11 = 0 AND y = 1997 THEN NULL
                WHEN c_custkey % 13 = 0 THEN '  '
                ELSE CAST(CAST(v AS DECIMAL(18, 2)) AS VARCHAR) END AS value
    FROM {source}"""


def _canonical(source: str) -> str:
    return f"""
    SELECT trim(entity_name) AS entity_name, trim(entity_code) AS entity_code,
           trim(series_name) AS series_name, trim(series_code) AS series_code,
           TRY_CAST(trim(CAST(period AS VARCHAR)) AS INTEGER) AS period,
           TRY_CAST(trim(CAST(value AS VARCHAR)) AS DOUBLE) AS value
    FROM {source}"""


def _pairs(source: str) -> str:
    return f"""
    SELECT DISTINCT trim(id) AS series_code, trim(topic) AS topic
    FROM {source}
    WHERE coalesce(trim(id), '') <> '' AND coalesce(trim(topic), '') <> ''"""


def _enriched(panel: str, pairs: str) -> str:
    return f"""
    SELECT p.entity_name, p.entity_code, p.series_name, p.series_code, p.period, p.value, m.topic
    FROM {panel} p JOIN {pairs} m ON p.series_code = m.series_code"""


# Named relations, each built on those before it.
RELATIONS = {
    "order_years": """
    SELECT c_custkey, c_name, c_nationkey, o_orderpriority,
           year(o_orderdate) AS y, o_totalprice AS v
    FROM orders JOIN customer ON o_custkey = c_custkey""",
    "cells": """
    SELECT c_custkey, c_name, c_nationkey, o_orderpriority, y, max(v) AS v
    FROM order_years GROUP BY ALL""",
    "raw_panel": _raw("cells"),
    "raw_repeated": _raw("order_years"),
    "dirty": """
    SELECT entity_name, entity_code,
           CASE WHEN entity_code LIKE 'C%23 ' THEN ' ' ELSE series_name END AS series_name,
           series_code,
           CASE WHEN entity_code LIKE 'C%29 ' THEN 'n/a'
                WHEN entity_code LIKE 'C%37 ' THEN '20231' ELSE period END AS period,
           CASE WHEN entity_code LIKE 'C%31 ' THEN 'abc' ELSE value END AS value
    FROM raw_panel""",
    "judged": """
    SELECT *,
           coalesce(trim(entity_name), '') = '' OR coalesce(trim(series_name), '') = ''
             OR coalesce(trim(series_code), '') = '' AS missing_identifier,
           NOT regexp_matches(coalesce(trim(period), ''), '^[0-9]{4}$') AS invalid_period,
           coalesce(trim(value), '') <> '' AND TRY_CAST(trim(value) AS DOUBLE) IS NULL
             AS non_numeric_value
    FROM dirty""",
    "canonical": _canonical("raw_panel"),
    "repeated": _canonical("raw_repeated"),
    "chosen": """
    SELECT * FROM canonical
    WHERE value IS NOT NULL
      AND upper(trim(coalesce(entity_code, ''))) NOT IN ('', 'WLD', 'EUU')""",
    "topics": """
    SELECT CASE WHEN o_orderstatus = 'O' THEN ' P.' || substr(o_orderpriority, 1, 1) || ' '
                ELSE 'P.' || substr(o_orderpriority, 1, 1) END AS id,
           CASE WHEN o_orderpriority LIKE '1%' THEN 'High'
                WHEN o_orderpriority LIKE '2%' AND o_orderstatus = 'O' THEN ' High '
                WHEN o_orderpriority LIKE '2%' THEN 'High'
                WHEN o_orderpriority LIKE '3%' THEN 'Medium'
                WHEN o_orderpriority LIKE '4%' THEN ' ' END AS topic
    FROM orders
    UNION ALL
    SELECT 'N.' || CAST(n_nationkey AS VARCHAR), n_name FROM nation""",
    "topic_pairs": _pairs("topics"),
    "long": _enriched("chosen", "topic_pairs"),
    "catalog": """
    SELECT CASE WHEN p_partkey % 3 = 0 THEN ' S' || CAST(p_partkey AS VARCHAR) || ' '
                ELSE 'S' || CAST(p_partkey AS VARCHAR) END AS id,
           p_name || ', "' || p_type || '"' || chr(10) AS name,
           CAST(p_size AS VARCHAR) AS source_id,
           p_brand AS source,
           CASE WHEN p_size % 10 = 0 THEN NULL ELSE ' ' || p_brand || ' ' END
             AS source_organization,
           CASE WHEN p_partkey % 13 = 0 THEN ' ' WHEN p_partkey % 17 = 0 THEN NULL
                ELSE p_type END AS topic
    FROM part
    UNION ALL
    SELECT ' S' || CAST(p_partkey AS VARCHAR) || ' ', p_name, CAST(p_size AS VARCHAR), p_brand,
           NULL, ' ' || p_type || ' '
    FROM part WHERE p_size > 25""",
    "catalog_pairs": _pairs("catalog"),
    "sales_topics": """
    SELECT ' S' || CAST(l_partkey AS VARCHAR) AS id,
           CASE WHEN l_quantity >= 49 THEN ' Bulk' ELSE p_brand END AS topic
    FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "sales_pairs": _pairs("sales_topics"),
    "sales_raw": """
    SELECT s_name AS entity_name,
           'E' || CAST(l_suppkey AS VARCHAR) || ' ' AS entity_code,
           'Part ' || CAST(l_partkey AS VARCHAR) AS series_name,
           CASE WHEN l_partkey % 7 = 0 THEN 'U' || CAST(l_partkey AS VARCHAR)
                ELSE ' S' || CAST(l_partkey AS VARCHAR) END AS series_code,
           year(l_shipdate) AS period,
           max(l_extendedprice) AS value
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    GROUP BY s_name, l_suppkey, l_partkey, year(l_shipdate)""",
    "sales": """
    SELECT entity_name, trim(entity_code) AS entity_code, series_name,
           trim(series_code) AS series_code, CAST(period AS INTEGER) AS period, value
    FROM sales_raw""",
    "sales_long": _enriched("sales", "catalog_pairs"),
    "crowded": """
    SELECT * REPLACE (CASE WHEN CAST(substr(entity_code, 2) AS BIGINT) % 3 = 0 THEN 'S1'
                           ELSE series_code END AS series_code) FROM sales""",
    "crowded_long": _enriched("crowded", "catalog_pairs"),
    "days": """
    SELECT 'User ' || CAST(user_id AS VARCHAR) AS user_name,
           CAST(user_id AS VARCHAR) AS user_id,
           event_type, CAST(day(ts) AS INTEGER) AS day, max(value) AS value
    FROM events GROUP BY ALL""",
}


def _needs(sql: str, known: list[str]) -> set[str]:
    words = set(sql.replace("(", " ").replace(")", " ").replace(",", " ").split())
    return {name for name in known if name in words}


def _query(final: str) -> str:
    """The final SELECT with the relations it needs, directly or not, in front of it."""
    names = list(RELATIONS)
    needed = _needs(final, names)
    for name in reversed(names):
        if name in needed:
            needed |= _needs(RELATIONS[name], names[: names.index(name)])
    parts = [f"{name} AS ({RELATIONS[name]})" for name in names if name in needed]
    return f"WITH {', '.join(parts)} {final}" if parts else final


def _wide(panel: str, keys: str, header: str, headers: tuple) -> str:
    literals = [str(h) if isinstance(h, int) else f"'{h}'" for h in headers]
    cells = ", ".join(
        f"max(CASE WHEN {header} = {literal} THEN value END) AS \"{name}\""
        for literal, name in zip(literals, headers)
    )
    return f"SELECT {keys}, {cells} FROM {panel} GROUP BY {keys}"


def _repeated(relation: str, keys: str) -> str:
    return (
        f"SELECT {keys}, count(*) AS row_count FROM {relation} GROUP BY {keys} HAVING count(*) > 1"
    )


ENTITY = "entity_name, entity_code"
SERIES = "series_name, series_code"

LONG = f"SELECT {COLUMNS}, topic FROM long"
SALES_LONG = f"SELECT {COLUMNS}, topic FROM sales_long"
CANONICAL = f"SELECT {COLUMNS} FROM canonical"
CATALOG = f"SELECT {CATALOG_COLUMNS} FROM catalog"
SERIES_WIDE = _wide("long", f"{ENTITY}, period, topic", "series_name", MAPPED_PRIORITIES)
PERIOD_WIDE = _wide("long", f"{ENTITY}, {SERIES}, topic", "period", YEARS)
LISTED_OUT = f"""
    SELECT {COLUMNS} FROM canonical
    WHERE coalesce(trim(entity_code), '') <> ''
      AND upper(trim(entity_code)) NOT IN (
        SELECT 'C' || CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal < 0)"""
USED = f"""
    SELECT trim(id) AS id, name, source_id, source, source_organization, topic FROM catalog
    WHERE trim(id) IN (SELECT series_code FROM sales_long)"""

SALES_CELLS = f"SELECT {ENTITY}, period, topic, series_name, value FROM sales_long"
SALES_PERIODS = _wide("sales_long", f"{ENTITY}, {SERIES}, topic", "period", YEARS)

FINAL = {
    "panel_canonical": CANONICAL,
    "panel_canonical_binary": CANONICAL,
    "panel_scan": CANONICAL,
    "panel_scan_native": """
    SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_suppkey AS VARCHAR) AS l_suppkey,
           CAST(l_partkey AS VARCHAR) AS l_partkey, trim(l_returnflag) AS l_returnflag,
           CAST(l_linenumber AS INTEGER) AS l_linenumber, l_extendedprice
    FROM lineitem WHERE l_extendedprice IS NOT NULL""",
    "dimension_scan": CATALOG,
    "dimension_scan_splits": CATALOG,
    "quality_report": """
    SELECT count(*) AS total_rows,
           count(*) FILTER (WHERE missing_identifier) AS missing_identifier,
           count(*) FILTER (WHERE invalid_period) AS invalid_period,
           count(*) FILTER (WHERE non_numeric_value) AS non_numeric_value
    FROM judged""",
    "rejected_rows": f"""
    SELECT {COLUMNS}, concat_ws(',',
             CASE WHEN missing_identifier THEN 'missing_identifier' END,
             CASE WHEN invalid_period THEN 'invalid_period' END,
             CASE WHEN non_numeric_value THEN 'non_numeric_value' END) AS reasons
    FROM judged WHERE missing_identifier OR invalid_period OR non_numeric_value""",
    "duplicate_keys": _repeated("raw_panel", "series_code, period"),
    "duplicate_cells_series": _repeated("repeated", f"{ENTITY}, period, series_name"),
    "duplicate_cells_period": _repeated("repeated", f"{ENTITY}, {SERIES}, period"),
    "filter_observed": f"SELECT {COLUMNS} FROM canonical WHERE value IS NOT NULL",
    "filter_entities": f"""
    SELECT {COLUMNS} FROM canonical
    WHERE upper(trim(coalesce(entity_code, ''))) NOT IN ('', 'WLD', 'EUU')""",
    "filter_entities_anti": LISTED_OUT,
    "filter_entities_anti_shuffled": LISTED_OUT,
    "dimension_clean": "SELECT series_code, topic FROM catalog_pairs",
    "dimension_conflicts": """
    SELECT series_code, count(*) AS topic_count FROM sales_pairs
    GROUP BY series_code HAVING count(*) > 1""",
    "enrich_topics": _enriched("canonical", "topic_pairs"),
    "enrich_catalog": SALES_LONG,
    "enrich_catalog_shuffled": SALES_LONG,
    "enrich_crowded_shuffled": f"SELECT {COLUMNS}, topic FROM crowded_long",
    "unmapped_series": """
    SELECT series_code, count(*) AS row_count FROM sales
    WHERE series_code NOT IN (SELECT series_code FROM catalog_pairs) GROUP BY series_code""",
    "unmapped_priorities": """
    SELECT series_code, count(*) AS row_count FROM chosen
    WHERE series_code NOT IN (SELECT series_code FROM topic_pairs) GROUP BY series_code""",
    "used_dimension": USED,
    "used_dimension_shuffled": USED,
    "distinct_series": "SELECT DISTINCT series_name FROM canonical",
    "series_wide": SERIES_WIDE,
    "series_wide_no_topic": _wide("chosen", f"{ENTITY}, period", "series_name", PRIORITIES),
    "series_wide_events": _wide("days", "user_name, user_id, day", "event_type", EVENT_TYPES),
    "period_wide": PERIOD_WIDE,
    "period_wide_no_topic": _wide("chosen", f"{ENTITY}, {SERIES}", "period", YEARS),
    "series_wide_catalog": SALES_CELLS,
    "series_wide_topics": SALES_CELLS,
    "period_wide_catalog": SALES_PERIODS,
    "panel_long": LONG,
    "publish_roundtrip": LONG,
    "publish_csv_roundtrip": CATALOG,
    "export_compact": CANONICAL,
    "export_csv": CANONICAL,
    "job_long": LONG,
    "job_series_wide": SERIES_WIDE,
    "job_period_wide": PERIOD_WIDE,
    "job_dimension": """
    SELECT trim(id) AS id, topic FROM topics WHERE trim(id) IN (SELECT series_code FROM long)""",
    "job_catalog_long": SALES_LONG,
    "job_catalog_long_shuffled": SALES_LONG,
    "job_catalog_series_wide": SALES_CELLS,
    "job_catalog_series_topics": SALES_CELLS,
    "job_catalog_period_wide": SALES_PERIODS,
    "job_catalog_dimension": USED,
}

ORACLE = {name: _query(final) for name, final in FINAL.items()}
