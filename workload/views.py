"""The archive the queries run on, as SQL for the oracle; ``archive.py`` is the same in DataFrames.

customer and nation stand in for entities and sites, orders for samples, lineitem for raw counts,
part for taxa and their three names, events for dates, supplier for publications. Nulls, zeros,
null codes and untidy text are injected by rule, since the given columns have none.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {
    "entity": """
        SELECT CAST(c.c_nationkey AS BIGINT) AS ID_SITE, c.c_custkey AS ID_ENTITY, n.n_name AS site_name,
               c.c_name AS entity_name, CAST(c.c_custkey % 140 - 60 AS DOUBLE) AS latitude,
               CAST(c.c_custkey % 40 - 10 AS DOUBLE) AS longitude, c.c_acctbal AS elevation,
               CASE WHEN c.c_custkey % 7 = 0 THEN NULL WHEN c.c_custkey % 7 = 1 THEN 'unknown'
                    ELSE lower(c.c_mktsegment) END AS site_type,
               CASE WHEN c.c_custkey % 2 = 0 THEN 'author  supplied' ELSE 'archive' END AS source,
               CASE WHEN c.c_custkey % 5 = 0 THEN NULL ELSE 'study ' || CAST(c.c_custkey % 17 AS VARCHAR) END AS publication,
               CASE WHEN c.c_custkey % 3 = 0 THEN NULL ELSE '10.1/' || CAST(c.c_custkey AS VARCHAR) END AS doi
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "external_link": """
        SELECT ID_SITE, ID_ENTITY, ID_SITE + 1000 AS external_ID_SITE, ID_ENTITY + 10000 AS external_ID_ENTITY,
               site_name AS external_site_name, entity_name AS external_entity_name, 'NEOTOMA' AS external_source
        FROM entity
        UNION ALL
        SELECT ID_SITE, ID_ENTITY, NULL, ID_ENTITY + 20000, upper(site_name), lower(entity_name), 'OTHER'
        FROM entity WHERE ID_ENTITY % 3 = 0""",
    "date_info": """
        SELECT user_id AS ID_ENTITY, event_id AS ID_DATE_INFO,
               CASE WHEN event_id % 77 = 0 THEN NULL WHEN event_type = 'click' THEN 'AMS radiocarbon'
                    WHEN event_type = 'view' THEN 'core top estimated' WHEN event_type = 'purchase' THEN 'pollen correlation'
                    WHEN event_type = 'signup' THEN 'Hiatus' ELSE 'unknown' END AS date_type,
               CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS depth,
               CAST(CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 5 = 0 THEN -777777 ELSE 1 END AS DOUBLE) AS thickness,
               'LAB - ' || CAST(event_id % 97 AS VARCHAR) AS lab_num,
               CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 4 = 1 THEN CAST(-999999 AS DOUBLE) ELSE value * 10 END AS age_c14,
               CASE WHEN event_id % 3 = 0 THEN NULL ELSE value * 11 END AS age_calib,
               CASE WHEN event_id % 6 = 0 THEN NULL WHEN event_id % 6 = 1 THEN CAST(0 AS DOUBLE) ELSE value / 10 END AS error,
               CASE event_id % 10 WHEN 0 THEN 'wood' WHEN 1 THEN ' bulk   sediment ' WHEN 2 THEN 'unknown material'
                    WHEN 3 THEN NULL ELSE 'peat' END AS material_dated,
               CASE WHEN event_id % 77 = 0 OR event_id % 9 = 0 THEN NULL WHEN event_id % 9 = 1 THEN 'unknown'
                    WHEN event_id % 9 = 2 THEN 'no' ELSE 'yes' END AS age_used,
               CASE event_id % 8 WHEN 0 THEN 'outlier' WHEN 1 THEN 'unknown reason' WHEN 2 THEN 'reversal '
                    WHEN 3 THEN 'see text' ELSE NULL END AS reason_age_not_used,
               CASE WHEN event_id % 13 = 0 THEN 'checked' ELSE NULL END AS notes
        FROM events""",
    "sample": """
        SELECT o_custkey AS ID_ENTITY, o_orderkey AS ID_SAMPLE, floor(o_totalprice) / 10 AS depth,
               CAST(CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE 1 END AS DOUBLE) AS thickness,
               'chron ' || CAST(o_orderkey % 3 AS VARCHAR) AS chronology_name,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS age_type,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(floor(o_totalprice / 50) AS INT) END AS age,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(floor(o_totalprice / 50) AS INT) - 50 END AS age_younger,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(floor(o_totalprice / 50) AS INT) + 50 END AS age_older,
               CASE WHEN o_orderkey % 4 = 0 THEN 'unknown' ELSE 'raw count' END AS count_type,
               CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE 'pollen' END AS sample_type
        FROM orders""",
    "source_sample": """
        SELECT ID_ENTITY, depth + 0.0002 AS depth, CASE WHEN ID_SAMPLE % 9 = 0 THEN CAST(0.5 AS DOUBLE) ELSE thickness END AS thickness,
               CASE WHEN ID_SAMPLE % 4 = 0 THEN age * 2 ELSE age END AS age, chronology_name
        FROM sample WHERE ID_SAMPLE % 10 <> 0""",
    "raw_count": """
        SELECT l_orderkey AS ID_SAMPLE, l_partkey AS raw_taxon, l_linenumber AS line,
               l_returnflag || '|' || l_linestatus AS element,
               CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL
                    WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN CAST(0 AS DOUBLE) ELSE l_quantity END AS cnt
        FROM lineitem""",
    "taxa_map": """
        SELECT p_partkey AS raw_taxon, p_name AS clean_name, split_part(p_name, ' ', 2) AS intermediate,
               CASE WHEN split_part(p_name, ' ', 2) < 'h' THEN 'group a' ELSE 'group b' END AS amalgamated
        FROM part WHERE p_size < 50""",
    "taxon_name": """
        SELECT min(number) AS ID_TAXON, taxon_name
        FROM (SELECT raw_taxon * 3 AS number, clean_name AS taxon_name FROM taxa_map
              UNION ALL SELECT raw_taxon * 3 + 1, intermediate FROM taxa_map
              UNION ALL SELECT raw_taxon * 3 + 2, amalgamated FROM taxa_map) u GROUP BY taxon_name""",
    "pollen_count": """
        SELECT r.ID_SAMPLE, n.ID_TAXON, x.amalgamation_level, sum(r.cnt) AS cnt
        FROM raw_count r
        JOIN (SELECT raw_taxon, 0 AS amalgamation_level, clean_name AS name FROM taxa_map
              UNION ALL SELECT raw_taxon, 1, intermediate FROM taxa_map
              UNION ALL SELECT raw_taxon, 2, amalgamated FROM taxa_map) x ON r.raw_taxon = x.raw_taxon
        JOIN taxon_name n ON n.taxon_name = x.name
        WHERE r.cnt IS NOT NULL GROUP BY ALL""",
    "model_name": """
        SELECT * FROM (VALUES (3, 'linear interpolation'), (8, 'BACON_INTCAL20')) m(ID_MODEL, model_name)""",
    "age_model": """
        SELECT m.ID_MODEL, s.ID_SAMPLE, s.age AS mean, s.age + m.ID_MODEL AS median, s.age - 90 AS UNCERT_5,
               s.age - 25 AS UNCERT_25, s.age + 25 AS UNCERT_75, s.age + 90 AS UNCERT_95
        FROM sample s JOIN model_name m ON (m.ID_MODEL = 8 OR s.ID_SAMPLE % 5 = 0)
        WHERE s.age_type IS NOT NULL AND s.age IS NOT NULL""",
    "age_file": """
        SELECT ID_ENTITY, concat(copy.n, CASE WHEN ID_SAMPLE % 7 = 0 THEN ',' ELSE '-' END, ID_SAMPLE) AS sample_ids,
               CASE WHEN ID_ENTITY % 10 = 1 THEN depth + 0.01 ELSE depth END AS depths,
               age + CAST(0.7 AS DOUBLE) AS mean, age + CAST(0.2 AS DOUBLE) AS median, age - CAST(90.9 AS DOUBLE) AS uncert_5,
               age - CAST(25.5 AS DOUBLE) AS uncert_25, age + CAST(25.5 AS DOUBLE) AS uncert_75, age + CAST(90.9 AS DOUBLE) AS uncert_95
        FROM sample CROSS JOIN (VALUES (1), (2)) copy(n)
        WHERE NOT (ID_ENTITY % 10 = 0 AND ID_SAMPLE % 2 = 0) AND (copy.n = 1 OR ID_SAMPLE % 10 = 0)""",
    "entity_pub": "SELECT DISTINCT o_custkey AS ID_ENTITY, o_orderkey % 100 AS ID_PUB FROM orders",
    "pub": "SELECT s_suppkey AS ID_PUB, CASE WHEN s_suppkey % 31 = 0 THEN NULL ELSE s_name END AS citation FROM supplier",
}


_ORDER = list(VIEWS)


def _needed(sql: str, among: list[str] = _ORDER) -> set[str]:
    """The views a text uses, directly or through other views; a view only uses earlier ones."""
    found: set[str] = set()
    for view in among:
        if re.search(rf"\b{view}\b", sql):
            found |= {view} | _needed(VIEWS[view], _ORDER[: _ORDER.index(view)])
    return found


def with_views(sql: str) -> str:
    """``sql`` with the views it needs in front, so it runs on the given tables alone."""
    needed = _needed(sql)
    parts = [f"{name} AS ({body.strip()})" for name, body in VIEWS.items() if name in needed]
    text = sql.strip()
    if not parts:
        return text
    return "WITH " + ",\n".join(parts) + ("\n, " + text[5:] if text.upper().startswith("WITH ") else "\n" + text)
