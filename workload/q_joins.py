"""Selections, lookups and joins."""

from pyspark.sql import functions as F

from siltframe.functions import clean_name
from siltframe.operators import amalgamate, changes, dates, harmonise, ids, joins, match, reshape
from siltframe.session import scratch_path
from siltframe.sources import tables

from .registry import query


@query("scan_by_ids", "SELECT * FROM date_info WHERE ID_ENTITY IN (SELECT ID_ENTITY FROM entity WHERE site_type = 'building')")
def _(w):
    wanted = w.entity.where(F.col("site_type") == "building").select("ID_ENTITY")
    return tables.scan_by_ids(w.date_info, wanted, "ID_ENTITY")


@query("scan_id_range", "SELECT * FROM sample WHERE ID_SAMPLE BETWEEN 500 AND 900000000")
def _(w):
    return tables.scan_id_range(w.sample, "ID_SAMPLE", 500, 900000000)


@query("filter_members", "SELECT * FROM sample WHERE ID_ENTITY IN (SELECT ID_ENTITY FROM date_info)")
def _(w):
    return joins.keep_members(w.sample, w.date_info.select("ID_ENTITY"), "ID_ENTITY")


@query(
    "filter_non_members",
    """SELECT * FROM date_info d WHERE NOT EXISTS
       (SELECT 1 FROM (VALUES ('wood'), ('unknown material')) x(m) WHERE x.m = d.material_dated)""",
)
def _(w):
    listed = tables.literal_table(w.spark, [("wood",), ("unknown material",)], "material_dated string")
    return joins.drop_members(w.date_info, listed, "material_dated")


@query("bbox_subset", "SELECT * FROM entity WHERE latitude BETWEEN 60 AND 70 AND longitude BETWEEN 0 AND 10")
def _(w):
    return w.entity.where(F.col("latitude").between(60, 70) & F.col("longitude").between(0, 10))


@query(
    "hiatus_split",
    """SELECT CASE WHEN regexp_matches(date_type, 'hiatus|Hiatus') THEN 'hiatus' ELSE 'dated' END AS part,
              ID_ENTITY, ID_DATE_INFO, date_type, depth
       FROM date_info WHERE date_type IS NOT NULL""",
)
def _(w):
    dated, hiatus = dates.split_hiatus(w.date_info.select("ID_ENTITY", "ID_DATE_INFO", "date_type", "depth"))
    return reshape.tagged_union({"dated": dated, "hiatus": hiatus}, "part")


@query(
    "coordinate_overrides",
    """WITH o(entity_name, latitude, longitude) AS (VALUES
         ('Customer#000000001', 78.9605564, 11.6668335), ('Customer#000000012', 78.9608333, NULL))
       SELECT e.ID_SITE, e.ID_ENTITY, e.entity_name,
              round_even(coalesce(CAST(o.latitude AS DOUBLE), e.latitude), 6) AS latitude,
              round_even(coalesce(CAST(o.longitude AS DOUBLE), e.longitude), 6) AS longitude
       FROM entity e LEFT JOIN o ON e.entity_name = o.entity_name""",
)
def _(w):
    # Corrected coordinates of two records.
    corrected = [("Customer#000000001", 78.9605564, 11.6668335), ("Customer#000000012", 78.9608333, None)]
    overrides = tables.literal_table(w.spark, corrected, "entity_name string, latitude double, longitude double")
    merged = joins.coalesce_overrides(w.entity, overrides, "entity_name", ["latitude", "longitude"])
    return merged.select(
        "ID_SITE",
        "ID_ENTITY",
        "entity_name",
        F.bround("latitude", 6).alias("latitude"),
        F.bround("longitude", 6).alias("longitude"),
    )


@query(
    "depth_offsets",
    """WITH o(ID_SITE, shift) AS (VALUES (3, -90.0), (8, -0.5), (12, -265.0))
       SELECT s.ID_ENTITY, s.ID_SAMPLE, s.depth + coalesce(CAST(o.shift AS DOUBLE), 0) AS depth
       FROM sample s JOIN entity e ON s.ID_ENTITY = e.ID_ENTITY LEFT JOIN o ON e.ID_SITE = o.ID_SITE""",
)
def _(w):
    # Depth shifts in centimetres per site.
    shifts = tables.literal_table(w.spark, [(3, -90.0), (8, -0.5), (12, -265.0)], "ID_SITE bigint, offset double")
    offsets = w.entity.join(shifts, "ID_SITE").select("ID_ENTITY", "offset")
    known = w.sample.join(w.entity, "ID_ENTITY", "left_semi").select("ID_ENTITY", "ID_SAMPLE", "depth")
    return joins.add_offsets(known, offsets, "ID_ENTITY", "depth")


@query("left_lookup", "SELECT a.*, m.model_name FROM age_model a LEFT JOIN model_name m ON a.ID_MODEL = m.ID_MODEL")
def _(w):
    return w.age_model.join(w.model_name, "ID_MODEL", "left")


@query(
    "right_enrich",
    """SELECT e.ID_SITE, e.entity_name, d.* FROM (SELECT * FROM entity WHERE ID_SITE < 20) e
       RIGHT JOIN date_info d ON e.ID_ENTITY = d.ID_ENTITY""",
)
def _(w):
    known = w.entity.where(F.col("ID_SITE") < 20).select("ID_SITE", "ID_ENTITY", "entity_name")
    return w.date_info.join(known, "ID_ENTITY", "left")


@query(
    "inner_metadata",
    """SELECT l.ID_ENTITY, l.external_ID_ENTITY, l.external_entity_name, e.site_name, e.entity_name, e.latitude, e.longitude
       FROM external_link l JOIN entity e ON l.ID_ENTITY = e.ID_ENTITY WHERE l.external_source = 'OTHER'""",
)
def _(w):
    links = w.external_link.where(F.col("external_source") == "OTHER")
    return links.select("ID_ENTITY", "external_ID_ENTITY", "external_entity_name").join(
        w.entity.select("ID_ENTITY", "site_name", "entity_name", "latitude", "longitude"), "ID_ENTITY"
    )


@query(
    "depth_reconcile",
    """SELECT coalesce(a.ID_ENTITY, b.ID_ENTITY) AS ID_ENTITY, coalesce(a.d, b.d) AS depth,
              CASE WHEN b.d IS NULL THEN 'archive' ELSE 'source' END AS found_in
       FROM (SELECT DISTINCT ID_ENTITY, round_even(depth, 3) AS d FROM sample) a
       FULL JOIN (SELECT DISTINCT ID_ENTITY, round_even(CASE WHEN thickness = 0.5 THEN depth + 1000 ELSE depth END, 3) AS d
                  FROM source_sample) b
       ON a.ID_ENTITY = b.ID_ENTITY AND a.d = b.d WHERE a.d IS NULL OR b.d IS NULL""",
)
def _(w):
    mine = w.sample.select("ID_ENTITY", F.bround("depth", 3).alias("depth"))
    moved = F.when(F.col("thickness") == 0.5, F.col("depth") + 1000).otherwise(F.col("depth"))
    other = w.source_sample.select("ID_ENTITY", F.bround(moved, 3).alias("depth"))
    return joins.unmatched_both_ways(mine, other, ["ID_ENTITY", "depth"], "archive", "source")


@query("samples_without_counts", "SELECT * FROM sample s WHERE NOT EXISTS (SELECT 1 FROM pollen_count p WHERE p.ID_SAMPLE = s.ID_SAMPLE)")
def _(w):
    return joins.drop_members(w.sample, w.pollen_count.select("ID_SAMPLE"), "ID_SAMPLE")


@query(
    "match_depth_rounded",
    """WITH a AS (SELECT ID_ENTITY, ID_SAMPLE, CASE WHEN ID_SAMPLE % 23 <> 0 THEN depth END AS depth FROM sample),
       b AS (SELECT ID_ENTITY, CASE WHEN age % 19 <> 0 THEN depth END AS depth, age FROM source_sample)
       SELECT a.ID_ENTITY, a.ID_SAMPLE, a.depth, b.depth AS depth_source, b.age AS age_source
       FROM a LEFT JOIN b ON a.ID_ENTITY = b.ID_ENTITY AND round_even(a.depth, 3) IS NOT DISTINCT FROM round_even(b.depth, 3)""",
)
def _(w):
    # Some depths are missing on either side; those of an entity match each other.
    mine = w.sample.select("ID_ENTITY", "ID_SAMPLE", F.when(F.col("ID_SAMPLE") % 23 != 0, F.col("depth")).alias("depth"))
    depth = F.when(F.col("age") % 19 != 0, F.col("depth")).alias("depth")
    return match.match_depth_rounded(mine, w.source_sample.select("ID_ENTITY", depth, F.col("age").alias("age_source")))


# Coarse depths: many samples of an entity share one, with other thicknesses.
_POSITIONAL = """
    WITH a AS (SELECT ID_ENTITY, ID_SAMPLE, floor(depth / 4000) * 4000 AS depth, thickness, count(*) OVER (PARTITION BY ID_ENTITY) AS n,
                      row_number() OVER (PARTITION BY ID_ENTITY ORDER BY floor(depth / 4000) * 4000, ID_SAMPLE) AS rn FROM sample),
    b AS (SELECT ID_ENTITY, floor(depth / 4000) * 4000 AS depth_source, thickness AS thickness_source,
                 count(*) OVER (PARTITION BY ID_ENTITY) AS n,
                 row_number() OVER (PARTITION BY ID_ENTITY ORDER BY floor(depth / 4000) * 4000, thickness) AS rn FROM source_sample),
    matched AS (
      SELECT a.ID_ENTITY, a.ID_SAMPLE, a.depth, a.thickness, b.depth_source, b.thickness_source, 'position' AS matched_by
      FROM a JOIN b ON a.ID_ENTITY = b.ID_ENTITY AND a.n = b.n AND a.rn = b.rn
      UNION ALL
      SELECT b.ID_ENTITY, a.ID_SAMPLE, a.depth, a.thickness, b.depth_source, b.thickness_source, 'depth'
      FROM b LEFT JOIN a ON a.ID_ENTITY = b.ID_ENTITY AND round_even(a.depth, 3) = round_even(b.depth_source, 3)
      WHERE NOT EXISTS (SELECT 1 FROM a x WHERE x.ID_ENTITY = b.ID_ENTITY AND x.n = b.n))
"""


def positional(w):
    coarse = (F.floor(F.col("depth") / 4000) * 4000).cast("double").alias("depth")
    mine = w.sample.select("ID_ENTITY", "ID_SAMPLE", coarse, "thickness")
    other = w.source_sample.select("ID_ENTITY", coarse, "thickness")
    return match.match_positional(mine, other, "ID_ENTITY", ["depth", "ID_SAMPLE"], ["depth", "thickness"])


@query("match_positional", _POSITIONAL + "SELECT * FROM matched")
def _(w):
    return positional(w)


@query(
    "thickness_corrections",
    _POSITIONAL
    + """SELECT ID_ENTITY, ID_SAMPLE, thickness_source AS thickness FROM matched
         WHERE round_even(depth, 3) = round_even(depth_source, 3) AND thickness_source <> thickness""",
)
def _(w):
    return match.corrected_values(positional(w), ["ID_ENTITY", "ID_SAMPLE"], "thickness")


@query(
    "date_pairing_faults",
    """WITH a AS (SELECT ID_ENTITY, ID_DATE_INFO, depth, lab_num,
                      row_number() OVER (PARTITION BY ID_ENTITY ORDER BY ID_DATE_INFO) AS rn FROM date_info)
       SELECT ID_ENTITY, ID_DATE_INFO, depth, lab_num,
              CASE WHEN ID_DATE_INFO % 5 = 0 THEN depth ELSE depth * 100 END AS depth_source,
              CASE WHEN ID_DATE_INFO % 7 = 0 THEN lab_num || 'x' ELSE lab_num END AS lab_num_source
       FROM a WHERE (ID_DATE_INFO % 5 = 0 AND depth * 100 <> depth) OR ID_DATE_INFO % 7 = 0""",
)
def _(w):
    mine = w.date_info.select("ID_ENTITY", "ID_DATE_INFO", "depth", "lab_num")
    fifth, seventh = F.col("ID_DATE_INFO") % 5 == 0, F.col("ID_DATE_INFO") % 7 == 0
    other = mine.select(
        "ID_ENTITY",
        F.col("ID_DATE_INFO").alias("order"),
        F.when(fifth, F.col("depth")).otherwise(F.col("depth") * 100).alias("depth"),
        F.when(seventh, F.concat("lab_num", F.lit("x"))).otherwise(F.col("lab_num")).alias("lab_num"),
    )
    matched = match.match_positional(mine, other, "ID_ENTITY", ["ID_DATE_INFO"], ["order"])
    return match.pairing_faults(matched, ["ID_ENTITY", "ID_DATE_INFO"], "lab_num").drop("order_source", "matched_by")


@query(
    "match_clean_names",
    """SELECT e.ID_ENTITY, e.entity_name, l.external_ID_ENTITY, l.external_entity_name AS entity_name_source,
              regexp_replace(lower(e.entity_name), '[^a-z0-9]', '', 'g') AS entity_name_clean
       FROM entity e JOIN external_link l ON l.external_source = 'OTHER'
        AND regexp_replace(lower(e.entity_name), '[^a-z0-9]', '', 'g') = regexp_replace(lower(l.external_entity_name), '[^a-z0-9]', '', 'g')""",
)
def _(w):
    links = w.external_link.where(F.col("external_source") == "OTHER")
    other = links.select("external_ID_ENTITY", F.col("external_entity_name").alias("entity_name"))
    return match.match_clean_names(w.entity.select("ID_ENTITY", "entity_name"), other, "entity_name")


@query(
    "site_names_clean",
    """SELECT ID_ENTITY, site_name, regexp_replace(lower(site_name), '[^a-z0-9]', '', 'g') AS site_name_clean FROM entity""",
)
def _(w):
    return w.entity.select("ID_ENTITY", "site_name", clean_name(F.col("site_name")).alias("site_name_clean"))


@query(
    "natural_join_keys",
    """SELECT d.ID_ENTITY, d.depth, d.lab_num, s.site_name FROM date_info d
       LEFT JOIN (SELECT ID_ENTITY, depth, min(notes) AS site_name FROM date_info GROUP BY ALL) s
       ON d.ID_ENTITY = s.ID_ENTITY AND d.depth IS NOT DISTINCT FROM s.depth""",
)
def _(w):
    noted = w.date_info.groupBy("ID_ENTITY", "depth").agg(F.min("notes").alias("site_name"))
    return joins.natural_join(w.date_info.select("ID_ENTITY", "depth", "lab_num"), noted)


@query(
    "get_entity",
    """SELECT e.*, l.external_ID_SITE, l.external_ID_ENTITY, l.external_site_name, l.external_entity_name, l.external_source
       FROM entity e JOIN external_link l ON e.ID_SITE = l.ID_SITE AND e.ID_ENTITY = l.ID_ENTITY
       WHERE e.ID_ENTITY IN (SELECT ID_ENTITY FROM date_info)""",
)
def _(w):
    return harmonise.get_entity(w.entity, w.external_link, w.date_info.select("ID_ENTITY"))


@query(
    "exists_flag",
    "SELECT s.*, EXISTS (SELECT 1 FROM pollen_count p WHERE p.ID_SAMPLE = s.ID_SAMPLE) AS has_counts FROM sample s",
)
def _(w):
    return joins.exists_flag(w.sample, w.pollen_count, "ID_SAMPLE", "has_counts")


@query(
    "collapse_publications",
    """SELECT e.ID_ENTITY, e.entity_name, p.publication FROM entity e LEFT JOIN (
         SELECT x.ID_ENTITY, CASE WHEN count(*) = count(citation) THEN string_agg(citation, ';' || chr(10) ORDER BY x.ID_PUB) END AS publication
         FROM entity_pub x LEFT JOIN pub ON x.ID_PUB = pub.ID_PUB GROUP BY x.ID_ENTITY) p ON e.ID_ENTITY = p.ID_ENTITY""",
)
def _(w):
    return harmonise.collapse_publications(w.entity.select("ID_ENTITY", "entity_name"), w.entity_pub, w.pub)


@query(
    "map_fanout_check",
    """SELECT clean_name, count(DISTINCT CASE WHEN raw_taxon % 50 = 0 THEN 'other' ELSE intermediate END) AS n_parents
       FROM taxa_map GROUP BY clean_name HAVING n_parents > 1""",
)
def _(w):
    second = F.when(F.col("raw_taxon") % 50 == 0, "other").otherwise(F.col("intermediate"))
    return amalgamate.map_conflicts(w.taxa_map.withColumn("intermediate", second), "clean_name", "intermediate")


@query(
    "map_disagreements",
    """SELECT raw_taxon, clean_name, intermediate, CASE WHEN raw_taxon % 50 = 0 THEN 'other' ELSE intermediate END AS intermediate2
       FROM taxa_map WHERE raw_taxon % 50 = 0""",
)
def _(w):
    second = F.when(F.col("raw_taxon") % 50 == 0, "other").otherwise(F.col("intermediate")).alias("intermediate2")
    reviewed = w.taxa_map.select("raw_taxon", "clean_name", "intermediate", second)
    return amalgamate.map_disagreements(reviewed, "intermediate", "intermediate2")


@query(
    "cross_source_models",
    """SELECT l.external_ID_ENTITY, l.ID_ENTITY, s.ID_SAMPLE, s.depth, m.ID_MODEL, m.mean, m.median
       FROM external_link l JOIN sample s ON l.external_ID_ENTITY = s.ID_ENTITY + 20000
       JOIN age_model m ON m.ID_SAMPLE = s.ID_SAMPLE WHERE l.external_source = 'OTHER'""",
)
def _(w):
    other = w.sample.select((F.col("ID_ENTITY") + 20000).alias("ID_ENTITY"), "ID_SAMPLE", "depth")
    models = w.age_model.select("ID_MODEL", "ID_SAMPLE", "mean", "median")
    return harmonise.models_across_sources(w.external_link, other, models, "OTHER")


@query(
    "assign_ids",
    """SELECT (dense_rank() OVER (ORDER BY site_name)) + 100 AS ID_SITE, row_number() OVER (ORDER BY site_name, entity_name) AS ID_ENTITY,
              site_name, entity_name FROM entity""",
)
def _(w):
    named = w.entity.select("site_name", "entity_name")
    sites = ids.assign_group_ids(named, ["site_name"], "ID_SITE", 100)
    return ids.assign_ids(sites, ["site_name", "entity_name"], "ID_ENTITY")


@query(
    "id_gaps",
    """WITH held AS (SELECT ID_DATE_INFO FROM date_info WHERE depth IS NOT NULL)
       SELECT i AS ID_DATE_INFO FROM range(1, (SELECT max(ID_DATE_INFO) + 1 FROM held)) r(i)
       WHERE NOT EXISTS (SELECT 1 FROM held WHERE held.ID_DATE_INFO = i)""",
)
def _(w):
    return ids.id_gaps(w.date_info.where(F.col("depth").isNotNull()), "ID_DATE_INFO")


@query("get_links", "SELECT * FROM external_link WHERE ID_ENTITY IN (3, 6, 7)")
def _(w):
    return harmonise.get_links(w.external_link, 3, 6, 7)


@query("rows_by_position", "SELECT ID_ENTITY, ID_SAMPLE, depth FROM (SELECT *, row_number() OVER (ORDER BY ID_SAMPLE) AS n FROM sample) WHERE n BETWEEN 101 AND 250")
def _(w):
    return ids.rows_at(w.sample.select("ID_ENTITY", "ID_SAMPLE", "depth"), ["ID_SAMPLE"], 101, 250)


@query("filter_like", "SELECT ID_TAXON, taxon_name FROM taxon_name WHERE taxon_name LIKE '%ring' OR taxon_name LIKE 'group _'")
def _(w):
    name = F.col("taxon_name")
    return w.taxon_name.where(name.like("%ring") | name.like("group _"))


@query("create_archive", "SELECT ID_SITE, ID_ENTITY, site_name, entity_name FROM entity")
def _(w):
    empty = tables.create_archive(w.spark, scratch_path(w.spark, "created")).entity
    new = w.entity.select(*[c for c in empty.columns if c in w.entity.columns])
    return changes.append_records(empty, new, ["ID_ENTITY"]).select("ID_SITE", "ID_ENTITY", "site_name", "entity_name")
