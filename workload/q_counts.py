"""Aggregates, reshaping and amalgamation of counts."""

from pyspark.sql import functions as F

from siltframe.functions import if_else, null_text
from siltframe.operators import aggregates, amalgamate, dates, harmonise, quality, reshape
from siltframe.plans import snapshot as snap
from siltframe.plans import summary
from siltframe.schema import SCHEMAS, TABLES
from siltframe.session import scratch_path
from siltframe.sources import tables

from .fingerprints import table_sql
from .registry import query

# The words taxon names are made of in the given tables.
_ADJECTIVES = ["blue", "cold", "hot", "large", "new", "old", "red", "small"]
_NOUNS = ["anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget"]
CLEAN_NAMES = [f"{a} {n}" for a in _ADJECTIVES for n in _NOUNS]
LEVEL_NAMES = {"clean": CLEAN_NAMES, "intermediate": _NOUNS, "amalgamated": ["group a", "group b"]}


def cases(names, value="p.cnt", name="t.taxon_name"):
    return ", ".join(f"""max(CASE WHEN {name} = '{n}' THEN {value} END) AS "{n}\"""" for n in names)


def wide_sql(level: str, where: str = "") -> str:
    number = list(LEVEL_NAMES).index(level)
    return f"""SELECT p.ID_SAMPLE, {cases(LEVEL_NAMES[level])}
               FROM pollen_count p JOIN taxon_name t ON p.ID_TAXON = t.ID_TAXON
               WHERE p.amalgamation_level = {number} {where} GROUP BY p.ID_SAMPLE"""


@query("count_per_entity", "SELECT ID_ENTITY, count(*) AS n_samples FROM sample GROUP BY ID_ENTITY")
def _(w):
    return aggregates.count_rows(w.sample, ["ID_ENTITY"], "n_samples")


@query(
    "sum_taxa",
    """SELECT ID_SAMPLE, raw_taxon, coalesce(sum(cnt), 0) AS count FROM raw_count GROUP BY ID_SAMPLE, raw_taxon""",
)
def _(w):
    return w.raw_count.groupBy("ID_SAMPLE", "raw_taxon").agg(aggregates.sum_or_zero("count").alias("count"))


@query(
    "first_per_key",
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY ID_ENTITY, lab_num
         ORDER BY depth NULLS LAST, ID_DATE_INFO) AS rn FROM date_info) WHERE rn = 1""",
)
def _(w):
    return aggregates.first_per_key(w.date_info, ["ID_ENTITY", "lab_num"], ["depth", "ID_DATE_INFO"])


@query(
    "entities_with_models",
    """SELECT s.ID_ENTITY, count(DISTINCT a.ID_SAMPLE) AS n_am FROM age_model a JOIN sample s ON a.ID_SAMPLE = s.ID_SAMPLE GROUP BY s.ID_ENTITY""",
)
def _(w):
    return summary.models_per_entity(w)


@query(
    "source_sample_counts",
    """SELECT * FROM (SELECT coalesce(a.ID_ENTITY, b.ID_ENTITY) AS ID_ENTITY, coalesce(a.n, 0) AS n_archive, coalesce(b.n, 0) AS n_source
       FROM (SELECT ID_ENTITY, count(*) AS n FROM sample GROUP BY ALL) a
       FULL JOIN (SELECT ID_ENTITY, count(*) AS n FROM source_sample GROUP BY ALL) b ON a.ID_ENTITY = b.ID_ENTITY)
       WHERE n_archive > n_source""",
)
def _(w):
    both = aggregates.compare_counts(w.sample, w.source_sample, "ID_ENTITY", "n_archive", "n_source")
    return both.where(F.col("n_archive") > F.col("n_source"))


@query(
    "source_row_mismatch",
    """SELECT * FROM (SELECT coalesce(a.ID_ENTITY, b.ID_ENTITY) AS ID_ENTITY, coalesce(a.n, 0) AS n_dates, coalesce(b.n, 0) AS n_source
       FROM (SELECT ID_ENTITY, count(*) AS n FROM date_info GROUP BY ALL) a
       FULL JOIN (SELECT ID_ENTITY, count(*) AS n FROM date_info WHERE notes IS NULL GROUP BY ALL) b ON a.ID_ENTITY = b.ID_ENTITY)
       WHERE n_dates <> n_source""",
)
def _(w):
    return quality.count_mismatch(
        w.date_info, w.date_info.where(F.col("notes").isNull()), "ID_ENTITY", "n_dates", "n_source"
    )


@query(
    "version_diff_counts",
    """SELECT * FROM (SELECT coalesce(a.chronology_name, b.chronology_name) AS chronology_name, coalesce(a.n, 0) AS n_old, coalesce(b.n, 0) AS n_new
       FROM (SELECT chronology_name, count(*) AS n FROM sample GROUP BY ALL) a
       FULL JOIN (SELECT chronology_name, count(*) AS n FROM source_sample GROUP BY ALL) b ON a.chronology_name = b.chronology_name)
       WHERE n_old <> n_new""",
)
def _(w):
    return quality.count_mismatch(w.sample, w.source_sample, "chronology_name", "n_old", "n_new")


@query(
    "symmetric_error",
    """SELECT ID_DATE_INFO, CASE WHEN error IS NULL OR age_calib IS NULL THEN NULL ELSE greatest(error, age_calib / 20) END AS error
       FROM date_info""",
)
def _(w):
    sides = w.date_info.select(
        "ID_DATE_INFO", F.col("error").alias("error_positive"), (F.col("age_calib") / 20).alias("error_negative")
    )
    return harmonise.symmetric_error(sides, "error_positive", "error_negative")


@query("sample_totals", "SELECT ID_SAMPLE, coalesce(sum(cnt), 0) AS total FROM raw_count GROUP BY ID_SAMPLE")
def _(w):
    return w.raw_count.groupBy("ID_SAMPLE").agg(aggregates.sum_or_zero("count").alias("total"))


@query("entities_single_date", "SELECT ID_ENTITY, lab_num, count(*) AS n FROM date_info GROUP BY ALL HAVING count(*) < 2")
def _(w):
    return aggregates.single_row_groups(w.date_info, ["ID_ENTITY", "lab_num"])


@query(
    "entities_no_counts",
    """SELECT s.ID_ENTITY, count(*) AS total, count(*) FILTER (c.ID_SAMPLE IS NULL) AS wo_counts
       FROM sample s LEFT JOIN (SELECT DISTINCT ID_SAMPLE FROM pollen_count WHERE cnt > 40) c ON s.ID_SAMPLE = c.ID_SAMPLE
       GROUP BY s.ID_ENTITY HAVING count(*) = count(*) FILTER (c.ID_SAMPLE IS NULL)""",
)
def _(w):
    return summary.uncounted_entities(w.archive.with_tables(pollen_count=w.pollen_count.where(F.col("count") > 40)))


@query(
    "counts_by_level",
    """SELECT s.ID_ENTITY, count(DISTINCT s.ID_SAMPLE) FILTER (p.amalgamation_level = 0) AS n_counts_0,
              count(DISTINCT s.ID_SAMPLE) FILTER (p.amalgamation_level = 1) AS n_counts_1,
              count(DISTINCT s.ID_SAMPLE) FILTER (p.amalgamation_level = 2) AS n_counts_2
       FROM pollen_count p JOIN sample s ON p.ID_SAMPLE = s.ID_SAMPLE WHERE p.cnt IS NOT NULL GROUP BY s.ID_ENTITY""",
)
def _(w):
    return snap.levels_per_entity(w.pollen_count, w.sample)


@query("find_duplicates", "SELECT *, count(*) OVER (PARTITION BY ID_ENTITY, lab_num) AS n FROM date_info QUALIFY n > 1")
def _(w):
    return aggregates.find_duplicates(w.date_info, ["ID_ENTITY", "lab_num"])


_TOTALS = """
    WITH totals AS (SELECT s.ID_ENTITY, floor(s.depth / 1000) AS depth, s.ID_SAMPLE, coalesce(t.total, 0) AS total
      FROM sample s LEFT JOIN (SELECT ID_SAMPLE, sum(cnt) AS total FROM raw_count GROUP BY ALL) t ON s.ID_SAMPLE = t.ID_SAMPLE)
"""


def totals(w):
    sums = w.raw_count.groupBy("ID_SAMPLE").agg(F.sum("count").alias("total"))
    return w.sample.join(sums, "ID_SAMPLE", "left").select(
        "ID_ENTITY",
        F.floor(F.col("depth") / 1000).cast("double").alias("depth"),
        "ID_SAMPLE",
        F.coalesce("total", F.lit(0.0)).alias("total"),
    )


@query(
    "same_totals_flag",
    _TOTALS
    + """SELECT ID_ENTITY, CAST(depth AS DOUBLE) AS depth, ID_SAMPLE, total,
                min(total) OVER w = max(total) OVER w AS same_total
         FROM totals WINDOW w AS (PARTITION BY ID_ENTITY, depth)""",
)
def _(w):
    return quality.duplicate_review(totals(w), w.entity, "ID_ENTITY").drop("keep")


@query(
    "duplicate_review",
    _TOTALS
    + """SELECT ID_ENTITY, CAST(depth AS DOUBLE) AS depth, ID_SAMPLE, total, min(total) OVER w = max(total) OVER w AS same_total,
                EXISTS (SELECT 1 FROM entity e WHERE e.ID_ENTITY = t.ID_ENTITY AND e.site_type IS NOT NULL) AS keep
         FROM totals t WINDOW w AS (PARTITION BY ID_ENTITY, depth)""",
)
def _(w):
    return quality.duplicate_review(totals(w), w.entity.where(F.col("site_type").isNotNull()), "ID_ENTITY")


@query(
    "sorted_dates",
    """SELECT DISTINCT * FROM (
         SELECT e.entity_name, d.date_type, d.depth, d.age_c14, d.age_calib AS age_cal FROM date_info d JOIN entity e ON d.ID_ENTITY = e.ID_ENTITY
         UNION ALL SELECT e.entity_name, CASE WHEN d.date_type = 'core top estimated' THEN 'Top of core estimated'
                      WHEN d.date_type = 'pollen correlation' THEN 'Pollen correlation' ELSE d.date_type END, d.depth, d.age_c14, d.age_calib
         FROM date_info d JOIN entity e ON d.ID_ENTITY = e.ID_ENTITY WHERE d.depth < 20)
       ORDER BY entity_name NULLS LAST, depth NULLS LAST, age_c14 NULLS LAST, age_cal NULLS LAST""",
)
def _(w):
    named = w.date_info.join(w.entity.select("ID_ENTITY", "entity_name"), "ID_ENTITY").select(
        "entity_name", "date_type", "depth", "age_c14", F.col("age_calib").alias("age_cal")
    )
    return dates.combine_dates(named, named.where(F.col("depth") < 20))


@query(
    "union_sources",
    """SELECT ID_ENTITY, depth, thickness, lab_num, CAST(NULL AS VARCHAR) AS chronology_name FROM date_info
       UNION ALL SELECT ID_ENTITY, depth, thickness, NULL, chronology_name FROM source_sample""",
)
def _(w):
    return reshape.union_sources(
        w.date_info.select("ID_ENTITY", "depth", "thickness", "lab_num"),
        w.source_sample.select("ID_ENTITY", "depth", "thickness", "chronology_name"),
    )


@query(
    "tagged_union",
    """SELECT u.entity_name, u.db, e.ID_ENTITY FROM (
         SELECT entity_name, 'archive' AS db FROM entity UNION ALL SELECT external_entity_name, 'OTHER' FROM external_link WHERE external_source = 'OTHER') u
       LEFT JOIN entity e ON u.entity_name = e.entity_name""",
)
def _(w):
    linked = w.external_link.where(F.col("external_source") == "OTHER")
    stacked = reshape.tagged_union(
        {
            "archive": w.entity.select("entity_name"),
            "OTHER": linked.select(F.col("external_entity_name").alias("entity_name")),
        }
    )
    return stacked.join(w.entity.select("ID_ENTITY", "entity_name"), "entity_name", "left")


@query(
    "incomplete_levels",
    """SELECT s.ID_SAMPLE, coalesce(c.n, 0) AS n_levels FROM sample s LEFT JOIN (
         SELECT ID_SAMPLE, count(DISTINCT amalgamation_level) AS n FROM pollen_count WHERE amalgamation_level < 2 OR cnt > 20 GROUP BY ALL) c
       ON s.ID_SAMPLE = c.ID_SAMPLE WHERE coalesce(c.n, 0) <> 3""",
)
def _(w):
    kept = w.pollen_count.where((F.col("amalgamation_level") < 2) | (F.col("count") > 20))
    return amalgamate.incomplete_levels(kept, w.sample)


@query(
    "complete_entities",
    """SELECT ID_ENTITY FROM entity INTERSECT SELECT ID_ENTITY FROM date_info INTERSECT SELECT ID_ENTITY FROM sample
       INTERSECT SELECT s.ID_ENTITY FROM age_model a JOIN sample s ON a.ID_SAMPLE = s.ID_SAMPLE
       INTERSECT SELECT s.ID_ENTITY FROM pollen_count p JOIN sample s ON p.ID_SAMPLE = s.ID_SAMPLE""",
)
def _(w):
    return summary.complete_entities(w)


@query(
    "new_taxa",
    """SELECT 74 + row_number() OVER (ORDER BY taxon_name) AS ID_TAXON, taxon_name FROM taxon_name t
       WHERE NOT EXISTS (SELECT 1 FROM taxa_map m WHERE m.intermediate = t.taxon_name)""",
)
def _(w):
    known = w.taxa_map.select(F.col("intermediate").alias("taxon_name")).distinct()
    return amalgamate.new_taxa(w.taxa_map, known, 74)


@query(
    "counts_to_long",
    """SELECT p.ID_SAMPLE, t.taxon_name AS taxon, p.cnt AS count FROM pollen_count p JOIN taxon_name t ON p.ID_TAXON = t.ID_TAXON
       WHERE p.amalgamation_level = 1""",
)
def _(w):
    wide = snap.snapshot(w).wide("intermediate")
    return reshape.to_long(wide, ["ID_SAMPLE"])


def pivoted(w, level, reverse=False):
    """One level wide: the pivot runs on ids, which the headers are a dictionary of."""
    counts = w.pollen_count.where(F.col("amalgamation_level") == level)
    named = reshape.id_headers(counts, w.taxon_name, "ID_TAXON", "taxon_name")
    return reshape.to_wide_by_id(counts, ["ID_SAMPLE"], "ID_TAXON", dict(sorted(named.items(), reverse=reverse)))


@query("counts_to_wide", wide_sql("amalgamated"))
def _(w):
    return pivoted(w, 2)


@query("sorted_taxa_columns", wide_sql("intermediate"))
def _(w):
    return reshape.sort_columns(pivoted(w, 1, reverse=True), ["ID_SAMPLE"])


@query(
    "split_levels",
    """SELECT CASE amalgamation_level WHEN 0 THEN 'clean' WHEN 1 THEN 'intermediate' ELSE 'amalgamated' END AS level,
              ID_SAMPLE, ID_TAXON, cnt AS count FROM pollen_count""",
)
def _(w):
    return reshape.tagged_union(amalgamate.split_levels(w.pollen_count), "level")


@query(
    "transpose_counts",
    """WITH m AS (SELECT e.site_name, t.taxon_name, sum(p.cnt) AS n FROM pollen_count p JOIN taxon_name t ON p.ID_TAXON = t.ID_TAXON
         JOIN sample s ON p.ID_SAMPLE = s.ID_SAMPLE JOIN entity e ON s.ID_ENTITY = e.ID_ENTITY WHERE p.amalgamation_level = 1 GROUP BY ALL)
       SELECT taxon_name AS taxon, """
    + cases([f"NATION_{i}" for i in range(25)], "n", "site_name")
    + " FROM m GROUP BY taxon_name",
)
def _(w):
    sites = w.sample.join(w.entity.select("ID_ENTITY", "site_name"), "ID_ENTITY").select("ID_SAMPLE", "site_name")
    counts = w.pollen_count.where(F.col("amalgamation_level") == 1)
    by_site = counts.join(sites, "ID_SAMPLE").groupBy("site_name", "ID_TAXON").agg(F.sum("count").alias("count"))
    # A row per site and a column per taxon; the transpose comes in blocks of ten sites.
    wide = reshape.to_wide_by_id(by_site, ["site_name"], "ID_TAXON", reshape.id_headers(by_site, w.taxon_name, "ID_TAXON", "taxon_name"))
    first, *others = reshape.transpose_blocks(wide, "site_name", "taxon", 10)
    for block in others:
        first = first.join(block, "taxon")
    return first


@query(
    "transpose_counts_long",
    """SELECT t.taxon_name AS taxon, p.ID_SAMPLE, p.cnt AS value FROM (SELECT DISTINCT ID_SAMPLE FROM pollen_count WHERE amalgamation_level = 2) s
       CROSS JOIN (SELECT DISTINCT ID_TAXON FROM pollen_count WHERE amalgamation_level = 2) u JOIN taxon_name t ON t.ID_TAXON = u.ID_TAXON
       JOIN pollen_count p ON p.ID_SAMPLE = s.ID_SAMPLE AND p.ID_TAXON = u.ID_TAXON AND p.amalgamation_level = 2""",
)
def _(w):
    # A row per sample is too many for columns.
    return reshape.transpose(pivoted(w, 2), "ID_SAMPLE", "taxon", long=True).where("value IS NOT NULL")


@query(
    "enumerate_values",
    """SELECT DISTINCT variable, current, trim(regexp_replace(current, '\\s+', ' ', 'g')) AS new FROM (
         SELECT 'date_type' AS variable, date_type AS current FROM date_info
         UNION ALL SELECT 'material_dated', material_dated FROM date_info
         UNION ALL SELECT 'age_used', age_used FROM date_info
         UNION ALL SELECT 'reason_age_not_used', reason_age_not_used FROM date_info) WHERE current IS NOT NULL""",
)
def _(w):
    return aggregates.value_catalogue(w.date_info, ["date_type", "material_dated", "age_used", "reason_age_not_used"])


@query(
    "prepare_taxa_map",
    """SELECT p_name || '-type' AS raw_taxon, p_name AS clean_name, p_type FROM part WHERE p_size % 5 <> 0""",
)
def _(w):
    name = F.when(F.col("p_size") % 5 == 0, "To  EXCLUDE").otherwise(F.concat(F.lit(" "), F.replace("p_name", F.lit(" "), F.lit("  "))))
    listed = w.given("part").select(
        F.concat("p_name", F.lit(" type")).alias("raw_taxon"), name.alias("clean_name"), "p_type"
    )
    return amalgamate.prepare_taxa_map(listed)


@query(
    "rename_columns",
    """SELECT ID_SAMPLE, mean, median, UNCERT_5 AS uncert_5, UNCERT_25 AS uncert_25, UNCERT_75 AS uncert_75, UNCERT_95 AS uncert_95 FROM age_model""",
)
def _(w):
    source = w.age_model.withColumnsRenamed({c: f"est_age_{c}" for c in w.age_model.columns if c.startswith("UNCERT")})
    plain = reshape.rename_matching(reshape.rename_matching(source, "^est_age_", ""), "UNCERT", "uncert")
    return plain.select("ID_SAMPLE", "mean", "median", *reshape.columns_starting(plain, "uncert"))


_LONG_NAMES = """SELECT r.raw_taxon, r.ID_SAMPLE, coalesce(m.clean_name, 'raw ' || r.raw_taxon) || '|' || r.element AS taxon, r.cnt AS count
                 FROM raw_count r LEFT JOIN taxa_map m ON r.raw_taxon = m.raw_taxon"""


def named_elements(w):
    """All raw counts under header names such as ``blue ring|N|O`` or ``raw 7|N|O``; some of those are never counted."""
    name = F.coalesce("clean_name", F.concat(F.lit("raw "), "raw_taxon"))
    return w.raw_count.join(w.taxa_map, "raw_taxon", "left").select(
        "raw_taxon", "ID_SAMPLE", F.concat_ws("|", name, "element").alias("taxon"), "count"
    )


@query(
    "drop_empty_taxa",
    f"WITH x AS ({_LONG_NAMES}) SELECT * FROM x WHERE taxon IN (SELECT taxon FROM x WHERE count IS NOT NULL)",
)
def _(w):
    return reshape.drop_empty_taxa(named_elements(w))


@query(
    "drop_empty_columns",
    """SELECT r.ID_SAMPLE, """
    + ", ".join(
        f"""sum(CASE WHEN element = '{e}' THEN cnt END) AS "{e}\"""" for e in ("A|F", "N|F", "R|F", "A|O", "R|O")
    )
    + " FROM raw_count r GROUP BY r.ID_SAMPLE",
)
def _(w):
    elements = reshape.headers(w.raw_count, "element")
    wide = w.raw_count.groupBy("ID_SAMPLE").pivot("element", elements).agg(F.sum("count"))
    return reshape.drop_empty_columns(wide, ["ID_SAMPLE"])


@query(
    "exclude_taxa",
    """SELECT ID_SAMPLE, raw_taxon, cnt AS count FROM raw_count
       WHERE raw_taxon NOT IN (SELECT raw_taxon FROM taxa_map WHERE intermediate = 'gizmo')""",
)
def _(w):
    excluded = w.taxa_map.where(F.col("intermediate") == "gizmo")
    return amalgamate.excluded_counts(w.raw_count.select("ID_SAMPLE", "raw_taxon", "count"), excluded)


@query(
    "excluded_counts",
    """SELECT r.ID_SAMPLE, r.raw_taxon, r.cnt AS count, m.raw_taxon IS NOT NULL AS kept
       FROM raw_count r LEFT JOIN taxa_map m ON r.raw_taxon = m.raw_taxon""",
)
def _(w):
    counts = w.raw_count.select("ID_SAMPLE", "raw_taxon", "count")
    kept = amalgamate.mapped_counts(counts, w.taxa_map).withColumn("kept", F.lit(True))
    return kept.unionByName(amalgamate.excluded_counts(counts, w.taxa_map).withColumn("kept", F.lit(False)))


_CLEAN = """
    WITH clean AS (SELECT r.ID_SAMPLE, t.ID_TAXON, 0 AS amalgamation_level, coalesce(sum(r.cnt), 0) AS count
      FROM raw_count r LEFT JOIN taxa_map m ON r.raw_taxon = m.raw_taxon LEFT JOIN taxon_name t ON m.clean_name = t.taxon_name
      WHERE r.cnt IS NOT NULL GROUP BY r.ID_SAMPLE, t.ID_TAXON),
    inter AS (SELECT c.ID_SAMPLE, u.ID_TAXON, 1 AS amalgamation_level, coalesce(sum(c.count), 0) AS count
      FROM clean c LEFT JOIN taxon_name t ON c.ID_TAXON = t.ID_TAXON
      LEFT JOIN (SELECT DISTINCT clean_name, intermediate FROM taxa_map) m ON t.taxon_name = m.clean_name
      LEFT JOIN taxon_name u ON m.intermediate = u.taxon_name GROUP BY c.ID_SAMPLE, u.ID_TAXON),
    amal AS (SELECT c.ID_SAMPLE, u.ID_TAXON, 2 AS amalgamation_level, coalesce(sum(c.count), 0) AS count
      FROM inter c LEFT JOIN taxon_name t ON c.ID_TAXON = t.ID_TAXON
      LEFT JOIN (SELECT DISTINCT intermediate, amalgamated FROM taxa_map) m ON t.taxon_name = m.intermediate
      LEFT JOIN taxon_name u ON m.amalgamated = u.taxon_name GROUP BY c.ID_SAMPLE, u.ID_TAXON)
"""


def clean(w):
    return amalgamate.amalgamate_clean(w.raw_count.select("ID_SAMPLE", "raw_taxon", "count"), w.taxa_map, w.taxon_name)


@query("amalgamate_clean", _CLEAN + "SELECT * FROM clean")
def _(w):
    return clean(w)


@query("amalgamate_intermediate", _CLEAN + "SELECT * FROM inter")
def _(w):
    return amalgamate.amalgamate_intermediate(clean(w), w.taxa_map, w.taxon_name)


@query("amalgamate_amalgamated", _CLEAN + "SELECT * FROM amal")
def _(w):
    inter = amalgamate.amalgamate_intermediate(clean(w), w.taxa_map, w.taxon_name)
    return amalgamate.amalgamate_amalgamated(inter, w.taxa_map, w.taxon_name)


@query(
    "amalgamate_levels",
    """SELECT ID_SAMPLE, ID_TAXON, amalgamation_level, cnt AS count FROM pollen_count
       UNION ALL SELECT ID_SAMPLE, NULL, l.level, sum(cnt) FROM raw_count CROSS JOIN (VALUES (0), (1), (2)) l(level)
       WHERE cnt IS NOT NULL AND raw_taxon NOT IN (SELECT raw_taxon FROM taxa_map) GROUP BY ALL""",
)
def _(w):
    return amalgamate.amalgamate_levels(w.raw_count.select("ID_SAMPLE", "raw_taxon", "count"), w.taxa_map, w.taxon_name)


@query(
    "unmapped_taxa",
    _CLEAN + "SELECT ID_SAMPLE, amalgamation_level, sum(count) AS lost_count FROM clean WHERE ID_TAXON IS NULL GROUP BY ALL",
)
def _(w):
    return amalgamate.unmapped(clean(w))


@query(
    "amalgamation_shrinkage",
    """SELECT *, n_clean - n_intermediate AS clean_minus_intermediate, n_clean - n_amalgamated AS clean_minus_amalgamated
       FROM (SELECT ID_SAMPLE, count(*) FILTER (amalgamation_level = 0) AS n_clean,
                    count(*) FILTER (amalgamation_level = 1) AS n_intermediate,
                    count(*) FILTER (amalgamation_level = 2) AS n_amalgamated FROM pollen_count GROUP BY ID_SAMPLE)
       ORDER BY clean_minus_amalgamated DESC, ID_SAMPLE""",
)
def _(w):
    return amalgamate.level_shrinkage(w.pollen_count)


@query(
    "text_null_cleanup",
    """SELECT ID_DATE_INFO, date_type, CASE WHEN ID_DATE_INFO % 6 = 0 THEN NULL ELSE lab_num END AS lab_num FROM date_info""",
)
def _(w):
    typed = F.when(F.col("ID_DATE_INFO") % 6 == 0, "NULL").otherwise(F.col("lab_num"))
    text = w.date_info.select("ID_DATE_INFO", F.coalesce("date_type", F.lit("NULL")).alias("date_type"), typed.alias("lab_num"))
    return text.select("ID_DATE_INFO", *[null_text(F.col(c)).alias(c) for c in ("date_type", "lab_num")])


@query(
    "if_else_null_test",
    """SELECT ID_DATE_INFO, CASE WHEN depth IS NULL THEN NULL WHEN depth > 50 THEN 'deep' ELSE 'shallow' END AS zone FROM date_info""",
)
def _(w):
    return w.date_info.select("ID_DATE_INFO", if_else(F.col("depth") > 50, F.lit("deep"), F.lit("shallow")).alias("zone"))


@query("load_tables", " UNION ALL ".join(table_sql(t) for t in TABLES))
def _(w):
    path = scratch_path(w.spark, "archive")
    for name in TABLES:
        table = w.archive.table(name)
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in SCHEMAS[name] if f.name not in table.columns]
        tables.write_table(table.select("*", *missing).select(*SCHEMAS[name].names), path, name)
    stored = tables.load_archive(w.spark, path)
    return reshape.union_sources(*[quality.fingerprint(stored.table(t).select(*SCHEMAS[t].names), t) for t in TABLES])
