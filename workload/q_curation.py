"""Snapshots, summaries, changes, checks and files."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltframe.functions import (
    derive_age_used,
    parse_flag,
    standard_date_type,
    to_centimetres,
    within_age_tolerance,
)
from siltframe.operators import agemodel, amalgamate, changes, dates, harmonise, ids, match, quality, reshape
from siltframe.plans import summary
from siltframe.plans.snapshot import snapshot
from siltframe.schema import LEGACY_LINK_SCHEMA, LEVELS, SCHEMAS
from siltframe.session import scratch_path
from siltframe.sources import colocated, files, tables, versions

from .fingerprints import fingerprint_sql, table_sql
from .q_counts import LEVEL_NAMES, wide_sql
from .registry import query

# ---- snapshots and summaries -------------------------------------------------------------------

_EUROPE = "SELECT n_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey WHERE r.r_name = 'EUROPE'"
_PICKED = f"SELECT ID_ENTITY FROM entity WHERE site_name IN ({_EUROPE})"


def european_sites(w):
    region = w.given("region").where(F.col("r_name") == "EUROPE").select(F.col("r_regionkey").alias("n_regionkey"))
    return w.given("nation").join(region, "n_regionkey").select(F.col("n_name").alias("site_name"))


def picked(w):
    return snapshot(w, european_sites(w))


@query("snapshot_entity", f"SELECT * FROM entity WHERE site_name IN ({_EUROPE})")
def _(w):
    return picked(w).entity


@query("snapshot_dates", f"SELECT * FROM date_info WHERE ID_ENTITY IN ({_PICKED})")
def _(w):
    return picked(w).date_info


@query("snapshot_samples", f"SELECT * FROM sample WHERE ID_ENTITY IN ({_PICKED})")
def _(w):
    return picked(w).sample


@query(
    "snapshot_age_model",
    f"""SELECT a.*, m.model_name FROM age_model a LEFT JOIN model_name m ON a.ID_MODEL = m.ID_MODEL
        WHERE a.ID_SAMPLE IN (SELECT ID_SAMPLE FROM sample WHERE ID_ENTITY IN ({_PICKED}))""",
)
def _(w):
    return picked(w).age_model


def _register_counts(level: str) -> None:
    @query(f"snapshot_counts_{level}", wide_sql(level))
    def _(w):
        return snapshot(w).wide(level)


for _level in LEVELS:
    _register_counts(_level)


@query(
    "snapshot_counts_long",
    f"""SELECT p.ID_SAMPLE, t.taxon_name, p.amalgamation_level, p.cnt AS count
        FROM pollen_count p LEFT JOIN taxon_name t ON p.ID_TAXON = t.ID_TAXON
        WHERE p.ID_SAMPLE IN (SELECT ID_SAMPLE FROM sample WHERE ID_ENTITY IN ({_PICKED}))""",
)
def _(w):
    return picked(w).counts


@query("snapshot_from_table", "SELECT * FROM entity WHERE ID_SITE IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)")
def _(w):
    rich = w.given("supplier").where(F.col("s_acctbal") > 5000)
    keys = rich.select(F.col("s_nationkey").cast("bigint").alias("ID_SITE"), F.lit("any").alias("site_name"))
    return snapshot(w, keys).entity


_STATS = """
    SELECT e.ID_SITE, e.ID_ENTITY, e.site_name, e.entity_name, coalesce(d.n, 0) AS dates, coalesce(s.n, 0) AS samples,
           coalesce(a.n, 0) AS age_model, coalesce(p.n0, 0) AS clean, coalesce(p.n1, 0) AS intermediate, coalesce(p.n2, 0) AS amalgamated
    FROM entity e LEFT JOIN (SELECT ID_ENTITY, count(*) AS n FROM date_info GROUP BY ALL) d ON e.ID_ENTITY = d.ID_ENTITY
    LEFT JOIN (SELECT ID_ENTITY, count(*) AS n FROM sample GROUP BY ALL) s ON e.ID_ENTITY = s.ID_ENTITY
    LEFT JOIN (SELECT ID_ENTITY, count(*) AS n FROM age_model JOIN sample USING (ID_SAMPLE) GROUP BY ALL) a ON e.ID_ENTITY = a.ID_ENTITY
    LEFT JOIN (SELECT ID_ENTITY, count(DISTINCT ID_SAMPLE) FILTER (amalgamation_level = 0) AS n0,
                      count(DISTINCT ID_SAMPLE) FILTER (amalgamation_level = 1) AS n1,
                      count(DISTINCT ID_SAMPLE) FILTER (amalgamation_level = 2) AS n2
               FROM pollen_count JOIN sample USING (ID_SAMPLE) GROUP BY ALL) p ON e.ID_ENTITY = p.ID_ENTITY
"""


@query("snapshot_stats", _STATS)
def _(w):
    stats = snapshot(w).stats()
    return stats.select(*stats.columns[:-1], "pollen_counts.*")


_SUMMARY = f"""
    WITH stats AS ({_STATS}), models AS (SELECT s.ID_ENTITY, count(DISTINCT a.ID_SAMPLE) AS n
      FROM age_model a JOIN sample s ON a.ID_SAMPLE = s.ID_SAMPLE GROUP BY ALL),
    full_summary AS (SELECT e.*, CASE WHEN t.dates > 0 THEN true END AS DATES, CASE WHEN t.samples > 0 THEN true END AS SAMPLES,
      CASE WHEN m.n > 0 THEN true END AS AM, nullif(t.clean, 0) AS n_counts_0, t.clean > 0 AS COUNTS_0,
      nullif(t.intermediate, 0) AS n_counts_1, t.intermediate > 0 AS COUNTS_1,
      nullif(t.amalgamated, 0) AS n_counts_2, t.amalgamated > 0 AS COUNTS_2,
      nullif(t.dates, 0) AS n_dates, nullif(t.samples, 0) AS n_samples, m.n AS n_am,
      CASE WHEN t.clean = t.intermediate AND t.clean = t.amalgamated THEN nullif(t.clean, 0) END AS n_counts,
      t.dates > 0 AS has_DATES, t.samples > 0 AS has_SAMPLES, m.n IS NOT NULL AS has_AM,
      t.clean > 0 AND t.intermediate > 0 AND t.amalgamated > 0 AS has_COUNTS,
      t.clean = t.intermediate AND t.clean = t.amalgamated AS levels_agree
      FROM entity e JOIN stats t ON e.ID_ENTITY = t.ID_ENTITY LEFT JOIN models m ON e.ID_ENTITY = m.ID_ENTITY)
"""


@query("db_summary", _SUMMARY + "SELECT * FROM full_summary")
def _(w):
    return summary.db_summary(w)


@query(
    "db_summary_totals",
    _SUMMARY
    + """SELECT count(*) AS entities, count(*) FILTER (has_DATES) AS with_dates, count(*) FILTER (has_AM) AS with_age_models,
                count(*) FILTER (has_COUNTS) AS with_counts FROM full_summary""",
)
def _(w):
    return summary.db_summary_totals(summary.db_summary(w))


@query(
    "export_summary",
    _SUMMARY + "SELECT ID_ENTITY, n_dates, n_samples, n_am, n_counts, has_DATES, has_COUNTS FROM full_summary",
)
def _(w):
    path = summary.write_summary(summary.db_summary(w), scratch_path(w.spark, "export"), "2022-03-01")
    types = "n_dates bigint, n_samples bigint, n_am bigint, n_counts bigint, has_DATES boolean, has_COUNTS boolean"
    stored = w.spark.read.csv(path, header=True).select("ID_ENTITY", *[c.split()[0] for c in types.split(", ")])
    schema = f"ID_ENTITY bigint, {types}"
    return stored.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in schema.split(", ")])


# ---- changes ------------------------------------------------------------------------------------


@query("append_new_records", "SELECT * FROM external_link")
def _(w):
    stored = w.external_link.where(F.col("external_source") == "NEOTOMA")
    new = w.external_link.where(F.col("external_source") == "OTHER")
    key = ["ID_ENTITY", "external_ID_ENTITY", "external_source"]
    return changes.append_records(stored, new, key, {"ID_ENTITY": w.entity})


@query(
    "append_unseen_counts",
    """SELECT ID_SAMPLE, ID_TAXON, amalgamation_level, CASE WHEN amalgamation_level = 2 THEN cnt + 1 ELSE cnt END AS count FROM pollen_count""",
)
def _(w):
    stored = w.pollen_count.where(F.col("amalgamation_level") < 2)
    new = w.pollen_count.withColumn("count", F.col("count") + 1)
    return changes.append_unseen(stored, new, ["ID_SAMPLE", "ID_TAXON", "amalgamation_level"])


_SLIM = ["ID_ENTITY", "ID_SAMPLE", "depth", "thickness", "age"]


def sample_updates(w):
    """Thickness corrections of every ninth sample, and samples that are not stored yet."""
    corrected = w.sample.where(F.col("ID_SAMPLE") % 9 == 0).select(
        "ID_SAMPLE", F.when(F.col("ID_SAMPLE") % 2 == 0, 2.5).alias("thickness")
    )
    new = w.sample.where(F.col("age").isNull()).select((F.col("ID_SAMPLE") + 10**9).alias("ID_SAMPLE"), "thickness")
    return corrected.unionByName(new)


@query(
    "upsert_by_key",
    """SELECT ID_ENTITY, ID_SAMPLE, depth, CASE WHEN ID_SAMPLE % 18 = 0 THEN 2.5 WHEN ID_SAMPLE % 9 = 0 THEN NULL ELSE thickness END AS thickness, age FROM sample
       UNION ALL SELECT NULL, ID_SAMPLE + 1000000000, NULL, thickness, NULL FROM sample WHERE age IS NULL""",
)
def _(w):
    return changes.upsert(w.sample.select(*_SLIM), sample_updates(w), ["ID_SAMPLE"])


@query(
    "change_set",
    """SELECT ID_SAMPLE, 'update' AS action FROM sample WHERE ID_SAMPLE % 9 = 0
       UNION ALL SELECT ID_SAMPLE + 1000000000, 'insert' FROM sample WHERE age IS NULL""",
)
def _(w):
    return changes.change_set(w.sample.select(*_SLIM), sample_updates(w), ["ID_SAMPLE"])


@query(
    "update_where",
    """SELECT ID_DATE_INFO, CASE WHEN reason_age_not_used = 'outlier' THEN 'no' ELSE age_used END AS age_used,
              CASE WHEN reason_age_not_used = 'outlier' THEN upper(lab_num) ELSE lab_num END AS lab_num FROM date_info""",
)
def _(w):
    updated = changes.update_where(
        w.date_info, F.col("reason_age_not_used") == "outlier", {"age_used": "no", "lab_num": F.upper("lab_num")}
    )
    return updated.select("ID_DATE_INFO", "age_used", "lab_num")


@query("delete_links", "SELECT *, CASE WHEN external_ID_SITE < 1010 THEN 'removed' ELSE 'kept' END AS part FROM external_link")
def _(w):
    kept, removed = changes.delete_where(w.external_link, F.col("external_ID_SITE") < 1010)
    return reshape.tagged_union({"kept": kept, "removed": removed}, "part")


@query(
    "rm_links",
    """SELECT *, 'left' AS part FROM external_link WHERE NOT (ID_ENTITY = 12 AND external_source = 'OTHER')
       UNION ALL SELECT *, 'before' FROM external_link WHERE ID_ENTITY = 12""",
)
def _(w):
    left, before = changes.rm_links(w.external_link, 12, "OTHER")
    return reshape.tagged_union({"left": left, "before": before}, "part")


@query("delete_by_rows", "SELECT * FROM external_link WHERE NOT (ID_SITE >= 10 AND external_source = 'OTHER')")
def _(w):
    rows = w.external_link.where((F.col("ID_SITE") >= 10) & (F.col("external_source") == "OTHER"))
    return changes.delete_rows(w.external_link, rows)


_GONE = "SELECT ID_ENTITY FROM entity WHERE site_type = 'machinery'"
_GONE_SAMPLES = f"SELECT ID_SAMPLE FROM sample WHERE ID_ENTITY IN ({_GONE})"


@query(
    "cascade_delete",
    " UNION ALL ".join(
        [table_sql(t, f"(SELECT * FROM {t} WHERE ID_ENTITY NOT IN ({_GONE}))") for t in ("entity", "external_link", "date_info", "sample")]
        + [table_sql(t, f"(SELECT * FROM {t} WHERE ID_SAMPLE NOT IN ({_GONE_SAMPLES}))") for t in ("pollen_count", "age_model")]
    ),
)
def _(w):
    left = changes.cascade_delete(w.archive, w.entity.where(F.col("site_type") == "machinery").select("ID_ENTITY"))
    names = ("entity", "external_link", "date_info", "sample", "pollen_count", "age_model")
    return reshape.union_sources(*[quality.fingerprint(left.table(t).select(*SCHEMAS[t].names), t) for t in names])


@query(
    "split_existing_new",
    """WITH incoming AS (SELECT ID_ENTITY, round_even(depth, 3) AS depth, thickness FROM source_sample
         UNION ALL SELECT ID_ENTITY, depth + 5000.5, thickness FROM sample WHERE ID_SAMPLE % 4 = 0),
       marked AS (SELECT i.*, EXISTS (SELECT 1 FROM sample s WHERE s.ID_ENTITY = i.ID_ENTITY AND s.depth = i.depth) AS known FROM incoming i)
       SELECT 'existing' AS part, ID_ENTITY, depth, thickness, NULL AS ID_SAMPLE FROM marked WHERE known
       UNION ALL SELECT 'new', ID_ENTITY, depth, thickness,
         (SELECT max(ID_SAMPLE) FROM sample) + row_number() OVER (ORDER BY ID_ENTITY, depth, thickness) FROM marked WHERE NOT known""",
)
def _(w):
    incoming = w.source_sample.select("ID_ENTITY", F.bround("depth", 3).alias("depth"), "thickness").unionByName(
        w.sample.where(F.col("ID_SAMPLE") % 4 == 0).select(
            "ID_ENTITY", (F.col("depth") + 5000.5).alias("depth"), "thickness"
        )
    )
    existing, new = changes.split_existing_new(w.sample, incoming, ["ID_ENTITY", "depth"])
    start = ids.current_max_id(w.sample, "ID_SAMPLE")
    numbered = ids.assign_ids(new, ["ID_ENTITY", "depth", "thickness"], "ID_SAMPLE", start)
    return reshape.tagged_union({"existing": existing, "new": numbered}, "part")


@query(
    "resolve_duplicates",
    """SELECT ID_SITE, ID_ENTITY, entity_name, source FROM entity WHERE ID_ENTITY % 10 <> 3
       UNION ALL SELECT ID_SITE, ID_ENTITY, entity_name, 'reviewed' FROM entity WHERE ID_ENTITY % 20 = 3""",
)
def _(w):
    slim = w.entity.select("ID_SITE", "ID_ENTITY", "entity_name", "source")
    keep = F.when(F.col("ID_ENTITY") % 20 == 3, 1).otherwise(0)
    reviewed = slim.where(F.col("ID_ENTITY") % 10 == 3).withColumns({"source": F.lit("reviewed"), "keep": keep})
    return changes.resolve_duplicates(slim, reviewed, "ID_ENTITY")


# ---- age models ---------------------------------------------------------------------------------

_QC = """
    WITH rows_ AS (SELECT DISTINCT ID_ENTITY, depths, mean, median, uncert_5, uncert_25, uncert_75, uncert_95 FROM age_file),
    a AS (SELECT *, count(*) OVER (PARTITION BY ID_ENTITY) AS n, row_number() OVER (PARTITION BY ID_ENTITY ORDER BY depths, mean) AS rn FROM rows_),
    b AS (SELECT ID_ENTITY, ID_SAMPLE, depth, count(*) OVER (PARTITION BY ID_ENTITY) AS n,
                 row_number() OVER (PARTITION BY ID_ENTITY ORDER BY depth, ID_SAMPLE) AS rn FROM sample),
    qc AS (SELECT a.ID_ENTITY, CASE WHEN max(a.n) <> coalesce(max(b.n), 0) THEN 'Mismatch in the number of samples.'
                  WHEN max(abs(a.depths - b.depth)) > 0.001 THEN 'Mismatch in the depths.' END AS reason
           FROM a LEFT JOIN b ON a.ID_ENTITY = b.ID_ENTITY AND a.rn = b.rn GROUP BY a.ID_ENTITY)
"""
_ACCEPTED = """
    SELECT 8 AS ID_MODEL, b.ID_SAMPLE, CAST(trunc(a.mean) AS INT) AS mean, CAST(trunc(a.median) AS INT) AS median,
           CAST(trunc(a.uncert_5) AS INT) AS UNCERT_5, CAST(trunc(a.uncert_25) AS INT) AS UNCERT_25,
           CAST(trunc(a.uncert_75) AS INT) AS UNCERT_75, CAST(trunc(a.uncert_95) AS INT) AS UNCERT_95
    FROM a JOIN b ON a.ID_ENTITY = b.ID_ENTITY AND a.rn = b.rn JOIN qc ON qc.ID_ENTITY = a.ID_ENTITY AND qc.reason IS NULL
"""


@query("age_model_qc", _QC + "SELECT ID_ENTITY, reason IS NULL AS status, reason FROM qc")
def _(w):
    return agemodel.age_model_qc(w.age_file, w.sample)


@query("age_model_accept", _QC + _ACCEPTED)
def _(w):
    return agemodel.accepted_rows(w.age_file, w.sample)[0]


@query(
    "replace_age_models",
    _QC
    + """SELECT m.* FROM age_model m JOIN sample s ON m.ID_SAMPLE = s.ID_SAMPLE LEFT JOIN qc ON qc.ID_ENTITY = s.ID_ENTITY
         WHERE NOT (m.ID_MODEL = 8 AND qc.ID_ENTITY IS NOT NULL AND qc.reason IS NULL) UNION ALL """
    + _ACCEPTED,
)
def _(w):
    return agemodel.load_age_models(w.age_file, w.sample, w.age_model)


_REVIEW = """
    WITH review AS (SELECT ID_ENTITY, entity_name,
        CASE ID_ENTITY % 6 WHEN 0 THEN 'Yes' WHEN 1 THEN 'y' WHEN 2 THEN 'No' WHEN 3 THEN 'maybe' WHEN 4 THEN 'IGNORE this' END AS ready_to_upload,
        CASE ID_ENTITY % 5 WHEN 0 THEN 'only one date' WHEN 1 THEN 'can be extracted from elsewhere' WHEN 2 THEN 'run ok' WHEN 3 THEN 'not run' END AS run_status
      FROM entity)
"""


def review(w):
    def by(n, *values):
        choice = F.when(F.lit(False), None)
        for i, v in enumerate(values):
            choice = choice.when(F.col("ID_ENTITY") % n == i, v)
        return choice

    return w.entity.select(
        "ID_ENTITY",
        "entity_name",
        by(6, "Yes", "y", "No", "maybe", "IGNORE this").alias("ready_to_upload"),
        by(5, "only one date", "can be extracted from elsewhere", "run ok", "not run").alias("run_status"),
    )


@query(
    "parse_flags",
    _REVIEW
    + """SELECT ID_ENTITY, ready_to_upload, CASE WHEN regexp_matches(ready_to_upload, '^[Yy]') THEN true
                WHEN regexp_matches(ready_to_upload, '^[Nn]') THEN false END AS ready FROM review""",
)
def _(w):
    return review(w).select("ID_ENTITY", "ready_to_upload", parse_flag(F.col("ready_to_upload")).alias("ready"))


@query(
    "age_models_ready",
    _REVIEW
    + """SELECT ID_ENTITY, entity_name, 'ready' AS part FROM review WHERE regexp_matches(ready_to_upload, '^[Yy]')
         UNION ALL SELECT ID_ENTITY, entity_name, 'pending' FROM review
         WHERE ready_to_upload = 'maybe' AND run_status IN ('run ok', 'not run') AND entity_name <> 'Customer#000000003'""",
)
def _(w):
    ready, pending = agemodel.age_models_ready(review(w), ["Customer#000000003"])
    return reshape.tagged_union({"ready": ready, "pending": pending}, "part").select("ID_ENTITY", "entity_name", "part")


# ---- dates and values ---------------------------------------------------------------------------


@query(
    "prepare_dates",
    """SELECT * FROM (SELECT d.ID_ENTITY, d.lab_num,
         coalesce(CASE WHEN d.age_c14 IN (-777777, -888888, -999999) THEN NULL ELSE d.age_c14 END,
                  CASE WHEN d.age_calib IN (-777777, -888888, -999999) THEN NULL ELSE d.age_calib END) AS age,
         CASE WHEN d.error IS NULL OR d.error <= 0 THEN 1 ELSE d.error END AS error, d.depth,
         CASE WHEN NOT regexp_matches(d.date_type, 'carbon|AMS|Counting|counting') THEN 0
              WHEN e.latitude <= -15 THEN 3 WHEN e.latitude < 15 THEN 4 ELSE 1 END AS cc
       FROM (SELECT ID_ENTITY, lab_num, age_c14, age_calib, error, depth, date_type FROM date_info
             UNION ALL SELECT ID_ENTITY, 'top', NULL, 0, 5, 0, 'Top of core known' FROM entity WHERE ID_ENTITY % 4 = 0) d
       LEFT JOIN entity e ON d.ID_ENTITY = e.ID_ENTITY
       WHERE NOT regexp_matches(d.date_type, 'hiatus|Hiatus')) WHERE age IS NOT NULL""",
)
def _(w):
    tops = w.entity.where(F.col("ID_ENTITY") % 4 == 0).select(
        "ID_ENTITY",
        F.lit("top").alias("lab_num"),
        F.lit(0.0).alias("age_calib"),
        F.lit(5.0).alias("error"),
        F.lit(0.0).alias("depth"),
        F.lit("Top of core known").alias("date_type"),
    )
    return dates.prepare_dates(w.date_info, w.entity, tops)


@query(
    "model_inputs",
    """SELECT ID_ENTITY, 'sample_depths' AS part, row_number() OVER (PARTITION BY ID_ENTITY ORDER BY depth, ID_SAMPLE) AS id, depth FROM sample
       UNION ALL SELECT ID_ENTITY, 'hiatus', NULL, depth FROM date_info WHERE regexp_matches(date_type, 'hiatus|Hiatus')""",
)
def _(w):
    return dates.model_inputs(w.date_info, w.sample)


@query(
    "standardise_date_type",
    """SELECT ID_DATE_INFO, date_type, CASE WHEN date_type LIKE '%core top estimated%' THEN 'Top of core estimated'
              WHEN date_type LIKE '%pollen correlation%' THEN 'Pollen correlation' ELSE date_type END AS standard FROM date_info""",
)
def _(w):
    return w.date_info.select("ID_DATE_INFO", "date_type", standard_date_type(F.col("date_type")).alias("standard"))


@query(
    "to_centimetres",
    """SELECT ID_DATE_INFO, CASE WHEN thickness < 0 THEN thickness ELSE thickness * 100 END AS thickness, depth * 100 AS depth FROM date_info""",
)
def _(w):
    return w.date_info.select("ID_DATE_INFO", *[to_centimetres(F.col(c)).alias(c) for c in ("thickness", "depth")])


@query(
    "age_within_tolerance",
    """WITH m AS (SELECT s.ID_SAMPLE, s.age, b.age AS age_source, s.chronology_name FROM sample s
         LEFT JOIN source_sample b ON s.ID_ENTITY = b.ID_ENTITY AND round_even(s.depth, 3) = round_even(b.depth, 3)),
       g AS (SELECT *, (round_even(age_source, 0) >= round_even(age, 0) * CAST(0.99 AS DOUBLE)
                        AND round_even(age_source, 0) <= round_even(age, 0) * CAST(1.01 AS DOUBLE))
                       OR (age IS NULL AND age_source IS NULL) AS same_age FROM m)
       SELECT ID_SAMPLE, age, age_source, same_age, CASE WHEN same_age THEN chronology_name END AS chronology_name FROM g""",
)
def _(w):
    source = w.source_sample.select("ID_ENTITY", "depth", F.col("age").alias("age_source"))
    matched = match.match_depth_rounded(w.sample, source)
    gated = match.gate_by_age(matched, "age_source", "age", ["chronology_name"])
    return gated.select("ID_SAMPLE", "age", "age_source", "same_age", "chronology_name")


@query(
    "age_tolerance_by_size",
    """SELECT ID_DATE_INFO, abs(round_even(-depth, 0) - round_even(-depth * 1.5, 0)) <= abs(round_even(-depth * 1.5, 0)) * CAST(0.01 AS DOUBLE)
              OR depth IS NULL AS same_age FROM date_info""",
)
def _(w):
    gate = within_age_tolerance(-F.col("depth"), -F.col("depth") * 1.5, by_size=True)
    return w.date_info.select("ID_DATE_INFO", gate.alias("same_age"))


@query(
    "recode_values",
    """SELECT ID_DATE_INFO, CASE material_dated WHEN ' bulk   sediment ' THEN 'bulk sediment' WHEN 'unknown material' THEN 'not known' ELSE material_dated END AS material_dated FROM date_info""",
)
def _(w):
    # A reviewed value list.
    rows = [
        ("material_dated", " bulk   sediment ", "bulk sediment"),
        ("material_dated", "unknown material", "not known"),
        ("material_dated", "peat", "peat"),
        ("date_type", "peat", "never applied"),
    ]
    revised = tables.literal_table(w.spark, rows, "variable string, current string, new string")
    return dates.recode_values(w.date_info, revised, "material_dated").select("ID_DATE_INFO", "material_dated")


def _filled(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR {c} LIKE '%unknown%' THEN 'not known' ELSE {c} END AS {c}"


@query(
    "fill_unknowns",
    f"""SELECT ID_DATE_INFO, {_filled("age_used")}, {_filled("date_type")}, {_filled("material_dated")},
               CASE WHEN reason_age_not_used IS NULL OR reason_age_not_used LIKE '%unknown%' THEN
                 CASE WHEN age_used IS NULL OR age_used = 'no' THEN 'not known' ELSE 'not applicable' END
               ELSE reason_age_not_used END AS reason_age_not_used FROM date_info""",
)
def _(w):
    filled = dates.fill_unknown_dates(w.date_info)
    return filled.select("ID_DATE_INFO", "age_used", "date_type", "material_dated", "reason_age_not_used")


@query(
    "route_reasons",
    """SELECT ID_DATE_INFO, CASE reason_age_not_used WHEN 'outlier' THEN NULL WHEN 'see text' THEN NULL
                WHEN 'reversal ' THEN 'reversal' ELSE reason_age_not_used END AS reason_age_not_used,
              coalesce(notes, CASE reason_age_not_used WHEN 'see text' THEN 'see the text' END) AS notes,
              CASE WHEN reason_age_not_used = 'outlier' THEN 'no' ELSE age_used END AS age_used FROM date_info""",
)
def _(w):
    # A reviewed reason list.
    rows = [
        ("see text", "see the text", "move to notes"),
        ("outlier", "outlier", "no reason given"),
        ("reversal ", "reversal", None),
        ("unknown reason", "unknown reason", None),
    ]
    revised = tables.literal_table(w.spark, rows, "current string, new string, remark string")
    routed = dates.route_reasons(w.date_info, revised)
    return routed.select("ID_DATE_INFO", "reason_age_not_used", "notes", "age_used")


@query("derive_age_used", "SELECT ID_DATE_INFO, CASE WHEN reason_age_not_used IS NULL THEN 'yes' ELSE 'no' END AS age_used FROM date_info")
def _(w):
    return w.date_info.select("ID_DATE_INFO", derive_age_used(F.col("reason_age_not_used")).alias("age_used"))


# ---- sources and links --------------------------------------------------------------------------


def external_tables(w):
    """An external source with its own column names and metres, derived from the given tables."""
    return {
        "entity": w.entity.select("ID_ENTITY", "ID_SITE", "entity_name", F.col("source").alias("TYPE"), "latitude"),
        "entity_pub": w.entity_pub,
        "pub": w.pub,
        "site": w.entity.select("ID_SITE", "site_name").distinct(),
        "date_info": w.date_info.select(
            "ID_ENTITY",
            F.col("depth").alias("avg_depth"),
            "thickness",
            F.col("age_c14").alias("age_C14"),
            F.col("error").alias("error_positive"),
            (F.col("error") / 2).alias("error_negative"),
            F.col("notes").alias("correlation_info"),
        ),
        "sample": w.sample.select("ID_ENTITY", "ID_SAMPLE", F.col("depth").alias("avg_depth"), "thickness"),
        "age_model": w.age_model.select("ID_SAMPLE", "ID_MODEL", F.col("mean").alias("est_age")),
        "pollen": w.raw_count.select("ID_SAMPLE", "raw_taxon", "count"),
    }


SOURCE = {
    "entity": harmonise.TableMapping(rename={"TYPE": "entity_type"}),
    "date_info": harmonise.TableMapping(
        rename={"avg_depth": "depth", "age_C14": "age_c14"},
        centimetres=("depth", "thickness"),
        error=("error_positive", "error_negative"),
        drop=("correlation_info",),
    ),
    "sample": harmonise.TableMapping(rename={"avg_depth": "depth"}, centimetres=("thickness",), scale=("depth",)),
    "age_model": harmonise.TableMapping(rename={"est_age": "age"}),
}

_PUBLICATION = """(SELECT x.ID_ENTITY, CASE WHEN count(*) = count(citation) THEN string_agg(citation, ';' || chr(10) ORDER BY x.ID_PUB) END AS publication
                   FROM entity_pub x LEFT JOIN pub ON x.ID_PUB = pub.ID_PUB GROUP BY x.ID_ENTITY)"""


def harmonised(w):
    chosen = w.entity.where(F.col("site_type").isNotNull()).select("ID_ENTITY")
    return harmonise.harmonise_source(external_tables(w), SOURCE, chosen)


@query(
    "harmonise_source",
    f"""SELECT e.ID_SITE, e.ID_ENTITY, e.entity_name, e.source AS entity_type, e.latitude, p.publication, e.site_name
        FROM entity e LEFT JOIN {_PUBLICATION} p ON e.ID_ENTITY = p.ID_ENTITY WHERE e.site_type IS NOT NULL""",
)
def _(w):
    return harmonised(w)["metadata"]


@query(
    "harmonise_source_dates",
    """SELECT ID_ENTITY, depth * 100 AS depth, CASE WHEN thickness < 0 THEN thickness ELSE thickness * 100 END AS thickness, age_c14, error
       FROM date_info WHERE ID_ENTITY IN (SELECT ID_ENTITY FROM entity WHERE site_type IS NOT NULL)""",
)
def _(w):
    return harmonised(w)["date_info"]


@query(
    "harmonise_source_models",
    """SELECT s.ID_SAMPLE, s.ID_ENTITY AS external_ID_ENTITY, s.depth * 100 AS depth, s.thickness * 100 AS thickness, a.ID_MODEL, a.mean AS age
       FROM sample s JOIN age_model a ON a.ID_SAMPLE = s.ID_SAMPLE
       WHERE s.ID_ENTITY IN (SELECT ID_ENTITY FROM entity WHERE site_type IS NOT NULL)""",
)
def _(w):
    return harmonised(w)["age_model"]


@query(
    "external_links",
    """SELECT CASE WHEN e.ID_SITE < 20 THEN e.ID_SITE END AS ID_SITE, CASE WHEN e.ID_SITE < 20 THEN e.ID_ENTITY END AS ID_ENTITY,
              e.ID_SITE + 500 AS external_ID_SITE, e.ID_ENTITY + 70000 AS external_ID_ENTITY,
              e.site_name AS external_site_name, e.entity_name AS external_entity_name, 'OTHER' AS external_source FROM entity e""",
)
def _(w):
    external = w.entity.select(
        "entity_name",
        (F.col("ID_SITE") + 500).alias("external_ID_SITE"),
        (F.col("ID_ENTITY") + 70000).alias("external_ID_ENTITY"),
        F.col("site_name").alias("external_site_name"),
        F.col("entity_name").alias("external_entity_name"),
    )
    return harmonise.external_links(w.entity.where(F.col("ID_SITE") < 20), external, "entity_name", "OTHER")


@query("links_from_legacy", "SELECT * FROM external_link WHERE external_source = 'NEOTOMA'")
def _(w):
    legacy = w.external_link.where(F.col("external_source") == "NEOTOMA").select(*w.external_link.columns[:6])
    stored = legacy.toDF(*LEGACY_LINK_SCHEMA.names)
    return harmonise.links_from_legacy(stored)


@query(
    "default_source",
    """SELECT e.*, coalesce(l.external_source, 'NEOTOMA') AS external_source FROM entity e
       LEFT JOIN (SELECT * FROM external_link WHERE external_source <> 'NEOTOMA') l ON e.ID_ENTITY = l.ID_ENTITY""",
)
def _(w):
    return harmonise.default_source(w.entity, w.external_link)


@query("exclusive_source", "SELECT * FROM external_link QUALIFY count(*) OVER (PARTITION BY ID_ENTITY) = 1")
def _(w):
    return harmonise.exclusive_source(w.external_link)


@query("match_flag", "SELECT external_ID_SITE IS NULL AS unmatched, * FROM external_link")
def _(w):
    return harmonise.match_flag(w.external_link, "external_ID_SITE", "unmatched")


# ---- checks -------------------------------------------------------------------------------------


@query(
    "table_diff",
    """WITH o AS (SELECT ID_SAMPLE, thickness, age, age_type FROM sample WHERE ID_SAMPLE % 50 <> 1),
       n AS (SELECT ID_SAMPLE, CASE WHEN ID_SAMPLE % 9 = 0 THEN NULL ELSE thickness + 0.0000000001 END AS thickness,
                    CASE WHEN ID_SAMPLE % 4 = 0 THEN age + 3 ELSE age END AS age,
                    CASE WHEN ID_SAMPLE % 5 = 0 THEN 'other' ELSE age_type END AS age_type FROM sample WHERE ID_SAMPLE % 50 <> 2)
       SELECT o.ID_SAMPLE, 'thickness' AS "column", '0.0' AS old_value, NULL AS new_value, 'changed' AS status
         FROM o JOIN n ON o.ID_SAMPLE = n.ID_SAMPLE WHERE o.ID_SAMPLE % 9 = 0
       UNION ALL SELECT o.ID_SAMPLE, 'age', CAST(o.age AS VARCHAR), CAST(n.age AS VARCHAR), 'changed'
         FROM o JOIN n ON o.ID_SAMPLE = n.ID_SAMPLE WHERE abs(o.age - n.age) > 1e-9 * greatest(abs(o.age), 1)
       UNION ALL SELECT o.ID_SAMPLE, 'age_type', o.age_type, n.age_type, 'changed'
         FROM o JOIN n ON o.ID_SAMPLE = n.ID_SAMPLE WHERE o.age_type IS DISTINCT FROM n.age_type
       UNION ALL SELECT ID_SAMPLE, NULL, NULL, NULL, 'added' FROM n WHERE ID_SAMPLE % 50 = 1
       UNION ALL SELECT ID_SAMPLE, NULL, NULL, NULL, 'removed' FROM o WHERE ID_SAMPLE % 50 = 2""",
)
def _(w):
    key = F.col("ID_SAMPLE")
    old = w.sample.select("ID_SAMPLE", "thickness", "age", "age_type")
    new = old.select(
        "ID_SAMPLE",
        F.when(key % 9 != 0, F.col("thickness") + 1e-10).alias("thickness"),
        F.when(key % 4 == 0, F.col("age") + 3).otherwise(F.col("age")).alias("age"),
        F.when(key % 5 == 0, "other").otherwise(F.col("age_type")).alias("age_type"),
    )
    return quality.table_diff(old.where(key % 50 != 1), new.where(key % 50 != 2), ["ID_SAMPLE"])


@query("check_pk", "SELECT ID_ENTITY, lab_num, count(*) AS n FROM date_info GROUP BY ALL HAVING count(*) > 1")
def _(w):
    return quality.check_pk(w.date_info, ["ID_ENTITY", "lab_num"])


@query("check_fk", "SELECT ID_SAMPLE, raw_taxon, cnt AS count FROM raw_count r WHERE NOT EXISTS (SELECT 1 FROM taxa_map m WHERE m.raw_taxon = r.raw_taxon)")
def _(w):
    return quality.check_fk(w.raw_count.select("ID_SAMPLE", "raw_taxon", "count"), w.taxa_map, "raw_taxon")


@query("suspicious_units", "SELECT * FROM date_info WHERE depth < 1 OR thickness < 1")
def _(w):
    return quality.suspicious_units(w.date_info)


@query("empty_dates", "SELECT * FROM date_info WHERE date_type IS NULL AND depth IS NULL AND thickness IS NULL AND age_used IS NULL")
def _(w):
    return quality.empty_dates(w.date_info)


@query(
    "drop_empty_dates",
    "SELECT * FROM date_info WHERE NOT (date_type IS NULL AND depth IS NULL AND thickness IS NULL AND age_used IS NULL)",
)
def _(w):
    return changes.drop_empty_rows(w.date_info, ["date_type", "depth", "thickness", "age_used"])[0]


@query(
    "existing_keys",
    """SELECT ID_ENTITY, ID_SAMPLE, depth FROM sample WHERE ID_ENTITY IN (SELECT user_id FROM events WHERE event_type = 'click')
          OR ID_SAMPLE IN (SELECT event_id FROM events WHERE event_type = 'click')""",
)
def _(w):
    clicks = w.given("events").where(F.col("event_type") == "click")
    new = clicks.select(F.col("user_id").alias("ID_ENTITY"), F.col("event_id").alias("ID_SAMPLE"))
    hits = quality.existing_keys(w.sample, new, ["ID_ENTITY", "ID_SAMPLE"])
    return hits.select("ID_ENTITY", "ID_SAMPLE", "depth")


@query(
    "missing_core_tops",
    """SELECT ID_ENTITY, 'Top of core known' AS date_type, depth FROM source_sample s WHERE NOT EXISTS
         (SELECT 1 FROM date_info d WHERE d.ID_ENTITY = s.ID_ENTITY AND d.date_type = 'core top estimated')""",
)
def _(w):
    source = w.source_sample.select("ID_ENTITY", F.lit("Top of core known").alias("date_type"), "depth")
    return quality.missing_core_tops(source, dates.standardise_date_types(w.date_info))


@query("zero_thickness", "SELECT ID_ENTITY, ID_SAMPLE, CASE WHEN round_even(thickness, 3) = 0 THEN NULL ELSE thickness END AS thickness FROM sample")
def _(w):
    return quality.zero_thickness(w.sample.select("ID_ENTITY", "ID_SAMPLE", "thickness"))


@query(
    "unpaired_lab_numbers",
    """SELECT *, count(*) OVER (PARTITION BY ID_ENTITY, lab_num) AS n FROM (
         SELECT ID_ENTITY, depth, regexp_replace(lab_num, '[\\s-]', '', 'g') AS lab_num FROM date_info
         UNION ALL SELECT ID_ENTITY, depth, replace(lab_num, ' - ', '') FROM date_info WHERE notes IS NULL) QUALIFY n <> 2""",
)
def _(w):
    mine = w.date_info.select("ID_ENTITY", "depth", "lab_num")
    other = w.date_info.where(F.col("notes").isNull()).select(
        "ID_ENTITY", "depth", F.replace("lab_num", F.lit(" - "), F.lit("-")).alias("lab_num")
    )
    return quality.unpaired_codes(mine, other, "ID_ENTITY")


@query(
    "unknown_entities",
    "SELECT DISTINCT external_entity_name AS entity_name FROM external_link WHERE external_entity_name NOT IN (SELECT entity_name FROM entity)",
)
def _(w):
    names = w.external_link.select(F.col("external_entity_name").alias("entity_name"))
    return quality.unknown_names(names, w.entity, "entity_name")


@query(
    "duplicate_redundancy",
    """SELECT ID_ENTITY, count(*) AS n_all, count(DISTINCT (date_type, depth, thickness, age_used)) AS n_unique FROM date_info GROUP BY ID_ENTITY""",
)
def _(w):
    return quality.redundancy(w.date_info, "ID_ENTITY", ["date_type", "depth", "thickness", "age_used"])


# ---- files --------------------------------------------------------------------------------------


@query(
    "read_csv_counts",
    """SELECT p.ID_SAMPLE, t.taxon_name AS taxon, p.cnt AS count FROM pollen_count p JOIN taxon_name t ON p.ID_TAXON = t.ID_TAXON WHERE p.amalgamation_level = 0""",
)
def _(w):
    path = scratch_path(w.spark, "counts")
    files.write_csv(snapshot(w).wide("clean"), path)
    wide = files.read_wide_csv(w.spark, path, T.StructType([T.StructField("ID_SAMPLE", T.LongType())]))
    return reshape.to_long(wide, ["ID_SAMPLE"])


@query("read_date_sheet", "SELECT ID_ENTITY AS entity_id, depth AS depth_cm, lab_num FROM date_info WHERE depth IS NOT NULL")
def _(w):
    path = scratch_path(w.spark, "sheet")
    exported = w.date_info.select(F.col("ID_ENTITY").alias("entityId"), F.col("depth").alias("Depth (cm)"), F.col("lab_num").alias("lab num"))
    files.write_csv(exported, path)
    schema = T.StructType.fromDDL("entityId bigint, `Depth (cm)` double, `lab num` string")
    return files.read_sheet(w.spark, path, schema, required="depth_cm")


@query(
    "read_age_model_files",
    """SELECT e.site_name AS entity_name, coalesce(e.site_type, 'none') AS subfolder, a.* EXCLUDE (ID_ENTITY)
       FROM age_file a JOIN entity e ON a.ID_ENTITY = e.ID_ENTITY WHERE e.site_name <> 'NATION_3'""",
)
def _(w):
    # Spark names the folders it writes key=value; the reader takes any folder name.
    path = scratch_path(w.spark, "bacon-runs")
    sites = w.entity.select("ID_ENTITY", "site_name", F.coalesce("site_type", F.lit("none")).alias("site_type"))
    placed = w.age_file.join(sites, "ID_ENTITY").select("site_type", "site_name", *files.AGE_MODEL_FILE.names)
    placed.write.partitionBy("site_type", "site_name").csv(path, header=True)
    found = files.read_age_model_files(w.spark, path)
    plain = {c: F.regexp_replace(c, "^[a-z_]+=", "") for c in ("entity_name", "subfolder")}
    named = found.withColumns(plain)
    return named.where(F.col("entity_name") != "NATION_3").drop("path")


# Sheets hold all raw counts; a raw taxon the map does not have stands under its number, without the other names.
_CELLS = """cells AS (SELECT coalesce(m.clean_name, 'raw ' || r.raw_taxon) AS name, m.clean_name, m.intermediate, m.amalgamated, r.ID_SAMPLE, r.line, r.element, r.cnt
                   FROM raw_count r LEFT JOIN taxa_map m ON r.raw_taxon = m.raw_taxon)"""
_SHEETS = f"""
    WITH {_CELLS},
    taxa AS (SELECT DISTINCT name, clean_name, intermediate, amalgamated FROM cells WHERE element <> 'A|F'),
    depths AS (SELECT DISTINCT line FROM cells),
    matrix AS (SELECT t.*, CAST(d.line * 10 AS DOUBLE) AS depth, c.total FROM taxa t CROSS JOIN depths d
               LEFT JOIN (SELECT name, line, sum(cnt) AS total FROM cells WHERE element <> 'A|F' GROUP BY ALL) c
               ON t.name = c.name AND d.line = c.line),
    list AS (SELECT name, clean_name, intermediate, amalgamated, CAST(line * 10 AS DOUBLE) AS depth, sum(cnt) AS total FROM cells WHERE element = 'A|F' GROUP BY ALL)
"""
_NAMES = ["name", "clean_name", "intermediate", "amalgamated"]


def sheet_cells(w):
    name = F.coalesce("clean_name", F.concat(F.lit("raw "), "raw_taxon")).alias("name")
    return w.raw_count.join(w.taxa_map, "raw_taxon", "left").select("ID_SAMPLE", "element", name, *_NAMES[1:], (F.col("line") * 10).alias("depth"), "count")


def count_sheets(w):
    cells = sheet_cells(w)
    depths = reshape.headers(cells, "depth")
    matrix = cells.where(F.col("element") != "A|F").groupBy(*_NAMES).pivot("depth", depths).agg(F.sum("count"))
    listed = (
        cells.where(F.col("element") == "A|F").groupBy(*_NAMES, "depth").agg(F.sum("count").alias("count"))
        .withColumn("clean_name", F.concat(F.lit(" "), "clean_name"))
    )
    return [("site m", "entity m", matrix, False), ("site l", "entity l", listed, True)]


@query(
    "harmonise_count_layouts",
    _SHEETS
    + """SELECT 'site m' AS site_name, 'entity m' AS entity_name, name AS taxon_name, clean_name AS clean, intermediate, amalgamated, depth, coalesce(total, 0) AS count FROM matrix
         UNION ALL SELECT 'site l', 'entity l', name, clean_name, intermediate, amalgamated, depth, total FROM list""",
)
def _(w):
    return files.harmonise_count_sheets(count_sheets(w))


@query(
    "harmonise_count_layouts_drop",
    _SHEETS
    + """SELECT 'site m' AS site_name, 'entity m' AS entity_name, name AS taxon_name, clean_name AS clean, intermediate, amalgamated, depth, total AS count FROM matrix WHERE total IS NOT NULL
         UNION ALL SELECT 'site l', 'entity l', name, clean_name, intermediate, amalgamated, depth, total FROM list""",
)
def _(w):
    return files.harmonise_count_sheets(count_sheets(w), null_policy="drop")


def _wide_print(level: str) -> str:
    columns = {"ID_SAMPLE": "ID_SAMPLE"} | {n: f'#"{n}"' for n in sorted(LEVEL_NAMES[level])}
    return fingerprint_sql(level, f"({wide_sql(level)})", columns)


@query(
    "write_snapshot_csv",
    " UNION ALL ".join(
        [
            table_sql("entity", shown="metadata"), table_sql("date_info", shown="dates"), table_sql("sample", shown="samples"),
            table_sql("age_model", "(SELECT a.*, m.model_name FROM age_model a LEFT JOIN model_name m ON a.ID_MODEL = m.ID_MODEL)", extra={"model_name": "model_name"}),
            *[_wide_print(level) for level in LEVELS],
        ]
    ),
)
def _(w):
    folder = scratch_path(w.spark, "bundle")
    w.spark.createDataFrame([], "none int").write.parquet(folder)
    prefix = f"{folder}/all"
    snap = snapshot(w)
    files.write_csvs(snap, prefix)
    # The values as they were read back, under declared types.
    kinds = {"metadata": SCHEMAS["entity"], "dates": SCHEMAS["date_info"], "samples": SCHEMAS["sample"], "age_model": snap.age_model.schema}
    prints = []
    for name, path in files.snapshot_files(prefix).items():
        if name in kinds:
            stored = files.read_csv(w.spark, path, T.StructType([kinds[name][c] for c in w.spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"').columns]))
            stored = stored.select(*[f.name for f in kinds[name]])
        else:
            stored = files.read_wide_csv(w.spark, path, T.StructType([T.StructField("ID_SAMPLE", T.LongType())]), "NA")
        if name == "age_model":
            stored = stored.select(*SCHEMAS["age_model"].names, "model_name")
        prints.append(quality.fingerprint(stored, name))
    return reshape.union_sources(*prints)


@query("snapshot_by_id", "SELECT * FROM date_info WHERE ID_ENTITY IN (3, 14, 15)")
def _(w):
    return snapshot(w, id_entity=[3, 14, 15]).date_info


@query("snapshot_by_name", "SELECT s.* FROM sample s JOIN entity e ON s.ID_ENTITY = e.ID_ENTITY WHERE e.entity_name IN ('Customer#000000003', 'Customer#000000014')")
def _(w):
    return snapshot(w, entity_name=["Customer#000000003", "Customer#000000014"]).sample


@query("snapshot_by_site", "SELECT * FROM entity WHERE ID_SITE IN (7, 8)")
def _(w):
    return snapshot(w, id_site=[7, 8]).entity


@query("read_sheet_skip", "SELECT ID_ENTITY AS entity_id, depth AS depth_cm, lab_num FROM date_info WHERE depth IS NOT NULL")
def _(w):
    path = scratch_path(w.spark, "skipped")
    # A sheet holds a run of at most 4000 dates of a site, below two lines of remarks and the header.
    sites = w.date_info.join(w.entity.select("ID_ENTITY", "ID_SITE"), "ID_ENTITY", "left").withColumn("ID_SITE", F.coalesce("ID_SITE", F.lit(-1)))
    placed = ids.with_position(sites.select("ID_SITE", "ID_ENTITY", "ID_DATE_INFO", "depth", "lab_num"), ["ID_DATE_INFO"], "place", ["ID_SITE"])
    sheet = F.concat_ws("-", "ID_SITE", F.floor((F.col("place") - 1) / 4000)).alias("sheet")
    cell = F.concat_ws(",", "ID_ENTITY", F.coalesce(F.col("depth").cast("string"), F.lit("")), F.concat(F.lit('"'), "lab_num", F.lit('"')))
    rows = placed.select(sheet, "place", cell.alias("value"))
    top = F.posexplode(F.array(*map(F.lit, ("dates", "as exported", "entityId,Depth (cm),lab num")))).alias("at", "value")
    heads = rows.select("sheet").distinct().select("sheet", top).select("sheet", (F.col("at") - 3).alias("place"), "value")
    lines = rows.unionByName(heads).repartition("sheet").sortWithinPartitions("sheet", "place")
    lines.select("sheet", "value").write.partitionBy("sheet").text(path)
    schema = T.StructType.fromDDL("entityId bigint, `Depth (cm)` double, `lab num` string")
    return files.read_sheet(w.spark, path, schema, required="depth_cm", skip=2)


@query(
    "read_count_sheets",
    f"""WITH {_CELLS},
        placed AS (SELECT e.ID_SITE, e.site_name, c.* FROM cells c JOIN sample s ON c.ID_SAMPLE = s.ID_SAMPLE JOIN entity e ON s.ID_ENTITY = e.ID_ENTITY),
        taxa AS (SELECT DISTINCT ID_SITE, site_name, name, clean_name, intermediate, amalgamated FROM placed),
        sums AS (SELECT ID_SITE, name, line, sum(cnt) AS total FROM placed GROUP BY ALL),
        found AS (SELECT t.*, l.line * 10.0 AS depth, CASE WHEN t.ID_SITE % 3 = 0 THEN total ELSE coalesce(total, 0) END AS count
                  FROM taxa t CROSS JOIN (VALUES (1), (2), (3), (4), (5), (6), (7)) l(line)
                  LEFT JOIN sums s ON s.ID_SITE = t.ID_SITE AND s.name = t.name AND s.line = l.line WHERE t.ID_SITE % 3 <> 0 OR s.line IS NOT NULL)
        SELECT site_name, CASE WHEN ID_SITE % 5 <> 0 THEN 'core ' || site_name END AS entity_name, name || ', sp.' AS taxon_name, clean_name AS clean,
               intermediate, amalgamated, CAST(depth AS DOUBLE) AS depth, count FROM found""",
)
def _(w):
    path = scratch_path(w.spark, "sheets")
    sites = w.sample.join(w.entity.select("ID_ENTITY", "ID_SITE", "site_name"), "ID_ENTITY").select("ID_SAMPLE", "ID_SITE", "site_name")
    cells = sheet_cells(w).join(sites, "ID_SAMPLE").withColumns(
        {"name": F.concat("name", F.lit(", sp.")), "clean_name": F.replace("clean_name", F.lit(" "), F.lit("   "))}
    )
    keys, third = ["ID_SITE", "site_name", *_NAMES], F.col("ID_SITE") % 3
    listed = cells.where(third == 0).groupBy(*keys, "depth").agg(F.sum("count").alias("Count"))
    wide = cells.where(third != 0).groupBy(*keys).pivot("depth", [10 * i for i in range(1, 8)]).agg(F.sum("count"))
    plain, led = wide.where(third == 1), wide.where(third == 2).select(*keys[:2], F.lit(None).cast("string").alias("no"), *wide.columns[2:])
    for mark, sheets in (("_LIST", listed), ("", plain), ("_sph", led)):
        named = sheets.withColumn("sheet", F.concat("site_name", F.lit(mark))).drop("ID_SITE", "site_name")
        named.write.mode("append").partitionBy("sheet").csv(path, header=True, quote='"', escape='"')
    cores = w.entity.where("ID_SITE % 5 <> 0").select(F.concat(F.lit("sheet="), "site_name").alias("site_name"), F.concat(F.lit("core "), "site_name").alias("entity_name"))
    found = files.read_count_sheets(w.spark, path, entities=cores.distinct(), site_from="folder")
    return found.withColumn("site_name", F.regexp_replace("site_name", "^sheet=", ""))


# ---- stored tables ------------------------------------------------------------------------------

_COUNT_KEY = ["ID_SAMPLE", "ID_TAXON", "amalgamation_level"]
_STORED = "SELECT ID_SAMPLE, ID_TAXON, amalgamation_level, cnt AS count FROM pollen_count"


def stored_counts(w, df):
    table = versions.VersionedTable(w.spark, scratch_path(w.spark, "counts"), SCHEMAS["pollen_count"], ["amalgamation_level"], {"ID_SAMPLE": 5000})
    table.create(df)
    return table


@query(
    "replace_slice_stored",
    f"""{_STORED} WHERE NOT (amalgamation_level = 2 AND ID_SAMPLE IN (SELECT s.ID_SAMPLE FROM sample s JOIN entity e ON s.ID_ENTITY = e.ID_ENTITY WHERE e.ID_SITE = 7))
       UNION ALL SELECT p.ID_SAMPLE, p.ID_TAXON, 2, p.cnt * 2 FROM pollen_count p JOIN sample s ON p.ID_SAMPLE = s.ID_SAMPLE JOIN entity e ON s.ID_ENTITY = e.ID_ENTITY
       WHERE e.ID_SITE = 7 AND p.amalgamation_level = 2 AND p.ID_SAMPLE % 2 = 0""",
)
def _(w):
    table = stored_counts(w, w.pollen_count)
    mine = w.sample.join(w.entity.where("ID_SITE = 7"), "ID_ENTITY", "left_semi").select("ID_SAMPLE")
    old = table.read().where("amalgamation_level = 2").join(mine, "ID_SAMPLE", "left_semi")
    new = old.where("ID_SAMPLE % 2 = 0").withColumn("count", F.col("count") * 2)
    table.replace_slice(old.select("ID_SAMPLE", "amalgamation_level"), new.select(*SCHEMAS["pollen_count"].names), ["ID_SAMPLE", "amalgamation_level"])
    return table.read()


@query("append_stored", _STORED + " UNION ALL SELECT ID_SAMPLE + 1000000000, ID_TAXON, amalgamation_level, cnt FROM pollen_count WHERE amalgamation_level = 2")
def _(w):
    table = stored_counts(w, w.pollen_count.where("amalgamation_level < 2"))
    last = w.pollen_count.where("amalgamation_level = 2")
    table.append(last)
    # Stored keys are left out of the second chunk, new ones go in.
    table.append_unseen(last.unionByName(last.withColumn("ID_SAMPLE", F.col("ID_SAMPLE") + 10**9)), _COUNT_KEY)
    return table.read()


def colocated_archive(w):
    path = scratch_path(w.spark, "buckets")
    colocated.write_colocated(w.archive, path, 8)
    return colocated.load_colocated(w.spark, path, 8)


@query(
    "snapshot_counts_colocated",
    f"""SELECT p.ID_SAMPLE, t.taxon_name, p.amalgamation_level, p.cnt AS count
        FROM pollen_count p LEFT JOIN taxon_name t ON p.ID_TAXON = t.ID_TAXON
        WHERE p.ID_SAMPLE IN (SELECT ID_SAMPLE FROM sample WHERE ID_ENTITY IN ({_PICKED}))""",
)
def _(w):
    return snapshot(colocated_archive(w), european_sites(w)).counts


@query("snapshot_wide_colocated", wide_sql("amalgamated", f"AND p.ID_SAMPLE IN (SELECT ID_SAMPLE FROM sample WHERE ID_ENTITY IN ({_PICKED}))"))
def _(w):
    return snapshot(colocated_archive(w), european_sites(w)).wide("amalgamated")
