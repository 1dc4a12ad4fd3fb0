"""Roll taxon counts up through the three taxonomic levels.

Counts stay long: (ID_SAMPLE, ID_TAXON, amalgamation_level, count). Each level is one map-side
combined aggregation keyed by sample and taxon, so neither a hot sample nor a hot taxon gathers its
raw rows in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import squish
from ..schema import LEVELS
from .aggregates import sum_or_zero
from .ids import assign_ids
from .joins import drop_members, keep_members, lookup

COUNT_COLUMNS = ["ID_SAMPLE", "ID_TAXON", "amalgamation_level", "count"]


def prepare_taxa_map(listed: DataFrame, raw: str = "raw_taxon") -> DataFrame:
    """A curated list as a map: excluded names out, names squished, " type" in raw names hyphenated.

    A row without a clean name is left out as well.
    """
    excluded = squish(F.lower("clean_name")).contains("exclude")
    return listed.where(~excluded).withColumns(
        {raw: F.regexp_replace(raw, " type", "-type"), "clean_name": squish(F.col("clean_name"))}
    )


def level_map(taxa_map: DataFrame, child: str, parent: str) -> DataFrame:
    """Distinct (child, parent) names with a known parent."""
    return taxa_map.select(child, parent).distinct().where(F.col(parent).isNotNull())


def _summed(counts: DataFrame, level: int) -> DataFrame:
    return (
        counts.groupBy("ID_SAMPLE", "ID_TAXON")
        .agg(sum_or_zero("count").alias("count"))
        .withColumn("amalgamation_level", F.lit(level))
        .select(*COUNT_COLUMNS)
    )


def _merged(counts: DataFrame, raw: str) -> DataFrame:
    """Raw counts summed by sample and raw taxon, before anything is joined to them."""
    return counts.where(F.col("count").isNotNull()).groupBy("ID_SAMPLE", raw).agg(sum_or_zero("count").alias("count"))


def amalgamate_clean(
    counts: DataFrame, taxa_map: DataFrame, taxon_name: DataFrame, raw: str = "raw_taxon"
) -> DataFrame:
    """Level 0 from raw counts (ID_SAMPLE, raw taxon, count); unmapped taxa end up under a null id.

    Names are turned into ids on the map; the counts are joined once, by raw taxon, after a first sum.
    """
    ids = lookup(taxa_map.select(raw, "clean_name"), taxon_name, {"clean_name": "taxon_name"}).select(raw, "ID_TAXON")
    return _summed(lookup(_merged(counts, raw), ids, {raw: raw}), 0)


def amalgamate_next(
    counts: DataFrame, taxa_map: DataFrame, taxon_name: DataFrame, child: str, parent: str, level: int
) -> DataFrame:
    """A coarser level from the one below, by a map from id to id; counts without a parent end up under a null id."""
    pairs = level_map(taxa_map, child, parent).join(
        taxon_name.select(F.col("taxon_name").alias(child), F.col("ID_TAXON").alias("__child")), child
    )
    ids = lookup(pairs, taxon_name, {parent: "taxon_name"}).select("__child", F.col("ID_TAXON").alias("__parent"))
    mapped = lookup(counts.select("ID_SAMPLE", "ID_TAXON", "count"), ids, {"ID_TAXON": "__child"})
    return _summed(mapped.select("ID_SAMPLE", F.col("__parent").alias("ID_TAXON"), "count"), level)


def amalgamate_intermediate(clean: DataFrame, taxa_map: DataFrame, taxon_name: DataFrame) -> DataFrame:
    return amalgamate_next(clean, taxa_map, taxon_name, "clean_name", "intermediate", 1)


def amalgamate_amalgamated(intermediate: DataFrame, taxa_map: DataFrame, taxon_name: DataFrame) -> DataFrame:
    return amalgamate_next(intermediate, taxa_map, taxon_name, "intermediate", "amalgamated", 2)


def amalgamate_levels(
    counts: DataFrame, taxa_map: DataFrame, taxon_name: DataFrame, raw: str = "raw_taxon"
) -> DataFrame:
    """All three levels from raw counts; unmapped taxa end up under a null id at each.

    Raw rows are summed first and joined once, to the three ids of their raw taxon; what is exploded
    to three levels carries numbers only.
    """
    names = ("clean_name", "intermediate", "amalgamated")
    ids = taxa_map.select(raw, *names)
    for i, name in enumerate(names):
        ids = lookup(ids, taxon_name.select("taxon_name", F.col("ID_TAXON").alias(f"__id{i}")), {name: "taxon_name"})
    kind = taxon_name.schema["ID_TAXON"].dataType
    ids = ids.select(raw, F.array(*[f"__id{i}" for i in range(len(names))]).alias("__ids"))
    none = F.array(*[F.lit(None).cast(kind) for _ in names])
    levels = F.posexplode(F.coalesce("__ids", none)).alias("amalgamation_level", "ID_TAXON")
    return (
        lookup(_merged(counts, raw), ids, {raw: raw})
        .select("ID_SAMPLE", "count", levels)
        .groupBy("ID_SAMPLE", "ID_TAXON", "amalgamation_level")
        .agg(sum_or_zero("count").alias("count"))
        .select(*COUNT_COLUMNS)
    )


def split_levels(counts: DataFrame) -> dict[str, DataFrame]:
    """One table per level; all three names are always present."""
    return {
        name: counts.where(F.col("amalgamation_level") == i).drop("amalgamation_level")
        for i, name in enumerate(LEVELS)
    }


def mapped_counts(counts: DataFrame, taxa_map: DataFrame, raw: str = "raw_taxon") -> DataFrame:
    return keep_members(counts, taxa_map, raw)


def excluded_counts(counts: DataFrame, taxa_map: DataFrame, raw: str = "raw_taxon") -> DataFrame:
    return drop_members(counts, taxa_map, raw)


def level_names(taxa_map: DataFrame) -> DataFrame:
    """Every name used at any level, once."""
    names = F.explode(F.array("clean_name", "intermediate", "amalgamated")).alias("taxon_name")
    return taxa_map.select(names).where(F.col("taxon_name").isNotNull()).distinct()


def new_taxa(taxa_map: DataFrame, taxon_name: DataFrame, start: int) -> DataFrame:
    """Names without an id yet, numbered in name order after ``start``."""
    unknown = level_names(taxa_map).join(taxon_name, "taxon_name", "left_anti")
    return assign_ids(unknown, ["taxon_name"], "ID_TAXON", start).select("ID_TAXON", "taxon_name")


def level_shrinkage(counts: DataFrame) -> DataFrame:
    """Per sample, how many rows each coarser level saves, largest first."""
    def n(level: int):
        return F.count(F.when(F.col("amalgamation_level") == level, 1))

    return (
        counts.groupBy("ID_SAMPLE")
        .agg(n(0).alias("n_clean"), n(1).alias("n_intermediate"), n(2).alias("n_amalgamated"))
        .withColumn("clean_minus_intermediate", F.col("n_clean") - F.col("n_intermediate"))
        .withColumn("clean_minus_amalgamated", F.col("n_clean") - F.col("n_amalgamated"))
        .orderBy(F.desc_nulls_last("clean_minus_amalgamated"), F.asc_nulls_last("ID_SAMPLE"))
    )


def incomplete_levels(counts: DataFrame, sample: DataFrame | None = None) -> DataFrame:
    """Samples that are not present at exactly three levels; with ``sample``, uncounted ones too."""
    present = counts.where(F.col("count").isNotNull()).select("ID_SAMPLE", "amalgamation_level").distinct()
    n = present.groupBy("ID_SAMPLE").agg(F.count("*").alias("n_levels"))
    if sample is not None:
        n = sample.select("ID_SAMPLE").join(n, "ID_SAMPLE", "left").na.fill(0, ["n_levels"])
    return n.where(F.col("n_levels") != 3)


def unmapped(counts: DataFrame) -> DataFrame:
    """Samples with counts whose taxon found no id, and how much count that is."""
    lost = counts.where(F.col("ID_TAXON").isNull())
    return lost.groupBy("ID_SAMPLE", "amalgamation_level").agg(sum_or_zero("count").alias("lost_count"))


def map_conflicts(taxa_map: DataFrame, child: str, parent: str) -> DataFrame:
    """Children with more than one parent: joining on them would count their samples twice."""
    pairs = level_map(taxa_map, child, parent)
    return pairs.groupBy(child).agg(F.count("*").alias("n_parents")).where(F.col("n_parents") > 1)


def map_disagreements(taxa_map: DataFrame, column: str, alternative: str) -> DataFrame:
    """Map rows whose alternative column names another parent."""
    return taxa_map.where(F.col(column) != F.col(alternative))
