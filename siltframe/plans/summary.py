"""How complete each entity of an archive is."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import distinct_keys
from ..sources.tables import Archive
from .snapshot import counted_levels, levels_per_entity


class LevelMismatch(ValueError):
    """An entity has another number of counted samples at some level."""


def models_per_entity(archive: Archive) -> DataFrame:
    """Samples with an age model per entity."""
    modelled = archive.age_model.select("ID_SAMPLE").distinct()
    return (
        modelled.join(archive.sample.select("ID_SAMPLE", "ID_ENTITY"), "ID_SAMPLE")
        .groupBy("ID_ENTITY")
        .agg(F.count("*").alias("n_am"))
    )


def db_summary(archive: Archive, *, strict: bool = False) -> DataFrame:
    """Each entity with its numbers of dates, samples, models and counts, and what it has.

    All facts are joined by ID_ENTITY, so an entity without dates keeps its other flags.
    ``n_counts`` is the common number of counted samples, null where the levels disagree;
    ``strict`` raises in that case.
    """
    entity = archive.entity
    joined = entity
    for part in (
        archive.date_info.groupBy("ID_ENTITY").agg(F.count("*").alias("n_dates")),
        archive.sample.groupBy("ID_ENTITY").agg(F.count("*").alias("n_samples")),
        models_per_entity(archive),
        levels_per_entity(archive.pollen_count, archive.sample),
    ):
        joined = joined.join(part, "ID_ENTITY", "left")
    # A level without counted samples is absent, not zero.
    joined = joined.withColumns({f"n_counts_{i}": F.nullif(F.col(f"n_counts_{i}"), F.lit(0)) for i in range(3)})
    n = [F.col(f"n_counts_{i}") for i in range(3)]
    agree = n[0].eqNullSafe(n[1]) & n[0].eqNullSafe(n[2])

    def has(column: str):
        return F.col(column).isNotNull()

    def mark(column: str):
        return F.when(has(column), True)

    result = joined.select(
        *entity.columns,
        mark("n_dates").alias("DATES"),
        mark("n_samples").alias("SAMPLES"),
        mark("n_am").alias("AM"),
        *[c for i in range(3) for c in (F.col(f"n_counts_{i}"), has(f"n_counts_{i}").alias(f"COUNTS_{i}"))],
        "n_dates",
        "n_samples",
        "n_am",
        F.when(agree, n[0]).alias("n_counts"),
        has("n_dates").alias("has_DATES"),
        has("n_samples").alias("has_SAMPLES"),
        has("n_am").alias("has_AM"),
        (has("n_counts_0") & has("n_counts_1") & has("n_counts_2")).alias("has_COUNTS"),
        agree.alias("levels_agree"),
    )
    if strict:
        bad = result.where(~F.col("levels_agree")).select("ID_ENTITY").first()
        if bad is not None:
            raise LevelMismatch(f"entity {bad.ID_ENTITY} has other numbers of samples at other levels")
    return result


def db_summary_totals(summary: DataFrame) -> DataFrame:
    """Numbers of entities, and of those with dates, models and counts."""
    return summary.agg(
        F.count("*").alias("entities"),
        F.count_if("has_DATES").alias("with_dates"),
        F.count_if("has_AM").alias("with_age_models"),
        F.count_if("has_COUNTS").alias("with_counts"),
    )


def write_summary(summary: DataFrame, folder: str, day: str) -> str:
    """Write a summary as CSV under a dated name and return its path."""
    path = f"{folder}/summary_{day}.csv"
    summary.write.mode("overwrite").csv(path, header=True)
    return path


def uncounted_entities(archive: Archive) -> DataFrame:
    """Entities none of whose samples has a count, with their number of samples."""
    counted = counted_levels(archive.pollen_count).select("ID_SAMPLE", F.lit(1).alias("__counted"))
    per_entity = (
        archive.sample.select("ID_SAMPLE", "ID_ENTITY")
        .join(counted, "ID_SAMPLE", "left")
        .groupBy("ID_ENTITY")
        .agg(F.count("*").alias("total"), F.count_if(F.col("__counted").isNull()).alias("wo_counts"))
    )
    return per_entity.where(F.col("wo_counts") == F.col("total"))


def complete_entities(archive: Archive) -> DataFrame:
    """Ids of the entities that have dates, samples, age models and counts."""
    sets = [
        distinct_keys(archive.date_info, "ID_ENTITY"),
        distinct_keys(archive.sample, "ID_ENTITY"),
        models_per_entity(archive).select("ID_ENTITY"),
        levels_per_entity(archive.pollen_count, archive.sample).select("ID_ENTITY"),
    ]
    ids = archive.entity.select("ID_ENTITY").distinct()
    return reduce(lambda kept, other: kept.join(other, "ID_ENTITY", "left_semi"), sets, ids)
