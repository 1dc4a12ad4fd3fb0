"""Dated horizons: cleaning, model inputs and reviewed values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    calibration_curve,
    derive_age_used,
    fill_unknown,
    is_hiatus,
    null_codes_to_null,
    positive_error,
    standard_date_type,
)
from .ids import with_position
from .reshape import union_sources


def standardise_date_types(dates: DataFrame) -> DataFrame:
    return dates.withColumn("date_type", standard_date_type(F.col("date_type")))


def combine_dates(dates: DataFrame, core_tops: DataFrame) -> DataFrame:
    """Dates of named entities and their core tops, without repeats, in entity and depth order."""
    return (
        union_sources(dates.where(F.col("entity_name").isNotNull()), standardise_date_types(core_tops))
        .distinct()
        .orderBy(*[F.asc_nulls_last(c) for c in ("entity_name", "depth", "age_c14", "age_cal")])
    )


def split_hiatus(dates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(dated horizons, hiatuses); a date without a type belongs to neither."""
    return dates.where(~is_hiatus(F.col("date_type"))), dates.where(is_hiatus(F.col("date_type")))


def prepare_dates(
    dates: DataFrame,
    entity: DataFrame,
    core_tops: DataFrame | None = None,
    *,
    entity_key: str = "ID_ENTITY",
    calendar_age: str = "age_calib",
) -> DataFrame:
    """Dates as an age-depth model wants them: one age, a positive error and a calibration curve."""
    if core_tops is not None:
        dates = union_sources(dates, core_tops)
    horizons, _ = split_hiatus(dates)
    age = F.coalesce(null_codes_to_null(F.col("age_c14")), null_codes_to_null(F.col(calendar_age)))
    return (
        horizons.join(entity.select(entity_key, "latitude"), entity_key, "left")
        .select(
            entity_key,
            "lab_num",
            age.alias("age"),
            positive_error(F.col("error")).alias("error"),
            "depth",
            calibration_curve(F.col("date_type"), F.col("latitude")).alias("cc"),
        )
        .where(F.col("age").isNotNull())
    )


def model_inputs(dates: DataFrame, sample: DataFrame, entity_key: str = "ID_ENTITY") -> DataFrame:
    """Per entity the numbered sample depths and the hiatus depths, stacked under ``part``."""
    depths = with_position(sample.select(entity_key, "depth", "ID_SAMPLE"), ["depth", "ID_SAMPLE"], "id", [entity_key])
    _, hiatus = split_hiatus(dates)
    return depths.select(entity_key, F.lit("sample_depths").alias("part"), "id", "depth").unionByName(
        hiatus.select(
            entity_key, F.lit("hiatus").alias("part"), F.lit(None).cast("bigint").alias("id"), "depth"
        )
    )


def derive_use(dates: DataFrame) -> DataFrame:
    return dates.withColumn("age_used", derive_age_used(F.col("reason_age_not_used")))


def fill_unknown_dates(dates: DataFrame) -> DataFrame:
    """Replace missing and unknown categories; an unknown reason depends on whether the age is used."""
    reason = F.col("reason_age_not_used")
    unused = F.col("age_used").isNull() | (F.col("age_used") == "no")
    stated = F.when(unused, "not known").otherwise("not applicable")
    filled = {c: fill_unknown(F.col(c)) for c in ("age_used", "date_type", "material_dated")}
    filled["reason_age_not_used"] = F.when(reason.isNull() | reason.contains("unknown"), stated).otherwise(reason)
    return dates.withColumns(filled)


def recode_values(df: DataFrame, revised: DataFrame, column: str) -> DataFrame:
    """Apply a reviewed list (variable, current, new) to one column."""
    changes = revised.where((F.col("variable") == column) & (F.col("current") != F.col("new")))
    changes = changes.select(F.col("current").alias(column), F.col("new").alias("__new"))
    return (
        df.join(changes, column, "left")
        .withColumn(column, F.coalesce("__new", column))
        .select(*df.columns)
    )


def route_reasons(dates: DataFrame, revised: DataFrame) -> DataFrame:
    """Move reviewed reasons where the reviewer's remark sends them.

    ``revised`` has (current, new, remark). A remark with "notes" moves the text to the notes, where
    an existing note wins; one with "reason" only says the age is not used; otherwise the new text
    replaces the reason. Rows without a reviewed reason stay as they are.
    """
    to_notes = F.coalesce(F.col("remark").rlike("notes"), F.lit(False))
    to_use = F.coalesce(F.col("remark").rlike("reason"), F.lit(False))
    plan = revised.where((F.col("current") != F.col("new")) | to_notes | to_use).select(
        F.col("current").alias("reason_age_not_used"),
        F.when(to_notes, F.col("new")).alias("__notes"),
        F.when(to_use, "no").alias("__used"),
        F.when(~to_notes & ~to_use, F.col("new")).alias("__reason"),
        F.lit(True).alias("__hit"),
    )
    routed = {
        "reason_age_not_used": F.when(F.col("__hit"), F.col("__reason")).otherwise(F.col("reason_age_not_used")),
        "notes": F.coalesce("notes", "__notes"),
        "age_used": F.coalesce("__used", "age_used"),
    }
    return dates.join(plan, "reason_age_not_used", "left").withColumns(routed).select(*dates.columns)
