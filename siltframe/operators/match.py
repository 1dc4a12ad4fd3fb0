"""Match the samples of two sources by depth, by position or by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean_name, if_else, within_age_tolerance
from .ids import pair_by_position
from .joins import join_null_safe

DEPTH_DIGITS = 3


def match_depth_rounded(
    left: DataFrame, right: DataFrame, entity: str = "ID_ENTITY", depth: str = "depth", how: str = "left"
) -> DataFrame:
    """Equi-join on (entity, depth rounded to three digits); right's depth is kept as ``<depth>_source``.

    Null depths of an entity match each other.
    """
    other = right.withColumnRenamed(depth, f"{depth}_source").withColumn(
        "__depth", F.bround(f"{depth}_source", DEPTH_DIGITS)
    )
    mine = left.withColumn("__depth", F.bround(depth, DEPTH_DIGITS))
    return join_null_safe(mine, other, [entity, "__depth"], how).drop("__depth")


def match_positional(
    archive: DataFrame,
    incoming: DataFrame,
    entity: str,
    archive_order: Sequence[str],
    incoming_order: Sequence[str],
    depth: str = "depth",
) -> DataFrame:
    """Pair the rows of each entity one to one by position where both sides have equally many.

    The other entities fall back to rounded depths, keeping every incoming row. Columns of
    ``incoming`` carry the suffix ``_source``; ``matched_by`` tells the two ways apart.
    """
    renamed = {c: f"{c}_source" for c in incoming.columns if c != entity}
    other = incoming.withColumnsRenamed(renamed)
    n_left = archive.groupBy(entity).agg(F.count("*").alias("__n_left"))
    n_right = incoming.groupBy(entity).agg(F.count("*").alias("__n_right"))
    equal = n_left.join(n_right, entity).where(F.col("__n_left") == F.col("__n_right")).select(entity)

    pairs = pair_by_position(
        archive.join(equal, entity, "left_semi"),
        other.join(equal, entity, "left_semi"),
        [entity],
        archive_order,
        [renamed[c] for c in incoming_order],
    )
    by_position = pairs.select("l.*", *[f"r.{c}" for c in renamed.values()])

    key = "__depth"
    left_rest = archive.join(equal, entity, "left_anti").withColumn(key, F.bround(depth, DEPTH_DIGITS))
    right_rest = other.join(equal, entity, "left_anti").withColumn(key, F.bround(renamed[depth], DEPTH_DIGITS))
    by_depth = join_null_safe(left_rest, right_rest, [entity, key], "right").drop(key)
    return by_position.withColumn("matched_by", F.lit("position")).unionByName(
        by_depth.withColumn("matched_by", F.lit("depth"))
    )


def match_clean_names(left: DataFrame, right: DataFrame, name: str, how: str = "inner") -> DataFrame:
    """Join on the normalised name, kept as ``<name>_clean``; right's name becomes ``<name>_source``."""
    key = f"{name}_clean"
    other = right.withColumnRenamed(name, f"{name}_source").withColumn(key, clean_name(F.col(f"{name}_source")))
    return left.withColumn(key, clean_name(F.col(name))).join(other, key, how)


def gate_by_age(
    df: DataFrame, age: str, archive_age: str, columns: Sequence[str], *, by_size: bool = False
) -> DataFrame:
    """Keep chronology columns only where the age agrees with the archive's; adds ``same_age``."""
    same = within_age_tolerance(F.col(age), F.col(archive_age), by_size=by_size)
    gated = {c: if_else(F.col("same_age"), F.col(c), F.lit(None)) for c in columns}
    return df.withColumn("same_age", same).withColumns(gated)


def corrected_values(matched: DataFrame, key: Sequence[str], column: str, depth: str = "depth") -> DataFrame:
    """From a positional match: rows with the same depth and another value, as an update set."""
    same_depth = F.bround(f"{depth}_source", DEPTH_DIGITS) == F.bround(depth, DEPTH_DIGITS)
    differs = F.col(f"{column}_source") != F.col(column)
    return matched.where(same_depth & differs).select(*key, F.col(f"{column}_source").alias(column))


def pairing_faults(matched: DataFrame, ids: Sequence[str], code: str, depth: str = "depth") -> DataFrame:
    """From a positional match: rows with a missing id, a depth off the unit change, or another code."""
    fault = (F.col(depth) * 100 != F.col(f"{depth}_source")) | (F.col(code) != F.col(f"{code}_source"))
    for name in ids:
        fault = F.col(name).isNull() | fault
    return matched.where(fault)
