"""Positions and ids over data of any size.

A plain ``row_number`` over everything sorts in one task, and over a group it sorts a hot group in
one task. Here rows are range-partitioned by (group, order), so a large group spreads over many
partitions, numbered inside each, and shifted by the row counts of the partitions before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import checkpoint
from .joins import join_null_safe


def with_position(df: DataFrame, order: Sequence[str], name: str, group: Sequence[str] = ()) -> DataFrame:
    """Add the 1-based position in ``order`` (nulls last), counted anew in each ``group``.

    ``group`` plus ``order`` must identify a row, otherwise ties are numbered arbitrarily. The
    ranged rows are checkpointed: the counts and the numbering must see the same partitions.
    """
    keys = [F.col(c).asc_nulls_last() for c in (*group, *order)]
    ranged = checkpoint(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("__row", F.monotonically_increasing_id())
        .withColumn("__part", F.spark_partition_id())
    )
    runs = ranged.groupBy("__part", *group).agg(F.min("__row").alias("__first"), F.count("*").alias("__n"))
    # One row per partition and group: without a group that is at most the number of partitions.
    before = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    joined = (
        join_null_safe(ranged, runs, ["__part", *group])
        if group
        else ranged.join(F.broadcast(runs), "__part")
    )
    position = F.col("__row") - F.col("__first") + F.col("__before") + 1
    return joined.withColumn(name, position).select(*df.columns, name)


def pair_by_position(
    left: DataFrame, right: DataFrame, group: Sequence[str], left_order: Sequence[str], right_order: Sequence[str]
) -> DataFrame:
    """Rows of both tables at the same position of their group: (group, struct ``l``, struct ``r``).

    Both tables are stacked and numbered in one pass. Rows that are equal in the given order follow a fingerprint of
    the whole row, so every run pairs them the same way; only rows that are equal in all columns can change places.
    """
    sides = []
    for side, df, order in (("l", left, left_order), ("r", right, right_order)):
        keys = [F.col(c).alias(f"__{side}{i}") for i, c in enumerate(order)]
        keys.append(F.xxhash64(*df.columns).alias(f"__{side}{len(order)}"))
        sides.append(df.select(*group, F.lit(side).alias("__side"), *keys, F.struct(*df.columns).alias(side)))
    order = [f"__{side}{i}" for side, o in (("l", left_order), ("r", right_order)) for i in range(len(o) + 1)]
    stacked = sides[0].unionByName(sides[1], allowMissingColumns=True)
    placed = with_position(stacked, order, "__position", [*group, "__side"])
    pairs = placed.groupBy(*group, "__position").agg(
        F.first("l", ignorenulls=True).alias("l"), F.first("r", ignorenulls=True).alias("r")
    )
    return pairs.where(F.col("l").isNotNull() & F.col("r").isNotNull()).drop("__position")


def assign_ids(df: DataFrame, order: Sequence[str], id_name: str, start: int = 0) -> DataFrame:
    """Give each row an id: ``start`` plus its position in ``order``, which must be unique."""
    return with_position(df, order, id_name).withColumn(id_name, F.col(id_name) + F.lit(start))


def assign_group_ids(df: DataFrame, keys: Sequence[str], id_name: str, start: int = 0) -> DataFrame:
    """Number the distinct values of ``keys`` in sorted order and join the number back."""
    numbered = assign_ids(df.select(*keys).distinct(), keys, id_name, start)
    return join_null_safe(df, numbered, keys)


def rows_at(df: DataFrame, order: Sequence[str], low: int, high: int) -> DataFrame:
    """The rows at positions ``low`` to ``high`` (from 1) in ``order``, which must be unique."""
    placed = with_position(df, order, "__position")
    return placed.where(F.col("__position").between(low, high)).drop("__position")


def current_max_id(df: DataFrame, id_name: str) -> int:
    """Largest stored id, 1 for an empty table."""
    return df.agg(F.coalesce(F.max(id_name), F.lit(1))).first()[0]


def id_gaps(df: DataFrame, id_name: str) -> DataFrame:
    """Unused ids between 1 and the largest one."""
    top = current_max_id(df, id_name)
    return df.sparkSession.range(1, top + 1).toDF(id_name).join(df, id_name, "left_anti")
