"""Join shapes the archive work relies on.

No join carries a broadcast hint unless the size of that side is bounded by construction: Spark
broadcasts a side whose measured size is under its threshold and sort-merges it otherwise, and
adaptive execution splits hot partitions of the sort-merge.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Keys = Sequence[str]


def _tagged(df: DataFrame, keys: Keys, tag: str) -> tuple[DataFrame, list[str]]:
    names = [f"__{tag}_{k}" for k in keys]
    return df.withColumnsRenamed(dict(zip(keys, names))), names


def join_null_safe(left: DataFrame, right: DataFrame, keys: Keys, how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match each other; the keys appear once, first."""
    other, names = _tagged(right, keys, "r")
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    joined = left.join(other, match, how)
    if how in ("left_semi", "left_anti"):
        return joined
    rest = [c for c in joined.columns if c not in keys and c not in names]
    if how in ("right", "right_outer"):
        shown = [F.col(n).alias(k) for k, n in zip(keys, names)]
    elif how.startswith(("full", "outer")):
        shown = [F.coalesce(F.col(k), F.col(n)).alias(k) for k, n in zip(keys, names)]
    else:
        shown = [F.col(k) for k in keys]
    return joined.select(*shown, *rest)


def natural_join(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join on every shared column name; nulls match as they do in the source tables' language."""
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("the two tables share no column")
    return join_null_safe(left, right, shared, how)


def lookup(df: DataFrame, dim: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Left join on differently named keys (``{column of df: column of dim}``); dim's keys are dropped."""
    other, names = _tagged(dim, list(on.values()), "d")
    match = reduce(lambda a, b: a & b, [F.col(k) == F.col(n) for k, n in zip(on, names)])
    return df.join(other, match, "left").drop(*names)


def distinct_keys(keys: DataFrame, on: str | Keys) -> DataFrame:
    """A key list from any table: repeats merge before they are shuffled, so a hot key stays one row."""
    return keys.select(*([on] if isinstance(on, str) else on)).distinct()


def keep_members(df: DataFrame, keys: DataFrame, on: str | Keys) -> DataFrame:
    return df.join(distinct_keys(keys, on), on, "left_semi")


def drop_members(df: DataFrame, keys: DataFrame, on: str | Keys) -> DataFrame:
    """Rows whose key is not listed; a null key is never listed, so it stays."""
    return df.join(distinct_keys(keys, on), on, "left_anti")


def exists_flag(df: DataFrame, facts: DataFrame, key: str, name: str) -> DataFrame:
    """``name`` is true where ``facts`` has any row for the key: one pass, not one probe per row."""
    present = facts.where(F.col(key).isNotNull()).select(key).distinct().withColumn("__hit", F.lit(True))
    return df.join(present, key, "left").withColumn(name, F.coalesce(F.col("__hit"), F.lit(False))).drop("__hit")


def unmatched_both_ways(
    left: DataFrame, right: DataFrame, keys: Keys, left_name: str, right_name: str
) -> DataFrame:
    """Keys found on one side only, with the side that has them."""
    both = join_null_safe(
        left.select(*keys).distinct().withColumn("__l", F.lit(True)),
        right.select(*keys).distinct().withColumn("__r", F.lit(True)),
        keys,
        "full_outer",
    )
    return both.where(F.col("__l").isNull() | F.col("__r").isNull()).select(
        *keys, F.when(F.col("__l"), left_name).otherwise(right_name).alias("found_in")
    )


def coalesce_overrides(df: DataFrame, overrides: DataFrame, key: str, columns: Keys) -> DataFrame:
    """Values of an override table win over the stored ones, where given."""
    other = overrides.select(key, *[F.col(c).alias(f"__new_{c}") for c in columns])
    merged = {c: F.coalesce(F.col(f"__new_{c}"), F.col(c)) for c in columns}
    return df.join(other, key, "left").withColumns(merged).select(*df.columns)


def add_offsets(df: DataFrame, offsets: DataFrame, key: str, column: str, offset: str = "offset") -> DataFrame:
    """Shift a measure by a per-record constant; records without one stay as they are."""
    other = offsets.select(key, F.col(offset).alias("__offset"))
    shifted = F.col(column) + F.coalesce(F.col("__offset"), F.lit(0.0))
    return df.join(other, key, "left").withColumn(column, shifted).select(*df.columns)


def all_null(columns: Keys) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNull() for c in columns])
