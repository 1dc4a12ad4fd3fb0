"""Group summaries. All combine on the map side, so a hot group never lands in one task whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import join_null_safe


def count_rows(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def sum_or_zero(column: str) -> Column:
    """Sum that ignores nulls and is 0, not null, for an all-null group."""
    return F.coalesce(F.sum(column), F.lit(0.0))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The whole first row of each key in ``order`` (nulls last), as an aggregate, not a window."""
    rest = [c for c in df.columns if c not in keys]
    # A struct comparison puts nulls first, so each order column is preceded by its null flag.
    rank = [part for c in order for part in (F.col(c).isNull().alias(f"__null_{c}"), F.col(c).alias(f"__ord_{c}"))]
    first = F.min_by(F.struct(*rest), F.struct(*rank)).alias("__row")
    return df.groupBy(*keys).agg(first).select(*keys, "__row.*").select(*df.columns)


def with_group_size(df: DataFrame, keys: Sequence[str], condition: Column, name: str = "n") -> DataFrame:
    """Rows of the groups whose size fulfils ``condition``, with that size.

    Counted by a partial aggregate and joined back, instead of a window that would hold a hot group.
    """
    sizes = count_rows(df, keys, name).where(condition)
    return join_null_safe(df, sizes, keys).select(*df.columns, name)


def find_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return with_group_size(df, keys, F.col("n") > 1)


def single_row_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Groups with fewer than two rows."""
    return count_rows(df, keys, "n").where(F.col("n") < 2)


def joined_text(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], text: str, name: str, separator: str = ";\n"
) -> DataFrame:
    """The texts of a group joined in ``order``; null if any of them is null.

    The result cell holds the group's texts by definition, repeated ones as often as they occur.
    """
    parts = F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias("__text"))))
    whole = F.array_join(F.transform(parts, lambda p: p["__text"]), separator)
    nulls = F.count(F.when(F.col(text).isNull(), 1))
    return df.groupBy(*keys).agg(F.when(nulls == 0, whole).alias(name))


def compare_counts(
    left: DataFrame, right: DataFrame, key: str, left_name: str, right_name: str
) -> DataFrame:
    """Rows per key in two tables; a key missing on one side counts 0 there."""
    both = count_rows(left, [key], left_name).join(count_rows(right, [key], right_name), key, "full_outer")
    return both.na.fill(0, [left_name, right_name])


def value_catalogue(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of categorical columns, with the squished form as proposed replacement."""
    from ..functions import squish

    values = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).alias("current")) for c in columns])
    return (
        df.select(F.explode(values).alias("v"))
        .select("v.variable", "v.current")
        .where(F.col("current").isNotNull())
        .distinct()
        .withColumn("new", squish(F.col("current")))
    )
