"""Keyed changes of a table as plans.

Every function returns what the table would be; nothing is written. ``sources.versions`` applies a
change to a stored table: it writes the touched slots to a new folder and then moves the pointer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import all_null, distinct_keys, drop_members, join_null_safe, keep_members

if TYPE_CHECKING:
    from ..sources.tables import Archive

Keys = Sequence[str]


class KeyViolation(ValueError):
    """New rows break a primary or foreign key."""


def key_violations(
    table: DataFrame, new: DataFrame, key: Keys, parents: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Keys of new rows that are null, repeated, already stored, or without a parent."""
    repeated = new.groupBy(*key).count().where(F.col("count") > 1).select(*key)
    faults = [
        ("null key", new.where(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])).select(*key)),
        ("repeated key", repeated),
        ("existing key", new.join(table, list(key), "left_semi").select(*key)),
    ]
    for column, parent in (parents or {}).items():
        faults.append((f"no parent for {column}", new.join(parent, column, "left_anti").select(*key)))
    tagged = [rows.withColumn("fault", F.lit(fault)) for fault, rows in faults]
    return reduce(DataFrame.unionByName, tagged)


def _check_single(rows: DataFrame, key: Keys) -> None:
    repeated = rows.groupBy(*key).count().where(F.col("count") > 1).first()
    if repeated is not None:
        raise KeyViolation(f"repeated key: {repeated.asDict()}")


def append_records(
    table: DataFrame, new: DataFrame, key: Keys, parents: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """The table with the new rows; raises if a key does not hold."""
    fault = key_violations(table, new, key, parents).first()
    if fault is not None:
        raise KeyViolation(f"{fault.fault}: {fault.asDict()}")
    return table.unionByName(new, allowMissingColumns=True).select(*table.columns)


def append_unseen(table: DataFrame, new: DataFrame, key: Keys) -> DataFrame:
    """The table with those new rows whose key it does not hold yet; raises if ``new`` repeats a key."""
    _check_single(new, key)
    unseen = drop_members(new, table, list(key))
    return table.unionByName(unseen, allowMissingColumns=True).select(*table.columns)


def upsert(table: DataFrame, updates: DataFrame, key: Keys) -> DataFrame:
    """Set the supplied columns, nulls included, where the key exists; insert the other keys.

    Raises if a key is repeated in the updates or a column is not one of the table's.
    """
    unknown = [c for c in updates.columns if c not in table.columns]
    if unknown:
        raise KeyViolation(f"not in the table: {', '.join(unknown)}")
    _check_single(updates, key)
    supplied = [c for c in updates.columns if c not in key]
    other = updates.select(*key, *[F.col(c).alias(f"__new_{c}") for c in supplied], F.lit(True).alias("__hit"))
    merged = table.join(other, list(key), "full_outer")
    value = {c: F.when(F.col("__hit"), F.col(f"__new_{c}")).otherwise(F.col(c)) for c in supplied}
    return merged.select(*[value.get(c, F.col(c)).alias(c) for c in table.columns])


def update_where(df: DataFrame, predicate: Column, values: Mapping[str, object]) -> DataFrame:
    """Set columns where the predicate holds; a null predicate leaves the row alone."""
    return df.withColumns(
        {c: F.when(predicate, v if isinstance(v, Column) else F.lit(v)).otherwise(F.col(c)) for c, v in values.items()}
    )


def delete_where(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """(kept, removed); a null predicate keeps the row."""
    return df.where(~F.coalesce(predicate, F.lit(False))), df.where(predicate)


def rm_links(external_link: DataFrame, id_entity: int, external_source: str) -> tuple[DataFrame, DataFrame]:
    """Remove an entity's links of one source: (remaining table, links the entity had before)."""
    mine = F.col("ID_ENTITY") == id_entity
    kept, _ = delete_where(external_link, mine & (F.col("external_source") == external_source))
    return kept, external_link.where(mine)


def delete_rows(df: DataFrame, rows: DataFrame, columns: Keys | None = None) -> DataFrame:
    """Remove rows equal to a listed one in all ``columns`` (default: all), nulls included."""
    listed = list(columns or df.columns)
    return join_null_safe(df, distinct_keys(rows, listed), listed, "left_anti")


def replace_slice(table: DataFrame, slots: DataFrame, new: DataFrame, key: Keys) -> DataFrame:
    """Remove every row at the listed key slots, then add the new rows."""
    return drop_members(table, slots, list(key)).unionByName(new)


def change_set(table: DataFrame, incoming: DataFrame, key: Keys, *, delete_missing: bool = False) -> DataFrame:
    """Dry run: the key and action (insert, update, delete) of every row that would change."""
    supplied = [c for c in incoming.columns if c not in key]
    old = table.select(*key, *supplied, F.lit(True).alias("__old"))
    new = incoming.select(*key, *[F.col(c).alias(f"__new_{c}") for c in supplied], F.lit(True).alias("__new"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__new_{c}")) for c in supplied], F.lit(True))
    action = (
        F.when(F.col("__old").isNull(), "insert")
        .when(F.col("__new").isNull(), "delete" if delete_missing else None)
        .when(~same, "update")
    )
    joined = old.join(new, list(key), "full_outer")
    return joined.select(*key, action.alias("action")).where(F.col("action").isNotNull())


def split_existing_new(archive: DataFrame, incoming: DataFrame, on: Keys) -> tuple[DataFrame, DataFrame]:
    """Incoming rows the archive already has, and those that still need an id."""
    known = distinct_keys(archive, on)
    return join_null_safe(incoming, known, on, "left_semi"), join_null_safe(incoming, known, on, "left_anti")


def resolve_duplicates(df: DataFrame, reviewed: DataFrame, key: str, keep: str = "keep") -> DataFrame:
    """Take out all reviewed duplicates and put back those marked to keep."""
    keepers = reviewed.where(F.col(keep) > 0).drop(keep)
    return drop_members(df, reviewed, key).unionByName(keepers, allowMissingColumns=True)


def drop_empty_rows(df: DataFrame, columns: Keys) -> tuple[DataFrame, DataFrame]:
    """(rows with content, rows that are null in all of ``columns``)."""
    return delete_where(df, all_null(columns))


def cascade_delete(archive: Archive, entities: DataFrame) -> Archive:
    """Remove entities with everything that hangs on them: links, dates, samples, counts, models."""
    gone = keep_members(archive.sample, entities, "ID_ENTITY").select("ID_SAMPLE").distinct()
    by_entity = {
        t: drop_members(archive.table(t), entities, "ID_ENTITY")
        for t in ("entity", "external_link", "date_info", "sample")
    }
    by_sample = {t: archive.table(t).join(gone, "ID_SAMPLE", "left_anti") for t in ("pollen_count", "age_model")}
    return archive.with_tables(**by_entity, **by_sample)
