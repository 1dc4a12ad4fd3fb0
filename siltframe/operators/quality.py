"""Checks. Each returns the offending rows, so an empty result means the check holds."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import if_else, strip_code
from .aggregates import compare_counts, count_rows, with_group_size
from .joins import all_null, drop_members, join_null_safe

Keys = Sequence[str]


def check_pk(df: DataFrame, key: Keys) -> DataFrame:
    """Key values held by more than one row."""
    return count_rows(df, key, "n").where(F.col("n") > 1)


def check_fk(child: DataFrame, parent: DataFrame, key: str | Keys) -> DataFrame:
    """Child rows without a parent."""
    return drop_members(child, parent, key)


def _differs(a: Column, b: Column, numeric: bool, tolerance: float) -> Column:
    if not numeric:
        return ~a.eqNullSafe(b)
    x, y = a.cast("double"), b.cast("double")
    return (a.isNull() != b.isNull()) | F.coalesce(F.abs(x - y) > tolerance * F.greatest(F.abs(x), F.lit(1.0)), F.lit(False))


def table_diff(old: DataFrame, new: DataFrame, key: Keys, tolerance: float = 1e-9) -> DataFrame:
    """Differing cells of two versions of a table: (key, column, old_value, new_value, status).

    Numbers differ if they are further apart than ``tolerance`` relative to the old value, or
    absolutely where that is below one. A row on one side only is reported once, without a column.
    """
    from pyspark.sql.types import NumericType

    kinds = {f.name: isinstance(f.dataType, NumericType) for f in old.schema.fields}
    shared = [c for c in old.columns if c in new.columns and c not in key]
    before = old.select(*key, *[F.col(c).alias(f"__old_{c}") for c in shared], F.lit(True).alias("__in_old"))
    after = new.select(*key, *[F.col(c).alias(f"__new_{c}") for c in shared], F.lit(True).alias("__in_new"))
    joined = join_null_safe(before, after, key, "full_outer")

    def cell(column: Column, old_value: Column, new_value: Column, status: str) -> Column:
        return F.struct(
            column.cast("string").alias("column"),
            old_value.cast("string").alias("old_value"),
            new_value.cast("string").alias("new_value"),
            F.lit(status).alias("status"),
        )

    none = F.lit(None)
    cells = []
    for c in shared:
        a, b = F.col(f"__old_{c}"), F.col(f"__new_{c}")
        cells.append(F.when(_differs(a, b, kinds[c], tolerance), cell(F.lit(c), a, b, "changed")))
    one_side = F.when(F.col("__in_old").isNull(), F.array(cell(none, none, none, "added"))).when(
        F.col("__in_new").isNull(), F.array(cell(none, none, none, "removed"))
    )
    differing = F.filter(F.array(*cells), lambda x: x.isNotNull()) if cells else F.array()
    return joined.select(*key, F.inline(F.coalesce(one_side, differing)))


def suspicious_units(df: DataFrame, columns: Keys = ("depth", "thickness")) -> DataFrame:
    """Values below one centimetre, the sign of a measure left in metres."""
    return df.where(reduce(lambda a, b: a | b, [F.col(c) < 1 for c in columns]))


def empty_dates(dates: DataFrame) -> DataFrame:
    return dates.where(all_null(["date_type", "depth", "thickness", "age_used"]))


def existing_keys(table: DataFrame, new: DataFrame, columns: Keys) -> DataFrame:
    """Stored rows that hold any of the new keys, on either column."""
    hit = None
    for c in columns:
        part = table.join(new.select(c).distinct().withColumn(f"__{c}", F.lit(True)), c, "left")
        table = part
        hit = F.col(f"__{c}").isNotNull() if hit is None else hit | F.col(f"__{c}").isNotNull()
    return table.where(hit).drop(*[f"__{c}" for c in columns])


def missing_core_tops(source_dates: DataFrame, archive_dates: DataFrame) -> DataFrame:
    """Core tops of a source whose entity has none in the archive."""
    def tops(dates: DataFrame) -> DataFrame:
        return dates.where(F.col("date_type").rlike("^(Top|top)"))

    return drop_members(tops(source_dates), tops(archive_dates), "ID_ENTITY")


def zero_thickness(sample: DataFrame) -> DataFrame:
    """Thickness that rounds to zero becomes null."""
    thickness = F.col("thickness")
    zero = F.bround(thickness, 3) == 0
    return sample.withColumn("thickness", if_else(zero, F.lit(None), thickness))


def count_mismatch(left: DataFrame, right: DataFrame, key: str, left_name: str, right_name: str) -> DataFrame:
    """Keys with another number of rows in the second table."""
    return compare_counts(left, right, key, left_name, right_name).where(F.col(left_name) != F.col(right_name))


def unpaired_codes(left: DataFrame, right: DataFrame, key: str, code: str = "lab_num") -> DataFrame:
    """Rows of two stacked sources whose cleaned code does not occur exactly twice in its group."""
    stacked = left.unionByName(right, allowMissingColumns=True).withColumn(code, strip_code(F.col(code)))
    return with_group_size(stacked, [key, code], F.col("n") != 2)


def unknown_names(df: DataFrame, known: DataFrame, name: str) -> DataFrame:
    return drop_members(df.select(name).distinct(), known, name)


def duplicate_review(totals: DataFrame, metadata: DataFrame, entity: str, depth: str = "depth") -> DataFrame:
    """Sheet for reviewing repeated samples: total, whether all repeats agree, and a keep flag.

    ``totals`` has (entity, depth, total, …), one row per sample; a row is kept if its entity is in
    the metadata.
    """
    known_totals = F.count("total")
    one_value = F.min("total").eqNullSafe(F.max("total")) & ((known_totals == 0) | (known_totals == F.count("*")))
    agree = totals.groupBy(entity, depth).agg(one_value.alias("same_total"))
    known = metadata.select(entity).distinct().withColumn("__known", F.lit(True))
    joined = join_null_safe(totals, agree, [entity, depth]).join(known, entity, "left")
    return joined.withColumn("keep", F.coalesce("__known", F.lit(False))).drop("__known")


def redundancy(df: DataFrame, entity: str, columns: Keys) -> DataFrame:
    """Per entity: all rows against rows that are distinct in ``columns``."""
    distinct_rows = df.groupBy(entity, *columns).agg(F.count("*").alias("__n"))
    return distinct_rows.groupBy(entity).agg(
        F.sum("__n").alias("n_all"), F.count("*").alias("n_unique")
    )


def _digits(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def fingerprint(df: DataFrame, name: str, places: int = 3) -> DataFrame:
    """What a table holds, whatever the order of its rows: (table_name, column_name, n, filled, total).

    ``total`` sums, over the rows, eight hexadecimal digits of the md5 of a value written as text, fractions rounded to
    ``places`` decimals; the column ``*`` does so for whole rows. Any engine that has md5 can compute it, in one pass.
    """
    from pyspark.sql.types import FractionalType

    scaled = lambda c: F.floor(c * 10**places + 0.5).cast("long").cast("string")
    texts = {
        f.name: scaled(F.col(f"`{f.name}`")) if isinstance(f.dataType, FractionalType) else F.col(f"`{f.name}`").cast("string")
        for f in df.schema.fields
    }
    row = F.concat_ws("|", *[F.coalesce(t, F.lit("~")) for t in texts.values()])
    cells = [
        F.struct(F.lit(c).alias("column_name"), F.count("*").alias("n"), F.count(t).alias("filled"), F.coalesce(F.sum(_digits(t)), F.lit(0)).alias("total"))
        for c, t in {**texts, "*": row}.items()
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.lit(name).alias("table_name"), F.inline("cells"))
