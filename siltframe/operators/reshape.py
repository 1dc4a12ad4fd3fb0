"""Wide and long count tables."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ids import with_position

# Headers of columns for ids without a name, and for rows without an id.
UNNAMED, UNMAPPED = "taxon {}", "unmapped"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def to_long(
    wide: DataFrame,
    ids: Sequence[str],
    name: str = "taxon",
    value: str = "count",
    *,
    keep_nulls: bool = False,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row per (ids, column) with a value.

    The measures go through one array: with thousands of columns that is several times faster than
    an unpivot, which copies the row once per column, and names are only attached to what is left.
    """
    measures = list(columns) if columns is not None else [c for c in wide.columns if c not in ids]
    cells = f"posexplode(array({', '.join(_quoted(m) for m in measures)})) AS (__column, {_quoted(value)})"
    long = wide.selectExpr(*[_quoted(i) for i in ids], cells)
    if not keep_nulls:
        long = long.where(F.col(_quoted(value)).isNotNull())
    named = F.lit(measures)[F.col("__column")].alias(name)
    return long.select(*[_quoted(i) for i in ids], named, _quoted(value))


def headers(long: DataFrame, name: str) -> list[str]:
    """The sorted distinct column headers of a pivot: as many as the table gets columns."""
    rows = long.select(name).where(F.col(name).isNotNull()).distinct().collect()
    return sorted(r[0] for r in rows)


def to_wide(
    long: DataFrame,
    ids: Sequence[str],
    name: str = "taxon_name",
    value: str = "count",
    names: Sequence[str] | None = None,
) -> DataFrame:
    """One column per name in code-point order; an absent cell is null, a stored zero stays zero."""
    shown = sorted(names) if names is not None else headers(long, name)
    return long.groupBy(*ids).pivot(name, shown).agg(F.first(value))


def id_headers(used: DataFrame, names: DataFrame, key: str, name: str) -> dict[str, int | None]:
    """{header: id} in code-point order for the distinct ids of ``used``: as many as the table gets columns.

    An id without a name is headed by itself, rows without an id by ``unmapped``.
    """
    found: dict[str, int | None] = {}
    for row in used.select(key).distinct().join(names.select(key, name), key, "left").collect():
        header = row[name] or (UNMAPPED if row[key] is None else UNNAMED.format(row[key]))
        if header in found:
            raise ValueError(f"two columns are called {header}")
        found[header] = row[key]
    return dict(sorted(found.items()))


def to_wide_by_id(
    long: DataFrame, ids: Sequence[str], key: str, headers_: dict[str, int | None], value: str = "count"
) -> DataFrame:
    """One column per id, renamed afterwards: names are never joined to the rows. No id is negative."""
    keyed = long.select(*ids, F.coalesce(key, F.lit(-1)).alias(key), value)
    wide = keyed.groupBy(*ids).pivot(key, [-1 if i is None else i for i in headers_.values()]).agg(F.first(value))
    return wide.toDF(*ids, *headers_)


def transpose(
    wide: DataFrame, row_name: str, new_name: str, names: Sequence[str] | None = None, *, long: bool = False
) -> DataFrame:
    """Columns become rows, and the values of ``row_name`` (or only those of ``names``) become columns.

    A table has no room for a column per row of a long table: ``transpose_blocks`` gives several, and ``long`` returns
    (new_name, row_name, value) without a pivot.
    """
    cells = to_long(wide, [row_name], new_name, "value" if long else "__value", keep_nulls=True)
    return cells.select(new_name, row_name, "value") if long else to_wide(cells, [new_name], row_name, "__value", names)


def transpose_blocks(wide: DataFrame, row_name: str, new_name: str, width: int = 1000) -> list[DataFrame]:
    """The transpose as tables of at most ``width`` new columns each, by the order of the values of ``row_name``.

    Every block has a row for every former column. The driver sees the headers of one block at a time.
    """
    placed = with_position(wide.select(row_name).where(F.col(row_name).isNotNull()).distinct(), [row_name], "__place")
    blocks = placed.select(row_name, F.floor((F.col("__place") - 1) / width).alias("__block"))
    cells = to_long(wide, [row_name], new_name, "__value", keep_nulls=True).join(blocks, row_name)
    last = blocks.agg(F.max("__block")).first()[0]
    out = []
    for block in range(0 if last is None else last + 1):
        own = F.col("__block") == block
        out.append(to_wide(cells.where(own), [new_name], row_name, "__value", headers(blocks.where(own), row_name)))
    return out


def sort_columns(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """Ids first, the others in code-point order."""
    return df.select(*first, *[_quoted(c) for c in sorted(c for c in df.columns if c not in first)])


def rename_matching(df: DataFrame, pattern: str, replacement: str) -> DataFrame:
    """Apply a regular expression to every header."""
    return df.toDF(*[re.sub(pattern, replacement, c) for c in df.columns])


def columns_starting(df: DataFrame, *prefixes: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefixes)]


def columns_containing(df: DataFrame, part: str) -> list[str]:
    return [c for c in df.columns if part in c]


def drop_empty_taxa(long: DataFrame, taxon: str = "taxon", value: str = "count") -> DataFrame:
    """Drop the taxa that have no value in any sample; the others keep their null rows."""
    used = long.groupBy(taxon).agg(F.count(value).alias("__n")).where(F.col("__n") > 0)
    return long.join(used, taxon, "left_semi")


def drop_empty_columns(wide: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Drop measure columns without a value: one pass over the table, whatever its width."""
    filled = {row[0] for row in to_long(wide, ids, "__name", "__value").select("__name").distinct().collect()}
    return wide.select(*[_quoted(c) for c in wide.columns if c in ids or c in filled])


def union_sources(*frames: DataFrame) -> DataFrame:
    """Stack tables by column name; a column a table lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def tagged_union(frames: dict[str, DataFrame], tag: str = "db") -> DataFrame:
    """Stack tables with the name of the source each row came from."""
    return union_sources(*[df.withColumn(tag, F.lit(source)) for source, df in frames.items()])


def long_from_matrix(
    matrix: DataFrame, ids: Sequence[str], null_policy: str = "zero"
) -> DataFrame:
    """A sheet with one column per depth becomes (ids, depth, count) rows.

    Header text that is no number gives a null depth. With ``null_policy="zero"`` an empty cell
    counts as zero and rows without a taxon name go; with ``"drop"`` only empty cells go.
    """
    if null_policy not in ("zero", "drop"):
        raise ValueError("null_policy is 'zero' or 'drop'")
    measures = [c for c in matrix.columns if c not in ids]
    numbers = matrix.select(*ids, *[F.expr(f"try_cast({_quoted(m)} AS DOUBLE)").alias(m) for m in measures])
    long = to_long(numbers, ids, "depth", "count", keep_nulls=True).withColumn(
        "depth", F.expr("try_cast(depth AS DOUBLE)")
    )
    if null_policy == "zero":
        return long.withColumn("count", F.coalesce("count", F.lit(0.0))).where(F.col("taxon_name").isNotNull())
    return long.where(F.col("count").isNotNull())
