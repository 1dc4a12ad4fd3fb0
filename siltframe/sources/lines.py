"""Lines of text files with their numbers, and the cells of CSV lines.

Files are read split by split, so a file of any size is spread over the cluster; a header meets its rows by a join on
the path, never by reading a file into one cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.joins import join_null_safe
from ..session import checkpoint

# A cell and the comma before it: quoted up to the next comma or the end of the line, or anything without a comma.
_CELL = r',([ \t]*"(?:[^"]++|"")*+"[ \t]*(?=,|$)|[^,]*)'


def csv_cells(line: Column) -> Column:
    """The cells of a CSV line, trimmed and without their quotes; an empty cell is null.

    A comma or a doubled quote inside quotes belongs to the cell. A quote that is never closed is text.
    """
    cells = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_CELL), F.lit(1))

    def plain(cell: Column) -> Column:
        text = F.trim(cell)
        quoted = text.rlike('(?s)^".*"$') & (F.length(text) > 1)
        inner = F.replace(F.substr(text, F.lit(2), F.length(text) - 2), F.lit('""'), F.lit('"'))
        return F.nullif(F.when(quoted, F.trim(inner)).otherwise(text), F.lit(""))

    return F.transform(cells, plain)


def numbered_lines(spark: SparkSession, path: str, pattern: str = "*", part: str = "") -> DataFrame:
    """All lines of the files below ``path`` whose name matches and whose path contains ``part``.

    The columns are (path, line, value), lines from 0 in each file.

    A line is numbered within its split while the split is read; the lines of the splits before, one number per split,
    are added by a join on (path, start of the split). The rows are checkpointed in between, as both sides must see the
    same splits.
    """
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path)
    location = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    read = files.select(
        location.alias("path"), F.col("_metadata.file_block_start").alias("__split"),
        F.monotonically_increasing_id().alias("__row"), "value",
    ).where(F.col("path").contains(part))
    held = checkpoint(read)
    splits = held.groupBy("path", "__split").agg(F.min("__row").alias("__first"), F.count("*").alias("__n"))
    # One row per split of a file.
    before = Window.partitionBy("path").orderBy("__split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    line = F.col("__row") - F.col("__first") + F.col("__before")
    return join_null_safe(held, splits, ["path", "__split"]).select("path", line.alias("line"), "value")


def with_header(lines: DataFrame) -> DataFrame:
    """Rows of CSV files under the first line of their file that is not blank: (path, line, header, cells, leading).

    ``leading`` is the number of rows of the file whose first cell is not empty. Blank lines are left out. Fields must
    not hold line breaks.
    """
    cells = lines.where(F.trim("value") != "").select("path", "line", csv_cells(F.col("value")).alias("cells"))
    filled = F.get("cells", F.lit(0)).isNotNull()
    heads = cells.groupBy("path").agg(
        F.min_by("cells", "line").alias("header"), F.min("line").alias("__top"), F.count_if(filled).alias("__filled")
    )
    heads = heads.withColumn("leading", F.col("__filled") - F.get("header", F.lit(0)).isNotNull().cast("int")).drop("__filled")
    rows = join_null_safe(cells, heads, ["path"]).where(F.col("line") > F.col("__top"))
    return rows.select("path", "line", "header", "cells", "leading")
