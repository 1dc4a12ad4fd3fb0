"""CSV inputs and the CSV bundle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import snake_case, squish
from ..operators.joins import keep_members
from ..operators.reshape import long_from_matrix, union_sources
from ..schema import LEVELS
from ..session import scratch
from .lines import csv_cells, numbered_lines, with_header

AGE_MODEL_FILE = T.StructType(
    [T.StructField("sample_ids", T.StringType())]
    + [
        T.StructField(n, T.DoubleType())
        for n in ("depths", "mean", "median", "uncert_5", "uncert_25", "uncert_75", "uncert_95")
    ]
)

# Marks in the file name of a count sheet that do not belong to the site name.
SHEET_MARKS = ["_list", "_LIST", "_SPH", "_sph"]
SHEET_NAMES = ["taxon_name", "clean", "intermediate", "amalgamated"]


def read_csv(spark: SparkSession, path: str, schema: T.StructType, null_value: str = "") -> DataFrame:
    """A CSV table with header, quoted as ``write_csv`` quotes; the schema is declared, so nothing is read twice.

    Where there are text columns a field may hold line breaks, so a file is read in one piece.
    """
    text = any(isinstance(f.dataType, T.StringType) for f in schema.fields)
    return spark.read.csv(
        path, schema=schema, header=True, enforceSchema=False, quote='"', escape='"', nullValue=null_value, multiLine=text
    )


def read_wide_csv(spark: SparkSession, path: str, ids: T.StructType, null_value: str = "") -> DataFrame:
    """A CSV whose measure columns are only known from its header; measures become doubles."""
    head = spark.read.csv(path, header=True, inferSchema=False)
    known = {f.name: f for f in ids.fields}
    fields = [known.get(c, T.StructField(c, T.DoubleType())) for c in head.columns]
    return read_csv(spark, path, T.StructType(fields), null_value)


def read_sheet(
    spark: SparkSession, path: str, schema: T.StructType, required: str | None = None, skip: int = 0
) -> DataFrame:
    """One sheet, exported as CSV; rows without ``required`` are left out.

    ``skip`` lines stand before the header line of every part; the lines of such a sheet are numbered
    split by split, and it must not have line breaks inside a field. A cell that is missing or not of
    its column's type is null.
    """
    if skip:
        lines = numbered_lines(spark, path).where((F.col("line") > skip) & (F.trim("value") != ""))
        cells = lines.select(csv_cells(F.col("value")).alias("cells"))
        sheet = cells.select(*[F.get("cells", F.lit(i)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])
    else:
        sheet = read_csv(spark, path, schema)
    sheet = sheet.toDF(*snake_case(sheet.columns))
    return sheet.where(F.col(required).isNotNull()) if required else sheet


def read_age_model_files(
    spark: SparkSession, path: str, pattern: str = "*.csv", name_part: str = "bacon", entities: DataFrame | None = None
) -> DataFrame:
    """All age-model files below ``path`` with where they come from.

    The entity is the parent folder of a file and ``subfolder`` the one above; only files whose
    path contains ``name_part`` are taken. Columns are found by the header of each file, in whatever
    order; a file that lacks one fails, and so does a row with another number of cells than its
    header. Files are read split by split, whatever their size.
    """
    found = with_header(numbered_lines(spark, path, pattern, name_part))
    uneven = F.raise_error(F.concat(F.lit("line "), (F.col("line") + 1).cast("string"), F.lit(" has another number of cells than the header of "), "path"))
    cells = found.where(F.when(F.size("cells") == F.size("header"), True).otherwise(uneven.cast("boolean")))

    def column(field: T.StructField):
        at = F.array_position("header", field.name)
        missing = F.raise_error(F.concat(F.lit(f"no column {field.name} in "), "path"))
        value = F.get("cells", at.cast("int") - 1)
        return F.when(at == 0, missing.cast("string")).otherwise(value).cast(field.dataType).alias(field.name)

    rows = cells.select(
        F.split_part("path", F.lit("/"), F.lit(-2)).alias("entity_name"),
        F.split_part("path", F.lit("/"), F.lit(-3)).alias("subfolder"),
        "path",
        *[column(f) for f in AGE_MODEL_FILE.fields],
    )
    return rows if entities is None else keep_members(rows, entities, "entity_name")


def sheet_from_path(path: str) -> tuple[str, bool]:
    """What the name of a count file tells: the site, and whether it is a list."""
    stem = path.rsplit("/", 1)[-1].rsplit(".", 1)[0]
    is_list = "_list" in stem or "_LIST" in stem
    for mark in SHEET_MARKS:
        stem = stem.replace(mark, "")
    return stem, is_list


def harmonise_count_sheet(sheet: DataFrame, *, is_list: bool = False, null_policy: str = "zero") -> DataFrame:
    """One count sheet, list or matrix, as (four names, depth, count).

    A list has depth and count columns; a matrix one column per depth. A sheet with a column named
    like "count" is a list whatever it is declared as. An empty column before the name column goes.
    """
    columns = sheet.columns
    if len(columns) > 1 and "name" in columns[1].lower() and sheet.where(F.col(columns[0]).isNotNull()).isEmpty():
        sheet = sheet.drop(columns[0])
        columns = columns[1:]
    if is_list or any("count" in c.lower() for c in columns):
        return sheet.toDF(*SHEET_NAMES, "depth", "count").withColumns(
            {c: F.expr(f"try_cast({c} AS DOUBLE)") for c in ("depth", "count")}
        )
    return long_from_matrix(sheet.toDF(*SHEET_NAMES, *columns[4:]), SHEET_NAMES, null_policy)


def harmonise_count_sheets(sheets: Sequence[tuple[str, str, DataFrame, bool]], null_policy: str = "zero") -> DataFrame:
    """Stack (site, entity, sheet, is_list) sheets under their names, with squished taxon levels."""
    frames = [
        harmonise_count_sheet(sheet, is_list=is_list, null_policy=null_policy).select(
            F.lit(site).alias("site_name"), F.lit(entity).alias("entity_name"), "*"
        )
        for site, entity, sheet, is_list in sheets
    ]
    return union_sources(*frames).withColumns({c: squish(F.col(c)) for c in SHEET_NAMES[1:]})


def read_count_sheets(
    spark: SparkSession,
    path: str,
    pattern: str = "*.csv",
    null_policy: str = "zero",
    entities: DataFrame | None = None,
    site_from: str = "file",
) -> DataFrame:
    """All count sheets below ``path`` as (site_name, entity_name, four names, depth, count); layouts may be mixed.

    The site comes from the name of the file, or of its folder. ``entities`` (site_name, entity_name) names the core of a
    site; a site it does not list has none. A sheet with "list" in its name or a column named like "count" has depth and
    count columns, any other one column per depth. A column before the names goes if the next header is like "name" or
    blank and it is empty itself. Sheets are read split by split and meet their header by a join on the path, so a sheet
    may be larger than any cell or task. Fields must not hold line breaks.
    """
    if null_policy not in ("zero", "drop"):
        raise ValueError("null_policy is 'zero' or 'drop'")
    place = {"file": -1, "folder": -2}[site_from]
    stem = F.regexp_replace(F.split_part("path", F.lit("/"), F.lit(place)), r"\.[^.]*$", "")
    second = F.coalesce(F.lower(F.get("header", F.lit(1))), F.lit("name"))
    led = second.contains("name") & (F.col("leading") == 0)
    counted = F.exists("header", lambda h: F.coalesce(F.lower(h).contains("count"), F.lit(False)))
    sheet = with_header(numbered_lines(spark, path, pattern)).withColumn("stem", stem).select(
        F.regexp_replace("stem", "|".join(SHEET_MARKS), "").alias("site_name"), "header", F.col("cells").alias("row"),
        F.when(led, 1).otherwise(0).alias("at"), (F.lower("stem").contains("_list") | counted).alias("is_list"),
    )
    pair = lambda depth, count: F.struct(depth.try_cast("double").alias("depth"), count.try_cast("double").alias("count"))
    listed = F.array(pair(F.get("row", F.col("at") + 4), F.get("row", F.col("at") + 5)))
    places = F.sequence(F.col("at") + 4, F.greatest(F.size("header") - 1, F.col("at") + 4))
    matrix = F.transform(places, lambda i: pair(F.get("header", i), F.get("row", i)))
    long = sheet.select(
        "site_name", *[F.get("row", F.col("at") + i).alias(c) for i, c in enumerate(SHEET_NAMES)], "is_list",
        F.explode(F.when(F.col("is_list"), listed).otherwise(matrix)).alias("cell"),
    ).select("site_name", *SHEET_NAMES, "is_list", "cell.depth", "cell.count")
    if null_policy == "zero":
        filled = F.when(F.col("is_list"), F.col("count")).otherwise(F.coalesce("count", F.lit(0.0)))
        long = long.withColumn("count", filled).where(F.col("is_list") | F.col("taxon_name").isNotNull())
    else:
        long = long.where(F.col("is_list") | F.col("count").isNotNull())
    long = long.drop("is_list").withColumns({c: squish(F.col(c)) for c in SHEET_NAMES[1:]})
    if entities is None:
        named = long.withColumn("entity_name", F.lit(None).cast("string"))
    else:
        named = long.join(entities.select("site_name", "entity_name"), "site_name", "left")
    return named.select("site_name", "entity_name", *SHEET_NAMES, "depth", "count")


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def write_csv(df: DataFrame, path: str, null_value: str = "", *, single_file: bool = False) -> None:
    out = df.coalesce(1) if single_file else df
    # White space around a value is part of it; by default Spark drops it when writing.
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    out.write.mode("overwrite").csv(path, header=True, nullValue=null_value, quote='"', escape='"', **kept)


def snapshot_files(prefix: str) -> dict[str, str]:
    """The seven tables of a bundle and where each is written."""
    names = {"metadata": "metadata", "dates": "dates", "samples": "samples", "age_model": "age_model"}
    names |= {level: f"pollen_counts_{level}" for level in LEVELS}
    return {table: f"{prefix}_{name}.csv" for table, name in names.items()}


def write_csvs(snapshot, prefix: str, *, single_file: bool = False):
    """Write a snapshot as seven CSV tables with a common path prefix and return it.

    A missing value is an empty field in the first four tables and NA in the counts. Each table is
    a folder of part files, unless ``single_file`` asks for one part.
    """
    from ..plans.snapshot import Snapshot

    if not isinstance(snapshot, Snapshot):
        raise TypeError("write_csvs needs the result of snapshot()")
    spark = snapshot.entity.sparkSession
    parent = prefix.rsplit("/", 1)[0] if "/" in prefix else "."
    if not path_exists(spark, parent):
        raise FileNotFoundError(f"the folder {parent} does not exist")
    paths = snapshot_files(prefix)
    tables = {
        "metadata": snapshot.entity,
        "dates": snapshot.date_info,
        "samples": snapshot.sample,
        "age_model": snapshot.age_model,
    }
    for name, df in tables.items():
        write_csv(df, paths[name], single_file=single_file)
    held = "stored_facts" in vars(snapshot)
    with scratch(spark):
        for level, wide in snapshot.pollen_count.items():
            write_csv(wide, paths[level], "NA", single_file=single_file)
        if not held:  # the counts that were stored for these pivots go with the scope
            vars(snapshot).pop("stored_facts", None)
    return snapshot
