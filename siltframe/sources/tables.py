"""The archive as a set of Parquet tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields, replace

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.joins import keep_members
from ..schema import MODEL_NAMES, SCHEMAS, TABLES


@dataclass(frozen=True)
class Archive:
    """The eight tables, lazily read."""

    entity: DataFrame
    external_link: DataFrame
    date_info: DataFrame
    sample: DataFrame
    taxon_name: DataFrame
    pollen_count: DataFrame
    model_name: DataFrame
    age_model: DataFrame

    @classmethod
    def of(cls, tables: Mapping[str, DataFrame]) -> Archive:
        return cls(**{f.name: tables[f.name] for f in fields(cls)})

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def with_tables(self, **tables: DataFrame) -> Archive:
        return replace(self, **tables)

    def register(self, prefix: str = "") -> None:
        for name in TABLES:
            self.table(name).createOrReplaceTempView(f"{prefix}{name}")


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """A table written out in code. It becomes part of the plan, so its size is known to Spark."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if not rows:
        return spark.createDataFrame([], schema)
    columns = [pa.array(list(c)) for c in zip(*rows)]
    return spark.createDataFrame(pa.table(columns, names=schema.names), schema)


def load_archive(spark: SparkSession, path: str) -> Archive:
    """Read ``<path>/<table>`` for every table with its declared schema."""
    return Archive.of({t: spark.read.schema(SCHEMAS[t]).parquet(f"{path}/{t}") for t in TABLES})


# The id each table is split by when it is read from a relational store.
_SPLIT_KEYS = {"entity": "ID_ENTITY", "external_link": "ID_ENTITY", "date_info": "ID_DATE_INFO", "sample": "ID_SAMPLE"}
_SPLIT_KEYS |= {"taxon_name": "ID_TAXON", "pollen_count": "ID_SAMPLE", "model_name": "ID_MODEL", "age_model": "ID_SAMPLE"}


def load_archive_jdbc(spark: SparkSession, url: str, partitions: int = 64, **options: str) -> Archive:
    """Read the tables from a relational store, each in ``partitions`` id ranges side by side.

    Filters and columns are pushed into the store's SQL.
    """
    def load(table: str) -> DataFrame:
        key = _SPLIT_KEYS[table]
        reader = spark.read.format("jdbc").options(url=url, **options)
        low, high = reader.option("query", f"SELECT min({key}) AS low, max({key}) AS high FROM {table}").load().first()
        return (
            spark.read.format("jdbc")
            .options(url=url, dbtable=table, **options)
            .options(partitionColumn=key, lowerBound=low or 0, upperBound=(high or 0) + 1, numPartitions=partitions)
            .load()
        )

    return Archive.of({t: load(t) for t in TABLES})


def write_table(df: DataFrame, path: str, name: str) -> None:
    """Replace one table; counts are laid out by level, so a level reads only its own files."""
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if name == "pollen_count":
        # Every file covers a range of samples of few levels, so an id range skips files by their min and max.
        ranged = df.repartitionByRange("amalgamation_level", "ID_SAMPLE")
        writer = ranged.sortWithinPartitions("amalgamation_level", "ID_SAMPLE").write.mode("overwrite")
        writer = writer.option("compression", "zstd").partitionBy("amalgamation_level")
    writer.parquet(f"{path}/{name}")


def write_archive(archive: Archive, path: str) -> None:
    for name in TABLES:
        write_table(archive.table(name), path, name)


def create_archive(spark: SparkSession, path: str) -> Archive:
    """Write empty tables and the seeded model names to a new path."""
    for name in TABLES:
        rows = MODEL_NAMES if name == "model_name" else []
        write_table(literal_table(spark, rows, SCHEMAS[name]), path, name)
    return load_archive(spark, path)


def scan_by_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is listed. The ids stay in the cluster; a small list goes to the scan, not to the query text."""
    return keep_members(df, ids, key)


def scan_id_range(df: DataFrame, key: str, low: int, high: int) -> DataFrame:
    """Rows with a key between two ids; pushed to the Parquet row groups."""
    return df.where(df[key].between(low, high))
