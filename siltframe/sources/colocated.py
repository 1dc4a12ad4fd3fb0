"""Samples, counts and age models stored in the same buckets of sample ids, so they join without an exchange.

Counts are partitioned by level and, within a level, bucketed and sorted by ``ID_SAMPLE`` like the samples and the age
models. A selection of samples then meets the counts bucket by bucket: the large side is read where it lies, in order.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession

from ..schema import SCHEMAS, TABLES
from .tables import Archive, write_table

KEY = "ID_SAMPLE"
#: Tables that hang on a sample, and the columns they are partitioned by.
BUCKETED = {"sample": [], "pollen_count": ["amalgamation_level"], "age_model": []}


def _name(path: str, table: str, buckets: int) -> str:
    return f"siltframe_{table}_{buckets}_{zlib.crc32(path.encode()):08x}"


def _declare(spark: SparkSession, path: str, table: str, buckets: int) -> str:
    """Make the files below ``path`` known under a name, with the buckets they are in."""
    name, parts = _name(path, table, buckets), BUCKETED[table]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in SCHEMAS[table])
    by = f"PARTITIONED BY ({', '.join(parts)})" if parts else ""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (path '{path}/{table}') {by} "
        f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets} BUCKETS"
    )
    if parts:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return name


def write_colocated(archive: Archive, path: str, buckets: int) -> None:
    """Write all tables; those that hang on a sample go to ``buckets`` buckets, one file per bucket and level.

    Take as many buckets as the counts have 128 MB, and no fewer than the session has shuffle partitions.
    """
    for table in TABLES:
        df: DataFrame = archive.table(table)
        if table not in BUCKETED:
            write_table(df, path, table)
            continue
        # Bucket numbers and shuffle partitions come from the same hash, so a task writes one bucket.
        writer = df.select(*SCHEMAS[table].names).repartition(buckets, KEY).write.mode("overwrite").option("compression", "zstd")
        if BUCKETED[table]:
            writer = writer.partitionBy(*BUCKETED[table])
        name = _name(path, table, buckets)
        writer.bucketBy(buckets, KEY).sortBy(KEY).option("path", f"{path}/{table}").saveAsTable(name)
        df.sparkSession.sql(f"DROP TABLE {name}")  # the files stay


def load_colocated(spark: SparkSession, path: str, buckets: int) -> Archive:
    """Read what ``write_colocated`` wrote with that many buckets."""
    tables = {}
    for table in TABLES:
        if table in BUCKETED:
            tables[table] = spark.table(_declare(spark, path, table, buckets)).select(*SCHEMAS[table].names)
        else:
            tables[table] = spark.read.schema(SCHEMAS[table]).parquet(f"{path}/{table}")
    return Archive.of(tables)
