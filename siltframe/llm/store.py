"""Tables written to the shared folder: they cut lineage, outlive lost executors and are read column by column."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure, scratch_path
from .words import mix

# Bounds the text that a Python worker holds at once, whatever the length of a document.
BATCH_ROWS = 256
BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """The session settings the operators are written for.

    Functions that run in tasks travel with the plan, so executors need no copy of this package.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__package__])
    configure(spark)
    for key, value in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS)),
        ("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES)),
    ):
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def stored(df: DataFrame, label: str, narrow: bool = False) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it again.

    ``narrow`` tables, a few numbers in a row, are written by four tasks a core at most, each of which goes through
    several partitions: many small files cost more than the rows in them.
    """
    if narrow:
        df = df.coalesce(4 * df.sparkSession.sparkContext.defaultParallelism)
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id written as text, modulo ``folds``; null ids fall in fold 0."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)), F.lit(0)).cast("int")


def _places(bits: int):
    def places(batches):
        for batch in batches:
            at = np.unique(mix(batch.column(0).to_numpy().view(np.uint64)) % np.uint64(bits)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((at >> 5).astype(np.int32)), pa.array(1 << (at & 31))], ["at", "bit"])

    return places


def sieve(keys: DataFrame, rows: DataFrame, column: str, bits: int = 1 << 24) -> DataFrame:
    """``rows`` whose ``column`` (long) is one of ``keys`` (one column, long), and few others.

    The bit table that goes to the tasks has ``bits`` bits whatever the number of keys; a full table lets more rows
    pass and is never wrong about a key. It thins out rows ahead of a join, not in its place.
    """
    spark = rows.sparkSession
    name = keys.columns[0]
    found = keys.where(F.col(name).isNotNull()).mapInArrow(_places(bits), "at int, bit long").groupBy("at").agg(F.bit_or("bit").alias("bit")).toArrow()
    table = np.zeros(bits // 32, np.int64)
    table[found["at"].to_numpy()] = found["bit"].to_numpy()
    shipped = spark.sparkContext.broadcast(table.astype(np.uint32))

    def passed(batches):
        known = shipped.value
        for batch in batches:
            at = (mix(batch.column(column).fill_null(0).to_numpy().view(np.uint64)) % np.uint64(bits)).astype(np.int64)
            yield batch.filter(pa.array((known[at >> 5] >> (at & 31).astype(np.uint32)) & np.uint32(1) == 1))

    return rows.mapInArrow(passed, rows.schema)
