"""Session settings, reliable checkpoints and scratch folders."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Split hot join partitions even where that costs one more exchange further up the plan.
_RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Open scratch scopes, the innermost last; each lists the folders made in it.
_scopes: list[list[str]] = []


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators are written for and return the session."""
    for key, value in _RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def _shared_dir(spark: SparkSession) -> str:
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            shared = tempfile.mkdtemp(prefix="siltframe-")
        sc.setCheckpointDir(shared)
    return sc.getCheckpointDir()


def _made(path: str) -> str:
    if _scopes:
        _scopes[-1].append(path)
    return path


def checkpoint(df: DataFrame) -> DataFrame:
    """Store ``df`` in the shared checkpoint folder, so a lost executor cannot change its rows."""
    _shared_dir(df.sparkSession)
    held = df.checkpoint()
    if _scopes:
        file = held._jdf.queryExecution().logical().rdd().getCheckpointFile()
        if file.isDefined():
            _made(file.get())
    return held


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared checkpoint folder; removed with the scratch scope it was asked for in."""
    return _made(f"{_shared_dir(spark)}/{label}-{uuid.uuid4().hex}")


def remove(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """A scope for work that ends in a write: tables and checkpoints made inside are removed at its end.

    Results that are still lazy then can no longer be computed, so write them inside. Scopes may be nested; each
    removes what was made while it was the innermost one, whether the work succeeded or not.
    """
    made: list[str] = []
    _scopes.append(made)
    try:
        yield made
    finally:
        _scopes.remove(made)
        for path in made:
            remove(spark, path)
