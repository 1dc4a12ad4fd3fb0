"""A local session for tests, checks and benchmarks."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from .session import configure


def local_session(cores: str | None = None, memory: str = "8g") -> SparkSession:
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("siltframe")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", memory)
        # Recording the Python call site of every column costs more than these small plans take.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
