"""Register a query under its key, together with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .archive import Workload
from .views import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str) -> Callable[[Callable[[Workload], DataFrame]], Callable[[Workload], DataFrame]]:
    def register(build: Callable[[Workload], DataFrame]) -> Callable[[Workload], DataFrame]:
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Workload(spark, sf_dir))

        run.__name__ = key
        QUERIES[key] = run
        ORACLES[key] = with_views(sql)
        return build

    return register
