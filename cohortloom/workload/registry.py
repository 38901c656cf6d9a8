"""Named queries and their comparison SQL."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortloom.session import wide_rows
from cohortloom.workload.fixtures import Data, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, extra: str = ""):
    """Register a function of `Data`; `sql` is completed with the views it mentions."""

    def register(build: Callable[[Data], DataFrame]) -> Callable[[Data], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Data(wide_rows(spark), folder))
        if sql is not None:
            ORACLES[name] = with_views(sql, extra)
        return build

    return register
