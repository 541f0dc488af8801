"""Where queries and their SQL twins are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from threadloom.plans.tables import Tables
from threadloom.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL_TWINS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under a name, with its SQL twin."""

    def add(body: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            ship_package(spark)
            return body(Tables(spark, folder))

        QUERIES[name] = run
        if sql is not None:
            SQL_TWINS[name] = sql
        return body

    return add
