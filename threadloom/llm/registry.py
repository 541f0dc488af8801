"""Where the queries of this subpackage and their SQL twins are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from threadloom.session import ship_package

# The CRC-32 of a text as SQL: eight shifts a byte, over its UTF-8 bytes.
CRC32 = """(4294967295 - list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, 2 * octet_length(encode({0})), 2),
  lambda i: ('0x' || hex(encode({0}))[i:i + 1])::BIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
  lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)))"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL_TWINS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (session, folder) under a name, with its SQL twin."""

    def add(body: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship_package(spark)
            return body(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            SQL_TWINS[name] = sql
        return body

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
