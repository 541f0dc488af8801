"""Scans. Schemas are given, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom import schemas
from threadloom.operators.emotion import build_lexicon
from threadloom.session import path_exists


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON object per line; blank lines are skipped."""
    return spark.read.schema(schema).json(path)


def head_jsonl(spark: SparkSession, path: str, n: int, schema: str) -> DataFrame:
    """The first ``n`` rows of the file."""
    return read_jsonl(spark, path, schema).limit(n)


def read_parquet(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Header line, quoted texts may span lines, quotes doubled inside."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def read_any(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Choose the reader by the path's extension."""
    low = path.lower().rstrip("/")
    if low.endswith(".parquet"):
        return read_parquet(spark, path, schema)
    if low.endswith(".csv"):
        if schema is None:
            raise ValueError("a CSV scan needs a schema")
        return read_csv(spark, path, schema)
    raise ValueError(f"unsupported file format: {path}")


def read_preferred(spark: SparkSession, enriched: str, base: str, score: str = "anxiety_score") -> tuple[DataFrame, bool]:
    """The enriched table when it exists, else the base one with null scores.

    The flag tells whether scores are there.
    """
    if path_exists(spark, enriched):
        df = read_parquet(spark, enriched)
        if score in df.columns:
            return df, True
        return df.withColumn(score, F.lit(None).cast("double")), False
    return read_parquet(spark, base).withColumn(score, F.lit(None).cast("double")), False


def read_lexicon(spark: SparkSession, path: str, emotions: list[str] | None = None) -> DataFrame:
    """(word, emotions) from a tab-separated lexicon; a missing file is empty.

    Lines with fewer than three fields have no score and drop out.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], "word string, emotions array<string>")
    rows = spark.read.schema(schemas.LEXICON).option("sep", "\t").option("quote", "").csv(path)
    return build_lexicon(rows, emotions)
