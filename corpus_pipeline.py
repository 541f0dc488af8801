"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written and read
back as the docs of the next one. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from threadloom.llm import cotraining, ngram_join, packing, quality_rules, substring_dedup
from threadloom.session import materialize, ship_package

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: SQL cannot express the fitted stages; the run is tested against plain versions of its stages.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps; null and empty texts are judged like others."""
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").cast("double").alias("good"))
    return cotraining.classify(docs, labels, keep=COLUMNS).where("kept").select(*COLUMNS)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base limits and are no outliers of their language and source."""
    ship_package(spark)
    return quality_rules.judge_quality(docs, keep=COLUMNS).where("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates, by id (null last) and text; of repeated rows one."""
    ship_package(spark)
    own_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))  # beside the text's hash, so null ids do not gather
    groups = ngram_join.near_duplicates(docs, with_first=True)
    first = groups.where("is_first").select(own_id.alias("_id"), F.col("text_id").alias("_text")).distinct()
    kept = docs.select(*COLUMNS, own_id.alias("_id"), F.xxhash64(F.col("text").cast("string")).alias("_text")).join(first, ["_id", "_text"], "left_semi")
    copies = Window.partitionBy("_id", "_text").orderBy("n_chars", "source", "lang")
    return kept.withColumn("_copy", F.row_number().over(copies)).where(F.col("_copy") == 1).select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document holds; sizes follow the text."""
    ship_package(spark)
    left = substring_dedup.remove_repeats(docs, keep=("lang", "source"))
    return left.select(
        "doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars")
    )


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents in sequences: doc_id, piece, start, size, bin, offset."""
    ship_package(spark)
    return packing.pack(packing.words_and_cluster(docs))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", rules),
    ("ngram_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
