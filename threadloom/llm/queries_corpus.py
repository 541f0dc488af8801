"""Queries that judge and pack whole corpora."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.llm import cotraining, packing
from threadloom.llm.registry import query, table


def quality_labels(spark, folder):
    return table(spark, folder, "labels").select("doc_id", F.col("quality").cast("double").alias("good"))


@query("op3_quality_classifier")
def op3_quality_classifier(spark, folder):
    return cotraining.classify(table(spark, folder, "documents"), quality_labels(spark, folder))


@query("op10_packing")
def op10_packing(spark, folder):
    return packing.pack(packing.words_and_cluster(table(spark, folder, "documents")))
