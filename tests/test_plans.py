"""Plans that must not turn into nested loops or unbounded single-task windows."""

import re

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
NAMES = [
    "clean_merge", "linkage", "value_counts", "histogram", "zscale", "emotion_score", "tfidf",
    "coherence_npmi", "coherence_cv", "topic_similarity", "kfold", "quota_sample", "roc_points", "edge_cases",
]


@pytest.mark.parametrize("name", NAMES)
def test_no_nested_loops(spark, name):
    plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_fold_ranks_never_sort_a_whole_class(spark):
    plan = entry.queries()["kfold"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    ranks = re.findall(r"row_number\(\) windowspecdefinition\(([^)]*)", plan)
    assert ranks and all("_bucket" in spec for spec in ranks)


def test_unused_columns_are_not_read(spark):
    plan = entry.queries()["comment_counts"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<conv_id:bigint,turn:bigint,text:string>" in plan
    plan = entry.queries()["value_counts"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<lang:string>" in plan
