"""Isotonic calibration by pooling adjacent violators, range by range."""

from __future__ import annotations

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from threadloom.functions.numeric import running_totals
from threadloom.session import materialize

#: Blocks pooled in one task.
PER_TASK = 200_000


def pool(stack: list[list], rows) -> list[list]:
    """Push (lo, hi, sum, weight) rows in order of ``lo``; neighbours whose means do not rise become one."""
    for row in rows:
        stack.append(list(row))
        while len(stack) > 1 and stack[-2][2] * stack[-1][3] >= stack[-1][2] * stack[-2][3]:
            _, hi, total, weight = stack.pop()
            last = stack[-1]
            last[1], last[2], last[3] = hi, last[2] + total, last[3] + weight
    return stack


def isotonic_blocks(points: DataFrame, per_task: int = PER_TASK) -> DataFrame:
    """The blocks of the rising step function closest to ``points`` (x, total, weight): lo, hi, total, weight.

    Blocks are dealt by ranges and pooled within a task; a stack of blocks may go on
    being pooled with others, so passes with other range borders follow until no two
    neighbours at a border are out of order. The result does not depend on the borders.
    """
    blocks, turn = points.select(F.col("x").alias("lo"), F.col("x").alias("hi"), "total", "weight"), 0

    def pooled(frames):
        stack: list[list] = []
        for frame in frames:
            stack = pool(stack, frame.itertuples(index=False))
        yield pd.DataFrame(stack, columns=["lo", "hi", "total", "weight"]).assign(task=TaskContext.get().partitionId())

    while True:
        parts = max(1, -(-blocks.count() // per_task))
        parts += turn % 2 if parts > 1 else 0
        dealt = blocks.repartitionByRange(parts, "lo").sortWithinPartitions("lo")
        found = materialize(dealt.mapInPandas(pooled, "lo double, hi double, total double, weight double, task int"), "blocks")
        blocks, turn = found.drop("task"), turn + 1
        if parts == 1:
            return blocks
        mean = F.col("total") / F.col("weight")
        ends = found.groupBy("task").agg(F.min_by(mean, "lo").alias("first"), F.max_by(mean, "lo").alias("last"))
        before = F.lag("last").over(W.orderBy("task"))  # one row a task
        if ends.withColumn("before", before).where(F.col("before") >= F.col("first")).isEmpty():
            return blocks


def isotonic_fit(df: DataFrame, score: str, label: str, per_task: int = PER_TASK) -> DataFrame:
    """Every distinct score with its weight and calibrated value: score, weight, calibrated.

    Rows with a null score or label do not count. An empty table gives no rows. Equal
    scores are one point. A score finds its block by the number of block starts up to
    it, which needs no range join.
    """
    known = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    points = materialize(
        known.groupBy(F.col(score).cast("double").alias("x")).agg(F.sum(F.col(label).cast("double")).alias("total"), F.count(F.lit(1)).cast("double").alias("weight")),
        "points",
    )
    blocks = isotonic_blocks(points, per_task).select(F.col("lo").alias("x"), (F.col("total") / F.col("weight")).alias("value"))
    started = points.join(blocks, "x", "left").withColumn("start", F.col("value").isNotNull().cast("long"))
    numbered = materialize(running_totals(started.select("x", "weight", "value", "start"), "x", {"start": "block"}, descending=False), "numbered")
    values = numbered.where(F.col("start") == 1).select("block", F.col("value").alias("calibrated"))
    return numbered.select("x", "weight", "block").join(values, "block").select(F.col("x").alias("score"), F.col("weight").cast("long").alias("weight"), "calibrated")
