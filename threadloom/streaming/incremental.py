"""Labelling as rows arrive: the batch anti-join and append run per micro-batch.

The source has no windows or late data; what it does incrementally is skip
posts that already have a result and save progress as it goes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from threadloom.operators.merge import pending
from threadloom.session import path_exists


def label_stream(
    posts: DataFrame,
    label: Callable[[DataFrame], DataFrame],
    results: str,
    checkpoint: str,
    key: str = "post_id",
) -> StreamingQuery:
    """Label the posts of a stream that have no result below ``results`` yet.

    Each micro-batch writes its own folder and replaces it when replayed, so a
    restart neither loses nor doubles rows.
    """
    spark = posts.sparkSession

    def run(batch: DataFrame, batch_id: int) -> None:
        target = f"{results}/batch={batch_id}"
        fresh = batch.dropDuplicates([key])
        if path_exists(spark, results):
            done = spark.read.parquet(results)
            fresh = pending(fresh, done.where(done["batch"] != batch_id), key)
        label(fresh).write.mode("overwrite").parquet(target)

    return (
        posts.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
