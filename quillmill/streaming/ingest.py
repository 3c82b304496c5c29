"""Resumable ingestion: append log, compaction, stop conditions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillmill.operators.dedupe import keep_last


def ingest(stream: DataFrame, log: str, checkpoint: str, stop: Callable[[SparkSession, str], bool] | None = None) -> int:
    """Appends all available rows to a log, once each: a batch overwrites its own folder when it is repeated.

    A source may give only so much at a time; the query runs until a run finds nothing
    more, so one call takes all there is.  After a batch ``stop`` may end it; the next
    call goes on from the checkpoint.  Returns the number of batches written.
    """
    spark = stream.sparkSession
    done: list[int] = []
    ended: list[int] = []

    def write(batch: DataFrame, n: int) -> None:
        if batch.isEmpty():
            return
        batch.write.mode("overwrite").parquet(f"{log}/batch={n}")
        done.append(n)
        if stop and stop(spark, log):
            ended.append(n)

    while not ended:
        before = len(done)
        q = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        while not q.awaitTermination(1):
            if ended:
                q.stop()
                break
        if len(done) == before:
            break
    return len(done)


def compacted(spark: SparkSession, log: str, keys: list[str], order: str) -> DataFrame:
    """The last row of each key in a log."""
    return keep_last(spark.read.parquet(log).drop("batch"), keys, order)
