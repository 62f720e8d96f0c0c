"""Running event counts per kind and day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COUNTS_SCHEMA = "kind string, day date, n_events bigint"


def count_events(events: DataFrame, width: str = "1 day") -> DataFrame:
    """Events per kind and window; works on batch and streaming frames."""
    return events.groupBy("kind", F.window("ts", width).alias("w")).agg(F.count(F.lit(1)).alias("n_events")).select(
        "kind", F.col("w.start").alias("window_start"), "n_events"
    )


def stream_event_counts(events: DataFrame, target: str, checkpoint: str, width: str = "1 day"):
    """Adds the counts of each batch to ``target``; returns the StreamingQuery.

    Counts add up, so every event counts however late it comes, and no state is kept. A batch writes a
    folder of its own number: a replayed batch overwrites itself.
    """
    def add(batch: DataFrame, batch_id: int) -> None:
        count_events(batch, width).coalesce(1).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return (
        events.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(add).start()
    )


def current_counts(spark: SparkSession, target: str) -> DataFrame:
    """The count of every (kind, window) over all batches so far."""
    return spark.read.parquet(target).groupBy("kind", "window_start").agg(F.sum("n_events").alias("n_events"))
