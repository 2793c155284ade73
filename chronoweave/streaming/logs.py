"""Streams beside the batch tables: append-only logs whose reruns add nothing, first detections, and alerts on transitions.

Late facts are never dropped here: both of a fact's dates are kept, so no watermark guards these streams; state is what the table
already holds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chronoweave.operators.serving import insert_new


def append_once(path: str, key: list[str]) -> Callable[[DataFrame, int], None]:
    """A batch function that appends the rows whose key the table lacks; a batch that runs twice adds nothing."""

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        try:
            stored = spark.read.schema(batch.schema).parquet(path)
            stored.isEmpty()
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e):
                raise
            stored = spark.createDataFrame([], batch.schema)
        insert_new(stored, batch, key).write.mode("append").parquet(path)

    return write


def stream_log(spark: SparkSession, source: str, schema: str, path: str, key: list[str], checkpoint: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df) -> StreamingQuery:
    """Follows a folder of Parquet files into an append-only log."""
    rows = transform(spark.readStream.schema(schema).parquet(source))
    return rows.writeStream.foreachBatch(append_once(path, key)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_detections(log: DataFrame, key: list[str], at: str = "created_at") -> DataFrame:
    """When each key was first logged, batch or stream (complete mode)."""
    return log.groupBy(*key).agg(F.min(at).alias("first_detected_at"), F.max(at).alias("last_detected_at"), F.count("*").alias("detections"))


def windowed_counts(events: DataFrame, at: str, by: str, size: str = "5 minutes", slide: str | None = None, late: str | None = None) -> DataFrame:
    """Counts per window; with ``late``, rows later than that are left out, which only a counter may do."""
    rows = events.withWatermark(at, late) if late else events
    return rows.groupBy(F.window(at, size, slide or size), by).agg(F.count("*").alias("n"))
