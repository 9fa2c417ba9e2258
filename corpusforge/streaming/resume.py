"""Resumable processing with Structured Streaming: every moment leaves a valid data set."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def process_new(spark: SparkSession, source: str, schema: str, sink: str, checkpoint: str, work: Callable[[DataFrame], DataFrame], key: str, finished: Column | None = None) -> None:
    """Takes what has come to a folder of Parquet files since the last run, works on it and appends the records.

    A batch that is run again after a failure leaves out keys that the sink already has as finished; keys that
    failed come again once they are sent again.
    """
    done = finished if finished is not None else F.lit(True)

    def batch(rows: DataFrame, _: int) -> None:
        from corpusforge.sources.readers import exists

        fresh = rows.dropDuplicates([key])
        if exists(spark, sink):
            fresh = fresh.join(spark.read.parquet(sink).where(done).select(key).distinct(), key, "left_anti")
        work(fresh).write.mode("append").parquet(sink)

    stream = spark.readStream.schema(schema).parquet(source)
    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def windowed_counts(events: DataFrame, time: str, kind: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts by window and kind under a watermark, for batches and streams alike."""
    counted = events.withWatermark(time, late) if events.isStreaming else events
    return counted.groupBy(F.window(time, width).alias("w"), kind).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), kind, "n")
