"""The same transforms over streams of files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def read_stream(spark: SparkSession, path: str, schema, max_files: int = 100) -> DataFrame:
    """New parquet files below ``path`` as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def once_each(stream: DataFrame, key: str, time: str, delay: str = "1 day") -> DataFrame:
    """Rows without redeliveries that arrive within ``delay``; state older than that is dropped."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, time: str, by: str, width: str, delay: str) -> DataFrame:
    """Rows per window and value; a window is given once, when the watermark has passed it."""
    w = stream.withWatermark(time, delay).groupBy(F.window(time, width).alias("w"), by).agg(F.count(F.lit(1)).alias("n"))
    return w.select(F.col("w.start").alias("window_start"), by, "n")


def run_batches(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Applies a batch transform to each micro-batch and stores it under its number, so a batch run twice is stored once."""

    def write(df: DataFrame, batch: int) -> None:
        transform(df).write.mode("overwrite").parquet(f"{out}/batch={batch}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
