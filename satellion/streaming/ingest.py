"""Reads as a stream: headers are unique within the watermark, repeats are written batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def stream_reads(spark: SparkSession, path: str, schema: str = "head string, dna string, ts timestamp", delay: str = "10 minutes") -> DataFrame:
    """Reads from Parquet files as they arrive; a header that repeats within the delay counts once."""
    return spark.readStream.schema(schema).parquet(path).withWatermark("ts", delay).dropDuplicatesWithinWatermark(["head"])


def count_by_window(reads: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Reads and bases per window of time."""
    return reads.groupBy(F.window("ts", width)).agg(F.count("*").alias("reads"), F.sum(F.length("dna")).alias("bases"))


def write_batches(df: DataFrame, path: str, checkpoint: str, step) -> StreamingQuery:
    """Runs step (a DataFrame function) on each batch; a batch's folder is overwritten when it is run again."""

    def write(batch: DataFrame, number: int) -> None:
        step(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
