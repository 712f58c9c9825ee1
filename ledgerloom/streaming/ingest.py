"""Watching a folder: new result documents are flattened as they arrive (an extension)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.operators.flatten import emit

DOCUMENT = "result_id long, file_name string, made_at timestamp, payload string"


def watch(spark: SparkSession, folder: str, schema: str = DOCUMENT, files_per_batch: int = 1000) -> DataFrame:
    """A stream over the Parquet files of a folder; each file is a whole delivery."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def first_deliveries(stream: DataFrame, key: str = "result_id", at: str = "made_at", late: str = "40 days") -> DataFrame:
    """The first delivery of each key; the state of a key is dropped once ``late`` has passed in event time."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def flatten_stream(stream: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Documents flattened into child tables under ``folder``, partitioned by tag; all that is there, then stop.

    Each micro-batch is written under its number, so one that is repeated after a failure replaces itself.
    """

    def write(batch: DataFrame, number: int) -> None:
        out = emit(batch).withColumn("batch", F.lit(number))
        out.write.mode("overwrite").partitionBy("tag").parquet(f"{folder}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
