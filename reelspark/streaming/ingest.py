"""An extension for streams: cues arriving as files are cleaned, de-duplicated and counted, and kept in a table.

The reference works in batches only; these jobs give the same rows as the batch operators on the same input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelspark.operators.documents import clean_cues


def cue_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def fresh_cues(cues: DataFrame, lateness: str = "2 days") -> DataFrame:
    """Clean cues, each once by video, times and text; state older than ``lateness`` of ingestion time is dropped."""
    timed = clean_cues(cues).withColumn("ingested_at", F.col("ingested_at").cast("timestamp")).withWatermark("ingested_at", lateness)
    return timed.dropDuplicatesWithinWatermark(["video_id", "language", "start_seconds", "end_seconds", "text"])


def cues_per_window(cues: DataFrame, window: str = "1 day", lateness: str = "2 days") -> DataFrame:
    """``start, language, cues``: cues ingested in each tumbling window, late ones included up to the watermark."""
    timed = cues.withColumn("ingested_at", F.col("ingested_at").cast("timestamp")).withWatermark("ingested_at", lateness)
    counted = timed.groupBy(F.window("ingested_at", window).alias("w"), "language").agg(F.count(F.lit(1)).alias("cues"))
    return counted.select(F.col("w.start").alias("start"), "language", "cues")


def keep(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append the stream's rows to a Parquet table exactly once and stop when what is there has been read."""
    return stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
