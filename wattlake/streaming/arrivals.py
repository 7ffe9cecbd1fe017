"""Appending, deduplicating and counting arriving records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wattlake.sources import landing

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def read_files(
    spark: SparkSession, folder: str, schema: T.StructType, file_name: str = "*",
    files_per_batch: int = 1_000,
) -> DataFrame:
    """Parquet files of a folder as a stream, a bounded number of them in each batch."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", file_name)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def with_event_time(stream: DataFrame, ts: str = "ts") -> DataFrame:
    """Zone-less times as times of the session zone: a watermark takes no others."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp"))


def append_enrichment(
    lines: DataFrame, path: str, checkpoint: str, keep: tuple[str, ...] = ()
) -> StreamingQuery:
    """Land all arrived enrichment records, then stop; the next run goes on from there.

    Each micro-batch fills a partition of its own and replaces it when it runs again, so a
    batch that failed half-way and is retried leaves no row twice. The partition also names the
    stream, by the id that its checkpoint holds, so streams can share a table and a renewed
    checkpoint replaces nothing.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not stream:
            raise RuntimeError("the stream has no id, so its batches cannot be told from others")
        rows = landing.land_enrichment_lines(batch, keep=keep).withColumns(
            {"stream_id": F.lit(stream), "batch_id": F.lit(batch_id).cast("long")}
        )
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "stream_id", "batch_id"
        ).parquet(path)

    return (
        lines.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def first_arrivals(
    stream: DataFrame, key: str = "event_id", ts: str = "ts", delay: str = "2 hours"
) -> DataFrame:
    """Each key once while its copies arrive within the delay. Later copies pass, and rows
    older than the watermark are dropped; the batch refresh of the mart settles those."""
    return with_event_time(stream, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def hourly_counts(stream: DataFrame, ts: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Number of arrivals in each hour that the watermark has closed."""
    return (
        with_event_time(stream, ts)
        .withWatermark(ts, delay)
        .groupBy(F.window(ts, "1 hour"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "n",
        )
    )


def write_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append all available rows to a Parquet table, then stop."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
