"""Streams of operation records: costs by window, and the contact table kept up to date batch by batch. An extension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.contacts import upserted


def windowed_costs(events: DataFrame, every: str = "1 hour", late: str = "2 hours", rate: float = 0.02, fee: float = 0.001) -> DataFrame:
    """(window_start, method, pages, total_s, cost) over events (ts, event_type, value: seconds); works on streams and tables."""
    by = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(F.window("ts", every), F.col("event_type").alias("method"))
    rows = by.agg(F.count("*").alias("pages"), F.sum("value").alias("total_s"))
    return rows.select(F.col("window.start").alias("window_start"), "method", "pages", "total_s", (F.col("total_s") / 60 * rate + F.col("pages") * fee).alias("cost"))


def upsert_batches(stream: DataFrame, path: str, checkpoint: str):
    """Keeps path/N current with each micro-batch N of contacts; a repeated batch writes the same version again."""

    def one(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        old = spark.read.parquet(f"{path}/{n - 1}") if n else None
        upserted(old, batch).write.mode("overwrite").parquet(f"{path}/{n}")

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
