"""Structured Streaming forms: daily buffering, weekly windows, first-seen links, expiry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def read_events(spark: SparkSession, path: str, schema: str = EVENTS, files: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def weekly_counts(events: DataFrame, late: str = "14 days") -> DataFrame:
    """Counts of tumbling weeks from Monday 00:00 UTC; later rows than ``late`` are dropped."""
    w = F.window("ts", "7 days", "7 days", "4 days")
    g = events.withWatermark("ts", late).groupBy(w, "event_type")
    return g.agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("week"), "event_type", "n", "total")


def first_seen(articles: DataFrame, keys: list[str], keep: str = "56 days") -> DataFrame:
    """The first article of each key; keys are forgotten after ``keep``."""
    return articles.withWatermark("published", keep).dropDuplicatesWithinWatermark(keys)


def buffered(articles: DataFrame, weeks: int = 8) -> DataFrame:
    """Buffer rows with their expiry."""
    return articles.withColumn("buffer_expires_at", F.col("published") + F.expr(f"interval {7 * weeks} days")).withColumn("analysed", F.lit(False))


def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process what is there and stop: the daily job. Reruns go on where it stopped."""
    q = df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).option("path", path).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def insert_ignore_batches(df: DataFrame, path: str, checkpoint: str, keys: list[str]) -> StreamingQuery:
    """Append rows whose key the table lacks, batch by batch; a batch that runs again adds nothing."""

    def add(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        new = batch.dropDuplicates(keys)
        try:
            new = new.join(spark.read.parquet(path).select(*keys), keys, "left_anti")
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
        new.write.mode("append").parquet(path)

    q = df.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
