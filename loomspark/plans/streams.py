"""Streams that run over the event files to their end, compared with the batch result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.plans.registry import ORACLE, QUERIES
from loomspark.streaming import pipeline


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def events_of(spark: SparkSession, table: DataFrame) -> DataFrame:
    """A table's file as a stream."""
    folder, _, name = table.inputFiles()[0].rpartition("/")
    return spark.readStream.schema(table.schema).option("pathGlobFilter", name).parquet(folder)


def o2_stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling windows of the event stream, complete mode."""
    counts = pipeline.windowed_counts(_events(spark, sf_dir)).select(F.col("w.start").alias("start"), "event_type", "n")
    return pipeline.drained(counts, "complete")


def o13_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of the event stream, each event once."""
    once = pipeline.deduplicated(_events(spark, sf_dir), "event_id", late="40 days")
    return pipeline.drained(once.select("user_id", "event_id"))


QUERIES |= {"o2_stream_counts": o2_stream_counts, "o13_stream_dedup": o13_stream_dedup}
ORACLE |= {
    "o2_stream_counts": "select time_bucket(interval '1 hour', ts) as start, event_type, count(*) as n from events group by all",
    "o13_stream_dedup": "select distinct user_id, event_id from events",
}
