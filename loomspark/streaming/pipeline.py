"""The two-stage pipeline as file streams.

Each stage is a query from the files of one folder to another; the second reads what the first has
written. Micro-batches go through foreachBatch, which leaves out sources that are already done, so
a batch that runs again after a failure changes nothing. A source whose rows are all to be tried
again is not done.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from loomspark.functions.text import has_error
from loomspark.operators.joins import finished_sources


@dataclass(frozen=True)
class Stage:
    """A step of the pipeline: rows of one schema to rows of another, which hold source, shard and error."""

    name: str
    reads: StructType
    writes: StructType
    transform: Callable[[DataFrame], DataFrame]
    #: Which rows of the input are worked on: stage 2 passes over failures of stage 1.
    only_valid: bool = False


def empty_as_error(rows: DataFrame, inputs: DataFrame) -> DataFrame:
    """rows, plus an error row for each input source that gave none, so that it counts as done."""
    none = inputs.select("source", "shard").distinct().join(rows.select("source").distinct(), "source", "left_anti")
    return rows.unionByName(none.withColumn("error", F.lit("no_segments")), allowMissingColumns=True)


def run_batch(stage: Stage, out: str) -> Callable[[DataFrame, int], None]:
    def work(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        batch = kept = batch.persist()  # read several times below
        if stage.only_valid:
            batch = batch.where(~has_error(F.col("error")))
        try:
            done = finished_sources(spark.read.schema(stage.writes).parquet(out))
            batch = batch.join(done, "source", "left_anti")
        except Exception as e:  # nothing written yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
        made = stage.transform(batch).persist()  # models run once, not for the rows and again for their sources
        rows = empty_as_error(made, batch)
        there = set(rows.columns)
        rows = rows.select(*((F.col(f.name) if f.name in there else F.lit(None)).cast(f.dataType).alias(f.name) for f in stage.writes))
        # One folder a batch: a batch that is repeated replaces what it wrote.
        rows.write.mode("overwrite").option("maxRecordsPerFile", 100_000).parquet(f"{out}/epoch={epoch}")
        made.unpersist()
        kept.unpersist()

    return work


def drain_shards(stage: Stage, df: DataFrame, out: str, epoch: int = 0) -> int:
    """Runs a stage over df shard after shard, each published before the next begins (X6); the number of shards."""
    work, names = run_batch(stage, out), sorted(r[0] for r in df.select("shard").distinct().collect())
    for k, name in enumerate(names):
        work(df.where(F.col("shard") == name), epoch + k)
    return len(names)


def start(spark: SparkSession, stage: Stage, source: str, out: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Runs a stage until its input is drained, or for good every so often (K5, O2, O3)."""
    stream = spark.readStream.schema(stage.reads).option("recursiveFileLookup", "true").parquet(source)
    writer = stream.writeStream.foreachBatch(run_batch(stage, out)).option("checkpointLocation", checkpoint).queryName(stage.name)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def progress(query: StreamingQuery) -> dict:
    """Rows so far and rows a second of a running stage."""
    last = query.lastProgress
    return {"stage": query.name, "rows": last["numInputRows"], "rate": last.get("processedRowsPerSecond")} if last else {"stage": query.name, "rows": 0, "rate": None}


def windowed_counts(events: DataFrame, ts: str = "ts", late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Events per window of a stream, late ones within a bound included (A23 on a stream)."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, width).alias("w"), "event_type").agg(F.count("*").alias("n"))


def deduplicated(events: DataFrame, key: str, ts: str = "ts", late: str = "10 minutes") -> DataFrame:
    """A stream without repeated keys inside the watermark."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def shared_folder(spark: SparkSession) -> str:
    """A new path in the folder that spark.checkpoint.dir names; only in local mode, and only where that is unset, in a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="loomspark-stream-")
    return f"{named.rstrip('/')}/stream-{uuid.uuid4().hex}"


def drained(frame: DataFrame, mode: str = "append") -> DataFrame:
    """The result of a stream over what is there now, as a table in the shared folder; no row passes through the driver.

    In mode complete a batch holds all of the result and the last one stays; else each batch adds a folder of its own.
    """
    spark = frame.sparkSession
    folder = shared_folder(spark)
    spark.createDataFrame([], frame.schema).write.parquet(f"{folder}/rows/epoch=-1")  # there if no batch comes

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/rows/epoch={0 if mode == 'complete' else epoch}")

    q = frame.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    try:
        q.awaitTermination()
    finally:
        q.stop()
    return spark.read.schema(frame.schema).parquet(f"{folder}/rows").select(*frame.columns)
