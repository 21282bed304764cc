"""Reading corpora: listings, manifests, shards, sidecar JSON, verdict and history lines, logs, and a SQL view over parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loomspark import schemas
from loomspark.functions import text as T

AUDIO = ("mp3", "wav", "flac", "m4a", "aac", "ogg", "opus", "wma")
WEB_AUDIO = ("mp3", "wav", "flac", "m4a", "aac", "mp4", "ogg", "webm")
SIDECAR = (
    "file_name string, source string, pipeline_version string, chunk_index int, audio_path string, sample_rate int, duration double, "
    "sentences array<struct<utt_id:string,speaker_id:string,speaker_min_similarity:double,text:string,language:string,"
    "time_range:struct<duration:double,start:double,end:double>,audio_quality_info:struct<dnsmos:double,c50:double,snr:double>>>"
)
V1_FILE = (
    "pipeline_version string, origin struct<raw_audio_path:string,sample_rate:string,duration:string>, sentences array<struct<"
    "speaker_id:string,language:string,time_range:struct<start:string,end:string,duration:string>,transcription_info:struct<transcript:string>>>"
)


def hidden(name: Column) -> Column:
    """Names that scans pass over: they begin with a dot or hold .temp."""
    return name.startswith(".") | F.contains(name, F.lit(".temp"))


def visible_paths(paths: DataFrame, extensions: Sequence[str] | None = None, path: str = "relative_path") -> DataFrame:
    """Rows whose path has no hidden component and, if asked for, one of the extensions."""
    parts = F.split(path, "/")
    keep = ~F.exists(parts, hidden)
    return paths.where(keep & T.extension(F.col(path)).isin(*extensions) if extensions else keep)


def files(spark: SparkSession, root: str, extensions: Sequence[str] | None = None) -> DataFrame:
    """relative_path, file_size and modified of all files below a folder; contents aren't read."""
    base = root.rstrip("/") + "/"
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length", "modificationTime")
    at = F.locate(base.removeprefix("file:"), F.col("path"))
    relative = F.when(at > 0, F.expr(f"substring(path, {len(base.removeprefix('file:'))} + locate('{base.removeprefix('file:')}', path))")).otherwise(F.col("path"))
    out = listed.select(relative.alias("relative_path"), F.col("length").alias("file_size"), F.col("modificationTime").alias("modified"))
    return visible_paths(out, extensions)


def top_names(paths: DataFrame, path: str = "relative_path") -> DataFrame:
    """First-level names of a listing."""
    name = F.split_part(path, F.lit("/"), F.lit(1)).alias("name")
    return paths.select(name).where(~hidden(F.col("name")) & (F.col("name") != "")).distinct()


def unprocessed(paths: DataFrame, path: str = "relative_path") -> DataFrame:
    """Audio files of the first pipeline version: no _processed folder, no .temp, eight extensions as written."""
    name = F.col(path)
    return paths.where(~F.contains(name, F.lit("_processed")) & ~F.contains(name, F.lit(".temp")) & name.rlike(rf"\.({'|'.join(AUDIO)})$"))


def expanded(spark: SparkSession, root: str, extensions: Sequence[str] | None = None) -> DataFrame:
    """top and relative_path of all visible files below the first-level names of a folder, listed by tasks."""
    out = files(spark, root, extensions)
    return out.select(F.split_part("relative_path", F.lit("/"), F.lit(1)).alias("top"), "relative_path", "file_size")


def pruned_paths(paths: DataFrame, prune: Sequence[str] = (), extensions: Sequence[str] = WEB_AUDIO, path: str = "relative_path") -> DataFrame:
    """Audio files of a web crawl: no folder of the pruned names, no name that begins with a dot or ~ or holds .temp."""
    parts = F.split(path, "/")
    name = F.element_at(parts, -1)
    inside = F.exists(F.slice(parts, 1, F.size(parts) - 1), lambda d: d.isin(*prune)) if prune else F.lit(False)
    return paths.where(~inside & ~name.rlike(r"^[.~]") & ~F.contains(name, F.lit(".temp")) & T.extension(F.col(path)).isin(*extensions))


def shards(paths: DataFrame, prefix: str, path: str = "relative_path") -> DataFrame:
    """Parts <prefix>_part-NNNNN.parquet of one folder with their numbers, in order."""
    number = F.regexp_extract(F.element_at(F.split(path, "/"), -1), rf"^{prefix}_part-([0-9]+)\.parquet$", 1)
    return paths.withColumn("part", number.try_cast("long")).where("part is not null").orderBy(path)


def part_rows(spark: SparkSession, path: str) -> DataFrame:
    """part and n_rows of each parquet file: no column is read, so the counts come from the footers."""
    return spark.read.option("recursiveFileLookup", "true").parquet(path).groupBy(F.col("_metadata.file_path").alias("part")).agg(F.count("*").alias("n_rows"))


def file_list(spark: SparkSession, path: str, extensions: Sequence[str] = AUDIO) -> DataFrame:
    """Paths in a text file, one a line, with whether each is taken."""
    lines = spark.read.text(path).select(F.trim("value").alias("relative_path")).where("relative_path <> ''")
    return lines.withColumn("taken", T.extension(F.col("relative_path")).isin(*extensions))


def csv_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True)


def parquet_table(spark: SparkSession, path: str, schema: StructType, columns: Sequence[str] | None = None) -> DataFrame:
    """A table whose parts may lack columns: they are null."""
    df = spark.read.schema(schema).parquet(path)
    return df.select(*columns) if columns else df


def bad_parts(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """part and rows of each part file, rows being 0 for one that can't be read: corrupt parts are counted, not only passed over."""
    there = files(spark, path, ["parquet"]).select(F.element_at(F.split("relative_path", "/"), -1).alias("part"))
    read = spark.read.schema(schema).option("ignoreCorruptFiles", "true").parquet(path).select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("part"))
    return there.join(read.groupBy("part").agg(F.count("*").alias("n")), "part", "left").select("part", F.coalesce("n", F.lit(0)).alias("n_rows"))


def shard_status(stage1: DataFrame, stage2: DataFrame) -> DataFrame:
    """shard and whether it has rows of either stage (S13); names that begin with _ aren't shards."""
    has = lambda df, c: df.select("shard").distinct().withColumn(c, F.lit(True))
    both = has(stage1, "a").join(has(stage2, "b"), "shard", "full_outer").where(~F.col("shard").startswith("_"))
    status = F.when(F.col("a") & F.col("b"), "stage1+stage2").when(F.col("a"), "stage1_only").otherwise("stage2_only")
    return both.select("shard", status.alias("status"))


def manifest_parts(paths: DataFrame, path: str = "relative_path") -> DataFrame:
    """Parquet files of a manifest: those named manifest_part-*, or all if none is."""
    name = F.element_at(F.split(path, "/"), -1)
    own = name.rlike(r"^manifest_part-\d+\.parquet$")
    found = paths.where(T.extension(F.col(path)) == "parquet").withColumn("own", own)
    return found.join(found.agg(F.bool_or("own").alias("any_own")), how="cross").where("own or not any_own").drop("own", "any_own")


def safe_path(path: Column) -> Column:
    """path if it stays inside its root: not absolute, no .. that climbs out; else null."""
    parts = F.filter(F.split(path, "/"), lambda p: (p != "") & (p != "."))
    depth = F.aggregate(
        parts, F.struct(F.lit(0).alias("d"), F.lit(0).alias("low")),
        lambda a, p: F.struct((a["d"] + F.when(p == "..", -1).otherwise(1)).alias("d"), F.least(a["low"], a["d"] + F.when(p == "..", -1).otherwise(1)).alias("low")),
        lambda a: a["low"],
    )
    return F.when(~path.startswith("/") & (depth >= 0), path)


def sidecar_path(audio: Column) -> Column:
    """Where the JSON of a chunk's audio is."""
    return F.regexp_replace(F.regexp_replace(audio, r"(^|/)audios/", "$1jsons/"), r"\.wav$", ".json")


def sidecars(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """One row for each sentence of sidecar JSON files (or JSON lines), with the chunk's key."""
    one = spark.read.schema(SIDECAR).json(path, multiLine=not lines).withColumn("s", F.explode("sentences"))
    return one.select(
        F.concat_ws("#", "source", F.col("chunk_index").cast("string")).alias("chunk"), "source", "chunk_index", F.col("audio_path").alias("chunk_audio_path"),
        F.col("duration").alias("chunk_duration"), "s.utt_id", "s.speaker_id", "s.speaker_min_similarity", F.col("s.time_range.start").alias("seg_start"),
        F.col("s.time_range.end").alias("seg_end"), F.col("s.time_range.duration").alias("seg_duration"), "s.audio_quality_info.*",
    )


def v1_files(spark: SparkSession, path: str) -> DataFrame:
    """One row for each sentence of first-version files, whose numbers are strings; an empty file is a list without entries (1.3)."""
    one = spark.read.schema(V1_FILE).json(path, multiLine=True).withColumn("s", F.explode("sentences"))
    number = lambda c: F.col(c).try_cast("double")
    return one.select(
        F.col("origin.raw_audio_path").alias("source"), number("origin.duration").alias("duration"), "s.speaker_id", "s.language",
        number("s.time_range.start").alias("seg_start"), number("s.time_range.end").alias("seg_end"), F.col("s.transcription_info.transcript").alias("text"),
    )


def with_min_duration(manifest: DataFrame, least: float) -> DataFrame:
    """Rows that last long enough; with a bound, those of unknown duration (null or 0) go too."""
    return manifest.where(F.col("duration") >= least) if least > 0 else manifest


def next_stage_input(segments: DataFrame) -> DataFrame:
    """One row for each chunk: its segments in order of start, and their seconds (S18). Rows with an error (other than null) or no path go."""
    ok = segments.where("error is null and coalesce(chunk_audio_path, '') <> ''")
    begin = F.coalesce("seg_start", F.lit(0.0))
    one = F.struct(begin.alias("at"), "pos", "utt_id", "speaker_id", "seg_start", "seg_end")
    return ok.groupBy("chunk_audio_path").agg(
        F.min("shard").alias("shard"), F.array_sort(F.collect_list(one)).alias("payload"), F.sum(F.col("seg_end") - F.col("seg_start")).alias("duration")
    )


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "line")


def log_events(lines: DataFrame, line: str = "line") -> DataFrame:
    """name and value of what log lines report: stage times, chunks done, retained per cent."""
    text = F.col(line)
    timed = F.regexp_extract(text, r"(\w+)_time_cost.*?total_ms[ =:]+([0-9.]+)", 1)
    value = F.regexp_extract(text, r"\w+_time_cost.*?total_ms[ =:]+([0-9.]+)", 1)
    kept = F.regexp_extract(text, r"retain_seg_percent[ =:]+([0-9.]+)", 1)
    name = F.when(timed != "", timed).when(kept != "", F.lit("retain_seg_percent")).when(F.contains(text, F.lit("chunk_done")), F.lit("chunk_done"))
    number = F.when(timed != "", value).when(kept != "", kept).otherwise("1")
    return lines.select(name.alias("name"), number.try_cast("double").alias("value")).where("name is not null")


def json_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Records of JSON lines; torn or oversize lines are dropped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def history(spark: SparkSession, path: str) -> DataFrame:
    return json_lines(spark, path, schemas.HISTORY).orderBy("ts")


def view(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A SQL view over all parquet files below path, columns joined by name."""
    df = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(path)
    df.createOrReplaceTempView(name)
    return df


def podcasts(spark: SparkSession, path: str) -> DataFrame:
    """One row for each entry of JSON lists."""
    return spark.read.schema("audio_path string, audio_duration_second double, relative_path string").json(path, multiLine=True)
