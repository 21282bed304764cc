"""Resume, sync, planning and verification as semi, anti, left and full outer joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomspark.operators.filters import retriable


def covered(manifest: DataFrame, segments: DataFrame) -> DataFrame:
    """Seconds and rows of manifest entries that any segment comes from; repeated entries all count."""
    hit = manifest.join(segments.select(F.col("source").alias("relative_path")).distinct(), "relative_path", "left_semi")
    return hit.agg(F.coalesce(F.sum("duration"), F.lit(0.0)).alias("seconds"), F.count("*").alias("matched"))


def not_done(work: DataFrame, done: DataFrame, key: str, done_key: str | None = None) -> DataFrame:
    """Work without a row in done."""
    return work.join(done.select(F.col(done_key or key).alias(key)).distinct(), key, "left_anti")


def finished_sources(stage2: DataFrame) -> DataFrame:
    """Sources with at least one row that is not to be tried again."""
    return stage2.groupBy("source").agg(F.bool_or(~retriable()).alias("done")).where("done").select("source")


def pending_sources(stage2: DataFrame) -> DataFrame:
    """Sources of which all rows are to be tried again."""
    return stage2.groupBy("source").agg(F.bool_and(retriable()).alias("pending")).where("pending").select("source")


def with_recorded(sample: DataFrame, recorded: DataFrame, columns: list[str]) -> DataFrame:
    """sample with columns of the first recorded row of each utt_id."""
    first = F.min_by(F.struct(*columns), F.struct("shard", "pos"))
    return sample.join(recorded.groupBy("utt_id").agg(first.alias("r")), "utt_id", "left").select(*sample.columns, "r.*")


def synced(ledger: DataFrame, source: DataFrame) -> DataFrame:
    """ledger plus the source's unseen audio paths, as work to do."""
    new = source.join(ledger.select("audio_path"), "audio_path", "left_anti").withColumn("state", F.lit("todo"))
    return ledger.unionByName(new, allowMissingColumns=True)


def to_copy(src: DataFrame, state: DataFrame, tolerance: float = 2.0) -> DataFrame:
    """Files whose state (size, and time within a tolerance) is not recorded."""
    s = state.select("relative_path", F.col("file_size").alias("s_size"), F.col("mtime").alias("s_mtime"))
    same = (F.col("file_size") == F.col("s_size")) & (F.abs(F.col("mtime") - F.col("s_mtime")) <= tolerance)
    return src.join(s, (src.relative_path == s.relative_path) & same, "left_anti")


def compare_trees(src: DataFrame, dst: DataFrame, tolerance: float = 2.0) -> DataFrame:
    """relative_path and what is wrong with the copy: missing, size, mtime, md5 or extra."""
    c = F.col
    both = src.alias("a").join(dst.alias("b"), "relative_path", "full_outer")
    wrong = (
        F.when(c("b.file_size").isNull(), "missing").when(c("a.file_size").isNull(), "extra").when(c("a.file_size") != c("b.file_size"), "size")
        .when(F.abs(c("a.mtime") - c("b.mtime")) > tolerance, "mtime").when(c("a.md5") != c("b.md5"), "md5")
    )
    return both.select("relative_path", wrong.alias("problem")).where("problem is not null")


def with_domains(segments: DataFrame, speakers: DataFrame, files: DataFrame) -> DataFrame:
    """Segments with labels of their speaker and of their file (J17); which side is sent around is left to the sizes at run time."""
    return segments.join(speakers, ["chunk_audio_path", "speaker_id"], "left").join(files, "chunk_audio_path", "left")


def score_distinct(df: DataFrame, column: str, score) -> DataFrame:
    """df with score(frame of distinct texts) joined back: each text is scored once."""
    return df.join(score(df.select(column).distinct()), column, "left")


def requeued(tasks: DataFrame) -> DataFrame:
    """What a restart makes of task states: begun and failed tasks are to do."""
    return tasks.withColumn("state", F.when(F.col("state").isin("processing", "failed"), "todo").otherwise(F.col("state")))


def write_back(chunks: DataFrame, results: DataFrame, fields: list[str]) -> DataFrame:
    """chunks (chunk_audio_path, sentences) with fields of results merged into each sentence by utt_id."""
    one = chunks.select("chunk_audio_path", F.posexplode("sentences").alias("at", "s")).select("chunk_audio_path", "at", "s.*")
    one = one.join(results.select("utt_id", *fields), "utt_id", "left")
    rest = [c for c in one.columns if c not in ("chunk_audio_path", "at")]
    listed = F.array_sort(F.collect_list(F.struct("at", *rest)))
    return one.groupBy("chunk_audio_path").agg(F.transform(listed, lambda x: F.struct(*(x[c].alias(c) for c in rest))).alias("sentences"))


def first_wins(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    n = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_n", n).where("_n = 1").drop("_n")


def schema_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """name, type_a and type_b of columns that two runs don't share or type differently; no row if the schemas agree."""
    left, right = dict(a.dtypes), dict(b.dtypes)
    names = [n for n in left | right if left.get(n) != right.get(n)]
    return a.sparkSession.createDataFrame([(n, left.get(n), right.get(n)) for n in names], "name string, type_a string, type_b string")
