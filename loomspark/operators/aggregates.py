"""Aggregations of yields, durations, re-checks and runs. Everything is a partial and final aggregation; nothing is capped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspark.functions import text as T
from loomspark.operators.filters import finite, flag, kept, measured, retriable
from loomspark.schemas import REASONS


def seconds_where(mask: Column, value: str = "seg_duration") -> Column:
    """Sum of a column over rows of a mask, null being 0 (A1)."""
    return F.coalesce(F.sum(F.when(mask, F.coalesce(F.col(value), F.lit(0.0)))), F.lit(0.0))


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int, by: tuple[str, ...] = ()) -> DataFrame:
    """bin (-1 below, bins above) and n per group (A2); histograms of parts merge by adding n."""
    x = F.col(value)
    at = F.when(x < low, -1).when(x > high, bins).otherwise(F.least(F.floor((x - low) / (high - low) * bins), F.lit(bins - 1))).cast("int")
    return df.where(x.isNotNull()).groupBy(*by, at.alias("bin")).agg(F.count("*").alias("n"), F.min(x).alias("least"), F.max(x).alias("most"))


def histogram_percentile(hist: DataFrame, low: float, high: float, bins: int, q: float, by: tuple[str, ...] = ()) -> DataFrame:
    """The q-th per cent of a histogram, interpolated inside its bin; the least value at or below the range, the most above it (A3)."""
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    running = F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    df = hist.withColumn("cum", running).withColumn("total", F.sum("n").over(group)).withColumn("least", F.min("least").over(group)).withColumn("most", F.max("most").over(group))
    df = df.withColumn("target", F.lit(q / 100) * F.col("total")).where("cum >= target and n > 0")
    df = df.withColumn("k", F.row_number().over(group.orderBy("bin"))).where("k = 1")
    width = (high - low) / bins
    inside = low + (F.col("bin") + (F.col("target") - (F.col("cum") - F.col("n"))) / F.col("n")) * width
    return df.select(*by, F.when(F.col("bin") < 0, F.col("least")).when(F.col("bin") >= bins, F.col("most")).otherwise(inside).alias("value"))


def percent(a: Column, b: Column) -> Column:
    return F.try_divide(a * 100.0, b)


def raw_level(manifest: DataFrame) -> DataFrame:
    """Files and seconds of a manifest; unknown durations are counted and add no seconds (A5)."""
    known = F.coalesce(F.col("duration") > 0, F.lit(False))
    return manifest.agg(F.count("*").alias("files"), seconds_where(known, "duration").alias("seconds"), F.count_if(~known).alias("unknown"))


def stage1_level(segments: DataFrame) -> DataFrame:
    """Distinct sources that gave segments, that failed (a source may do both), distinct chunks, rows and seconds."""
    ok = ~T.has_error(F.col("error"))
    return segments.agg(
        F.count_distinct(F.when(ok, F.col("source"))).alias("ok_files"), F.count_distinct(F.when(~ok, F.col("source"))).alias("failed_files"),
        F.count_distinct(F.when(ok, F.col("chunk_audio_path"))).alias("chunks"), F.count_if(ok).alias("segments"), seconds_where(ok).alias("seconds"),
    )


def yield_funnel(stage2: DataFrame, by: str = "shard") -> DataFrame:
    """Rows and seconds per group: all, kept, with errors, to be tried again, and dropped for each reason, which need not exclude one another."""
    err = T.has_error(F.col("error"))
    return stage2.groupBy(by).agg(
        F.count("*").alias("n_rows"), seconds_where(F.lit(True)).alias("seconds"), F.count_if(kept()).alias("kept"), seconds_where(kept()).alias("kept_seconds"),
        F.count_if(err).alias("errors"), F.count_if(retriable()).alias("retriable"),
        *(F.count_if(flag(f"dropped_by_{r}")).alias(f"n_{r}") for r in REASONS), *(seconds_where(flag(f"dropped_by_{r}")).alias(f"s_{r}") for r in REASONS),
        percent(F.count_if(kept()).cast("double"), F.count("*")).alias("kept_pct"),
    )


def funnel_levels(manifest: DataFrame, stage2: DataFrame) -> DataFrame:
    """level, files and seconds of the raw, stage-1 and stage-2 levels, and the part of the level above (A4)."""
    raw = manifest.agg(F.count("*").alias("n"), seconds_where(F.coalesce(F.col("duration") > 0, F.lit(False)), "duration").alias("seconds")).select(F.lit(0).alias("level"), "n", "seconds")
    one = stage2.agg(F.count("*").alias("n"), seconds_where(F.lit(True)).alias("seconds")).select(F.lit(1).alias("level"), "n", "seconds")
    two = stage2.where(kept()).agg(F.count("*").alias("n"), seconds_where(F.lit(True)).alias("seconds")).select(F.lit(2).alias("level"), "n", "seconds")
    above = Window.orderBy("level")  # of three rows
    return raw.union(one).union(two).withColumn("seconds_pct", percent(F.col("seconds"), F.lag("seconds").over(above)))


def reasons_long(funnel: DataFrame, by: str = "shard") -> DataFrame:
    """The funnel's reasons as rows."""
    stack = ", ".join(f"'{r}', n_{r}, s_{r}" for r in REASONS)
    return funnel.select(by, F.expr(f"stack({len(REASONS)}, {stack}) as (reason, n, seconds)"))


def top_errors(df: DataFrame, n: int = 30) -> DataFrame:
    """The most frequent categories of errors, ties by name."""
    return df.where(T.has_error(F.col("error"))).groupBy(T.classify_error(F.col("error")).alias("category")).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "category").limit(n)


def duration_buckets(df: DataFrame, edges=T.COARSE, value: str = "seg_duration") -> DataFrame:
    """Rows, seconds and their parts per bucket of duration."""
    each = df.where(F.col(value).isNotNull()).groupBy(T.bucket(F.col(value), *edges).alias("bucket")).agg(F.count("*").alias("n"), F.sum(value).alias("seconds"))
    whole = Window.partitionBy()  # of a few buckets
    return each.select("bucket", "n", "seconds", percent(F.col("n").cast("double"), F.sum("n").over(whole)).alias("pct"))


def duration_stats(df: DataFrame, low: float = 2.0, high: float = 30.0) -> DataFrame:
    """Per shard and overall (shard null): numbers, seconds, extremes, median and rows out of bounds."""
    d = F.col("seg_duration")
    return df.groupingSets([[F.col("shard")], []], F.col("shard")).agg(
        F.count(d).alias("n"), F.sum(d).alias("seconds"), F.min(d).alias("least"), F.max(d).alias("most"), F.median(d).alias("median"),
        F.count_if(d < low).alias("below"), F.count_if(d > high).alias("above"),
    )


def language_seconds(df: DataFrame) -> DataFrame:
    """Rows and seconds by language, null and empty being unknown (A10)."""
    lang = F.when(F.coalesce("language", F.lit("")) == "", "unknown").otherwise(F.col("language"))
    return df.groupBy(lang.alias("language")).agg(F.count("*").alias("n"), F.sum("seg_duration").alias("seconds"))


def mergeability(pairs: DataFrame) -> DataFrame:
    """Pairs, zero gaps, gap and pair seconds per category."""
    return pairs.groupBy("category").agg(F.count("*").alias("n"), F.count_if(F.col("gap") == 0).alias("zero_gaps"), F.sum("gap").alias("gap_seconds"), F.sum("pair_duration").alias("pair_seconds"))


def chunk_sizes(segments: DataFrame) -> DataFrame:
    """Chunks, and those with one segment only."""
    return segments.groupBy("chunk_audio_path").agg(F.count("*").alias("n")).agg(F.count("*").alias("chunks"), F.count_if(F.col("n") == 1).alias("single"))


LENGTH_BANDS = ([2.0, 4.0, 8.0], ["<2", "2-4", "4-8", ">=8"])


def confusion(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """Agreement of two tests per band of length and overall (band null)."""
    rows = df.select(T.bucket(F.col("seg_duration"), *LENGTH_BANDS).alias("band"), a.alias("a"), b.alias("b"))
    cell = lambda x, y: F.count_if((F.col("a") if x else ~F.col("a")) & (F.col("b") if y else ~F.col("b")))
    return rows.groupingSets([[F.col("band")], []], F.col("band")).agg(cell(1, 1).alias("both"), cell(1, 0).alias("only_a"), cell(0, 1).alias("only_b"), cell(0, 0).alias("neither"))


def speaker_recheck(verdicts: DataFrame, least: float = 0.68) -> DataFrame:
    """Segments that sound like several speakers by embedding, by diarization, by either, and mean drift of the similarity."""
    emb = F.coalesce(F.col("emb_min_similarity") < least, F.lit(False))
    dia = F.coalesce(F.col("dia_n_speakers") > 1, F.lit(False))
    seen = F.coalesce(F.col("emb_min_similarity").cast("string"), F.col("dia_n_speakers").cast("string")).isNotNull()
    return verdicts.where(seen).agg(
        F.count("*").alias("n"), F.count_if(emb).alias("by_embedding"), F.count_if(dia).alias("by_diarization"), F.count_if(emb | dia).alias("by_either"),
        seconds_where(emb | dia).alias("seconds"), F.avg(F.col("emb_min_similarity") - F.col("rec_min_similarity")).alias("drift"),
    )


def background_grades(df: DataFrame, good: float = 3.0, fair: float = 2.0) -> DataFrame:
    """Rows per band of length and grade of the background score."""
    grade = F.when(F.col("bak") >= good, "clean").when(F.col("bak") >= fair, "mild").otherwise("clear")
    return df.where(F.col("bak").isNotNull()).groupBy(T.bucket(F.col("seg_duration"), *LENGTH_BANDS).alias("band"), grade.alias("grade")).agg(F.count("*").alias("n"), F.sum("seg_duration").alias("seconds"))


def anomalies(df: DataFrame, kind: Column, example: Column, n: int = 3) -> DataFrame:
    """Occurrences per kind, and the least few examples of 200 characters; no kind's examples are ever all gathered."""
    rows = df.select(kind.alias("kind"), F.left(example, F.lit(200)).alias("example")).where("kind is not null")
    counts = rows.groupBy("kind").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("kind").orderBy("example"))
    some = rows.groupBy("kind", "example").agg(F.lit(1)).withColumn("k", place).where(F.col("k") <= n).groupBy("kind").agg(F.array_sort(F.collect_list("example")).alias("e"))
    return counts.join(some, "kind", "left").select("kind", "n", F.array_join("e", " | ").alias("examples"))


def snapshot(manifest: DataFrame, segments: DataFrame, stage2: DataFrame) -> DataFrame:
    """One row: progress of stage 1 over the manifest and what stage 2 keeps."""
    total = manifest.agg(F.sum("duration").alias("total_secs"))
    err = T.has_error(F.col("error"))
    done = segments.agg(F.count_distinct(F.when(~err, F.col("source"))).alias("done_files"), F.count_distinct(F.when(err, F.col("source"))).alias("failed_files"), seconds_where(~err).alias("valid_secs"))
    two = stage2.agg(F.count("*").alias("stage2_rows"), seconds_where(kept()).alias("kept_secs"))
    return total.join(done, how="cross").join(two, how="cross").withColumn("yield_pct", percent(F.col("kept_secs"), F.col("valid_secs")))


def run_summary(df: DataFrame, by: str = "tree") -> DataFrame:
    """Per run: segments, chunks, retained seconds, extremes and medians; failure marks of scorers are left out."""
    mid = lambda c: F.median(F.when(measured(F.col(c)), F.col(c)))
    return df.groupBy(by).agg(
        F.count("*").alias("n"), F.count_distinct("chunk_audio_path").alias("chunks"), F.count_distinct("speaker_id").alias("speakers"), F.sum("seg_duration").alias("seconds"),
        F.median("seg_duration").alias("median"), F.min("seg_duration").alias("least"), F.max("seg_duration").alias("most"),
        mid("dnsmos").alias("dnsmos"), mid("c50").alias("c50"), mid("snr").alias("snr"),
    )


def speaker_seconds(df: DataFrame) -> DataFrame:
    return df.groupBy("chunk_audio_path", "speaker_id").agg(F.count("*").alias("n"), F.sum("seg_duration").alias("seconds"))


def stage_times(events: DataFrame, audio_seconds: float) -> DataFrame:
    """Total milliseconds of each stage of a log, and how many times faster than the audio it ran."""
    return events.groupBy("name").agg(F.count("*").alias("n"), F.sum("value").alias("total_ms")).withColumn("speed", F.try_divide(F.lit(audio_seconds * 1000), F.col("total_ms")))


def discarded(df: DataFrame) -> DataFrame:
    """Rows and seconds that each filter discards, and their part of all rows."""
    each = [F.struct(F.lit(r).alias("step"), flag(f"dropped_by_{r}").alias("hit")) for r in REASONS]
    rows = df.select("seg_duration", F.explode(F.array(*each)).alias("x"))
    out = rows.groupBy("x.step").agg(F.count("*").alias("all"), F.count_if("x.hit").alias("n"), seconds_where(F.col("x.hit")).alias("seconds"))
    return out.select("step", "n", "seconds", percent(F.col("n").cast("double"), F.col("all")).alias("pct"))


def file_totals(manifest: DataFrame, problem: Column) -> DataFrame:
    """Valid and invalid files and whole seconds of the valid ones."""
    return manifest.agg(F.count_if(problem.isNull()).alias("valid"), F.count_if(problem.isNotNull()).alias("invalid"), F.coalesce(F.sum(F.when(problem.isNull(), F.floor("duration"))), F.lit(0)).cast("long").alias("seconds"))


def daily(df: DataFrame, ts: str, value: str, start_hour: int = 10) -> DataFrame:
    """Totals of days that begin at an hour."""
    day = F.window(ts, "1 day", startTime=f"{start_hour} hours")
    return df.groupBy(day.alias("w")).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("day_start"), "n", "total")


def tag_counts(df: DataFrame, tags: str) -> DataFrame:
    """Rows and part of all rows that carry each tag."""
    n = df.agg(F.count("*").alias("all"))
    each = df.select(F.explode(F.array_distinct(tags)).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))
    return each.join(n, how="cross").select("tag", "n", percent(F.col("n").cast("double"), F.col("all")).alias("pct"))


def longest_per_speaker(segments: DataFrame) -> DataFrame:
    """The longest segment of each speaker of a chunk, the first on a tie."""
    best = F.max_by(F.struct("utt_id", "seg_duration"), F.struct("seg_duration", -F.col("pos")))
    return segments.groupBy("chunk_audio_path", "speaker_id").agg(best.alias("b")).select("chunk_audio_path", "speaker_id", "b.*")


def class_transcript(segments: DataFrame, n: int = 25) -> DataFrame:
    """The first texts of each chunk joined by blanks (A26); only n texts of a chunk ever meet."""
    place = F.row_number().over(Window.partitionBy("chunk_audio_path").orderBy("pos"))
    first = segments.withColumn("k", place).where(F.col("k") <= n).groupBy("chunk_audio_path").agg(F.array_sort(F.collect_list(F.struct("k", "text"))).alias("t"))
    return first.select("chunk_audio_path", F.array_join("t.text", " ").alias("transcript"))


def alignment_score(words: DataFrame) -> DataFrame:
    """Mean score of a segment's words, inside 0 to 1; -1 without any."""
    mean = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.avg("score")))
    return words.groupBy("utt_id").agg(F.coalesce(mean, F.lit(-1.0)).alias("alignment_score"))


DNSMOS_POLYNOMIALS = {"sig": (-0.08397278, 1.22083953, 0.0052439), "bak": (-0.13166888, 1.60915514, -0.39604546), "ovrl": (-0.06766283, 1.11546468, 0.04602535)}


def polynomial(x: Column, coefficients: tuple[float, ...]) -> Column:
    out = F.lit(0.0)
    for c in coefficients:
        out = out * x + F.lit(c)
    return out


def dnsmos(hops: DataFrame) -> DataFrame:
    """Mean over hops of raw scores sig, bak and ovrl, each mapped by its polynomial."""
    return hops.groupBy("utt_id").agg(*(F.avg(polynomial(F.col(k), p)).alias(k) for k, p in DNSMOS_POLYNOMIALS.items()))


def throughput(completions: DataFrame, n: int = 8) -> DataFrame:
    """Audio per wall second over each worker's last n completions."""
    w = Window.partitionBy("worker").orderBy("ts", "task").rowsBetween(-(n - 1), 0)
    return completions.withColumn("rtf", F.try_divide(F.sum("audio").over(w), F.sum("wall").over(w)))


def slow_workers(latest: DataFrame, factor: float = 10.0, peers: int = 3) -> DataFrame:
    """worker, rtf and whether it is slower than the median by a factor, with enough peers."""
    mid = latest.agg(F.median("rtf").alias("median"), F.count("*").alias("n"))
    return latest.join(mid, how="cross").select("worker", "rtf", ((F.col("n") >= peers) & (F.col("rtf") * factor < F.col("median"))).alias("slow"))


def slow_alerts(checks: DataFrame, cooldown: float = 600.0) -> DataFrame:
    """Checks at which an alert goes out: the second slow one in a row, and not within a cooldown of the last alert."""
    before = F.coalesce(F.lag("slow").over(Window.partitionBy("worker").orderBy("ts")), F.lit(False))
    due = checks.withColumn("due", F.col("slow") & before).where("due").groupBy("worker").agg(F.array_sort(F.collect_list("ts")).alias("times"))
    sent = F.aggregate(
        "times", F.array().cast("array<double>"),
        lambda out, t: F.when((F.size(out) == 0) | (t - F.coalesce(F.try_element_at(out, F.lit(-1)), t) >= cooldown), F.array_append(out, t.cast("double"))).otherwise(out),
    )
    return due.select("worker", F.explode(sent).alias("ts"))


def rate_of_progress(history: DataFrame, value: str, now: float, window: float, shortest: float = 30.0) -> DataFrame:
    """Progress per second between the ends of a trailing window; null if it is short or goes down."""
    recent = history.where((F.col("ts") >= now - window) & (F.col("ts") <= now))
    ends = recent.agg(F.min("ts").alias("t0"), F.max("ts").alias("t1"), F.min_by(value, "ts").alias("v0"), F.max_by(value, "ts").alias("v1"))
    ok = (F.col("t1") - F.col("t0") >= shortest) & (F.col("v1") >= F.col("v0"))
    return ends.select(F.when(ok, F.try_divide(F.col("v1") - F.col("v0"), F.col("t1") - F.col("t0"))).alias("rate"), "t1", "v1")


def eta(rate: DataFrame, total: float, now: float, idle: float = 900.0) -> DataFrame:
    """Seconds to go, none if progress is older than idle; and the per cent done."""
    fresh = F.col("t1") >= now - idle
    return rate.select(F.when(fresh & (F.col("rate") > 0), (total - F.col("v1")) / F.col("rate")).alias("eta_s"), percent(F.col("v1"), F.lit(total)).alias("done_pct"), (~fresh).alias("stale"))


def pair_similarity(pairs: DataFrame, least: float = 0.68) -> DataFrame:
    """Pairs that pass, fail and could not be scored."""
    s = F.col("similarity")
    return pairs.agg(F.count_if(s >= least).alias("passed"), F.count_if(s < least).alias("rejected"), F.count_if(s.isNull() | ~finite(s)).alias("failed"))


def extrapolated(part: Column, population: Column, sample: Column) -> Column:
    """A sample's count for its population."""
    return F.try_divide(part * population, sample)
