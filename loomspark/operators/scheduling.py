"""What the schedulers of the corpus decide, as expressions and joins: order, delays, profiles, task states, configuration."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dispatch_key(id_: Column, seed: str = "0") -> Column:
    """A key to order work by: as good as shuffled, and the same in every run of a seed."""
    return F.md5(F.concat(F.lit(f"{seed}:"), id_))


#: Megabytes from which on a file waits, and the shortest and longest wait in seconds. Fixed values.
WAITS = ((500, 20, 60), (200, 15, 40), (50, 5, 15), (0, 1, 4))


def jitter(size: Column, id_: Column) -> Column:
    """Seconds that a task waits before it loads its file, more for large files (T29); 1 to 3 where the size is unknown.

    Where in the range is told by a digest of the id, so that a run can be repeated.
    """
    part = F.conv(F.left(F.md5(id_), F.lit(8)), 16, 10).cast("double") / float(1 << 32)
    out = F.lit(1.0) + 2.0 * part
    for least, low, high in reversed(WAITS):
        more = (size > least * (1 << 20)) if least else size.isNotNull()
        out = F.when(more, low + (high - low) * part).otherwise(out)
    return out


def profile_of(device: Column, profiles: Sequence[tuple[str, str]]) -> Column:
    """The name of the first profile (name, match) whose match is part of the device's name, whatever its case; null if none is."""
    out = F.lit(None).cast("string")
    for name, match in reversed(profiles):
        out = F.when(F.contains(F.lower(device), F.lit(match.lower())), name).otherwise(out)
    return out


def ledger_step(tasks: DataFrame, results: DataFrame) -> DataFrame:
    """tasks (audio_path, duration, state, error) after a round of results (audio_path, error): complete or failed; tasks without a result stay."""
    told = results.select("audio_path", F.coalesce("error", F.lit("")).alias("_e"))
    out = tasks.drop("error").join(told, "audio_path", "left")
    state = F.when(F.col("_e").isNull(), F.col("state")).when(F.col("_e") == "", "complete").otherwise("failed")
    return out.select("audio_path", "duration", state.alias("state"), F.when(F.col("_e") != "", F.col("_e")).alias("error"))


def ledger_totals(tasks: DataFrame) -> DataFrame:
    """Tasks and hours of each state."""
    return tasks.groupBy("state").agg(F.count("*").alias("n"), (F.coalesce(F.sum("duration"), F.lit(0.0)) / 3600).alias("hours"))


def run_tasks(tasks: DataFrame, make: Callable[[], Callable[[str], object]], key: str = "audio_path") -> DataFrame:
    """key, pipeline_status and error_msg of each task, worked on by what make() gives in each Python worker.

    A task that fails is a FAILURE with its message and stops nothing. If make() itself fails, all tasks of
    that worker are FAILURE_INIT. Tasks without a key are left out.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            work, broken = make(), None
        except Exception as e:
            work, broken = None, str(e)
        for pdf in frames:
            out = []
            for k in pdf[key]:
                status, message = ("FAILURE_INIT", broken) if work is None else ("SUCCESS", None)
                if work is not None:
                    try:
                        work(k)
                    except Exception as e:
                        status, message = "FAILURE", str(e)
                out.append((k, status, message))
            yield pd.DataFrame(out, columns=[key, "pipeline_status", "error_msg"])

    return tasks.where(F.col(key).isNotNull()).select(key).mapInPandas(run, f"{key} string, pipeline_status string, error_msg string")


#: Thresholds of a configuration: section, name in it, name of the parameter, default. Fixed values.
PARAMETERS = (
    ("entrypoint", "SAMPLE_RATE", "target_sample_rate", 24000), ("standardization", "ffmpeg_timeout", "ffmpeg_timeout", 200), ("standardization", "target_dbfs", "target_dbfs", -20.0),
    ("embedding_refinement", "enable", "refinement", True), ("strategy_parameters", "inter_similarity_threshold", "inter_similarity_threshold", 0.7),
    ("strategy_parameters", "merge_gap", "merge_gap", 2.0), ("strategy_parameters", "min_segment_length", "min_segment_length", 3.0),
    ("strategy_parameters", "max_segment_length", "max_segment_length", 30.0), ("strategy_parameters", "intra_similarity_threshold", "intra_similarity_threshold", 0.64),
    ("strategy_parameters", "grace_period_start", "grace_period_start", 0.0), ("strategy_parameters", "grace_period_end", "grace_period_end", 0.02),
    ("strategy_parameters", "foreign_tolerance", "foreign_tolerance", 0.1), ("strategy_parameters", "foreign_relabel_ratio", "foreign_relabel_ratio", 0.8),
    ("strategy_parameters", "strategy", "metrics_strategy", "average"), ("strategy_parameters", "fixed_dnsmos_threshold", "fixed_dnsmos_threshold", 3.0),
    ("strategy_parameters", "fixed_c50_threshold", "fixed_c50_threshold", 40.0), ("strategy_parameters", "fixed_snr_threshold", "fixed_snr_threshold", 40.0),
)


def parameters(config: dict) -> dict[str, object]:
    """The thresholds that an old configuration states, under their names of today, others by default; nothing else is read."""
    return {name: config.get(section, {}).get(key, default) for section, key, name, default in PARAMETERS}


def marked_dropped(rows: DataFrame, survivors: DataFrame, flag: str, key: str = "utt_id") -> DataFrame:
    """rows with a flag that is true where key is not among the survivors."""
    kept = survivors.select(key).distinct().withColumn("_kept", F.lit(True))
    return rows.join(kept, key, "left").withColumn(flag, F.col("_kept").isNull()).drop("_kept")


def file_guard(size: Column, duration: Column, most_bytes: int, most_seconds: float, least_seconds: float) -> Column:
    """Why a file isn't decoded: its size is checked first, then a known duration's upper and lower bound; null if it is."""
    return (
        F.when(size.isNull(), "stat_failed").when(size > most_bytes, "oversized").when(duration > most_seconds, "long").when(duration < least_seconds, "too_short")
    )
