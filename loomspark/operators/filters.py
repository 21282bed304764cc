"""Row predicates and drop flags. A score below 0 means it was not computed and never drops a row; a threshold of None scores without filtering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspark.functions import text as T
from loomspark.schemas import FLAGS

#: Thresholds by language: most word (character) errors, speaking rate, alignment, perplexity, spelling, silences.
PROFILES = {
    "zh": (0.15, 2, 10, 0.55, 800, 0.30, 1), "en": (0.18, 2, 20, 0.65, 800, 0.65, 1), "ja": (0.40, 2, 10, 0.55, 1000, 0.30, 1), "ko": (0.40, 2, 10, 0.55, 1200, 0.30, 2),
    "fr": (0.50, 4, 16, 0.60, 1200, 0.55, 1), "de": (0.50, 4, 16, 0.60, 1400, 0.55, 1), "ru": (0.50, 4, 16, 0.55, 1000, 0.40, 2), "vi": (0.50, 2, 10, 0.55, 1200, 0.30, 2),
}


def valid() -> Column:
    return ~T.has_error(F.col("error"))


def flag(name: str) -> Column:
    """A drop flag, null being false."""
    return F.coalesce(F.col(name), F.lit(False))


def kept() -> Column:
    """No error and no drop flag."""
    out = valid()
    for f in FLAGS:
        out = out & ~flag(f)
    return out


def retriable() -> Column:
    """Errors of a remote service, which are tried again (P5)."""
    return F.coalesce(F.contains("error", F.lit(T.RETRIABLE)), F.lit(False))


def outside(value: Column, least: float | None = None, most: float | None = None) -> Column:
    """Whether a computed score (0 or more) lies outside its bounds."""
    out = F.lit(False)
    if least is not None:
        out = out | (value < least)
    if most is not None:
        out = out | (value > most)
    return F.coalesce((value >= 0) & out, F.lit(False))


def text_quality_reason(ppl: float | None = None, spell: float | None = None, llm: float | None = None, semantic: float | None = None, tts: float | None = None) -> Column:
    """The first threshold that a row fails, in the order ppl, spell, llm, semantic, tts; null if it fails none."""
    out = F.lit(None).cast("string")
    for name, least in reversed((("spell", spell), ("llm", llm), ("semantic", semantic), ("tts", tts))):
        if least is not None:
            out = F.when(outside(F.col(name), least=least), name).otherwise(out)
    return F.when(outside(F.col("ppl"), most=ppl), "ppl").otherwise(out) if ppl is not None else out


def good_metrics(df: DataFrame, dnsmos: float, c50: float, snr: float) -> DataFrame:
    """Rows at or above three fixed bounds (P10)."""
    return df.where((F.col("dnsmos") >= dnsmos) & (F.col("c50") >= c50) & (F.col("snr") >= snr))


def above_average(df: DataFrame) -> DataFrame:
    """Rows at or above their chunk's mean dnsmos."""
    mean = F.avg("dnsmos").over(Window.partitionBy("chunk_audio_path"))
    return df.withColumn("mean", mean).where("dnsmos >= mean").drop("mean")


def duration_per_char(df: DataFrame, least: float = 3.0, most: float = 30.0, chars: int = 2, by: str = "chunk_audio_path") -> DataFrame:
    """Rows with a keep column: duration and characters in bounds, and seconds a character inside the file's fence.

    The fence is p10 - 1.5 iqr to p90 + 1.5 iqr, iqr being p90 - p10, over rows with characters; without any, 0 to no bound.
    """
    ratio = F.when(F.col("n_chars") > 0, F.col("seg_duration") / F.col("n_chars"))
    marks = df.groupBy(by).agg(F.percentile(ratio, F.array(F.lit(0.1), F.lit(0.9))).alias("p"))
    p10, p90 = F.get("p", F.lit(0)), F.get("p", F.lit(1))
    low, high = F.coalesce(p10 - 1.5 * (p90 - p10), F.lit(0.0)), F.coalesce(p90 + 1.5 * (p90 - p10), F.lit(float("inf")))
    marks = marks.select(by, low.alias("low"), high.alias("high"))
    value = F.coalesce(ratio, F.lit(0.0))
    keep = F.col("seg_duration").between(least, most) & (F.col("n_chars") >= chars) & value.between(F.col("low"), F.col("high"))
    return df.join(marks, by).withColumn("keep", keep).drop("low", "high")


def language_fits(detected: Column, target: str) -> Column:
    """Unknown languages pass."""
    return detected.isNull() | detected.isin("unknown", target)


def validate(df: DataFrame, most: float, ref: str = "text", hyp: str = "asr_val_text") -> DataFrame:
    """asr_wer (characters for zh, ja, ko, else words) and dropped_by_asr_validation; a chunk whose numbers of texts differ fails as a whole."""
    norm = {"_rc": T.normal_for_cer(F.col(ref)), "_hc": T.normal_for_cer(F.col(hyp)), "_rw": T.normal_for_wer(F.col(ref)), "_hw": T.normal_for_wer(F.col(hyp))}
    df = df.withColumns(norm)
    by_char = F.coalesce(F.col("language").isin(*T.CJK), F.lit(False))
    score = F.when(by_char, T.cer(F.col("_rc"), F.col("_hc"))).otherwise(T.wer(F.col("_rw"), F.col("_hw")))
    chunk = Window.partitionBy("chunk_audio_path")
    uneven = F.count(ref).over(chunk) != F.count(hyp).over(chunk)
    return df.withColumn("asr_wer", score).withColumn("dropped_by_asr_validation", uneven | (F.col("asr_wer") > most)).drop(*norm)


def cascade(df: DataFrame, rate: tuple[float, float] | None, silences: int | None, alignment: float | None, ppl: float | None) -> DataFrame:
    """Drop flags in order: only rows that every earlier step left are tested (P15, P16); rows of an error are none's."""
    alive = valid() & ~flag("dropped_by_asr_validation") if "dropped_by_asr_validation" in df.columns else valid()
    steps = (
        ("dropped_by_speaking_rate", outside(F.col("speaking_rate"), *rate) if rate else F.lit(False)),
        ("dropped_by_silence", outside(F.col("silences"), most=silences)),
        ("dropped_by_alignment", outside(F.col("alignment_score"), least=alignment)),
        ("dropped_by_text_quality", outside(F.col("ppl"), most=ppl)),
    )
    for name, bad in steps:
        df = df.withColumn(name, alive & bad)
        alive = alive & ~F.col(name)
    return df if "dropped_by_asr_validation" in df.columns else df.withColumn("dropped_by_asr_validation", F.lit(False))


def cascade_by_language(df: DataFrame) -> DataFrame:
    """cascade() with the calibrated thresholds of each row's language; languages without a profile are not filtered."""
    rows = [(k, *map(float, v)) for k, v in PROFILES.items()]
    profiles = df.sparkSession.createDataFrame(rows, "language string, p_wer double, p_low double, p_high double, p_align double, p_ppl double, p_spell double, p_sil double")
    df = df.join(F.broadcast(profiles), "language", "left")  # eight rows
    alive = valid()
    c = F.col
    steps = (
        ("dropped_by_speaking_rate", (c("speaking_rate") >= 0) & ((c("speaking_rate") < c("p_low")) | (c("speaking_rate") > c("p_high")))),
        ("dropped_by_silence", (c("silences") >= 0) & (c("silences") > c("p_sil"))),
        ("dropped_by_alignment", (c("alignment_score") >= 0) & (c("alignment_score") < c("p_align"))),
        ("dropped_by_text_quality", (c("ppl") >= 0) & (c("ppl") > c("p_ppl"))),
    )
    for name, bad in steps:
        df = df.withColumn(name, alive & F.coalesce(bad, F.lit(False)))
        alive = alive & ~c(name)
    return df.withColumn("dropped_by_asr_validation", F.lit(False)).drop("p_wer", "p_low", "p_high", "p_align", "p_ppl", "p_spell", "p_sil")


def admission(duration: Column, least: float = 10, most: float = 10800) -> Column:
    """What a batch scheduler does with a file of a duration (P20)."""
    return F.when(duration < least, "skip").when(duration > most, "failed").otherwise("admit")


def audio_problem(size: Column, duration: Column) -> Column:
    """Why an audio file is invalid, null if it is not."""
    return (
        F.when(size < 1024, "too_small").when(duration.isNull() | (duration <= 0), "undecodable").when(duration > 86400, "too_long")
    )


def speech_language_ok(language: Column, prob: Column, supported: list[str], least: float = 0.8) -> Column:
    """P21."""
    return language.isin(*supported) & (prob > least)


def one_speaker(answer: Column) -> Column:
    """A veto on segments in which a model hears more than one speaker; no answer keeps them."""
    return ~F.coalesce(F.contains(answer, F.lit("是")), F.lit(False))


def measured(value: Column) -> Column:
    """Values of a scorer without its failure mark."""
    return value > -100


def has_any(*columns: str) -> Column:
    """Records that hold at least one of some fields."""
    return F.coalesce(*(F.col(c).cast("string") for c in columns)).isNotNull()


def finite(value: Column) -> Column:
    """P26."""
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))


def whole_files(rows: DataFrame, failed: str = "failed", by: str = "source") -> DataFrame:
    """Files fail as one: if a chunk failed, one error row stands for all rows of the file."""
    bad = F.bool_or(failed).over(Window.partitionBy(by))
    n = F.row_number().over(Window.partitionBy(by).orderBy(F.col(failed).desc(), "chunk_index", "pos"))
    out = rows.withColumn("_bad", bad).withColumn("_n", n).where("not _bad or _n = 1")
    others = [c for c in rows.columns if c not in (by, "shard", failed, "error")]
    out = out.withColumns({c: F.when(~F.col("_bad"), F.col(c)) for c in others})
    return out.withColumn("error", F.when(F.col("_bad"), F.coalesce("error", F.lit("chunk failed")))).drop("_bad", "_n")


def scored_or_failed(df: DataFrame) -> DataFrame:
    """Rows that a scorer could measure; a chunk all of whose rows failed is one error row."""
    ok = (F.col("seg_end") > F.col("seg_start")) & ~F.coalesce(F.col("score_error") != "", F.lit(False))
    some = F.bool_or(ok).over(Window.partitionBy("chunk_audio_path"))
    first = F.row_number().over(Window.partitionBy("chunk_audio_path").orderBy("pos")) == 1
    df = df.withColumn("_ok", ok).withColumn("_some", some).withColumn("_first", first)
    return df.where("_ok or (not _some and _first)").withColumn("error", F.when(~F.col("_some"), "no_scores")).drop("_ok", "_some", "_first")


def placeholder(score: Column, threshold: float) -> tuple[Column, Column]:
    """The threshold where a scorer is off, and whether it is one (X11)."""
    return F.coalesce(score, F.lit(threshold)), score.isNull()
