"""Tables of the corpus and their columns. In frames, ``start`` and ``end`` are ``seg_start`` and ``seg_end``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

_KINDS = {"s": StringType(), "d": DoubleType(), "l": LongType(), "i": IntegerType(), "b": BooleanType()}


def _table(columns: str) -> StructType:
    return StructType([StructField(name, _KINDS[kind]) for name, _, kind in (c.partition(":") for c in columns.split())])


TOP = _table("name:s")
PATHS = _table("relative_path:s format:s")
MANIFEST = _table("relative_path:s duration:d file_size:l format:s")
SEGMENTS = _table(
    "utt_id:s source:s shard:s pipeline_version:s chunk_index:i chunk_audio_path:s sample_rate:i chunk_duration:d speaker_id:s "
    "speaker_min_similarity:d start:d end:d seg_duration:d dnsmos:d c50:d snr:d error:s"
)
STAGE2 = _table(
    "utt_id:s source:s origin_source:s shard:s pipeline_version:s chunk_index:i chunk_audio_path:s start:d end:d seg_duration:d speaker_id:s text:s "
    "language:s domain_text:s domain_acoustic:s domain_speaker:s speaking_rate:d alignment_score:d ppl:d llm_text_score:d dropped_by_silence:b "
    "dropped_by_alignment:b dropped_by_text_quality:b dropped_by_speaking_rate:b dropped_by_asr_validation:b asr_wer:d asr_val_text:s error:s"
)
HISTORY = _table("ts:d stage1_done_secs:d stage1_done_files:l stage2_kept_secs:d total_secs:d")
REASONS = ("silence", "alignment", "text_quality", "speaking_rate", "asr_validation")
FLAGS = tuple(f"dropped_by_{r}" for r in REASONS)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The schema's columns in order, each cast; missing ones are null, extra ones go."""
    there = set(df.columns)
    return df.select(*((F.col(f.name) if f.name in there else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields))


def framed(df: DataFrame) -> DataFrame:
    """start and end as seg_start and seg_end."""
    return df.withColumnsRenamed({"start": "seg_start", "end": "seg_end"})
