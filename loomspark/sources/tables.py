"""The corpus tables that the queries run on, derived from the generated ones with the same SQL for Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: name: (tables it needs, SQL). {S} is the string type and {G} what makes a regular expression replace all.
DERIVED: dict[str, tuple[tuple[str, ...], str]] = {
    "manifest": (
        ("documents",),
        """select concat(source, '/', cast(doc_id as {S}), '.', case doc_id % 4 when 0 then 'mp3' when 1 then 'wav' when 2 then 'flac' else 'm4a' end) as relative_path,
           case when doc_id % 50 = 0 then cast(0 as double) else n_chars / cast(16 as double) end as duration, n_chars as file_size,
           case doc_id % 4 when 0 then 'mp3' when 1 then 'wav' when 2 then 'flac' else 'm4a' end as format, doc_id
           from documents""",
    ),
    "segments": (
        ("conversations",),
        """select concat('c', cast(conv_id as {S}), '_', cast(turn as {S})) as utt_id, concat('conv/', cast(conv_id as {S})) as chunk_audio_path,
           concat('shard-', cast(conv_id % 3 as {S})) as shard, case when (turn * conv_id) % 5 < 3 then 'S0' else 'S1' end as speaker_id,
           cum - dur as seg_start, cum as seg_end, dur as seg_duration, turn as pos, conv_id as cid, role, text
           from (select *, sum(dur + gap) over (partition by conv_id order by turn rows between unbounded preceding and current row) as cum
                 from (select conv_id, turn, role, text, (((length(text) + turn * 3) % 320) + 8) / cast(16 as double) as dur,
                              ((conv_id * 5 + turn * 7) % 24) / cast(16 as double) as gap from conversations) b) e""",
    ),
    "stage2": (
        ("segments",),
        """select *, case when nch = 0 then cast(-1 as double) else nch / seg_duration end as speaking_rate
           from (select utt_id, chunk_audio_path, shard, speaker_id, seg_start, seg_end, seg_duration, pos, cid, text,
                 length(regexp_replace(text, '[,.!?"''，。！？“”‘’ \\t\\n\\r]', ''{G})) as nch,
                 case when cid % 29 = 0 then 'asr_access_failed: remote' when cid % 31 = 0 then 'task error: boom' when cid % 37 = 0 then '' end as error,
                 case cid % 4 when 0 then 'en' when 1 then 'fr' when 2 then 'de' end as language,
                 case when (cid + pos) % 13 = 0 then cast(-1 as double) else ((cid * 31 + pos * 17) % 1024) / cast(1024 as double) end as alignment_score,
                 case when (cid + pos) % 11 = 0 then cast(-1 as double) else cast((cid * 37 + pos * 11) % 1500 as double) end as ppl,
                 (cid + pos) % 4 - 1 as silences
                 from segments) s""",
    ),
    "turns": (
        ("events",),
        """select concat('d', cast(day(ts) as {S})) as chunk_audio_path, concat('U', cast(user_id % 5 as {S})) as speaker_id,
           cast(hour(ts) * 3600 + minute(ts) * 60 + second(ts) as double) as seg_start,
           cast(hour(ts) * 3600 + minute(ts) * 60 + second(ts) + ((event_id % 40) + 1) * 30 as double) as seg_end, event_id as pos
           from events""",
    ),
    "scored": (
        ("segments",),
        """select *, cast((cid * 7 + pos * 13) % 64 as double) / 16 + 1 as dnsmos, cast((cid * 11 + pos * 5) % 80 as double) as c50,
           case when (cid + pos) % 17 = 0 then cast(-420.69 as double) else cast((cid * 3 + pos * 29) % 60 as double) end as snr,
           case when pos % 6 = 5 then null else cast((cid * 19 + pos * 23) % 128 as double) / 128 end as speaker_min_similarity
           from segments""",
    ),
}
RAW = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A generated or derived table."""
    if name in RAW:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    needs, sql = DERIVED[name]
    frames = {f"_{n}": table(spark, sf_dir, n) for n in needs}
    sql = sql.format(S="string", G="")
    for n in needs:
        sql = sql.replace(f"from {n}", f"from {{_{n}}}")
    return spark.sql(sql, **frames)


def oracle_prefix() -> str:
    """The derived tables as common table expressions for DuckDB."""
    return "with recursive " + ",\n".join(f"{n} as ({sql.format(S='varchar', G=", 'g'")})" for n, (_, sql) in DERIVED.items())
