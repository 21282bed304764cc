"""Predicates, set operations, label and path functions over the corpus tables, each as a query of its own."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomspark.functions import labels
from loomspark.functions import text as T
from loomspark.operators import aggregates as A
from loomspark.operators import filters as P
from loomspark.operators import intervals as I  # noqa: E741
from loomspark.operators import joins as J
from loomspark.operators import sampling as L
from loomspark.operators import scorers as M
from loomspark.plans.registry import query
from loomspark.sources import readers as R


@query("select shard, count(*) filter (coalesce(error, '') = '') as n_valid, count(*) filter (error <> '') as n_error, count(*) filter (error like '%asr_access_failed%') as n_retriable from stage2 group by shard")
def p1_p5_masks(t):
    return t("stage2").groupBy("shard").agg(F.count_if(P.valid()).alias("n_valid"), F.count_if(T.has_error(F.col("error"))).alias("n_error"), F.count_if(P.retriable()).alias("n_retriable"))


@query("""select utt_id, coalesce(speaking_rate >= 0 and (speaking_rate < 4 or speaking_rate > 60), false) as rate, coalesce(silences > 1, false) as silence,
    coalesce(alignment_score >= 0 and alignment_score < 0.55::double, false) as alignment from stage2""")
def p6_p8_flags(t):
    return t("stage2").select("utt_id", P.outside(F.col("speaking_rate"), 4, 60).alias("rate"), P.outside(F.col("silences"), most=1).alias("silence"), P.outside(F.col("alignment_score"), least=0.55).alias("alignment"))


@query("select utt_id, least(seg_end + 0.0625, coalesce(lead(seg_start) over w, seg_end + 0.0625)) as seg_end from segments window w as (partition by chunk_audio_path order by seg_start, pos) qualify seg_end - seg_start >= 2")
def p17_p18_long_enough(t):
    """Segments of at least two seconds, measured before the grace period."""
    wide = I.with_grace(t("segments").withColumn("kept", F.col("seg_end") - F.col("seg_start") >= 2), 0.0, 0.0625)
    return wide.where("kept").select("utt_id", "seg_end")


@query("select doc_id from documents where lang in ('en', 'fr') and (doc_id % 10) / 10.0::double > 0.8::double")
def p21_speech_language(t):
    return t("documents").where(P.speech_language_ok(F.col("lang"), (F.col("doc_id") % 10) / F.lit(10.0), ["en", "fr"])).select("doc_id")


@query("select utt_id from segments where pos % 3 <> 0")
def p22_one_speaker(t):
    answer = F.when(F.col("pos") % 3 == 0, "是的").when(F.col("pos") % 3 == 1, "否")
    return t("segments").where(P.one_speaker(answer)).select("utt_id")


@query("select utt_id from scored where pos % 6 <> 5 or snr > -100")
def p24_any_field(t):
    return t("scored").withColumn("snr", F.when(P.measured(F.col("snr")), F.col("snr"))).where(P.has_any("speaker_min_similarity", "snr")).select("utt_id")


@query("""select doc_id, case when doc_id % 4 = 3 then 'unknown' when doc_id % 4 = 2 and doc_id % 8 = 2 then 'news' else case (doc_id // 4) % 3 when 0 then 'news' when 1 then 'lecture' else 'unknown' end end as domain
    from documents""")
def p25_snapped_labels(t):
    said = F.element_at(F.array(*map(F.lit, ("news", "lecture", "no such label"))), (F.floor(F.col("doc_id") / 4) % 3 + 1).cast("int"))
    odd = F.when(F.col("doc_id") % 4 == 3, None).when((F.col("doc_id") % 4 == 2) & (F.col("doc_id") % 8 == 2), " NEWS\t").when(F.col("doc_id") % 4 == 1, F.concat(F.lit(" "), F.upper(said))).otherwise(said)
    return t("documents").select("doc_id", T.snap(F.trim(odd, F.lit(" \t")), labels.TEXT["domain"]).alias("domain"))


@query("select doc_id from documents where doc_id % 5 > 2")
def p26_finite(t):
    x = F.when(F.col("doc_id") % 5 == 0, float("nan")).when(F.col("doc_id") % 5 == 1, float("-inf")).when(F.col("doc_id") % 5 > 2, F.col("n_chars").cast("double"))
    return t("documents").where(P.finite(x)).select("doc_id")


@query(f"select * from (values {', '.join(f'({k!r}, {v!r}, {i})' for k, vs in labels.ALL.items() for i, v in enumerate(vs))}) v(label, value, place)")
def t17_labels(t):
    spark = t("region").sparkSession
    return spark.createDataFrame([(k, v, i) for k, vs in labels.ALL.items() for i, v in enumerate(vs)], "label string, value string, place int")


@query("""select relative_path, case when starts_with(relative_path, 'src1/') then 'mnt/one/' || substr(relative_path, 6) when starts_with(relative_path, 'src1') then 'mnt/ten' || substr(relative_path, 5) else relative_path end as moved,
    'raw/' || relative_path as short, regexp_replace(split_part(relative_path, '/', 2), '[''" ]', '', 'g') as file_id from manifest""")
def t21_t23_t27_paths(t):
    p = F.col("relative_path")
    return t("manifest").select(
        "relative_path", T.rewrite_prefix(p, [("src1/", "mnt/one/"), ("src1", "mnt/ten")]).alias("moved"),
        T.short_path(F.concat(F.lit("/data/raw/"), p)).alias("short"), T.file_id(F.split_part(p, F.lit("/"), F.lit(2))).alias("file_id"),
    )


@query("select utt_id, case when pos % 4 < 3 then (pos * 7 % 100) + 0.5::double end as retained from segments")
def t28_retention(t):
    number = (F.col("pos") * 7 % 100 + F.lit(0.5)).cast("string")
    line = F.when(F.col("pos") % 4 == 0, F.concat(F.lit("retain_seg_percent: "), number, F.lit(" %"))).when(F.col("pos") % 4 == 3, F.lit("no such figure")).otherwise(F.concat(F.lit("Retained="), number))
    return t("segments").select("utt_id", T.retention(line).alias("retained"))


@query("select relative_path from manifest where format in ('mp3', 'wav', 'flac', 'm4a') and doc_id % 7 not in (0, 1)")
def s4_unprocessed(t):
    odd = F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("old_processed/"), "relative_path")).when(F.col("doc_id") % 7 == 1, F.concat("relative_path", F.lit(".temp"))).otherwise(F.col("relative_path"))
    return R.unprocessed(t("manifest").select(odd.alias("relative_path")))


@query("select 'm/manifest_part-' || doc_id || '.parquet' as relative_path from documents where doc_id % 3 = 0")
def s14_manifest_parts(t):
    kind = F.when(F.col("doc_id") % 3 == 0, "manifest_part-").when(F.col("doc_id") % 3 == 1, "other-").otherwise("manifest_part-x")
    return R.manifest_parts(t("documents").select(F.concat(F.lit("m/"), kind, F.col("doc_id").cast("string"), F.lit(".parquet")).alias("relative_path")))


@query("select relative_path from manifest where doc_id % 3 <> 0 and doc_id % 5 <> 0")
def j4_j11_left_out(t):
    """Files that neither a report nor an earlier manifest has."""
    m = t("manifest")
    report, earlier = m.where("doc_id % 3 = 0").select(F.col("relative_path").alias("path")), m.where("doc_id % 5 = 0").select(F.col("relative_path").alias("FilePath"))
    return J.not_done(J.not_done(m, report, "relative_path", "path"), earlier, "relative_path", "FilePath").select("relative_path")


@query("select utt_id, length(text) as ref_chars, length(replace(text, ' ', '')) as hyp_chars from segments where pos % 5 <> 4")
def j7_zipped(t):
    """Two recognisers' outputs, met by chunk and place."""
    s = t("segments")
    other = s.where("pos % 5 <> 4").select("chunk_audio_path", "pos", F.replace("text", F.lit(" "), F.lit("")).alias("hyp"))
    return s.join(other, ["chunk_audio_path", "pos"]).select("utt_id", F.length("text").alias("ref_chars"), F.length("hyp").alias("hyp_chars"))


@query("select utt_id, language, case language when 'en' then 1 when 'fr' then 2 when 'de' then 3 else 4 end * length(text) as score from stage2")
def j18_scored_by_language(t):
    factor = {"en": 1, "fr": 2, "de": 3}
    out = M.score_by_language(t("stage2"), "text", "score", "long", lambda language: lambda texts: [factor.get(language, 4) * len(x) for x in texts])
    return out.select("utt_id", "language", "score")


@query("select shard, coalesce(sum(case when speaker_id = 'S0' and pos % 9 <> 0 then seg_duration end), 0.0) as seconds, count(*) filter (speaker_id = 'S0') as n from segments group by shard")
def a1_masked_sums(t):
    mask = F.col("speaker_id") == "S0"
    s = t("segments").withColumn("seg_duration", F.when(F.col("pos") % 9 != 0, F.col("seg_duration")))
    return s.groupBy("shard").agg(A.seconds_where(mask).alias("seconds"), F.count_if(mask).alias("n"))


@query("select shard, count(*) as n, sum(seg_duration) as seconds, min(seg_duration) as least, max(seg_duration) as most from segments group by shard")
def a31_merged_parts(t):
    """Partial aggregates of parts, kept as rows, and their merge: what an incremental monitor keeps."""
    d = F.col("seg_duration")
    parts = t("segments").groupBy("shard", (F.col("cid") % 7).alias("part")).agg(F.count("*").alias("n"), F.sum(d).alias("s"), F.min(d).alias("a"), F.max(d).alias("b"))
    return parts.groupBy("shard").agg(F.sum("n").alias("n"), F.sum("s").alias("seconds"), F.min("a").alias("least"), F.max("b").alias("most"))


@query(""", g as (select shard, greatest(seg_start - lag(seg_end) over (partition by chunk_audio_path order by seg_start, utt_id), 0) as gap, lag(utt_id) over (partition by chunk_audio_path order by seg_start, utt_id) as p from segments)
    select shard, count(*) as pairs, count(*) filter (gap = 0) as zero_gaps, sum(gap) as gap_seconds, max(gap) as longest_gap from g where p is not null group by shard""")
def w4_gaps(t):
    g = I.pair_categories(t("segments"))
    return g.groupBy("shard").agg(F.count("*").alias("pairs"), F.count_if(F.col("gap") == 0).alias("zero_gaps"), F.sum("gap").alias("gap_seconds"), F.max("gap").alias("longest_gap"))


@query("select chunk_audio_path, speaker_id, pos, seg_end - seg_start as seconds from turns order by seconds desc, pos limit 8")
def w13_slowest(t):
    return t("turns").select("chunk_audio_path", "speaker_id", "pos", (F.col("seg_end") - F.col("seg_start")).alias("seconds")).orderBy(F.col("seconds").desc(), "pos").limit(8)


@query("select chunk_audio_path, ('0x' || left(sha1(chunk_audio_path), 8))::bigint % 16 as bucket, count(*) as n from segments group by all")
def l5_hash_shuffle(t):
    return t("segments").withColumn("bucket", L.hash_bucket(F.col("chunk_audio_path"), 16)).groupBy("chunk_audio_path", "bucket").agg(F.count("*").alias("n"))


@query("select utt_id from (select utt_id from segments where pos % 2 = 0 union select utt_id from segments where pos % 3 = 0) except select utt_id from segments where pos % 4 = 0")
def l10_l11_sets(t):
    u = lambda cond: t("segments").where(cond).select("utt_id")
    return u("pos % 2 = 0").union(u("pos % 3 = 0")).distinct().subtract(u("pos % 4 = 0"))


@query("select relative_path, duration, cast(null as varchar) as format from manifest where doc_id % 2 = 0 union all select relative_path, null, format from manifest where doc_id % 2 = 1")
def l12_l13_union_by_name(t):
    m = t("manifest")
    return m.where("doc_id % 2 = 0").select("relative_path", "duration").unionByName(m.where("doc_id % 2 = 1").select("format", "relative_path"), allowMissingColumns=True)


@query("""select 'SPK_' || left(sha1(chunk_audio_path), 6) || '_' || printf('%02d', dense_rank() over (partition by chunk_audio_path order by speaker_id) - 1) as speaker, count(*) over (partition by chunk_audio_path, speaker_id) as n, utt_id from segments""")
def x1_renamed(t):
    by = Window.partitionBy("chunk_audio_path")
    suffix = F.format_string("%02d", F.dense_rank().over(by.orderBy("speaker_id")) - 1)
    return t("segments").select(T.speaker_name(F.col("chunk_audio_path"), suffix, 6).alias("speaker"), F.count("*").over(by.partitionBy("chunk_audio_path", "speaker_id")).alias("n"), "utt_id")


@query("select chunk_audio_path, count(*) as n, count(distinct speaker_id) as speakers, sum(seg_end - seg_start) as seconds, median(seg_end - seg_start) as middle, min(seg_end - seg_start) as least from turns group by 1")
def x5_sweep_summary(t):
    d = F.col("seg_end") - F.col("seg_start")
    return t("turns").groupBy("chunk_audio_path").agg(F.count("*").alias("n"), F.count_distinct("speaker_id").alias("speakers"), F.sum(d).alias("seconds"), F.median(d).alias("middle"), F.min(d).alias("least"))


@query("select * from (values ('duration', 'double', 'string'), ('format', 'string', null), ('extra', null, 'bigint')) v(name, type_a, type_b)")
def x12_schema_difference(t):
    m = t("manifest").select("relative_path", "duration", "format")
    return J.schema_difference(m, m.select("relative_path", F.col("duration").cast("string").alias("duration"), F.lit(1).cast("long").alias("extra")))
