"""Exports, paths, scorers and small reports over the corpus tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomspark.functions import text as T
from loomspark.operators import aggregates as A
from loomspark.operators import filters as P
from loomspark.operators import joins as J
from loomspark.operators import scorers as M
from loomspark.plans.registry import query
from loomspark.sources import readers as R
from loomspark.sources import writers as K


@query("select utt_id, 'audios/' || left(sha1(chunk_audio_path), 2) || '/' || sha1(chunk_audio_path) || '_chunk' || cid || '_' || pos || '.wav' as path, 'jsons/' || left(sha1(chunk_audio_path), 2) || '/' || sha1(chunk_audio_path) || '_chunk' || cid || '_' || pos || '.json' as sidecar from segments")
def k6_paths(t):
    p = K.audio_path(F.col("chunk_audio_path"), F.col("cid"), F.col("pos"))
    return t("segments").select("utt_id", p.alias("path"), R.sidecar_path(p).alias("sidecar"))


_NUMBER = "case when {1} is not null then '\"{0}\":' || {1}::double::varchar end"


def _object(*parts: str) -> str:
    return f"'{{' || concat_ws(',', {', '.join(parts)}) || '}}'"


def _number(name: str, value: str) -> str:
    return _NUMBER.format(name, value)


def _text(name: str, value: str) -> str:
    return f"case when {value} is not null then '\"{name}\":' || to_json({value})::varchar end"


_TIMES = _object(_number("duration", "round(seg_duration, 5)"), _number("start", "round(seg_start, 5)"), _number("end", "round(seg_end, 5)"))
_SCORES = _object(_number("dnsmos", "round(dnsmos, 4)"), _number("c50", "round(c50, 4)"), _number("snr", "round(snr, 4)"))
_SENTENCE = _object(
    _text("utt_id", "utt_id"), _text("speaker_id", "speaker_id"), _number("speaker_min_similarity", "round(speaker_min_similarity, 4)"), f"'\"time_range\":' || {_TIMES}", f"'\"audio_quality_info\":' || {_SCORES}"
)
_V1_TIMES = "'{' || printf('\"seg_start\":\"%.4f\",\"seg_end\":\"%.4f\",\"seg_duration\":\"%.4f\"', seg_start, seg_end, seg_duration) || '}'"
_V1 = _object(_text("speaker_id", "speaker_id"), _text("language", "language"), f"'\"time_range\":' || {_V1_TIMES}", f"'\"transcription_info\":{{' || coalesce({_text('transcript', 'text')}, '') || '}}'")


@query(f"""select chunk_audio_path, '{{"audio_path":' || to_json(chunk_audio_path)::varchar || ',"duration":' || round(sum(seg_duration), 5)::varchar || ',"sentences":[' || string_agg({_SENTENCE}, ',' order by pos) || ']}}' as json from scored group by 1""")
def k6_sidecars(t):
    return K.sidecar(t("scored"))


@query(f"select chunk_audio_path, '[' || string_agg({_V1}, ',' order by pos) || ']' as json from stage2 group by 1")
def k7_v1_json(t):
    return K.v1_json(t("stage2").select("chunk_audio_path", "pos", "speaker_id", "language", "seg_start", "seg_end", "seg_duration").join(t("segments").select("chunk_audio_path", "pos", "text"), ["chunk_audio_path", "pos"]))


@query("""select utt_id, printf('spk-%05d/%06d.wav', dense_rank() over (partition by chunk_audio_path order by speaker_id), row_number() over (partition by chunk_audio_path, speaker_id order by pos) - 1) as file_name from segments""")
def k8_export_names(t):
    return K.export_names(t("segments"), "libritts")


@query(
    """, n as (select *, row_number() over (partition by chunk_audio_path order by seg_start, pos) as n, cast(floor(seg_start * 1000) as bigint) as a, cast(floor(seg_end * 1000) as bigint) as b from segments)
    select chunk_audio_path, string_agg(n || chr(10) || printf('%02d:%02d:%02d,%03d', a // 3600000 % 24, a // 60000 % 60, a // 1000 % 60, a % 1000) || ' --> ' || printf('%02d:%02d:%02d,%03d', b // 3600000 % 24, b // 60000 % 60, b // 1000 % 60, b % 1000)
    || chr(10) || speaker_id || ': ' || text || chr(10), chr(10) order by n) as srt from n group by 1"""
)
def k9_subtitles(t):
    return K.subtitles(t("segments"))


@query(
    """, r as (select chunk_audio_path as relative_path, sum(seg_duration) as initial, sum(case when pos % 2 = 0 then seg_duration else 0 end) as final from segments group by 1)
    select relative_path, printf('%.2f', initial) as initial, printf('%.2f', final) as final, printf('%.2f', case when initial > 0 then least(100.0::double, final / initial * 100) else 0.0::double end) as retention from r"""
)
def k10_retention(t):
    final = F.sum(F.when(F.col("pos") % 2 == 0, F.col("seg_duration")).otherwise(0.0))
    return K.retention_report(t("segments").groupBy(F.col("chunk_audio_path").alias("relative_path")).agg(F.sum("seg_duration").alias("initial"), final.alias("final")))


@query("select shard, count(*) as n from segments where shard <> 'shard-1' group by shard")
def k3_missing_shards(t):
    s = t("segments")
    return K.missing_shards(s, s.where("shard = 'shard-1'")).groupBy("shard").agg(F.count("*").alias("n"))


@query("select relative_path, case when doc_id % 3 = 0 then null when doc_id % 3 = 1 then null else 'a/../' || relative_path end as safe from manifest")
def s15_safe_paths(t):
    p = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("/"), F.col("relative_path"))).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("../"), F.col("relative_path"))).otherwise(F.concat(F.lit("a/../"), F.col("relative_path")))
    return t("manifest").select("relative_path", R.safe_path(p).alias("safe"))


@query("select case pos % 3 when 0 then 'asr' when 1 then 'retain_seg_percent' else 'chunk_done' end as name, count(*) as n, cast(sum(case pos % 3 when 0 then pos + 0.5::double when 1 then 12.5::double else 1 end) as double) as total from segments group by 1")
def s22_log_events(t):
    p = F.col("pos")
    line = F.when(p % 3 == 0, F.concat(F.lit("INFO asr_time_cost in 3 total_ms "), (p + 0.5).cast("string"))).when(p % 3 == 1, F.lit("x retain_seg_percent 12.5")).otherwise("y chunk_done z")
    return R.log_events(t("segments").select(line.alias("line"))).groupBy("name").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


@query("select case pos % 3 when 0 then 'asr' end as name, count(*) as n, cast(sum(pos + 0.5::double) as double) as total_ms, 36000000.0::double / sum(pos + 0.5::double) as speed from segments where pos % 3 = 0 group by 1")
def a18_stage_times(t):
    line = F.concat(F.lit("asr_time_cost total_ms "), (F.col("pos") + 0.5).cast("string"))
    return A.stage_times(R.log_events(t("segments").where("pos % 3 = 0").select(line.alias("line"))), 36000.0)


@query("select utt_id, case when seg_duration > 15 then 150 + floor(seg_duration / 24)::double else greatest(120.0::double, 60 + floor(seg_duration / 24)) end as x from segments where false union all select utt_id, greatest(120.0::double, 60 + floor(seg_duration * 200 / 24)) from segments")
def t30_timeouts(t):
    return t("segments").select("utt_id", T.decode_timeout(F.col("seg_duration") * 200).alias("x"))


def _unit(salt: str, value: str) -> str:
    return f"(('0x' || left(sha1('{salt}:' || {value}), 8))::bigint / 4294967295.0::double)"


def _stub(name: str, low: int, high: int) -> str:
    """What the stub scorer of a name says of text."""
    return f"case when coalesce(text, '') = '' then -1.0::double else {low} + {high - low} * {_unit(name, 'text')} end"


@query(
    f""", a as (select *, case when seg_duration >= 2 then {_stub("stub_alignment", 0, 1)} else -1.0::double end as alignment_score from segments),
    b as (select *, alignment_score >= 0 and alignment_score < 0.3::double as low_alignment from a),
    c as (select *, case when seg_duration >= 2 and not low_alignment then {_stub("stub_ppl", 10, 2000)} else -1.0::double end as ppl from b)
    select utt_id, alignment_score, ppl, low_alignment, ppl > 1000 as high_ppl from c"""
)
def m_scored_cascade(t):
    """Scores by stub models, each only of rows that the step before left, then the flags."""
    df = t("segments").withColumn("error", F.lit(None).cast("string"))
    df = M.score_alive(df, "stub_alignment", "alignment_score", F.col("seg_duration") >= 2, "text")
    alive = (F.col("seg_duration") >= 2) & ~P.outside(F.col("alignment_score"), least=0.3)
    df = M.score_alive(df, "stub_ppl", "ppl", alive, "text")
    return df.select("utt_id", "alignment_score", "ppl", P.outside(F.col("alignment_score"), least=0.3).alias("low_alignment"), P.outside(F.col("ppl"), most=1000).alias("high_ppl"))


@query(f"select utt_id, {_stub('stub_llm', 0, 1)} as llm_text_score from segments")
def m8_distinct_texts(t):
    """Each distinct text scored once, joined back to every segment."""
    return J.score_distinct(t("segments").select("utt_id", "text"), "text", lambda d: d.withColumn("llm_text_score", M.score("stub_llm", F.col("text")))).select("utt_id", "llm_text_score")


@query(
    f""", x as (select chunk_audio_path, string_agg(text, ' ' order by pos) as text from (select *, row_number() over (partition by chunk_audio_path order by pos) as k from segments) q where k <= 25 group by 1)
    select chunk_audio_path, case when text = '' then 'news' else ['news', 'talk', 'lecture', 'unknown'][cast(floor({_unit("d", "text")} * 3.999) as bigint) + 1] end as domain from x"""
)
def m9_domains(t):
    """A domain for each chunk, from its first texts."""
    said = M.score("stub_domain", F.col("transcript"))
    domain = F.get_json_object(T.json_in(F.col("answer")), "$.domain")
    return A.class_transcript(t("segments")).withColumn("answer", said).select("chunk_audio_path", T.snap(domain, ["news", "talk", "lecture", "unknown"]).alias("domain"))


@query("select count(*) filter (s >= 0.68) as passed, count(*) filter (s < 0.68) as rejected, count(*) filter (s is null) as failed from (select speaker_min_similarity as s from scored)")
def x4_pair_similarity(t):
    return A.pair_similarity(t("scored").withColumn("similarity", F.col("speaker_min_similarity")))


@query("select utt_id, coalesce(case when pos % 2 = 0 then c50 end, 40.0::double) as c50, pos % 2 <> 0 as placeholder from scored")
def x11_placeholders(t):
    value, off = P.placeholder(F.when(F.col("pos") % 2 == 0, F.col("c50")), 40.0)
    return t("scored").select("utt_id", value.alias("c50"), off.alias("placeholder"))


@query("select chunk_audio_path, count(*) as n, bool_or(not ok) as failed from (select *, pos % 4 <> 3 as ok, bool_or(pos % 4 <> 3 and cid % 5 <> 0) over (partition by chunk_audio_path) as any_ok, row_number() over (partition by chunk_audio_path order by pos) as k from segments) q where (ok and cid % 5 <> 0) or (not any_ok and k = 1) group by 1")
def x10_scored_or_failed(t):
    s = t("segments").withColumn("score_error", F.when((F.col("pos") % 4 == 3) | (F.col("cid") % 5 == 0), "boom"))
    out = P.scored_or_failed(s).groupBy("chunk_audio_path").agg(F.count("*").alias("n"), F.bool_or(F.col("pos") % 4 == 3).alias("failed"))
    return out


@query("select distinct sig, bak, ovrl from (select 0) cross join (select 0.0052439::double as sig, -0.39604546::double as bak, 0.04602535::double as ovrl) where false union all select round(avg((-0.08397278::double * d + 1.22083953::double) * d + 0.0052439::double), 6), round(avg((-0.13166888::double * d + 1.60915514::double) * d + -0.39604546::double), 6), round(avg((-0.06766283::double * d + 1.11546468::double) * d + 0.04602535::double), 6) from (select dnsmos as d from scored)")
def a29_dnsmos(t):
    one = A.dnsmos(t("scored").select(F.lit("all").alias("utt_id"), *(F.col("dnsmos").alias(k) for k in ("sig", "bak", "ovrl"))))
    return one.select(*(F.round(k, 6).alias(k) for k in ("sig", "bak", "ovrl")))


@query("select label as utt_id, count(*) as n_windows from embeddings group by 1")
def a28_consistency(t):
    from loomspark.operators.intervals import consistency

    e = t("embeddings").select(F.col("label").alias("utt_id"), "embedding", "vec_id")
    first = e.groupBy("utt_id").agg(F.min_by("embedding", "vec_id").alias("reference_embedding"))
    return consistency(e, first, 0.5).select("utt_id", "n_windows")


@query(
    """, c as (select user_id as worker, event_id, epoch(ts) as ts, event_id % 3 > 0 as slow from events), d as (select *, slow and coalesce(lag(slow) over (partition by worker order by ts), false) as due from c),
    q as (select worker, ts, row_number() over (partition by worker order by ts) as k from d where due),
    r as (select worker, k, ts as sent from q where k = 1 union all select q.worker, q.k, case when q.ts - r.sent >= 86400 then q.ts else r.sent end from r join q on q.worker = r.worker and q.k = r.k + 1)
    select worker, count(distinct sent) as n from r group by worker"""
)
def w12_alerts(t):
    ts = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    checks = t("events").select(F.col("user_id").alias("worker"), ts.alias("ts"), (F.col("event_id") % 3 > 0).alias("slow"))
    return A.slow_alerts(checks, 86400.0).groupBy("worker").agg(F.count("*").alias("n"))
