"""Quality control: yields, durations, mergeability, re-checks, samples, filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomspark.functions import text as T
from loomspark.operators import aggregates as A
from loomspark.operators import filters as P
from loomspark.operators import sampling as L
from loomspark.plans.registry import query

CASCADE = {"rate": (4.0, 60.0), "silences": 1, "alignment": 0.55, "ppl": 1000.0}
#: The same cascade in SQL, over the derived table stage2.
FLAGGED = """, c0 as (select *, not coalesce(error <> '', false) as ok from stage2),
 c1 as (select *, ok and speaking_rate >= 0 and (speaking_rate < 4 or speaking_rate > 60) as f_rate from c0),
 c2 as (select *, ok and not f_rate and silences >= 0 and silences > 1 as f_sil from c1),
 c3 as (select *, ok and not f_rate and not f_sil and alignment_score >= 0 and alignment_score < 0.55 as f_align from c2),
 flagged as (select *, ok and not f_rate and not f_sil and not f_align and ppl >= 0 and ppl > 1000 as f_text,
             ok and not f_rate and not f_sil and not f_align and not (ppl >= 0 and ppl > 1000) as kept from c3)"""
SECONDS = "coalesce(sum(case when {} then seg_duration end), 0)"


def flagged(t):
    return P.cascade(t("stage2"), **CASCADE)


@query(
    f"""{FLAGGED} select shard, count(*) as n_rows, sum(seg_duration) as seconds, count(*) filter (kept) as kept, {SECONDS.format("kept")} as kept_seconds,
    count(*) filter (coalesce(error <> '', false)) as errors, count(*) filter (coalesce(contains(error, 'asr_access_failed'), false)) as retriable,
    count(*) filter (f_sil) as n_silence, count(*) filter (f_align) as n_alignment, count(*) filter (f_text) as n_text_quality, count(*) filter (f_rate) as n_speaking_rate, 0 as n_asr_validation,
    {SECONDS.format("f_sil")} as s_silence, {SECONDS.format("f_align")} as s_alignment, {SECONDS.format("f_text")} as s_text_quality, {SECONDS.format("f_rate")} as s_speaking_rate, 0.0::double as s_asr_validation,
    count(*) filter (kept) * 100.0::double / count(*) as kept_pct from flagged group by shard"""
)
def yield_funnel(t):
    return A.yield_funnel(flagged(t))


@query(
    f"""{FLAGGED}, l as (select 0 as level, count(*) as n, coalesce(sum(case when duration > 0 then duration end), 0) as seconds from manifest
    union all select 1, count(*), sum(seg_duration) from flagged union all select 2, count(*), coalesce(sum(seg_duration), 0) from flagged where kept)
    select level, n, seconds, seconds * 100.0::double / lag(seconds) over (order by level) as seconds_pct from l"""
)
def a4_funnel_levels(t):
    return A.funnel_levels(t("manifest"), flagged(t))


@query(
    f"""{FLAGGED}, r as (select shard, case when f_sil then 'silence' when f_align then 'alignment' when f_text then 'text_quality' when f_rate then 'speaking_rate' end as reason, seg_duration from flagged),
    k as (select * from (select distinct shard from flagged), (values ('silence'), ('alignment'), ('text_quality'), ('speaking_rate'), ('asr_validation')) v(reason))
    select k.shard, k.reason, count(r.shard) as n, coalesce(sum(r.seg_duration), 0) as seconds from k left join r on r.shard = k.shard and r.reason = k.reason group by k.shard, k.reason"""
)
def a7_reasons(t):
    return A.reasons_long(A.yield_funnel(flagged(t)))


@query("select count(*) as files, coalesce(sum(case when duration > 0 then duration end), 0) as seconds, count(*) filter (not coalesce(duration > 0, false)) as unknown from manifest")
def a5_raw_level(t):
    return A.raw_level(t("manifest"))


@query(
    """select count(distinct case when not e then chunk_audio_path end) as ok_files, count(distinct case when e then chunk_audio_path end) as failed_files,
    count(distinct case when not e then chunk_audio_path end) as chunks, count(*) filter (not e) as segments, coalesce(sum(case when not e then seg_duration end), 0) as seconds
    from (select *, coalesce(error <> '', false) as e from stage2)"""
)
def a6_stage1_level(t):
    return A.stage1_level(t("stage2").withColumn("source", F.col("chunk_audio_path")))


@query(
    """select case when contains(error, 'asr_access_failed') then 'asr_access_failed' when contains(error, ':') then left(trim(split_part(error, ':', 1)), 60) else left(error, 40) end as category,
    count(*) as n from stage2 where coalesce(error <> '', false) group by 1 order by n desc, category limit 30"""
)
def a8_top_errors(t):
    return A.top_errors(t("stage2"))


@query(
    """, b as (select case when seg_duration < 4 then '<4' when seg_duration < 8 then '4-8' when seg_duration < 15 then '8-15' else '>=15' end as bucket, seg_duration from segments)
    select bucket, count(*) as n, sum(seg_duration) as seconds, count(*) * 100.0::double / (select count(*) from b) as pct from b group by bucket"""
)
def a9_duration_buckets(t):
    return A.duration_buckets(t("segments"))


@query(
    """, b as (select case when duration < 3 then '0-3' when duration < 5 then '3-5' when duration < 7 then '5-7' when duration < 9 then '7-9' when duration < 12 then '9-12' when duration < 15 then '12-15' else '15+' end as bucket, duration from manifest)
    select bucket, count(*) as n, sum(duration) as seconds, count(*) * 100.0::double / (select count(*) from b) as pct from b group by bucket"""
)
def a22_file_durations(t):
    return A.duration_buckets(t("manifest"), T.FINE, "duration")


@query(
    """select shard, count(*) as n, sum(seg_duration) as seconds, min(seg_duration) as least, max(seg_duration) as most, median(seg_duration) as median,
    count(*) filter (seg_duration < 2) as below, count(*) filter (seg_duration > 30) as above from segments group by grouping sets ((shard), ())"""
)
def a10_duration_stats(t):
    return A.duration_stats(t("segments"))


@query("select case when coalesce(language, '') = '' then 'unknown' else language end as language, count(*) as n, sum(seg_duration) as seconds from stage2 group by 1")
def a10_languages(t):
    return A.language_seconds(t("stage2"))


HIST = """, h as (select shard, case when seg_duration < 0 then -1 when seg_duration > 16 then 64 else least(cast(floor(seg_duration / 16 * 64) as integer), 63) end as bin,
 count(*) as n, min(seg_duration) as least, max(seg_duration) as most from segments group by all)"""


@query(f"{HIST} select * from h")
def a2_histogram(t):
    return A.histogram(t("segments"), "seg_duration", 0.0, 16.0, 64, ("shard",))


@query(
    f"""{HIST}, c as (select *, sum(n) over (partition by shard order by bin) as cum, sum(n) over (partition by shard) as total, min(least) over (partition by shard) as lo, max(most) over (partition by shard) as hi from h),
    f as (select *, row_number() over (partition by shard order by bin) as k from c where cum >= 0.5 * total)
    select shard, case when bin < 0 then lo when bin >= 64 then hi else (bin + (0.5::double * total - (cum - n)) / n) * 0.25::double end as value from f where k = 1"""
)
def a3_histogram_percentile(t):
    return A.histogram_percentile(A.histogram(t("segments"), "seg_duration", 0.0, 16.0, 64, ("shard",)), 0.0, 16.0, 64, 50.0, ("shard",))


VERDICTS = """, v as (select utt_id, shard, seg_duration, speaker_min_similarity as emb, (cid + pos) % 3 + 1 as dia, speaker_min_similarity + 0.125 as rec, dnsmos as bak from scored)"""


def verdicts(t):
    return t("scored").select(
        "utt_id", "shard", "seg_duration", F.col("speaker_min_similarity").alias("emb_min_similarity"), ((F.col("cid") + F.col("pos")) % 3 + 1).alias("dia_n_speakers"),
        (F.col("speaker_min_similarity") + 0.125).alias("rec_min_similarity"), F.col("dnsmos").alias("bak"),
    )


@query(
    f"""{VERDICTS}, x as (select *, coalesce(emb < 0.68, false) as a, dia > 1 as b from v)
    select count(*) as n, count(*) filter (a) as by_embedding, count(*) filter (b) as by_diarization, count(*) filter (a or b) as by_either,
    sum(case when a or b then seg_duration end) as seconds, avg(emb - rec) as drift from x where emb is not null or dia is not null"""
)
def a13_speaker_recheck(t):
    return A.speaker_recheck(verdicts(t))


@query(
    f"""{VERDICTS}, x as (select case when seg_duration < 2 then '<2' when seg_duration < 4 then '2-4' when seg_duration < 8 then '4-8' else '>=8' end as band, coalesce(emb < 0.68, false) as a, dia > 1 as b from v)
    select band, count(*) filter (a and b) as both, count(*) filter (a and not b) as only_a, count(*) filter (not a and b) as only_b, count(*) filter (not a and not b) as neither
    from x group by grouping sets ((band), ())"""
)
def a12_confusion(t):
    return A.confusion(verdicts(t), F.coalesce(F.col("emb_min_similarity") < 0.68, F.lit(False)), F.col("dia_n_speakers") > 1)


@query(
    f"""{VERDICTS} select case when seg_duration < 2 then '<2' when seg_duration < 4 then '2-4' when seg_duration < 8 then '4-8' else '>=8' end as band,
    case when bak >= 3 then 'clean' when bak >= 2 then 'mild' else 'clear' end as grade, count(*) as n, sum(seg_duration) as seconds from v where bak is not null group by all"""
)
def a14_background(t):
    return A.background_grades(verdicts(t))


@query(
    """, k as (select case when seg_duration > 15 then 'long' when seg_duration < 2 then 'short' end as kind, left(text, 200) as example from segments),
    e as (select kind, example, row_number() over (partition by kind order by example) as r from (select distinct kind, example from k where kind is not null))
    select k.kind, count(*) as n, (select string_agg(example, ' | ' order by example) from e where e.kind = k.kind and r <= 3) as examples from k where kind is not null group by k.kind"""
)
def a15_anomalies(t):
    d = F.col("seg_duration")
    return A.anomalies(t("segments"), F.when(d > 15, "long").when(d < 2, "short"), F.col("text"))


@query(
    f"""{FLAGGED} select (select sum(duration) from manifest) as total_secs,
    (select count(distinct chunk_audio_path) from flagged where ok) as done_files, (select count(distinct chunk_audio_path) from flagged where not ok) as failed_files,
    (select sum(seg_duration) from flagged where ok) as valid_secs, (select count(*) from flagged) as stage2_rows, (select sum(seg_duration) from flagged where kept) as kept_secs,
    (select sum(seg_duration) from flagged where kept) * 100.0::double / (select sum(seg_duration) from flagged where ok) as yield_pct"""
)
def a16_snapshot(t):
    return A.snapshot(t("manifest"), t("stage2").withColumn("source", F.col("chunk_audio_path")), flagged(t))


@query(
    """select shard as tree, count(*) as n, count(distinct chunk_audio_path) as chunks, count(distinct speaker_id) as speakers, sum(seg_duration) as seconds, median(seg_duration) as median,
    min(seg_duration) as least, max(seg_duration) as most, median(dnsmos) as dnsmos, median(c50) as c50, median(case when snr > -100 then snr end) as snr from scored group by shard"""
)
def a17_run_summary(t):
    return A.run_summary(t("scored").withColumnRenamed("shard", "tree"))


@query("select chunk_audio_path, speaker_id, count(*) as n, sum(seg_duration) as seconds from segments group by all")
def a17_speaker_seconds(t):
    return A.speaker_seconds(t("segments"))


@query(
    """select shard, quantile_cont(seg_duration, 0.5) as p50, quantile_cont(seg_duration, 0.9) as p90, quantile_cont(seg_duration, 0.99) as p99, sum(seg_duration) / count(*) as mean from segments group by shard"""
)
def a19_chunk_stats(t):
    p = F.percentile("seg_duration", F.array(F.lit(0.5), F.lit(0.9), F.lit(0.99)))
    rows = t("segments").groupBy("shard").agg(p.alias("p"), (F.sum("seg_duration") / F.count("*")).alias("mean"))
    return rows.select("shard", F.col("p")[0].alias("p50"), F.col("p")[1].alias("p90"), F.col("p")[2].alias("p99"), "mean")


@query(
    f"""{FLAGGED}, s as (select unnest(['silence', 'alignment', 'text_quality', 'speaking_rate', 'asr_validation']) as step, unnest([f_sil, f_align, f_text, f_rate, false]) as hit, seg_duration from flagged)
    select step, count(*) filter (hit) as n, coalesce(sum(case when hit then seg_duration end), 0) as seconds, count(*) filter (hit) * 100.0::double / count(*) as pct from s group by step"""
)
def a20_discarded(t):
    return A.discarded(flagged(t))


@query(
    """, p as (select duration, case when file_size < 1024 then 'too_small' when duration is null or duration <= 0 then 'undecodable' when duration > 86400 then 'too_long' end as problem from manifest)
    select count(*) filter (problem is null) as valid, count(*) filter (problem is not null) as invalid, cast(coalesce(sum(case when problem is null then floor(duration) end), 0) as bigint) as seconds from p"""
)
def a21_file_totals(t):
    return A.file_totals(t("manifest"), P.audio_problem(F.col("file_size"), F.col("duration")))


@query("""select case when file_size < 1024 then 'too_small' when duration is null or duration <= 0 then 'undecodable' when duration > 86400 then 'too_long' end as problem, count(*) as n from manifest group by 1""")
def p27_audio_problems(t):
    return t("manifest").groupBy(P.audio_problem(F.col("file_size"), F.col("duration")).alias("problem")).agg(F.count("*").alias("n"))


@query("select time_bucket(interval '1 day', ts - interval '10 hours') + interval '10 hours' as day_start, count(*) as n, sum(event_id) as total from events group by 1")
def a23_daily(t):
    return A.daily(t("events"), "ts", "event_id")


@query(
    """, x as (select distinct utt_id, unnest([role, speaker_id, shard]) as tag from segments)
    select tag, count(*) as n, count(*) * 100.0::double / (select count(*) from segments) as pct from x group by tag"""
)
def a24_tags(t):
    return A.tag_counts(t("segments").withColumn("tags", F.array("role", "speaker_id", "shard")), "tags")


@query("select chunk_audio_path, speaker_id, utt_id, seg_duration from (select *, row_number() over (partition by chunk_audio_path, speaker_id order by seg_duration desc, pos) as k from segments) where k = 1")
def a25_longest_per_speaker(t):
    return A.longest_per_speaker(t("segments"))


@query("select chunk_audio_path, string_agg(text, ' ' order by pos) as transcript from (select *, row_number() over (partition by chunk_audio_path order by pos) as k from segments) where k <= 25 group by 1")
def a26_transcripts(t):
    return A.class_transcript(t("segments"))


@query("select chunk_audio_path as utt_id, greatest(0.0::double, least(1.0::double, sum(dnsmos / 4) / count(*))) as alignment_score from scored group by 1")
def a27_alignment(t):
    return A.alignment_score(t("scored").select(F.col("chunk_audio_path").alias("utt_id"), (F.col("dnsmos") / 4).alias("score")))


@query(
    """, w as (select user_id as worker, event_id as task, epoch(ts) as ts, (event_id % 50 + 1)::double as audio, (event_id % 7 + 1)::double as wall from events)
    select worker, task, sum(audio) over k / sum(wall) over k as rtf from w window k as (partition by worker order by ts, task rows between 7 preceding and current row)"""
)
def a30_throughput(t):
    return A.throughput(completions(t)).select("worker", "task", "rtf")


def completions(t):
    i = F.col("event_id")
    return t("events").select(F.col("user_id").alias("worker"), i.alias("task"), F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"), (i % 50 + 1).cast("double").alias("audio"), (i % 7 + 1).cast("double").alias("wall"))


@query(
    """, w as (select user_id as worker, sum((event_id % 50 + 1)::double) / sum((event_id % 7 + 1)::double) as rtf from events group by 1), m as (select median(rtf) as med, count(*) as n from w)
    select worker, rtf, n >= 3 and rtf * 1.25 < med as slow from w, m"""
)
def o8_slow_workers(t):
    return A.slow_workers(completions(t).groupBy("worker").agg((F.sum("audio") / F.sum("wall")).alias("rtf")), factor=1.25)


HISTORY = ", hist as (select epoch(ts) as ts, (sum(event_id) over (order by ts, event_id))::double as done from events)"


def history(t):
    """A history of cumulative progress, one sample an hour, from a two-level sum: within hours and over hours."""
    hours = t("events").groupBy(F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 3600).alias("h")).agg(F.sum("event_id").alias("s"), F.max(F.unix_seconds(F.col("ts").cast("timestamp"))).alias("ts"))
    from pyspark.sql import Window

    return hours.select(F.col("ts").cast("double").alias("ts"), F.sum("s").over(Window.orderBy("h")).cast("double").alias("done"))


HOURS = """, hh as (select floor(epoch(ts) / 3600) as h, sum(event_id) as s, max(floor(epoch(ts))) as ts from events group by 1), hist as (select ts::double as ts, (sum(s) over (order by h))::double as done from hh),
 e as (select min(ts) as t0, max(ts) as t1, arg_min(done, ts) as v0, arg_max(done, ts) as v1 from hist where ts >= (select max(ts) from hist) - 86400)"""


def _last(frame):
    return float(frame.agg(F.max("ts")).first()[0] or 0)


@query(f"{HOURS} select case when t1 - t0 >= 30 and v1 >= v0 then (v1 - v0) / (t1 - t0) end as rate, t1, v1 from e")
def w10_rate(t):
    h = history(t)
    return A.rate_of_progress(h, "done", _last(h), 86400.0)


@query(f"{HOURS} select (1e12::double - v1) / ((v1 - v0) / (t1 - t0)) as eta_s, v1 * 100.0::double / 1e12::double as done_pct, false as stale from e")
def w11_eta(t):
    h = history(t)
    return A.eta(A.rate_of_progress(h, "done", _last(h), 86400.0), 1e12, _last(h))


@query("select utt_id, shard from (select *, row_number() over (partition by shard order by left(sha1(utt_id), 12), utt_id) as k from segments) where k <= 20")
def l1_sample_per_shard(t):
    return L.smallest(t("segments"), 20, by="shard").select("utt_id", "shard")


@query("select utt_id, shard from segments order by left(sha1(utt_id), 12), utt_id limit 50")
def l1_sample_global(t):
    return L.smallest(t("segments"), 50).select("utt_id", "shard")


@query(
    """, k as (select shard, count(*) as population, least(count(*), 20) as n from segments group by shard) select shard, population, n, n::double / population as rate from k"""
)
def l2_sample_info(t):
    df = t("segments")
    return L.with_population(L.smallest(df, 20, by="shard"), df, "shard")


@query("select cast(('0x' || left(sha1(chunk_audio_path), 8)) as bigint) % 64 as bucket, count(*) as n from segments group by 1")
def l4_hash_buckets(t):
    return t("segments").groupBy(L.hash_bucket(F.col("chunk_audio_path"), 64).alias("bucket")).agg(F.count("*").alias("n"))


@query("select chunk_audio_path, count(*) as n from segments group by 1")
def l6_biggest_first(t):
    return L.biggest_first(t("segments"))


@query(
    """, r as (select *, dense_rank() over (partition by chunk_audio_path order by speaker_id) as who, row_number() over (partition by chunk_audio_path, speaker_id order by pos) as which from segments)
    select utt_id, who, which from r where who <= 5 and which <= 5"""
)
def l9_preview(t):
    return L.preview(t("segments")).select("utt_id", "who", "which")


@query(
    """, k as (select relative_path, split_part(relative_path, '/', 1) as shard, duration, case when duration > 2400 then 'long' else 'short' end as kind from manifest)
    select relative_path, kind, cast(floor((row_number() over (partition by shard, kind order by duration, relative_path) - 1) / case when kind = 'long' then 6 else 20 end) as bigint) as batch from k"""
)
def q10_packing(t):
    return L.packed(t("manifest").withColumn("shard", F.split_part("relative_path", F.lit("/"), F.lit(1)))).select("relative_path", "kind", "batch")


@query("select utt_id, cast(floor((row_number() over (partition by chunk_audio_path order by pos) - 1) / 16) as bigint) as batch from segments")
def q11_asr_batches(t):
    return L.batches(t("segments")).select("utt_id", "batch")


@query("select utt_id, speaker_id from segments")
def q12_priority(t):
    return L.by_priority(t("segments"), F.col("speaker_id") == "S1").select("utt_id", "speaker_id")


@query(
    """, k as (select relative_path, split_part(relative_path, '/', 1) as shard, row_number() over (partition by split_part(relative_path, '/', 1) order by relative_path) - 1 as i from manifest)
    select relative_path, i, shard || '/' || (i // 10 * 10)::varchar || '_' || (i // 10 * 10 + 9)::varchar as folder from k"""
)
def k17_folders(t):
    return L.folder_of(t("manifest").withColumn("shard", F.split_part("relative_path", F.lit("/"), F.lit(1))), 10).select("relative_path", "i", "folder")


@query("select utt_id, row_number() over (partition by chunk_audio_path, speaker_id order by pos) as index from segments")
def w6_speaker_index(t):
    return L.speaker_index(t("segments")).select("utt_id", "index")


@query(
    """, g as (select row_number() over (order by source) as pos, source as name, count(*) as available from documents group by source),
    r as (select 0 as round, pos, name, available, 0::bigint as take, (select cast(floor(0.6::double * count(*)) as bigint) from documents) as left_ from g union all
      select round + 1, pos, name, available, take + give, left_ - sum(give) over () from (
        select *, greatest(0, least(wish, left_ - coalesce(sum(wish) over (order by pos rows between unbounded preceding and 1 preceding), 0))) as give from (
          select *, least(available - take, case when take < available then ceil(left_::double / greatest(1, count(*) filter (take < available) over ()))::bigint else 0 end) as wish from r) a) b
      where left_ > 0 and round < 50)
    select name, available, max(take) as take from r group by 1, 2"""
)
def q9_allocation(t):
    """Three fifths of all documents, dealt over sources."""
    from pyspark.sql import Window

    docs = t("documents")
    groups = docs.groupBy(F.col("source").alias("name")).agg(F.count("*").alias("available")).withColumn("pos", F.row_number().over(Window.orderBy("name")))
    return L.allocated(groups, int(docs.count() * 0.6))


@query(f"{FLAGGED} select utt_id, f_rate as dropped_by_speaking_rate, f_sil as dropped_by_silence, f_align as dropped_by_alignment, f_text as dropped_by_text_quality, kept from flagged")
def p16_cascade(t):
    return flagged(t).select("utt_id", "dropped_by_speaking_rate", "dropped_by_silence", "dropped_by_alignment", "dropped_by_text_quality", P.kept().alias("kept"))


@query(
    """, p(language, lo, hi, al, pp, si) as (values ('en', 2.0::double, 20.0::double, 0.65::double, 800.0::double, 1), ('fr', 4, 16, 0.6, 1200, 1), ('de', 4, 16, 0.55, 1400, 1)),
    c0 as (select s.*, lo, hi, case when s.language = 'de' then 0.60::double else al end as al, pp, si, not coalesce(error <> '', false) as ok from stage2 s left join p on p.language = s.language),
    c1 as (select *, ok and coalesce(speaking_rate >= 0 and (speaking_rate < lo or speaking_rate > hi), false) as f1 from c0),
    c2 as (select *, ok and not f1 and coalesce(silences >= 0 and silences > si, false) as f2 from c1),
    c3 as (select *, ok and not f1 and not f2 and coalesce(alignment_score >= 0 and alignment_score < al, false) as f3 from c2),
    c4 as (select *, ok and not f1 and not f2 and not f3 and coalesce(ppl >= 0 and ppl > pp, false) as f4 from c3)
    select utt_id, ok and not f1 and not f2 and not f3 and not f4 as kept from c4"""
)
def p16_cascade_by_language(t):
    return P.cascade_by_language(t("stage2")).select("utt_id", P.kept().alias("kept"))


@query(
    """select utt_id, case when ppl >= 0 and ppl > 1000 then 'ppl' when alignment_score >= 0 and alignment_score < 0.5 then 'spell' when speaking_rate >= 0 and speaking_rate < 8 then 'llm' end as reason from stage2"""
)
def p9_text_quality_reason(t):
    df = t("stage2").withColumn("spell", F.col("alignment_score")).withColumn("llm", F.col("speaking_rate"))
    return df.select("utt_id", P.text_quality_reason(ppl=1000, spell=0.5, llm=8).alias("reason"))


@query("select utt_id from scored where dnsmos >= 2.8 and c50 >= 40 and snr >= 10")
def p10_metrics_fixed(t):
    return P.good_metrics(t("scored"), 2.8, 40, 10).select("utt_id")


@query("select utt_id from (select *, avg(dnsmos) over (partition by chunk_audio_path) as m from scored) where dnsmos >= m")
def p11_metrics_average(t):
    return P.above_average(t("scored")).select("utt_id")


@query(
    """, x as (select *, case when nch > 0 then seg_duration / nch end as r from stage2), q as (select shard, quantile_cont(r, 0.1) as p10, quantile_cont(r, 0.9) as p90 from x group by shard)
    select utt_id, seg_duration between 3 and 30 and nch >= 2 and coalesce(r, 0) between p10 - 1.5 * (p90 - p10) and p90 + 1.5 * (p90 - p10) as keep from x join q using (shard)"""
)
def p12_duration_per_char(t):
    return P.duration_per_char(t("stage2").withColumnRenamed("nch", "n_chars"), by="shard").select("utt_id", "keep")


@query("select utt_id from stage2 where language is null or language in ('unknown', 'en')")
def p13_language_gate(t):
    return t("stage2").where(P.language_fits(F.col("language"), "en")).select("utt_id")


@query("select case when duration < 10 then 'skip' when duration > 10800 then 'failed' else 'admit' end as what, count(*) as n from manifest group by 1")
def p20_admission(t):
    return t("manifest").groupBy(P.admission(F.col("duration")).alias("what")).agg(F.count("*").alias("n"))


@query("select shard, count(*) filter (coalesce(contains(error, 'asr_access_failed'), false)) as n from stage2 group by shard")
def p5_retriable(t):
    return t("stage2").groupBy("shard").agg(F.count_if(P.retriable()).alias("n"))


@query("select median(snr) as snr, count(*) as n from scored where snr > -100")
def p23_measured(t):
    return t("scored").where(P.measured(F.col("snr"))).agg(F.median("snr").alias("snr"), F.count("*").alias("n"))
