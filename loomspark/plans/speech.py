"""Intervals, turns, text and joins of the corpus tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomspark.functions import text as T
from loomspark.operators import aggregates as A
from loomspark.operators import folds
from loomspark.operators import intervals as I
from loomspark.operators import joins as J
from loomspark.plans.registry import query

PAIRS = """, pr as (select *, lag(utt_id) over w as prev_id, lag(speaker_id) over w as prev_spk, lag(seg_end) over w as prev_end, lag(seg_start) over w as prev_start, lag(seg_duration) over w as prev_dur
 from segments window w as (partition by chunk_audio_path order by seg_start, utt_id)),
 pairs as (select chunk_audio_path, utt_id, prev_id, greatest(seg_start - prev_end, 0) as gap, seg_duration + prev_dur as pair_duration,
 case when speaker_id is distinct from prev_spk then 'different_speaker' when seg_duration < 1 or prev_dur < 1 then 'no_embedding_short_segment' when seg_start - prev_end >= 0.8 then 'gap_too_large'
 when seg_end - prev_start >= 30 then 'merged_too_long' else 'mergeable_by_structure' end as category from pr where prev_id is not null)"""


@query(f"{PAIRS} select utt_id, prev_id, gap, pair_duration, category from pairs")
def w3_pair_categories(t):
    return I.pair_categories(t("segments")).select("utt_id", "prev_id", "gap", "pair_duration", "category")


@query(f"{PAIRS} select category, count(*) as n, count(*) filter (gap = 0) as zero_gaps, sum(gap) as gap_seconds, sum(pair_duration) as pair_seconds from pairs group by category")
def a11_mergeability(t):
    return A.mergeability(I.pair_categories(t("segments")))


@query("select count(*) as chunks, count(*) filter (n = 1) as single from (select count(*) as n from segments group by chunk_audio_path)")
def a11_chunk_sizes(t):
    return A.chunk_sizes(t("segments"))


@query(
    f"""{PAIRS}, b as (select *, prev_id || '|' || utt_id as pair, cast(('0x' || left(sha1(chunk_audio_path), 8)) as bigint) % 64 as bucket from pairs where category = 'mergeable_by_structure'),
    k as (select *, row_number() over (partition by bucket order by left(sha1(pair), 12), pair) as r, greatest(1, 200 // (select count(distinct bucket) from b)) as budget from b)
    select pair, bucket from k where r <= budget"""
)
def l3_pair_sample(t):
    from loomspark.operators.sampling import pair_sample

    return pair_sample(I.pair_categories(t("segments")).where("category = 'mergeable_by_structure'"), 200).select("pair", "bucket")


@query(
    """, x as (select a.chunk_audio_path, a.pos, sum(least(a.seg_end, b.seg_end) - greatest(a.seg_start, b.seg_start)) as hit from turns a join turns b on a.chunk_audio_path = b.chunk_audio_path
    and a.seg_start < b.seg_end and b.seg_start < a.seg_end and a.speaker_id is distinct from b.speaker_id group by all)
    select t.chunk_audio_path, t.pos, coalesce(hit, 0) as hit from turns t left join x using (chunk_audio_path, pos)"""
)
def j12_contamination(t):
    return I.contamination(t("turns"))


@query(
    """select distinct a.chunk_audio_path, a.pos from turns a join turns b on a.chunk_audio_path = b.chunk_audio_path and a.seg_start < b.seg_end and b.seg_start < a.seg_end
    and a.speaker_id is distinct from b.speaker_id where least(a.seg_end, b.seg_end) - greatest(a.seg_start, b.seg_start) >= 0.9 * (a.seg_end - a.seg_start)"""
)
def j13_swallowed(t):
    return I.swallowed(t("turns"), t("turns")).select("chunk_audio_path", "pos")


@query(
    """, s as (select * from turns where seg_end - seg_start between 1e-9 and 120), f as (select chunk_audio_path, seg_start + pos % 4 * 20 as seg_start, seg_end + pos % 4 * 20 as seg_end from turns),
    x as (select s.chunk_audio_path, s.pos, max(least(s.seg_end, f.seg_end) - greatest(s.seg_start, f.seg_start)) as best from s join f on s.chunk_audio_path = f.chunk_audio_path and s.seg_start < f.seg_end and f.seg_start < s.seg_end group by all)
    select s.chunk_audio_path, s.pos, coalesce(best >= 0.5 * (seg_end - seg_start), false) as hit from s left join x using (chunk_audio_path, pos)"""
)
def j15_short_turn_recall(t):
    """Turns of two minutes at most, looked for among the same turns heard up to a minute late."""
    turns, late = t("turns"), F.col("pos") % 4 * 20
    found = turns.withColumns({"seg_start": F.col("seg_start") + late, "seg_end": F.col("seg_end") + late})
    return I.short_turn_recall(turns, found, longest=120.0).select("chunk_audio_path", "pos", "hit")


@query(
    """, sg as (select * from turns), x as (select s.chunk_audio_path, s.pos, sum(least(s.seg_end, b.seg_end) - greatest(s.seg_start, b.seg_start)) as f from sg s join turns b
    on s.chunk_audio_path = b.chunk_audio_path and s.seg_start < b.seg_end and b.seg_start < s.seg_end and s.speaker_id is distinct from b.speaker_id group by all)
    select sg.chunk_audio_path, sg.pos, coalesce(f, 0) as foreign from sg left join x using (chunk_audio_path, pos)""".replace("as foreign", 'as "foreign"')
)
def j16_foreign_overlap(t):
    return I.foreign_overlap(t("turns"), t("turns"))


@query("""select chunk_audio_path, pos from (select *, max(seg_end) over (partition by chunk_audio_path order by seg_start, pos rows between unbounded preceding and 1 preceding) as m from turns) where seg_end > coalesce(m, 0)""")
def w1_denested(t):
    return I.denested(t("turns")).select("chunk_audio_path", "pos")


@query(
    """, a as (select *, coalesce(least(seg_end + 0.25, lead(seg_start) over (partition by chunk_audio_path order by seg_start, pos)), seg_end + 0.25) as e2 from segments)
    select utt_id, greatest(seg_start - 0.5, coalesce(lag(e2) over (partition by chunk_audio_path order by seg_start, pos), 0), 0) as seg_start, e2 as seg_end from a"""
)
def w2_grace(t):
    return I.with_grace(t("segments"), 0.5, 0.25).select("utt_id", "seg_start", "seg_end")


@query(
    """, g as (select chunk_audio_path, speaker_id, min(struct_pack(s := seg_start, p := pos)) as first from turns where least(seg_end, 86400) > seg_start group by all),
    f as (select *, row_number() over (partition by chunk_audio_path order by first) - 1 as k from g)
    select pos, seg_start, least(seg_end, 86400.0::double) as seg_end, printf('SPEAKER_%02d', k) as speaker from turns join f using (chunk_audio_path, speaker_id) where least(seg_end, 86400) > seg_start"""
)
def w7_relabelled(t):
    return I.relabelled(t("turns"), 86400.0).select("pos", "seg_start", "seg_end", "speaker")


@query("select utt_id, 'SPK_' || left(sha1(chunk_audio_path), 8) || '_' || speaker_id as speaker from segments")
def w8_speaker_names(t):
    return t("segments").select("utt_id", T.speaker_name(F.col("chunk_audio_path"), F.col("speaker_id")).alias("speaker"))


@query(
    """select chunk_audio_path, gap_start, gap_end from (select chunk_audio_path, seg_end as gap_start, lead(seg_start) over (partition by chunk_audio_path order by seg_start, pos) as gap_end from segments)
    where gap_end - gap_start >= 0.5"""
)
def w9_silences(t):
    return I.silences(t("segments"), 0.5)


@query(
    """, e as (select chunk_audio_path, speaker_id, sum(seg_end - seg_start) as seconds, min(struct_pack(s := seg_start, p := pos)) as first from turns group by all)
    select chunk_audio_path, speaker_id, seconds from (select *, row_number() over (partition by chunk_audio_path order by seconds desc, first) as k from e) where k = 1"""
)
def j14_dominant_speaker(t):
    return I.dominant_speaker(t("turns"))


@query(
    """, n as (select *, case when seg_duration < 1 then 0 when seg_duration <= 1.5 then 1 else floor((seg_duration - 1.5) / 0.5 + 1e-9) + 1 end as k from segments where seg_duration <= 30)
    select utt_id, w, seg_start + w * 0.5 as win_start, least(seg_start + w * 0.5 + 1.5, seg_end) as win_end from (select *, unnest(range(cast(k as bigint))) as w from n)"""
)
def q8_embedding_windows(t):
    return I.embedding_windows(t("segments"), 1.5, 0.5).select("utt_id", "w", "win_start", "win_end")


MERGE = """, o as (select *, row_number() over (partition by chunk_audio_path order by pos) as r from segments),
 m as (select chunk_audio_path, r, seg_start as s, seg_end as e, speaker_id as who, 1 as g from o where r = 1 union all
 select o.chunk_audio_path, o.r, case when j then m.s else o.seg_start end, o.seg_end, o.speaker_id, case when j then m.g else m.g + 1 end
 from m join o on o.chunk_audio_path = m.chunk_audio_path and o.r = m.r + 1,
 lateral (select o.speaker_id = m.who and o.seg_start - m.e < 0.8 and o.seg_end - m.s < 30 as j) q)"""


@query(f"{MERGE} select chunk_audio_path, min(s) as seg_start, max(e) as seg_end, min(who) as speaker_id, cast(count(*) as integer) as n_merged from m group by chunk_audio_path, g")
def q1_merge(t):
    return folds.simple_merge(t("segments"))


@query(
    """, x as (select *, row_number() over (partition by chunk_audio_path order by pos) as r, lag(seg_end) over (partition by chunk_audio_path order by pos) as before, max(seg_end) over (partition by chunk_audio_path) as audio from segments where role <> 'system'),
    gf as (select x.utt_id, coalesce(sum(case when h.seg_end is not null and x.before is not null then greatest(0, least(x.seg_start, h.seg_end) - greatest(x.before, h.seg_start)) end), 0) as f from x left join segments h on h.chunk_audio_path = x.chunk_audio_path and h.speaker_id <> x.speaker_id group by 1),
    o as (select x.*, f from x join gf using (utt_id)),
    m as (select chunk_audio_path, r, seg_start as s, seg_end as e, speaker_id as who, seg_duration >= 1 as known, 1 as g, audio from o where r = 1 union all
      select o.chunk_audio_path, o.r, case when j then m.s else o.seg_start end, o.seg_end, o.speaker_id, case when j then m.known else o.seg_duration >= 1 end, case when j then m.g else m.g + 1 end, m.audio
      from m join o on o.chunk_audio_path = m.chunk_audio_path and o.r = m.r + 1,
      lateral (select o.speaker_id = m.who and m.known and o.seg_duration >= 1 and o.seg_start - m.e < 0.8::double and o.seg_end - m.s < 30 and o.f <= 0.1::double as j) q),
    p as (select chunk_audio_path, g, min(s) as s, max(e) as e, min(who) as who, min(audio) as audio from m group by 1, 2),
    h as (select p.chunk_audio_path, g, h.seg_start as s, h.seg_end as e, row_number() over (partition by p.chunk_audio_path, g order by h.seg_start, h.seg_end) as k from p join segments h on h.chunk_audio_path = p.chunk_audio_path and h.speaker_id <> who),
    r as (select chunk_audio_path, g, 0::bigint as k, s as a, e as z from p union all
      select r.chunk_audio_path, r.g, h.k, case when hit and s <= a and a < e and e < z then e else a end, case when hit and a < s and s < z and z <= e then s else z end
      from r join h on h.chunk_audio_path = r.chunk_audio_path and h.g = r.g and h.k = r.k + 1, lateral (select greatest(0, least(z, e) - greatest(a, s)) > 0.1::double as hit) q),
    u as (select chunk_audio_path, g, arg_max(a, k) as a, arg_max(z, k) as z from r group by 1, 2),
    w as (select u.*, s, e, case when e is not null then greatest(0, least(z, e) - greatest(a, s)) end as hit from u left join h using (chunk_audio_path, g)),
    v as (select chunk_audio_path, g, sum(coalesce(hit, 0)) <= 0.1::double or sum(hit) / (z - a) >= 0.8::double as stays from w group by chunk_audio_path, g, a, z),
    b as (select w.*, greatest(a, coalesce(max(e) over (partition by chunk_audio_path, g order by s, e rows between unbounded preceding and 1 preceding), a)) as reach from w join v using (chunk_audio_path, g) where not stays and hit > 0.1::double),
    f as (select chunk_audio_path, reach as a, s as z from b union all select chunk_audio_path, greatest(a, max(e)), z from b group by chunk_audio_path, g, a, z union all select chunk_audio_path, a, z from u join v using (chunk_audio_path, g) where stays),
    l as (select f.*, audio, row_number() over (partition by chunk_audio_path order by a, z) as n from f join (select distinct chunk_audio_path, audio from x) q using (chunk_audio_path) where z - a >= 2),
    y as (select *, least(z + 0.02::double, coalesce(lead(a) over (partition by chunk_audio_path order by n), audio)) as z2 from l),
    c as (select *, greatest(a - 0.08::double, coalesce(lag(z2) over (partition by chunk_audio_path order by n), 0)) as a2 from y)
    select chunk_audio_path, (row_number() over (partition by chunk_audio_path order by n) - 1)::varchar as index, a2 as seg_start, z2 as seg_end from c where z2 - a2 >= 2"""
)
def q1_q5_segmenter(t):
    """The full segmenter with embeddings and other speakers' turns, over all chunks."""
    segs = t("segments").where("role <> 'system'").withColumn("index", F.col("utt_id")).withColumn("audio", F.max("seg_end").over(_chunk()))
    segs = segs.withColumn("embedding", F.when(F.col("seg_duration") >= 1, F.array(F.lit(1.0), (F.col("pos") % 2).cast("double"))))
    p = folds.Segmenting(intra=0.6, block_merge_across_foreign=True, drop_foreign=True, trim_foreign=True, split_foreign=True, enforce_min=True)
    return folds.segment_chunks(segs.select("chunk_audio_path", "pos", "index", "seg_start", "seg_end", "speaker_id", "embedding", "audio"), t("segments"), p).drop("speaker_id")


@query(
    """, s as (select *, row_number() over (partition by chunk_audio_path order by seg_start, seg_end) as i from segments), p as (select chunk_audio_path, min(seg_start) as s, max(seg_end) as e from segments group by 1),
    g as (select a.chunk_audio_path, a.i, b.seg_start - a.seg_end as size, (a.seg_end + b.seg_start) / 2 as mid from s a join s b on b.chunk_audio_path = a.chunk_audio_path and b.i = a.i + 1 where b.seg_start > a.seg_end),
    c as (select chunk_audio_path, mid from (select g.*, row_number() over (partition by chunk_audio_path order by size desc, i) as k, greatest(2, ceil((e - s) / 27)) - 1 as n from g join p using (chunk_audio_path) where e - s >= 30) where k <= n),
    w as (select chunk_audio_path, s as x from p union all select chunk_audio_path, mid from c), q as (select w.chunk_audio_path, x as seg_start, coalesce(lead(x) over (partition by w.chunk_audio_path order by x), e) as seg_end from w join p using (chunk_audio_path))
    select * from q where chunk_audio_path not in (select chunk_audio_path from q where seg_end - seg_start >= 30)"""
)
def q2_cut_long(t):
    return folds.cut_chunks(t("segments"))


#: The other speakers' turns: all segments, heard up to a second and a half before they are.
HEARD = "h as (select chunk_audio_path, seg_start - 1 - pos % 3 / 4.0::double as s, seg_end - 1 - pos % 2 / 2.0::double as e, speaker_id as who from segments)"


def _heard(t):
    s, pos = t("segments"), F.col("pos")
    return s.withColumns({"seg_start": F.col("seg_start") - 1 - pos % 3 / 4.0, "seg_end": F.col("seg_end") - 1 - pos % 2 / 2.0})


@query(
    f""", {HEARD}, o as (select utt_id, seg_start, seg_end, s, e, case when e is not null then greatest(0, least(seg_end, e) - greatest(seg_start, s)) end as hit from segments x left join h on h.chunk_audio_path = x.chunk_audio_path and who is distinct from speaker_id),
    v as (select utt_id, sum(coalesce(hit, 0)) <= 0.1::double or sum(hit) / (seg_end - seg_start) >= 0.6::double as stays from o group by utt_id, seg_start, seg_end),
    b as (select o.*, greatest(seg_start, coalesce(max(e) over (partition by utt_id order by s, e rows between unbounded preceding and 1 preceding), seg_start)) as reach from o join v using (utt_id) where not stays and hit > 0.1::double),
    f as (select utt_id, reach as a, s as z from b union all select utt_id, greatest(seg_start, max(e)), seg_end from b group by utt_id, seg_start, seg_end)
    select utt_id, a as seg_start, z as seg_end from f where z - a >= 1 union all select utt_id, seg_start, seg_end from segments join v using (utt_id) where stays"""
)
def q3_q4_split_around(t):
    """Segments with other speakers' speech cut out of them, dropped, or kept where almost all of it is foreign."""
    return folds.guard_chunks(t("segments"), _heard(t), folds.Segmenting(least=1.0, drop_foreign=True, split_foreign=True, relabel_ratio=0.6))


@query(
    f""", {HEARD}, o as (select x.utt_id, s, e, row_number() over (partition by utt_id order by s, e, who) as k from segments x join h on h.chunk_audio_path = x.chunk_audio_path and who is distinct from speaker_id),
    r as (select utt_id, 0::bigint as k, seg_start as a, seg_end as z from segments union all
      select r.utt_id, o.k, case when hit and s <= a and a < e and e < z then e else a end, case when hit and a < s and s < z and z <= e then s else z end
      from r join o on o.utt_id = r.utt_id and o.k = r.k + 1, lateral (select greatest(0, least(z, e) - greatest(a, s)) > 0.1::double as hit) q)
    select utt_id, arg_max(a, k) as seg_start, arg_max(z, k) as seg_end from r group by utt_id"""
)
def q5_trimmed(t):
    """Segments without the other speakers' speech at their ends, turn by turn."""
    return folds.guard_chunks(t("segments"), _heard(t), folds.Segmenting(trim_foreign=True))


def _chunk():
    from pyspark.sql import Window

    return Window.partitionBy("chunk_audio_path")


@query(
    """, s as (select *, row_number() over (partition by chunk_audio_path order by seg_start, seg_end) - 1 as i from segments),
    g as (select a.chunk_audio_path, a.i, b.seg_start - a.seg_end as gap from s a join s b on b.chunk_audio_path = a.chunk_audio_path and b.i = a.i + 1),
    r as (select chunk_audio_path, 0::bigint as a, max(i) as b from s group by 1 union all
      select chunk_audio_path, h.a, h.b from (select r.chunk_audio_path, unnest([{'a': r.a, 'b': x.m}, {'a': x.m + 1, 'b': r.b}]) as h from r
        join (select r.chunk_audio_path, r.a, r.b, max(struct_pack(gap := g.gap, i := -g.i)).i * -1 as m from r join g on g.chunk_audio_path = r.chunk_audio_path and g.i >= r.a and g.i < r.b group by all) x
        on x.chunk_audio_path = r.chunk_audio_path and x.a = r.a and x.b = r.b
        join s p on p.chunk_audio_path = r.chunk_audio_path and p.i = r.a join s q on q.chunk_audio_path = r.chunk_audio_path and q.i = r.b where q.seg_end - p.seg_start >= 20) y)
    select r.chunk_audio_path, p.seg_start, q.seg_end from r join s p on p.chunk_audio_path = r.chunk_audio_path and p.i = r.a join s q on q.chunk_audio_path = r.chunk_audio_path and q.i = r.b
    where r.a = r.b or q.seg_end - p.seg_start < 20"""
)
def q6_split_turns(t):
    return folds.split_turns(t("segments").select("chunk_audio_path", "seg_start", "seg_end"))


@query(
    """, s as (select chunk_audio_path as source, seg_start, seg_end, row_number() over (partition by chunk_audio_path order by seg_start, seg_end) - 1 as i from turns),
    r as (select source, 0.0::double as t0, 0::bigint as i, null::double as cs, null::double as ce, 'go' as what from (select distinct source from s) q union all
      select source, coalesce(ce, t0), coalesce(best + 1, i), cs, ce, what from (
        select r.source, r.t0, r.i, x.best, case when 90000 - r.t0 <= 7200 or x.best is not null then r.t0 end as cs,
          case when 90000 - r.t0 <= 7200 then 90000.0::double when x.best is not null then least(coalesce((e.seg_end + n.seg_start) / 2, e.seg_end), r.t0 + 7200) end as ce,
          case when 90000 - r.t0 <= 7200 then case when 90000 - r.t0 >= 1800 then 'end' else 'short' end when x.best is null then 'fail' else 'go' end as what
        from r left join (select r.source, r.i, max(struct_pack(d := s.seg_end - s.seg_start, i := -s.i)).i * -1 as best from r join s on s.source = r.source and s.i >= r.i and s.seg_end - r.t0 <= 7200 and s.seg_end - r.t0 >= 1800
          where 90000 - r.t0 > 7200 group by all) x on x.source = r.source and x.i = r.i
        left join s e on e.source = r.source and e.i = x.best left join s n on n.source = r.source and n.i = x.best + 1 where r.what = 'go' and r.t0 < 90000) y)
    select source, cs as chunk_start, ce as chunk_end from r where cs is not null and what <> 'short' and source not in (select source from r where what = 'fail')"""
)
def q7_cut_files(t):
    speech = t("turns").select(F.col("chunk_audio_path").alias("source"), "seg_start", "seg_end", F.lit(90000.0).alias("total"))
    return folds.cut_files(speech, 1800.0, 7200.0)


@query(
    """, u as (select chunk_audio_path, case when pos % 2 = 0 then 'a' else 'b' end as mode, pos, seg_start, seg_end, speaker_id from segments),
    m as (select chunk_audio_path, mode, speaker_id as main from (select chunk_audio_path, mode, speaker_id, row_number() over (partition by chunk_audio_path, mode order by sum(seg_end - seg_start) desc, min(pos)) as k from u group by 1, 2, 3) where k = 1),
    c as (select u.*, row_number() over (partition by chunk_audio_path order by mode, pos) as k from u join m using (chunk_audio_path, mode) where speaker_id <> main and seg_end > seg_start and seg_end - seg_start <= 4),
    r as (select chunk_audio_path, 1::bigint as k, [struct_pack(m := mode, s := seg_start, e := seg_end, w := speaker_id)] as taken from c where k = 1 union all
      select c.chunk_audio_path, c.k, case when len(list_filter(r.taken, lambda x: greatest(0, least(c.seg_end, x.e) - greatest(c.seg_start, x.s)) / (c.seg_end - c.seg_start) >= 0.5)) > 0 then r.taken
        else list_append(r.taken, struct_pack(m := c.mode, s := c.seg_start, e := c.seg_end, w := c.speaker_id)) end from r join c on c.chunk_audio_path = r.chunk_audio_path and c.k = r.k + 1),
    l as (select chunk_audio_path, unnest(taken) as x from r where (chunk_audio_path, k) in (select chunk_audio_path, max(k) from r group by 1))
    select chunk_audio_path, x.m as mode, x.s as seg_start, x.e as seg_end, x.w as speaker_id from l"""
)
def j14_reference_turns(t):
    turns = t("segments").select("chunk_audio_path", F.when(F.col("pos") % 2 == 0, "a").otherwise("b").alias("mode"), "pos", "seg_start", "seg_end", "speaker_id")
    return folds.reference_turns(turns, longest=4.0)


@query("""select coalesce(sum(duration), 0) as seconds, count(*) as matched from manifest where doc_id in (select doc_id from labels)""")
def j1_covered(t):
    m = t("manifest")
    done = m.join(t("labels"), "doc_id", "left_semi").select(F.col("relative_path").alias("source"))
    return J.covered(m, done)


@query("select relative_path from manifest where doc_id not in (select doc_id from labels)")
def j2_not_done(t):
    m = t("manifest")
    done = m.join(t("labels"), "doc_id", "left_semi").select(F.col("relative_path").alias("source"))
    return J.not_done(m, done, "relative_path", "source").select("relative_path")


@query("select chunk_audio_path as source from stage2 group by 1 having bool_or(not coalesce(contains(error, 'asr_access_failed'), false))")
def j3_finished(t):
    return J.finished_sources(t("stage2").withColumn("source", F.col("chunk_audio_path")))


@query("select chunk_audio_path as source from stage2 group by 1 having bool_and(coalesce(contains(error, 'asr_access_failed'), false))")
def j3_pending(t):
    return J.pending_sources(t("stage2").withColumn("source", F.col("chunk_audio_path")))


@query("""select s.utt_id, r.dnsmos, r.snr from (select utt_id from segments order by left(sha1(utt_id), 12), utt_id limit 50) s left join scored r using (utt_id)""")
def j5_recorded(t):
    from loomspark.operators.sampling import smallest

    return J.with_recorded(smallest(t("segments"), 50).select("utt_id"), t("scored"), ["dnsmos", "snr"])


@query("select relative_path as audio_path, case when doc_id % 3 = 0 then 'complete' else 'todo' end as state from manifest")
def j8_sync(t):
    m = t("manifest").select(F.col("relative_path").alias("audio_path"), "doc_id")
    return J.synced(m.where("doc_id % 3 = 0").select("audio_path", F.lit("complete").alias("state")), m.select("audio_path"))


TREES = ", a as (select relative_path, file_size, doc_id::double as mtime, 'x' as md5, doc_id from manifest where doc_id % 7 <> 0), b as (select relative_path, file_size + (case when doc_id % 11 = 0 then 1 else 0 end) as file_size, doc_id + (case when doc_id % 13 = 0 then 5.0::double else 1 end) as mtime, case when doc_id % 17 = 0 then 'y' else 'x' end as md5 from manifest where doc_id % 5 <> 0)"


def trees(t):
    m, d = t("manifest"), F.col("doc_id")
    a = m.where("doc_id % 7 <> 0").select("relative_path", "file_size", d.cast("double").alias("mtime"), F.lit("x").alias("md5"))
    size, late = F.col("file_size") + F.when(d % 11 == 0, 1).otherwise(0), d + F.when(d % 13 == 0, 5.0).otherwise(1.0)
    return a, m.where("doc_id % 5 <> 0").select("relative_path", size.alias("file_size"), late.alias("mtime"), F.when(d % 17 == 0, "y").otherwise("x").alias("md5"))


@query(
    f"""{TREES}, c as (select coalesce(a.relative_path, b.relative_path) as relative_path, case when b.file_size is null then 'missing' when a.file_size is null then 'extra' when a.file_size <> b.file_size then 'size'
    when abs(a.mtime - b.mtime) > 2 then 'mtime' when a.md5 <> b.md5 then 'md5' end as problem from a full join b on a.relative_path = b.relative_path) select * from c where problem is not null"""
)
def j10_verify(t):
    return J.compare_trees(*trees(t))


@query(f"{TREES} select relative_path from a where not exists (select 1 from b where b.relative_path = a.relative_path and b.file_size = a.file_size and abs(a.mtime - b.mtime) <= 2)")
def j9_to_copy(t):
    return J.to_copy(*trees(t)).select("relative_path")


@query(
    """select s.utt_id, count(*) over (partition by s.chunk_audio_path, s.speaker_id) as speaker_rows, f.n as file_rows from segments s join (select chunk_audio_path, count(*) as n from segments group by 1) f using (chunk_audio_path)"""
)
def j17_labels(t):
    s = t("segments")
    by = lambda name, *c: s.groupBy(*c).agg(F.count("*").alias(name))
    return J.with_domains(s, by("speaker_rows", "chunk_audio_path", "speaker_id"), by("file_rows", "chunk_audio_path")).select("utt_id", "speaker_rows", "file_rows")


@query("select utt_id, length(text) as score from segments")
def l14_scored_once(t):
    return J.score_distinct(t("segments").select("utt_id", "text"), "text", lambda d: d.withColumn("score", F.length("text"))).select("utt_id", "score")


@query("select case when doc_id % 4 in (1, 2) then 'todo' when doc_id % 4 = 3 then 'complete' else 'todo' end as state, count(*) as n from manifest group by 1")
def w14_requeued(t):
    state = F.element_at(F.array(*map(F.lit, ("todo", "processing", "failed", "complete"))), (F.col("doc_id") % 4 + 1).cast("int"))
    return J.requeued(t("manifest").withColumn("state", state)).groupBy("state").agg(F.count("*").alias("n"))


@query("""select chunk_audio_path, min(shard) as shard, count(*) as n, sum(seg_end - seg_start) as duration, string_agg(utt_id, ',' order by seg_start, pos) as ids from stage2 where error is null group by 1""")
def s18_next_stage(t):
    from loomspark.sources.readers import next_stage_input

    out = next_stage_input(t("stage2"))
    return out.select("chunk_audio_path", "shard", F.size("payload").cast("long").alias("n"), "duration", F.array_join("payload.utt_id", ",").alias("ids"))


@query("select relative_path from manifest where duration >= 30")
def s19_min_duration(t):
    from loomspark.sources.readers import with_min_duration

    return with_min_duration(t("manifest"), 30).select("relative_path")


@query("select distinct split_part(relative_path, '/', 1) as name from manifest")
def s1_top_names(t):
    from loomspark.sources.readers import top_names

    return top_names(t("manifest"))


@query("select relative_path from manifest where format in ('mp3', 'flac')")
def s2_visible_paths(t):
    from loomspark.sources.readers import visible_paths

    return visible_paths(t("manifest"), ["mp3", "flac"]).select("relative_path")


@query("""select coalesce(a.shard, b.shard) as shard, case when a.shard is not null and b.shard is not null then 'stage1+stage2' when a.shard is not null then 'stage1_only' else 'stage2_only' end as status
from (select distinct shard from segments) a full join (select distinct shard from stage2 where shard <> 'shard-1') b on a.shard = b.shard""")
def s13_shards(t):
    from loomspark.sources.readers import shard_status

    return shard_status(t("segments"), t("stage2").where("shard <> 'shard-1'"))


@query("select relative_path, format as extension, relative_path as short, case when relative_path like 'src1%' then 'disk/' || relative_path when relative_path like 'src%' then 'tape/' || substr(relative_path, 4) else relative_path end as mapped from manifest")
def t9_paths(t):
    p = F.col("relative_path")
    return t("manifest").select("relative_path", T.extension(p).alias("extension"), T.short_path(p).alias("short"), T.rewrite_prefix(p, [("src1", "disk/src1"), ("src", "tape/")]).alias("mapped"))


@query(
    """select utt_id, length(regexp_replace(text, '[,.!?"''，。！？“”‘’ \\t\\n\\r]', '', 'g')) as chars, length(regexp_replace(text, '[,.!?"''，。！？“”‘’ ]', '', 'g')) as loose,
    len(regexp_extract_all(text, '[,.!?;:。、！？；：，…—–\\-]+')) as pauses from segments"""
)
def t1_t3_characters(t):
    x = F.col("text")
    return t("segments").select("utt_id", T.count_chars(x).alias("chars"), T.char_count(x).alias("loose"), T.pause_marks(x).cast("long").alias("pauses"))


@query("select utt_id, case when silences < 0 then silences else greatest(0, silences - len(regexp_extract_all(text, '[,.!?;:。、！？；：，…—–\\-]+'))) end as silences from (select s.*, x.text from stage2 s join segments x using (utt_id))")
def t10_silences(t):
    s = t("stage2").select("utt_id", "silences").join(t("segments").select("utt_id", "text"), "utt_id")
    return s.select("utt_id", T.unexplained_silences(F.col("silences"), F.col("text")).cast("long").alias("silences"))


@query("select utt_id, case when seg_duration > 0 and nch > 0 then nch / seg_duration else -1 end as rate from stage2")
def t11_speaking_rate(t):
    return t("stage2").select("utt_id", T.speaking_rate(F.col("nch"), F.col("seg_duration")).alias("rate"))


@query(
    """, u as (select *, case when language in ('zh', 'ja', 'ko') then length(text) / 4.0::double else len(list_filter(regexp_split_to_array(trim(text), '\\s+'), lambda x: x <> ''))::double end as units from (select s.language, x.utt_id, x.text, s.pos % 5 as errors from stage2 s join segments x using (utt_id)))
    select utt_id, greatest(0.0::double, least(1.0::double, 1 - errors / greatest(units, 1.0::double))) as spell from u"""
)
def t12_spelling(t):
    s = t("stage2").select("utt_id", "language", (F.col("pos") % 5).alias("errors")).join(t("segments").select("utt_id", "text"), "utt_id")
    return s.select("utt_id", T.spell_score(F.col("errors"), F.col("text"), F.col("language")).alias("spell"))


@query("select utt_id, case when pos < 2 then -1.0::double when c50 >= 50 then 1e21::double else 2.0::double end as ppl from scored")
def t13_perplexity(t):
    s = t("scored").select("utt_id", T.perplexity(F.when(F.col("c50") >= 50, F.col("c50")).otherwise(0.0), F.col("pos")).alias("ppl"))
    return s.select("utt_id", F.when(F.col("ppl") == 1, 2.0).otherwise(F.col("ppl")).alias("ppl"))


@query("select utt_id, case when (cid + pos) % 3 = 0 then '{\"ppl\": ' || pos || '}' end as answer, case when (cid + pos) % 3 = 0 then pos end as ppl from segments")
def t14_model_json(t):
    said = F.when((F.col("cid") + F.col("pos")) % 3 == 0, F.concat(F.lit('Sure:\n```json\n{"ppl": '), F.col("pos").cast("string"), F.lit("}\n``` done"))).otherwise("no idea")
    s = t("segments").select("utt_id", T.json_in(said).alias("answer"))
    return s.select("utt_id", "answer", F.get_json_object("answer", "$.ppl").cast("long").alias("ppl"))


@query("select utt_id, left(sha1(text), 8) as short, md5(text) as key from segments")
def t15_hashes(t):
    return t("segments").select("utt_id", T.short_hash(F.col("text")).alias("short"), F.md5("text").alias("key"))


@query("select utt_id, case speaker_id when 'S0' then 'en' else 'yue' end as code, case when speaker_id = 'S0' then 'News' else 'unknown' end as domain from segments")
def t16_labels(t):
    name = F.when(F.col("speaker_id") == "S0", " English ").otherwise("Cantonese")
    return t("segments").select("utt_id", T.language_code(name).alias("code"), T.snap(F.when(F.col("speaker_id") == "S0", " news ").otherwise("x"), ["News", "unknown"]).alias("domain"))


@query(
    """, p as (select a.vec_id as i, b.vec_id as j, a.embedding as x, b.embedding as y from embeddings a join embeddings b on b.vec_id = a.vec_id + 1)
    select i, round(list_dot_product(x::double[], y::double[]) / (sqrt(list_dot_product(x::double[], x::double[])) * sqrt(list_dot_product(y::double[], y::double[]))), 6) as sim from p"""
)
def t18_cosine(t):
    e = t("embeddings").select("vec_id", "embedding")
    n = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return e.join(n, "vec_id").select(F.col("vec_id").alias("i"), F.round(T.cosine(F.col("embedding"), F.col("other")), 6).alias("sim"))


@query(
    """, n as (select relative_path, cast(floor(duration) as bigint) * 100 as s from manifest) select relative_path, case when s >= 86400 then (s // 86400)::varchar || 'd ' || (s % 86400 // 3600)::varchar || 'h ' || (s % 3600 // 60)::varchar || 'm'
    when s >= 3600 then (s // 3600)::varchar || 'h ' || (s % 3600 // 60)::varchar || 'm' else (s // 60)::varchar || 'm' end as text from n"""
)
def t22_durations(t):
    return t("manifest").select("relative_path", T.duration_text(F.floor("duration") * 100).alias("text"))


@query("select utt_id, repeat('█', cast(floor(cid % 11 / 10.0::double * 20) as integer)) || repeat('░', 20 - cast(floor(cid % 11 / 10.0::double * 20) as integer)) as bar from segments")
def t24_bars(t):
    return t("segments").select("utt_id", T.bar((F.col("cid") % 11) / 10.0).alias("bar"))


@query(
    """, m as (select utt_id, cast(floor(seg_start * 1000) as bigint) as ms from segments) select utt_id, printf('%02d:%02d:%02d,%03d', ms // 3600000 % 24, ms // 60000 % 60, ms // 1000 % 60, ms % 1000) as t from m"""
)
def k9_srt_times(t):
    return t("segments").select("utt_id", T.srt_time(F.col("seg_start")).alias("t"))


@query(
    r""", w as (select utt_id, unnest(list_transform(regexp_split_to_array(text, '\s+'), lambda x, i: struct_pack(i := i, w := regexp_replace(lower(x), '[^\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}]', '', 'g')))) as x from segments),
    n as (select utt_id, count(*) filter (x.w <> '') as n, count(*) filter (x.w <> '' and x.i % 5 = 0) as gone from w group by 1), e as (select utt_id, case when n = 0 or n = gone then 1.0::double else gone::double / n end as asr_wer from n)
    select utt_id, asr_wer, asr_wer > 0.18 as dropped_by_asr_validation from e"""
)
def p14_validation(t):
    """Word and character errors of a transcript against itself with every fifth word left out."""
    from loomspark.operators.filters import validate

    s = t("segments").select("utt_id", "chunk_audio_path", "text", "pos").join(t("stage2").select("utt_id", "language"), "utt_id")
    hyp = F.array_join(F.filter(F.split("text", r"\s+"), lambda w, i: i % 5 != 4), " ")
    return validate(s.withColumn("asr_val_text", hyp), 0.18).select("utt_id", "asr_wer", "dropped_by_asr_validation")


@query(
    """, w as (select utt_id, len(list_filter(regexp_split_to_array(trim(text), '\\s+'), lambda x: x <> '')) as n from segments) select utt_id, case when n = 0 then 1.0::double else (n // 5)::double / n end as wer from w"""
)
def t7_wer(t):
    """Leaving out every fifth word costs exactly that many deletions, whatever the words."""
    hyp = F.array_join(F.filter(T.words(F.col("text")), lambda w, i: i % 5 != 4), " ")
    return t("segments").select("utt_id", T.wer(F.col("text"), hyp).alias("wer"))


@query("select chunk_audio_path, count(*) as n, bool_or(pos % 9 = 8) as failed from segments group by 1 having not bool_or(pos % 9 = 8) union all select chunk_audio_path, 1, true from segments group by 1 having bool_or(pos % 9 = 8)")
def o5_whole_files(t):
    from loomspark.operators.filters import whole_files

    s = t("segments").select(F.col("chunk_audio_path").alias("source"), "shard", F.col("pos").alias("chunk_index"), "pos", (F.col("pos") % 9 == 8).alias("failed"), F.lit(None).cast("string").alias("error"))
    return whole_files(s).groupBy(F.col("source").alias("chunk_audio_path")).agg(F.count("*").alias("n"), F.bool_or("failed").alias("failed"))
