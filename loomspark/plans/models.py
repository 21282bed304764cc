"""Scorers over made audio whose right answer SQL can tell, and stub models over texts."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from loomspark.functions import text as T
from loomspark.operators import scorers as M
from loomspark.operators import signal as S
from loomspark.plans.exports import _unit
from loomspark.plans.registry import query
from loomspark.sources.store import wav_bytes

#: Samples as hex digits: silence, a tone of half the rate, a tone of a tenth of it, and faint noise.
QUIET, HIGH, LOW, FAINT = "0000", "004000C0", "0040" * 5 + "00C0" * 5, "5200AEFF"


def _wav(*parts):
    """A mono file of 1000 samples a second from (samples as hex, times)."""
    return wav_bytes(F.unhex(F.concat(*(F.repeat(F.lit(h), n if not isinstance(n, int) else F.lit(n)) for h, n in parts))), 1000)


@query("select utt_id, case when pos % 7 < 6 then (pos % 5 + 1) / 10.0::double end as speech_from, case when pos % 7 < 6 then (pos % 5 + 5) / 10.0::double end as speech_to, case when pos % 7 < 6 then 1 end as spans from segments")
def m1_m3_activity(t):
    """Where speech is in files with a tone between silences, after a separation that fails; files that can't be read have no answer."""
    made = _wav((QUIET, (F.col("pos") % 5 + 1).cast("int") * 100), (HIGH, 200), (QUIET, 310))
    raw = F.when(F.col("pos") % 7 == 6, F.lit(b"no wav")).otherwise(made)
    s = t("segments").select("utt_id", S.separated(raw).alias("raw")).select("utt_id", M.score("energy_vad", F.col("raw")).alias("v"))
    at = lambda c: F.round(F.get("v", F.lit(0))[c], 6)
    return s.select("utt_id", at("start").alias("speech_from"), at("end").alias("speech_to"), F.when(F.col("v").isNotNull(), F.size("v")).alias("spans"))


@query("select utt_id, unnest([0.0::double, 1, 2]) as turn_from, unnest([1.0::double, 2, 2.5]) as turn_to, unnest(['S0', 'S1', 'S0']) as speaker from segments")
def m2_turns(t):
    """Two voices, the first of which comes back."""
    made = _wav((HIGH, 500), (LOW, 100), (HIGH, F.when(F.col("pos") >= 0, 250)))
    s = t("segments").select("utt_id", M.score("band_turns", made).alias("v")).select("utt_id", F.explode("v").alias("v"))
    return s.select("utt_id", F.col("v.start").alias("turn_from"), F.col("v.end").alias("turn_to"), "v.speaker")


@query("select utt_id, 16 as size, true as same, false as other from segments")
def m4_embeddings(t):
    """Two files of a voice are alike, and unlike one of another voice."""
    e = lambda *parts: M.score("band_embedding", _wav(*parts))
    n = (F.col("pos") % 4 + 1).cast("int") * 100
    s = t("segments").select("utt_id", e((HIGH, n)).alias("a"), e((HIGH, 450)).alias("b"), e((LOW, n)).alias("c"))
    return s.select("utt_id", F.size("a").alias("size"), (T.cosine(F.col("a"), F.col("b")) > 0.9).alias("same"), (T.cosine(F.col("a"), F.col("c")) > 0.9).alias("other"))


@query("select utt_id, case when pos % 7 = 6 then -1 else 46 end as snr from segments")
def m5_snr(t):
    """A tone over noise of a two-hundredth of its strength: 46 dB; -1 where there is no file to tell from."""
    raw = F.when(F.col("pos") % 7 == 6, F.lit(b"no wav")).otherwise(_wav((FAINT, 250), (HIGH, F.when(F.col("pos") >= 0, 250))))
    return t("segments").select("utt_id", F.round(M.score("energy_snr", raw)).cast("int").alias("snr"))


@query("select utt_id, array_to_string(list_filter(regexp_split_to_array(trim(text), '\\s+'), lambda w, i: i % 10 <> 0), ' ') as text from segments")
def m6_transcripts(t):
    """What the stub recogniser makes of a text: every tenth word is lost."""
    return t("segments").select("utt_id", M.score("stub_asr", F.col("text")).alias("text"))


@query(f"select utt_id, {_unit('x', 'text').replace(chr(39) + 'x:' + chr(39), 'coalesce(language, chr(63)) || chr(58)')} as score from stage2")
def m7_alignment(t):
    """Texts aligned by the model of their language, one model at a time in each task."""

    def make(language):
        return lambda texts: [int(hashlib.sha1(f"{language or '?'}:{x}".encode()).hexdigest()[:8], 16) / 0xFFFFFFFF for x in texts]

    return M.score_by_language(t("stage2"), "text", "score", "double", make).select("utt_id", "score")


@query(f"select utt_id, ['en', 'fr', 'de'][cast(floor({_unit('l', 'text')} * 2.999) as bigint) + 1] as tag, 1 + cast({_unit('s', 'text')} > 0.9::double as integer) as speakers from segments where text <> ''")
def m10_tags(t):
    s = t("segments").where("text <> ''")
    return s.select("utt_id", M.score("stub_language", F.col("text")).alias("tag"), M.score("stub_speakers", F.col("text")).cast("int").alias("speakers"))


@query("select * from (values ('band_embedding'), ('band_turns'), ('energy_snr'), ('energy_vad'), ('no_separation'), ('stub_alignment'), ('stub_asr'), ('stub_c50'), ('stub_dnsmos'), ('stub_domain'), ('stub_embedding'), ('stub_language'), ('stub_llm'), ('stub_ppl'), ('stub_snr'), ('stub_speakers'), ('stub_spell')) v(name)")
def m11_scorers(t):
    return t("region").sparkSession.createDataFrame([(n,) for n in M.names() if n.split("_")[0] in ("band", "energy", "no", "stub")], "name string")


NORMAL = "trim(regexp_replace(regexp_replace(lower(text), '[^\\p{L}\\p{M}\\p{Nd}\\p{Nl}\\p{Pc}\\s]', '', 'g'), '\\s+', ' ', 'g'))"
BARE = "regexp_replace(text, '[^\\p{L}\\p{M}\\p{Nd}\\p{Nl}\\p{Pc}]', '', 'g')"


@query(f"select utt_id, {NORMAL} as for_words, {BARE} as for_chars from segments")
def t4_t5_normal_texts(t):
    return t("segments").select("utt_id", T.normal_for_wer(F.col("text")).alias("for_words"), T.normal_for_cer(F.col("text")).alias("for_chars"))


@query("select utt_id, case when length(text) = 0 or length(hyp) = 0 then 1.0::double else levenshtein(text, hyp)::double / length(text) end as cer from (select utt_id, left(text, 200) as text, replace(left(text, 200), 'e', 'a') || 'x' as hyp from segments)")
def t6_cer(t):
    ref = F.left("text", F.lit(200))
    return t("segments").select("utt_id", T.cer(ref, F.concat(F.replace(ref, F.lit("e"), F.lit("a")), F.lit("x"))).alias("cer"))


@query("""select utt_id, case pos % 6 when 0 then '<none>' when 1 then '<none>' when 2 then 'asr_access_failed' when 3 then 'task error' when 4 then left('a message without a mark ' || repeat('long ', 20), 40) else left(repeat('kind ', 20), 60) end as kind from segments""")
def t8_error_kinds(t):
    p = F.col("pos") % 6
    error = F.when(p == 0, None).when(p == 1, "").when(p == 2, "remote: asr_access_failed: 503").when(p == 3, " task error : boom: x").when(p == 4, F.concat(F.lit("a message without a mark "), F.repeat(F.lit("long "), F.lit(20))))
    error = error.when(p == 5, F.concat(F.repeat(F.lit("kind "), F.lit(20)), F.lit(": x")))
    return t("segments").select("utt_id", T.classify_error(error).alias("kind"))


@query("select utt_id, greatest(0.0::double, least(seg_end, cid + 5) - greatest(seg_start, cid)) as shared, case when seg_duration < 4 then '<4' when seg_duration < 8 then '4-8' when seg_duration < 15 then '8-15' else '>=15' end as coarse, case when seg_duration < 3 then '0-3' when seg_duration < 5 then '3-5' when seg_duration < 7 then '5-7' when seg_duration < 9 then '7-9' when seg_duration < 12 then '9-12' when seg_duration < 15 then '12-15' else '15+' end as fine from segments")
def t19_t25_overlaps_and_buckets(t):
    at = F.col("cid").cast("double")
    return t("segments").select("utt_id", T.overlap(F.col("seg_start"), F.col("seg_end"), at, at + 5).alias("shared"), T.bucket(F.col("seg_duration"), *T.COARSE).alias("coarse"), T.bucket(F.col("seg_duration"), *T.FINE).alias("fine"))
