"""What sources and sinks do, as queries: tables are written to the shared folder in each format, read back and reported on."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from loomspark import schemas
from loomspark.functions import text as T
from loomspark.operators import joins as J
from loomspark.operators import sampling as L
from loomspark.operators import scheduling as H
from loomspark.operators import scorers as M
from loomspark.plans.registry import query
from loomspark.sources import readers as R
from loomspark.sources import store
from loomspark.sources import writers as K
from loomspark.streaming import pipeline
from loomspark.streaming.pipeline import shared_folder

MANIFEST = "select relative_path, duration, file_size, format from manifest"


def _place(t):
    spark = t("region").sparkSession
    return spark, shared_folder(spark)


def _manifest(t):
    return t("manifest").select("relative_path", "duration", "file_size", "format")


@query("select 'format=' || format as top, 1::bigint as n from manifest group by format")
def s3_top_dirs(t):
    """Files below each first-level folder of a tree."""
    spark, at = _place(t)
    _manifest(t).repartition(1).write.partitionBy("format").parquet(at)
    return R.expanded(spark, at, ["parquet"]).groupBy("top").agg(F.count("*").alias("n"))


@query("select 'csv' as ext, 1::bigint as n union all select 'json', 1")
def s4b_s20_by_extension(t):
    """A folder of several kinds of files as the input of a batch, by extension."""
    spark, at = _place(t)
    m = _manifest(t).coalesce(1)
    m.write.csv(f"{at}/a")
    m.write.json(f"{at}/b")
    m.write.parquet(f"{at}/c")
    found = R.files(spark, at, ["csv"]).unionByName(R.files(spark, at, ["json"]))
    return found.where("file_size > 0").groupBy(T.extension(F.col("relative_path")).alias("ext")).agg(F.count("*").alias("n"))


@query("select case when doc_id % 5 = 4 then 'x/' else 'skip.d/' end || relative_path as relative_path from manifest where doc_id % 5 in (3, 4) and format in ('mp3', 'wav', 'flac', 'm4a')")
def s5_pruned_paths(t):
    d, p = F.col("doc_id") % 5, F.col("relative_path")
    name = F.regexp_replace(p, "^.*/", "")
    odd = F.when(d == 0, F.concat(F.lit("skip/"), p)).when(d == 1, F.concat(F.lit("x/~"), name)).when(d == 2, F.concat(F.lit("x/"), p, F.lit(".temp.wav"))).when(d == 3, F.concat(F.lit("skip.d/"), p)).otherwise(F.concat(F.lit("x/"), p))
    return R.pruned_paths(t("manifest").select(odd.alias("relative_path")), ["skip"])


@query("select format in ('mp3', 'wav') as taken, count(*) as n from manifest group by 1")
def s6_file_list(t):
    """A text file of paths; how many are taken and how many passed over."""
    spark, at = _place(t)
    t("manifest").select(F.concat(F.lit(" "), "relative_path")).write.text(at)
    return R.file_list(spark, at, ["mp3", "wav"]).groupBy("taken").agg(F.count("*").alias("n"))


@query(MANIFEST)
def s7_csv_manifest(t):
    spark, at = _place(t)
    _manifest(t).write.csv(at, header=True)
    return R.csv_manifest(spark, at).select("relative_path", F.col("duration").cast("double").alias("duration"), F.col("file_size").cast("long").alias("file_size"), "format")


@query("select relative_path, format from manifest")
def s8_s9_parquet_manifest(t):
    """Two of a manifest's columns: the others aren't read."""
    spark, at = _place(t)
    K.sharded(_manifest(t), at)
    return R.parquet_table(spark, at, schemas.MANIFEST, ["relative_path", "format"])


@query("select 'm/manifest_part-' || printf('%05d', doc_id) || '.parquet' as relative_path, doc_id as part from documents where doc_id % 3 = 0")
def s10_shards(t):
    kind = F.when(F.col("doc_id") % 3 == 0, "manifest_part-").when(F.col("doc_id") % 3 == 1, "paths_part-").otherwise("manifest-")
    return R.shards(t("documents").select(F.concat(F.lit("m/"), kind, F.format_string("%05d", F.col("doc_id")), F.lit(".parquet")).alias("relative_path")), "manifest")


@query("select format, count(*) as n_rows from manifest group by format")
def s11_part_rows(t):
    """Rows of each part from the files' footers; one part for each format here."""
    spark, at = _place(t)
    _manifest(t).repartition(1).write.partitionBy("format").parquet(at)
    return R.part_rows(spark, at).select(F.regexp_extract("part", "format=([^/]+)/", 1).alias("format"), "n_rows")


@query("select relative_path, duration, cast(null as bigint) as file_size, cast(null as varchar) as format from manifest")
def s12_tolerant_read(t):
    """Parts without a column give nulls for it, and a part that is no parquet file is counted with no row."""
    spark, at = _place(t)
    t("manifest").select("relative_path", "duration").write.parquet(at)
    return R.parquet_table(spark, at, schemas.MANIFEST)


@query("select false as readable, 1::bigint as parts, 0::bigint as n_rows union all select true, 1, count(*) from manifest")
def s12_bad_parts(t):
    spark, at = _place(t)
    _manifest(t).coalesce(1).write.parquet(at)
    store.put(spark, f"{at}/torn.parquet", b"PAR1 and no more")
    parts = R.bad_parts(spark, at, schemas.MANIFEST)
    return parts.groupBy((F.col("n_rows") > 0).alias("readable")).agg(F.count("*").alias("parts"), F.sum("n_rows").alias("n_rows"))


@query("select 'jsons/' || chunk_audio_path || '.json' as sidecar, utt_id from segments where pos = 0")
def s16_sidecar_paths(t):
    s = t("segments").where("pos = 0")
    return s.select(R.sidecar_path(F.concat(F.lit("audios/"), "chunk_audio_path", F.lit(".wav"))).alias("sidecar"), "utt_id")


@query("select chunk_audio_path, utt_id, speaker_id, seg_start, seg_end, seg_duration, round(dnsmos, 4) as dnsmos from scored")
def s17_sidecars(t):
    """Sidecars written as JSON and read back, a row for each sentence."""
    spark, at = _place(t)
    K.sidecar(t("scored")).select("json").write.text(at)
    return R.sidecars(spark, at, lines=True).select("chunk_audio_path", "utt_id", "speaker_id", "seg_start", "seg_end", "seg_duration", "dnsmos")


@query("select relative_path as audio_path, duration as audio_duration_second, format as relative_path from manifest")
def s21_podcasts(t):
    spark, at = _place(t)
    rows = F.to_json(F.collect_list(F.struct(F.col("relative_path").alias("audio_path"), F.col("duration").alias("audio_duration_second"), F.col("format").alias("relative_path"))))
    t("manifest").groupBy("format").agg(rows.alias("json")).repartition("format").select("json").write.option("maxRecordsPerFile", 1).text(at)
    return R.podcasts(spark, at)


WAV_RATE = 1000


def _wavs(t):
    """A stereo file for each segment, pos * 10 + 37 frames long, its left channel at a half and its right at zero."""
    frames = (F.col("pos") * 10 + 37).cast("int")
    return t("segments").select("utt_id", "pos", store.wav_bytes(F.unhex(F.repeat(F.lit("00400000"), frames)), WAV_RATE, 2).alias("raw"))


@query("select utt_id, case when pos % 7 = 6 then 0 else (pos * 10 + 37) / 1000.0::double end as seconds from segments")
def s25_t26_wav_seconds(t):
    """Seconds told by headers, 0 for files that can't be read."""
    raw = F.when(F.col("pos") % 7 == 6, F.lit(b"RIFF and no more")).otherwise(F.col("raw"))
    return _wavs(t).select("utt_id", M.wav_duration(raw).alias("seconds"))


@query("select utt_id, greatest(0, least(pos * 10 + 37, 60) - 20) as n, case when pos * 10 + 37 > 20 then 0.25::double end as mean, case when pos * 10 + 37 > 20 then round(0.25 * power(10, -0.15::double), 6) end as loud from segments")
def s23_s24_t20_clips(t):
    """Mono samples of 20 to 60 ms of each file, and what is left of them when loudness may change by 3 dB."""

    @F.pandas_udf("n int, mean double, loud double")
    def clipped(raw: pd.Series) -> pd.DataFrame:
        out = []
        for x in raw:
            rate, channels, _, data = M.wav(x)
            some = M.clip(M.decode_pcm(data, channels), rate, 0.02, 0.06)
            loud = M.normalised(some)
            out.append((len(some), sum(some) / len(some) if some else None, round(sum(loud) / len(loud), 6) if loud else None))
        return pd.DataFrame(out, columns=["n", "mean", "loud"])

    return _wavs(t).select("utt_id", clipped("raw").alias("c")).select("utt_id", "c.*")


@query("select n_rows, count(*) as parts from (select least(100, n - k * 100) as n_rows from (select count(*) as n from manifest) q, unnest(range(0, (n + 99) // 100)) r(k)) group by 1")
def k1_sharded(t):
    """A hundred rows a part at most."""
    spark, at = _place(t)
    K.sharded(_manifest(t).coalesce(1), at, rows=100)
    return R.part_rows(spark, at).groupBy("n_rows").agg(F.count("*").alias("parts"))


@query("select relative_path, format from manifest")
def k2_paths(t):
    spark, at = _place(t)
    K.paths(t("manifest"), at)
    return R.parquet_table(spark, at, schemas.PATHS)


@query("select shard, utt_id, seg_end - seg_start as seconds from segments where shard <> 'shard-1'")
def k4_by_shard(t):
    """Segments partitioned by shard: a shard that isn't asked for isn't read."""
    spark, at = _place(t)
    K.sharded(t("segments").select("utt_id", "shard", "seg_start", "seg_end"), at, by="shard")
    return spark.read.parquet(at).where("shard <> 'shard-1'").select("shard", "utt_id", (F.col("seg_end") - F.col("seg_start")).alias("seconds"))


@query(
    """, g as (select shard, count(*) as n from segments group by shard), l as (select shard as k, '| ' || shard || ' | ' || n || ' |' as line from g union all select '!', '## shards' union all select '!!', '| shard | n |' union all select '!!!', '|---|---|')
    select row_number() over (order by k) as at, line from l"""
)
def k11_report(t):
    """A report of a small table, its lines in order."""
    spark = t("region").sparkSession
    text = K.report({"shards": t("segments").groupBy("shard").agg(F.count("*").alias("n")).orderBy("shard")}, thousands="")
    return spark.createDataFrame([(i, x) for i, x in enumerate((x for x in text.split("\n") if x), 1)], "at long, line string")


@query("select * from (values ('n_rows', false), ('hf_token', true), ('API_KEY', true), ('nested.secret', true), ('path', false)) v(name, refused)")
def k12_secrets(t):
    def refused(payload: dict) -> bool:
        try:
            K.refuse_secrets(payload)
        except ValueError:
            return True
        return False

    keys = {"n_rows": {"n_rows": 1}, "hf_token": {"hf_token": 1}, "API_KEY": {"API_KEY": 1}, "nested.secret": {"a": [{"secret": 1}]}, "path": {"path": 1}}
    return t("region").sparkSession.createDataFrame([(k, refused(v)) for k, v in keys.items()], "name string, refused boolean")


@query("select s.chunk_audio_path, row_number() over (partition by s.chunk_audio_path order by s.pos) as at, s.utt_id, case when s.pos % 3 <> 2 then language end as language from segments s join stage2 using (utt_id)")
def k13_write_back(t):
    """Results merged into the sentences of their chunks by id; sentences without a result stay, in place."""
    chunks = t("segments").groupBy("chunk_audio_path").agg(F.array_sort(F.collect_list(F.struct("pos", "utt_id"))).alias("sentences"))
    done = J.write_back(chunks, t("stage2").where("pos % 3 <> 2").select("utt_id", "language"), ["language"])
    return done.select("chunk_audio_path", F.posexplode("sentences").alias("at", "s")).select("chunk_audio_path", (F.col("at") + 1).cast("long").alias("at"), "s.utt_id", "s.language")


VERDICT = "id string, kind string, similarity double"


def _verdicts(t, at):
    """Two batches of verdicts appended as JSON lines, and a last line that is torn."""
    spark = t("region").sparkSession
    v = t("scored").select(F.col("utt_id").alias("id"), F.lit("segment").alias("kind"), F.col("speaker_min_similarity").alias("similarity"), "pos")
    K.as_json_lines(v.where("pos % 4 = 0").drop("pos"), at)
    K.as_json_lines(v.where("pos % 4 = 1").drop("pos"), at)
    store.put(spark, f"{at}/part-torn.json", b'{"id": "x", "kind": "segm')
    return R.json_lines(spark, at, VERDICT)


@query("select utt_id as id, 'segment' as kind, speaker_min_similarity as similarity from scored where pos % 4 < 2")
def k14_x3_verdicts(t):
    return _verdicts(t, _place(t)[1])


@query("select utt_id from segments where pos % 4 >= 2")
def j6_uncached(t):
    """Segments that have no verdict yet."""
    return J.not_done(t("segments"), _verdicts(t, _place(t)[1]), "utt_id", "id").select("utt_id")


@query("select 1::double as ts, 3::bigint as stage1_done_files union all select 2, 5 union all select 3, 8")
def x2_history(t):
    """The monitor's history in order of time; torn lines are passed over."""
    spark, at = _place(t)
    store.put(spark, f"{at}/a.json", b'{"ts": 3, "stage1_done_files": 8}\n{"ts": 1, "stage1_done_files": 3}\n{"ts": 4, "stage1_do')
    store.put(spark, f"{at}/b.json", b'{"ts": 2, "stage1_done_files": 5}\n')
    return R.history(spark, at).select("ts", "stage1_done_files")


@query("select 'whole' as state, count(*) as n from segments union all select 'backup', count(*) - 1 from segments union all select 'none', -1")
def k15_x8_state(t):
    """State saved twice; the second time's is read, the first time's once the file is torn, a default where there is none."""
    spark, at = _place(t)
    n = t("segments").count()
    store.save_state(spark, f"{at}/state.json", {"n": n - 1})
    store.save_state(spark, f"{at}/state.json", {"n": n})
    whole = store.load_state(spark, f"{at}/state.json")["n"]
    store.put(spark, f"{at}/state.json", b'{"n": ')
    backup = store.load_state(spark, f"{at}/state.json")["n"]
    none = store.load_state(spark, f"{at}/other.json", {"n": -1})["n"]
    return spark.createDataFrame([("whole", whole), ("backup", backup), ("none", none)], "state string, n long")


@query("select format, count(*) as n, cast(coalesce(sum(duration), 0) as double) as seconds, count(*) filter (doc_id % 2 = 1) as sized from (select format, doc_id, case when doc_id % 2 = 0 then duration end as duration from manifest) group by format")
def k16_view(t):
    """SQL over a view of parquet files whose columns differ."""
    spark, at = _place(t)
    m = t("manifest")
    m.where("doc_id % 2 = 0").select("format", "duration").write.parquet(f"{at}/a")
    m.where("doc_id % 2 = 1").select("file_size", "format").write.parquet(f"{at}/b")
    R.view(spark, "corpus_files", at)
    return spark.sql("select format, count(*) as n, coalesce(sum(duration), 0D) as seconds, count(file_size) as sized from corpus_files group by format")


@query("select * from (values ('again', 'there', 3::bigint), ('first', 'copied', 3::bigint), ('first', 'missing', 1::bigint), ('later', 'copied', 1::bigint), ('later', 'there', 3::bigint)) v(run, status, n)")
def k18_copies(t):
    """A tree copied, copied again, and again with a file more: what each run did."""
    spark, at = _place(t)
    for i in range(4):
        store.put(spark, f"{at}/src/d{i % 2}/f{i}.txt", b"x" * (1000 * i + 1))
    plan = R.files(spark, f"{at}/src").where("relative_path not like '%f3.txt'")
    lost = spark.createDataFrame([("d9/none.txt", 5)], "relative_path string, file_size long")
    runs = []
    for name, todo in (("first", plan.select("relative_path", "file_size").union(lost)), ("again", plan), ("later", R.files(spark, f"{at}/src"))):
        done = store.copied(todo, f"{at}/src", f"{at}/dst").select(F.lit(name).alias("run"), "status")
        done.write.mode("append").parquet(f"{at}/log")
        runs.append(name)
    assert {r[0] for r in J.compare_trees(*(R.files(spark, f"{at}/{d}").select("relative_path", "file_size", F.lit(0.0).alias("mtime"), F.lit("").alias("md5")) for d in ("src", "dst"))).collect()} == set()
    return spark.read.parquet(f"{at}/log").groupBy("run", "status").agg(F.count("*").alias("n"))


@query("select doc_id, max(i) as n from (select doc_id, text, unnest(range(0, least(length(text), 64) + 1)) as i from documents) where strlen(left(text, i)) <= 64 group by doc_id")
def k19_messages(t):
    """How many characters of each text a message of 64 bytes can hold."""
    return t("documents").where("text is not null").select("doc_id", F.length(K.shortened(F.col("text"), 64)).cast("long").alias("n"))


@query("select 'info' as level, 'done ' || utt_id as message, shard, pos from segments")
def k20_log_lines(t):
    spark, at = _place(t)
    s = t("segments").select("utt_id", "shard", "pos")
    K.log_lines(s.select("shard", "pos", "utt_id"), "info", F.concat(F.lit("done "), "utt_id")).write.text(at)
    return spark.read.schema("level string, message string, shard string, pos long").json(at)


@query("select utt_id, pos % 3 = 0 as dropped_by_alignment from segments")
def p15_marked(t):
    s = t("segments").select("utt_id", "pos")
    return H.marked_dropped(s, s.where("pos % 3 <> 0"), "dropped_by_alignment").select("utt_id", "dropped_by_alignment")


@query("select relative_path, case when file_size > 2000 then 'oversized' when duration > 100 then 'long' when duration < 10 then 'too_short' end as why from manifest")
def p19_guards(t):
    return t("manifest").select("relative_path", H.file_guard(F.col("file_size"), F.col("duration"), 2000, 100, 10).alias("why"))


@query("select relative_path, (row_number() over (partition by format order by relative_path) - 1) // 25 * 25 as low from manifest")
def w5_row_buckets(t):
    out = L.folder_of(t("manifest"), 25, by="format")
    return out.select("relative_path", F.regexp_extract("folder", "/([0-9]+)_", 1).cast("long").alias("low"))


@query("select conv_id from (select distinct conv_id from conversations) order by left(sha1(conv_id::varchar), 12), conv_id::varchar limit 20")
def l7_episodes(t):
    """Twenty conversations, the same in every run."""
    ids = t("conversations").select("conv_id").distinct().withColumn("id", F.col("conv_id").cast("string"))
    return L.smallest(ids, 20, "id").select("conv_id")


@query("select utt_id, md5('7:' || utt_id) as key from segments")
def l8_dispatch_order(t):
    return t("segments").select("utt_id", H.dispatch_key(F.col("utt_id"), "7").alias("key")).orderBy("key")


@query(
    """, w as (select relative_path, doc_id, file_size * 500000 as size, cast('0x' || left(md5(relative_path), 8) as bigint) / 4294967296.0::double as part from manifest)
    select relative_path, round(case when doc_id % 9 = 0 then 1 + 2 * part when size > 524288000 then 20 + 40 * part when size > 209715200 then 15 + 25 * part when size > 52428800 then 5 + 10 * part else 1 + 3 * part end, 6) as seconds from w"""
)
def t29_jitter(t):
    size = F.when(F.col("doc_id") % 9 != 0, F.col("file_size") * 500000)
    return t("manifest").select("relative_path", F.round(H.jitter(size, F.col("relative_path")), 6).alias("seconds"))


@query("select * from (select c_custkey, case when contains(lower(c_name), '7') then 'big' when contains(lower(c_name), 'customer#0') then 'small' end as profile from customer)")
def o7_profiles(t):
    return t("customer").select("c_custkey", H.profile_of(F.col("c_name"), [("big", "7"), ("small", "CUSTOMER#0")]).alias("profile"))


@query(
    """, k as (select relative_path as audio_path, duration, case doc_id % 4 when 0 then 'complete' when 1 then 'failed' else 'processing' end as state from manifest)
    select state, count(*) as n, sum(duration) / 3600 as hours from k group by state"""
)
def o10_ledger(t):
    """A round of the scheduler: what was begun, what came back, and the totals."""
    m, d = t("manifest"), F.col("doc_id") % 4
    tasks = m.select(F.col("relative_path").alias("audio_path"), "duration", F.lit("processing").alias("state"), F.lit(None).cast("string").alias("error"))
    results = m.where(d < 2).select(F.col("relative_path").alias("audio_path"), F.when(d == 1, "boom").alias("error"))
    return H.ledger_totals(H.ledger_step(tasks, results))


@query("select relative_path as audio_path, case when format = 'mp3' then 'FAILURE' else 'SUCCESS' end as pipeline_status, case when format = 'mp3' then 'no decoder' end as error_msg from manifest union all select relative_path, 'FAILURE_INIT', 'no model' from manifest where format = 'wav'")
def x7_batch_status(t):
    def make():
        def work(path: str) -> None:
            if path.endswith(".mp3"):
                raise OSError("no decoder")

        return work

    def broken():
        raise OSError("no model")

    m = t("manifest").select(F.col("relative_path").alias("audio_path"), "format")
    return H.run_tasks(m, make).union(H.run_tasks(m.where("format = 'wav'"), broken))


@query("select * from (values ('merge_gap', '0.8'), ('min_segment_length', '3.0'), ('target_sample_rate', '16000'), ('metrics_strategy', 'average')) v(name, value)")
def x9_parameters(t):
    old = {"strategy_parameters": {"merge_gap": 0.8, "no_such": 1}, "entrypoint": {"SAMPLE_RATE": 16000}, "api": {"token": "x"}}
    got = {k: str(v) for k, v in H.parameters(old).items() if k in ("merge_gap", "min_segment_length", "target_sample_rate", "metrics_strategy")}
    return t("region").sparkSession.createDataFrame(list(got.items()), "name string, value string")


IN = "source string, shard string, pos long, seconds double, error string"
OUT = "source string, shard string, n long, seconds double, error string"


def _stages():
    from pyspark.sql.types import _parse_datatype_string as parsed

    def first(df):
        ok = df.where("pos % 5 <> 4")
        return ok.groupBy("source", "shard").agg(F.count("*").alias("n"), F.sum("seconds").alias("seconds"), F.max("error").alias("error"))

    second = lambda df: df.withColumn("seconds", F.col("seconds") / 2)
    return pipeline.Stage("cut", parsed(IN), parsed(OUT), first), pipeline.Stage("score", parsed(OUT), parsed(OUT), second, only_valid=True)


def _source(t, folder):
    s = t("segments").select(F.col("chunk_audio_path").alias("source"), "shard", F.col("pos").cast("long").alias("pos"), F.col("seg_duration").alias("seconds"), F.lit(None).cast("string").alias("error"))
    s = s.withColumn("pos", F.when(F.col("shard") == "shard-2", 4).otherwise(F.col("pos")))
    s.write.parquet(folder)


@query(
    """, a as (select chunk_audio_path as source, shard, count(*) as n, sum(seg_duration) as seconds from segments where shard <> 'shard-2' and pos % 5 <> 4 group by all),
    f as (select distinct chunk_audio_path as source, shard from segments where shard = 'shard-2')
    select 1 as stage, source, shard, n, seconds, cast(null as varchar) as error from a union all select 1, source, shard, null, null, 'no_segments' from f union all select 2, source, shard, n, seconds / 2, null from a"""
)
def k5_o1_o4_two_stages(t):
    """Two stages as file streams, run to the end, then once more: nothing is done twice, and empty files are recorded as errors."""
    spark, at = _place(t)
    first, second = _stages()
    _source(t, f"{at}/in")
    for _ in range(2):
        pipeline.start(spark, first, f"{at}/in", f"{at}/one", f"{at}/c1").awaitTermination()
        pipeline.start(spark, second, f"{at}/one", f"{at}/two", f"{at}/c2").awaitTermination()
    read = lambda name, k: spark.read.schema(second.writes).parquet(f"{at}/{name}").select(F.lit(k).alias("stage"), "source", "shard", "n", "seconds", "error")
    return read("one", 1).union(read("two", 2))


@query("select 'cut' as stage, count(*) as n from segments")
def o9_progress(t):
    """Rows that a stage's query reports to have read."""
    spark, at = _place(t)
    first, _ = _stages()
    _source(t, f"{at}/in")
    q = pipeline.start(spark, first, f"{at}/in", f"{at}/one", f"{at}/c1")
    q.awaitTermination()
    done = pipeline.progress(q)
    return spark.createDataFrame([(done["stage"], done["rows"])], "stage string, n long")


@query("select event_type, count(*) as n, max(event_id) as last_id from events group by event_type")
def o11_monitor(t):
    """A monitor's snapshot kept up to date by a stream, each batch's replacing the one before."""
    from loomspark.plans.streams import events_of

    spark = t("events").sparkSession
    return pipeline.drained(events_of(spark, t("events")).groupBy("event_type").agg(F.count("*").alias("n"), F.max("event_id").alias("last_id")), "complete")


@query(
    """, a as (select chunk_audio_path as source, shard, count(*) as n from segments where shard <> 'shard-2' and pos % 5 <> 4 group by all)
    select source, shard, n, cast(null as varchar) as error from a union all select distinct chunk_audio_path, shard, null::bigint, 'no_segments' from segments where shard = 'shard-2'"""
)
def x6_one_shard_at_a_time(t):
    """One stage, drained shard by shard; a shard that is asked for again adds nothing."""
    spark, at = _place(t)
    first, _ = _stages()
    _source(t, f"{at}/in")
    pipeline.drain_shards(first, spark.read.schema(first.reads).parquet(f"{at}/in"), f"{at}/one")
    pipeline.drain_shards(first, spark.read.schema(first.reads).parquet(f"{at}/in").where("shard = 'shard-1'"), f"{at}/one", epoch=100)
    return spark.read.schema(first.writes).parquet(f"{at}/one").select("source", "shard", "n", "error")
