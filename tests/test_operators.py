"""Small hand cases of filters, joins, sources, sinks, scorers and streams."""

import json
import math

import pytest
from pyspark.sql import functions as F

from loomspark import schemas
from loomspark.functions import text as T
from loomspark.operators import aggregates as A
from loomspark.operators import filters as P
from loomspark.operators import joins as J
from loomspark.operators import sampling as L
from loomspark.operators import scorers as M
from loomspark.sources import readers as R
from loomspark.sources import writers as K
from loomspark.streaming import pipeline


def values(spark, expr, rows, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x"))).collect()]


def test_text(spark):
    assert values(spark, T.count_chars, ["a b,c!\n", None, "你好，"]) == [3, 0, 2]
    assert values(spark, T.char_count, ["a b,c!\n", "\t"]) == [4, 1]
    assert values(spark, T.pause_marks, ["a, b... c", "", None]) == [2, 0, 0]
    assert values(spark, T.normal_for_wer, ["It's  Ｆｉｎｅ, ДА!", ""]) == ["its fine да", ""]
    assert values(spark, T.normal_for_cer, ["A b,Ｃ"]) == ["AbC"]
    assert values(spark, T.classify_error, [None, "", "asr_access_failed: x", " boom : y", "z" * 50]) == ["<none>", "<none>", "asr_access_failed", "boom", "z" * 40]
    assert values(spark, T.extension, ["a/b.MP3", ".bashrc", "x.d/y", "a.tar.gz", "dir/.x.wav"]) == ["mp3", "", "", "gz", "wav"]
    assert values(spark, T.duration_text, [156960.0, 3600.0, 59.0, None, -1.0], "double") == ["1d 19h 36m", "1h 0m", "0m", "N/A", "N/A"]
    assert values(spark, T.srt_time, [0.0, 3661.5, 90000.25], "double") == ["00:00:00,000", "01:01:01,500", "01:00:00,250"]
    assert values(spark, T.json_in, ['ok ```json\n{"a": 1}\n```', "none"]) == ['{"a": 1}', None]
    assert values(spark, T.short_path, ["a/b/c/d", "x"]) == ["b/c/d", "x"]
    assert values(spark, T.retention, ["retained: 42.5%", "nothing"]) == [42.5, None]
    assert values(spark, T.file_id, ["it's \"a b\""]) == ["itsab"]
    assert values(spark, R.safe_path, ["a/b", "/a", "../a", "a/../../b", "a/../b"]) == ["a/b", None, None, None, "a/../b"]
    assert values(spark, lambda x: T.bucket(x, *T.COARSE), [0.0, 4.0, 14.9, 15.0, None], "double") == ["<4", "4-8", "8-15", ">=15", None]


def test_error_rates(spark):
    rows = [("the cat sat on mat", "the cat sit mat"), ("a b", "a b"), ("", "x"), ("x", "")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string").orderBy("i")
    assert [r[0] for r in df.select(T.wer(F.col("a"), F.col("b"))).collect()] == [0.4, 0.0, 1.0, 1.0]
    assert [r[0] for r in df.select(T.cer(F.col("a"), F.col("b"))).collect()][1:] == [0.0, 1.0, 1.0]


def test_scores_below_zero_never_drop(spark):
    assert values(spark, lambda x: P.outside(x, 0.5, 2.0), [-1.0, -420.69, 0.0, 0.5, 2.0, 2.1, None], "double") == [False, False, True, False, False, True, False]
    assert values(spark, lambda x: P.outside(x), [0.0], "double") == [False]


def test_kept_and_reasons(spark):
    rows = [(None, None, None), ("", False, None), ("boom", False, None), (None, True, None), (None, None, 5000.0)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, error string, dropped_by_silence boolean, ppl double")
    for f in schemas.FLAGS[1:]:
        df = df.withColumn(f, F.lit(None).cast("boolean"))
    assert [r[0] for r in df.orderBy("i").select(P.kept()).collect()] == [True, True, False, False, True]
    assert [r[0] for r in df.orderBy("i").select(P.text_quality_reason(ppl=100)).collect()] == [None, None, None, None, "ppl"]


def test_cascade_flags_one_reason(spark):
    df = spark.createDataFrame([(None, 100.0, 9, 0.1, 9999.0), ("x", 100.0, 9, 0.1, 9999.0), (None, -1.0, -1, -1.0, -1.0)], "error string, speaking_rate double, silences int, alignment_score double, ppl double")
    got = P.cascade(df, (4.0, 60.0), 1, 0.55, 1000.0).select(*schemas.FLAGS).collect()
    assert [sum(r) for r in got] == [1, 0, 0]
    assert [sum(r) for r in P.cascade(df, None, None, None, None).select(*schemas.FLAGS).collect()] == [0, 0, 0]


def test_resume(spark):
    df = spark.createDataFrame([("a", "asr_access_failed: x"), ("a", None), ("b", "asr_access_failed"), ("c", "")], "source string, error string")
    assert {r[0] for r in J.finished_sources(df).collect()} == {"a", "c"} and {r[0] for r in J.pending_sources(df).collect()} == {"b"}


def test_write_back(spark):
    chunks = spark.createDataFrame([("c", [("u1", 1.0), ("u2", 2.0)]), ("d", [("u3", 3.0)])], "chunk_audio_path string, sentences array<struct<utt_id:string,start:double>>")
    res = spark.createDataFrame([("u2", "hello")], "utt_id string, text string")
    got = {r[0]: [tuple(s) for s in r[1]] for r in J.write_back(chunks, res, ["text"]).collect()}
    assert got == {"c": [("u1", 1.0, None), ("u2", 2.0, "hello")], "d": [("u3", 3.0, None)]}


def test_samples_nest(spark):
    df = spark.range(200).selectExpr("cast(id as string) as utt_id", "id % 3 as shard")
    ids = lambda n: {r[0] for r in L.smallest(df, n, by="shard").select("utt_id").collect()}
    assert ids(5) < ids(9) and len(ids(9)) == 27 and len(ids(0)) == 200


def test_allocation(spark):
    g = spark.createDataFrame([(0, "a", 3), (1, "b", 10), (2, "c", 7)], "pos int, name string, available long")
    assert [tuple(r)[2] for r in L.allocated(g, 100).collect()] == [3, 10, 7] and sum(r["take"] for r in L.allocated(g, 11).collect()) == 11
    assert L.allocated(g.limit(0), 5).count() == 0


def test_histogram_merges_and_percentile(spark):
    df = spark.createDataFrame([(float(x),) for x in [-5, 0, 1, 2, 3, 9, 10, 99]], "v double")
    h = A.histogram(df, "v", 0.0, 10.0, 10)
    assert {r["bin"]: r["n"] for r in h.collect()} == {-1: 1, 0: 1, 1: 1, 2: 1, 3: 1, 9: 2, 10: 1}
    pick = lambda q: A.histogram_percentile(h, 0.0, 10.0, 10, q).first()["value"]
    assert (pick(1), pick(50), pick(100)) == (-5.0, pytest.approx(3.0), 99.0)


def test_rate_and_eta(spark):
    h = spark.createDataFrame([(0.0, 0.0), (50.0, 10.0), (100.0, 30.0)], "ts double, done double")
    r = A.rate_of_progress(h, "done", 100.0, 60.0)
    assert r.first()["rate"] == pytest.approx(0.4) and A.rate_of_progress(h, "done", 100.0, 20.0).first()["rate"] is None
    assert A.eta(r, 70.0, 100.0).first()["eta_s"] == pytest.approx(100.0) and A.eta(r, 70.0, 5000.0).first()["eta_s"] is None


def test_whole_files(spark):
    df = spark.createDataFrame([("a", "s", 0, 0, False, None), ("a", "s", 1, 1, True, "bad"), ("b", "s", 0, 0, False, None)], "source string, shard string, chunk_index int, pos int, failed boolean, error string")
    got = {(r["source"], r["pos"], r["error"]) for r in P.whole_files(df).collect()}
    assert got == {("a", None, "bad"), ("b", 0, None)}


def test_files_and_parts(spark, tmp_path):
    for name in ("a.mp3", "sub/b.WAV", ".hidden/c.mp3", "x.temp/d.mp3", "e.txt"):
        p = tmp_path / "in" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(b"12345")
    got = {(r["relative_path"], r["file_size"]) for r in R.files(spark, str(tmp_path / "in"), ["mp3", "wav"]).collect()}
    assert got == {("a.mp3", 5), ("sub/b.WAV", 5)}
    spark.createDataFrame([("a", 1.0)], "relative_path string, duration double").coalesce(1).write.parquet(str(tmp_path / "m"))
    assert R.parquet_table(spark, str(tmp_path / "m"), schemas.MANIFEST).first().asDict() == {"relative_path": "a", "duration": 1.0, "file_size": None, "format": None}
    (tmp_path / "m" / "zz_part-1.parquet").write_bytes(b"not parquet")
    assert sorted(r["n_rows"] for r in R.bad_parts(spark, str(tmp_path / "m"), schemas.MANIFEST).collect()) == [0, 1]


def test_json_sources(spark, tmp_path):
    (tmp_path / "h.jsonl").write_text('{"ts": 2, "total_secs": 9}\n{"ts": 1, "total_secs": 8}\n{"ts": 3, "tot')
    assert [r["ts"] for r in R.history(spark, str(tmp_path / "h.jsonl")).collect() if r["ts"]] == [1.0, 2.0]
    (tmp_path / "v1a.json").write_text("[]")
    (tmp_path / "v1b.json").write_text(json.dumps({"origin": {"raw_audio_path": "a", "duration": "5.0000"}, "sentences": [{"speaker_id": "s", "time_range": {"start": "0.5000", "end": "1.0"}, "transcription_info": {"transcript": "hi"}}]}))
    assert [(r["source"], r["seg_start"], r["text"]) for r in R.v1_files(spark, str(tmp_path / "v1*.json")).collect()] == [("a", 0.5, "hi")]
    (tmp_path / "side.json").write_text(json.dumps({"source": "a", "chunk_index": 0, "sentences": [{"utt_id": "u", "time_range": {"start": 0, "end": 2}, "audio_quality_info": {"dnsmos": 3.5}}]}))
    assert [(r["chunk"], r["utt_id"], r["seg_end"], r["dnsmos"]) for r in R.sidecars(spark, str(tmp_path / "side.json")).collect()] == [("a#0", "u", 2.0, 3.5)]
    (tmp_path / "list.txt").write_text("a.mp3\n\nb.txt\n")
    assert {tuple(r) for r in R.file_list(spark, str(tmp_path / "list.txt")).collect()} == {("a.mp3", True), ("b.txt", False)}
    (tmp_path / "m.csv").write_text("FilePath,x\na,1\n")
    assert R.csv_manifest(spark, str(tmp_path / "m.csv")).first().asDict() == {"FilePath": "a", "x": "1"}


def test_view_joins_columns_by_name(spark, tmp_path):
    spark.createDataFrame([(1,)], "a int").write.parquet(str(tmp_path / "v/x"))
    spark.createDataFrame([(2,)], "b int").write.parquet(str(tmp_path / "v/y"))
    R.view(spark, "both", str(tmp_path / "v"))
    assert spark.sql("select sum(a), sum(b), count(*) from both").first() == (1, 2, 2)


def test_reports(spark):
    df = spark.createDataFrame([("a", 1.5, None)], "name string, x double, y int")
    assert "| a | 1.50 | N/A |" in K.report({"t": df}) and json.loads(K.report({"t": df}, "json"))["t"]["rows"] == [["a", 1.5, None]]
    with pytest.raises(ValueError, match="api_key"):
        K.report({"t": df.withColumnRenamed("name", "api_key")})
    assert K.message("aé" * 2, 2) == "a"


def test_shards_of_more_than_five_digits(spark, tmp_path):
    from loomspark.plans import catalog

    spark.createDataFrame([(i,) for i in (3, 99999, 100002, 1234569)], "doc_id long").write.parquet(str(tmp_path / "documents.parquet"))
    got = {tuple(r) for r in catalog.queries()["s10_shards"](spark, str(tmp_path)).select("relative_path", "part").collect()}
    assert got == {(f"m/manifest_part-{n}.parquet", int(n)) for n in ("00003", "99999", "100002", "1234569")}


def test_reports_of_thousands(spark, tmp_path):
    """The query's counts are plain, as in its SQL; reports for people have marks."""
    from loomspark.plans import catalog

    t = {"n": spark.createDataFrame([(1234567, -1234, 999)], "a long, b long, c long")}
    assert "| 1,234,567 | -1,234 | 999 |" in K.report(t) and "| 1234567 | -1234 | 999 |" in K.report(t, thousands="")
    spark.createDataFrame([(0, i, "user", "x") for i in range(1200)], "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    spark.createDataFrame([(0,)], "r_regionkey int").write.parquet(str(tmp_path / "region.parquet"))
    assert [r.line for r in catalog.queries()["k11_report"](spark, str(tmp_path)).orderBy("at").collect()][-1] == "| shard-0 | 1200 |"


def test_sharded(spark, tmp_path):
    K.sharded(spark.range(10).selectExpr("id", "id % 2 as shard").coalesce(1), str(tmp_path / "s"), rows=2, by="shard")
    assert len(list((tmp_path / "s").rglob("*.parquet"))) == 6 and spark.read.parquet(str(tmp_path / "s")).count() == 10


def test_scorers_never_drop(spark):
    @M.register("test_fails", "double", -1.0)
    def make():
        def batch(items):
            if any(x == "bad" for x in items):
                raise ValueError
            return [float(len(x)) for x in items]

        return batch

    assert M.guarded(make(), ["a", "bad", "ccc"], -1.0) == [1.0, -1.0, 3.0]
    df = spark.createDataFrame([("1", "x"), ("2", None)], "utt_id string, text string")
    got = {r["utt_id"]: r["ppl"] for r in M.score_alive(df, "stub_ppl", "ppl", F.col("utt_id") == "1", "text").collect()}
    assert got["2"] == -1.0 and got["1"] > 0


def test_scorers_get_slices_in_one_worker(spark):
    """Several scores of a row are one Python step, and no scorer gets a whole Arrow batch of inputs."""

    @M.register("no_more_than", "struct<n:long,x:string>", None)
    def no_more_than():
        return lambda items: [None if x == "7" else {"n": len(items), "x": x} for x in items]

    try:
        df = spark.range(2000).coalesce(1).select(F.col("id").cast("string").alias("x")).select("x", *(M.score("no_more_than", F.concat("x", F.lit(k))).alias(f"v{k}") for k in ("", "a", "b")))
        got = df.collect()
    finally:
        del M._REGISTRY["no_more_than"]
    assert max(r.v.n for r in got if r.v) <= M.SLICE and [r.x for r in got if r.v is None] == ["7"]
    assert all(r.v is None or r.v.x == r.x for r in got) and all(r.va.x == r.x + "a" and r.vb.x == r.x + "b" for r in got)
    assert df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_audio():
    import io
    import wave

    raw = io.BytesIO()
    with wave.open(raw, "wb") as w:
        w.setparams((2, 2, 8000, 0, "NONE", ""))
        w.writeframes(b"\x00\x40\x00\x00" * 4000)
    rate, channels, seconds, data = M.wav(raw.getvalue())
    samples = M.decode_pcm(data, channels)
    assert (rate, channels, seconds, len(samples), samples[0]) == (8000, 2, 0.5, 4000, 0.25)
    assert len(M.clip(samples, rate, -1, 0.25)) == 2000 and M.clip(samples, rate, 9, 10) == []
    assert M.normalised(samples)[0] == pytest.approx(0.25 * 10 ** (-3 / 20)) and M.normalised([]) == []


def test_stage_streams_resume(spark, tmp_path):
    calls = []
    one = pipeline.Stage("one", schemas.MANIFEST, schemas.SEGMENTS, lambda b: b.where("duration > 0").select(F.col("relative_path").alias("source"), "shard", F.col("relative_path").alias("utt_id"), F.col("duration").alias("seg_duration")))
    reads = type(one.reads)(list(one.reads.fields)).add("source", "string").add("shard", "string")  # add() changes what it is called on
    one = pipeline.Stage("one", reads, one.writes, one.transform)
    two = pipeline.Stage("two", schemas.SEGMENTS, schemas.STAGE2, lambda b: (calls.append(1), b.select("source", "shard", "utt_id", F.lit("ok").alias("text")))[1], only_valid=True)
    put = lambda *rows: spark.createDataFrame([(n, d, n, "s") for n, d in rows], "relative_path string, duration double, source string, shard string").write.mode("append").parquet(str(tmp_path / "in"))
    run = lambda: [pipeline.start(spark, s, str(tmp_path / a), str(tmp_path / b), str(tmp_path / f"cp_{b}")).awaitTermination() for s, a, b in ((one, "in", "s1"), (two, "s1", "s2"))]
    put(("a", 1.0), ("b", 0.0))
    run()
    put(("c", 2.0), ("a", 1.0))
    run()
    s1, s2 = spark.read.parquet(str(tmp_path / "s1")), spark.read.parquet(str(tmp_path / "s2"))
    assert sorted((r["source"], r["error"]) for r in s1.collect()) == [("a", None), ("b", "no_segments"), ("c", None)]
    assert sorted(r["source"] for r in s2.collect()) == ["a", "c"]
    assert [f.name for f in schemas.STAGE2] == [c for c in s2.columns if c != "epoch"]


def test_perplexity_and_cosine(spark):
    df = spark.createDataFrame([(1.0, 5, [1.0, 0.0], [1.0, 1.0]), (60.0, 5, [0.0, 0.0], [1.0, 1.0]), (1.0, 1, [1.0], [1.0, 2.0])], "loss double, n int, a array<double>, b array<double>")
    got = df.select(T.perplexity(F.col("loss"), F.col("n")), T.cosine(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [pytest.approx(math.e), 1e21, -1.0] and got[0][1] == pytest.approx(math.sqrt(0.5)) and got[1][1] is None and got[2][1] is None
