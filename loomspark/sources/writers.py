"""Sinks: sharded parquet, sidecar JSON, subtitles, reports. Spark's commit protocol publishes whole results only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.functions import text as T
from loomspark.functions.text import extension


def sharded(df: DataFrame, path: str, rows: int = 100_000, by: str | None = None) -> None:
    """Parquet with so many rows a file at most, partitioned by a column (K1, K4)."""
    w = df.write.mode("append").option("maxRecordsPerFile", rows)
    (w.partitionBy(by) if by else w).parquet(path)


def paths(df: DataFrame, path: str) -> None:
    """relative_path with its format (K2)."""
    sharded(df.select("relative_path", extension(F.col("relative_path")).alias("format")), path)


def missing_shards(df: DataFrame, done: DataFrame, by: str = "shard") -> DataFrame:
    """Rows of shards that were not written yet (K3)."""
    return df.join(done.select(by).distinct(), by, "left_anti")


def utt_id(path: Column, chunk: Column, index: Column) -> Column:
    return F.concat(F.sha1(path), F.lit("_chunk"), chunk.cast("string"), F.lit("_"), index.cast("string"))


def audio_path(path: Column, chunk: Column, index: Column) -> Column:
    """Where a segment's audio goes: a folder of the first two digits of its digest (K6)."""
    return F.concat(F.lit("audios/"), F.left(F.sha1(path), F.lit(2)), F.lit("/"), utt_id(path, chunk, index), F.lit(".wav"))


def sidecar(segments: DataFrame) -> DataFrame:
    """chunk_audio_path and its JSON: times at 5 and scores at 4 decimals (K6)."""
    r = lambda c, n: F.round(c, n).alias(c)
    one = F.struct(
        "pos", "utt_id", "speaker_id", r("speaker_min_similarity", 4),
        F.struct(F.round("seg_duration", 5).alias("duration"), F.round("seg_start", 5).alias("start"), F.round("seg_end", 5).alias("end")).alias("time_range"),
        F.struct(r("dnsmos", 4), r("c50", 4), r("snr", 4)).alias("audio_quality_info"),
    )
    chunks = segments.groupBy("chunk_audio_path").agg(F.array_sort(F.collect_list(one)).alias("s"), F.sum("seg_duration").alias("duration"))
    said = F.transform("s", lambda x: F.struct(*(x[c].alias(c) for c in ("utt_id", "speaker_id", "speaker_min_similarity", "time_range", "audio_quality_info"))))
    return chunks.select("chunk_audio_path", F.to_json(F.struct(F.col("chunk_audio_path").alias("audio_path"), F.round("duration", 5).alias("duration"), said.alias("sentences"))).alias("json"))


def v1_json(segments: DataFrame) -> DataFrame:
    """The first version's JSON of a file, numbers being strings of four decimals (K7)."""
    s = lambda c: F.format_string("%.4f", c).alias(c)
    one = F.struct("pos", "speaker_id", "language", F.struct(s("seg_start"), s("seg_end"), s("seg_duration")).alias("time_range"), F.struct(F.col("text").alias("transcript")).alias("transcription_info"))
    return segments.groupBy("chunk_audio_path").agg(F.to_json(F.transform(F.array_sort(F.collect_list(one)), lambda x: x.dropFields("pos"))).alias("json"))


def subtitles(segments: DataFrame) -> DataFrame:
    """chunk_audio_path and its SRT text (K9)."""
    n = F.row_number().over(_by_start())
    line = F.concat(F.col("n").cast("string"), F.lit("\n"), T.srt_time(F.col("seg_start")), F.lit(" --> "), T.srt_time(F.col("seg_end")), F.lit("\n"), F.coalesce("speaker_id", F.lit("")), F.lit(": "), F.coalesce("text", F.lit("")), F.lit("\n"))
    lines = segments.withColumn("n", n).select("chunk_audio_path", "n", line.alias("line"))
    return lines.groupBy("chunk_audio_path").agg(F.array_sort(F.collect_list(F.struct("n", "line"))).alias("l")).select("chunk_audio_path", F.array_join("l.line", "\n").alias("srt"))


def _by_start():
    from pyspark.sql import Window

    return Window.partitionBy("chunk_audio_path").orderBy("seg_start", "pos")


def export_names(segments: DataFrame, style: str = "default") -> DataFrame:
    """utt_id and file name of each segment: by speaker folder (libritts), or numbered (mp3, wav, default) (K8)."""
    from pyspark.sql import Window

    speaker = F.dense_rank().over(Window.partitionBy("chunk_audio_path").orderBy("speaker_id"))
    k = F.row_number().over(Window.partitionBy("chunk_audio_path", "speaker_id").orderBy("pos")) - 1
    if style == "libritts":
        name = F.concat(F.format_string("spk-%05d/", speaker), F.format_string("%06d.wav", k))
    else:
        name = F.concat("utt_id", F.lit(".mp3" if style == "mp3" else ".wav"))
    return segments.select("utt_id", name.alias("file_name"))


def retention_report(df: DataFrame) -> DataFrame:
    """relative_path, initial and final seconds and the per cent kept, as text of two decimals."""
    pct = F.when(F.col("initial") > 0, F.least(F.lit(100.0), F.col("final") / F.col("initial") * 100)).otherwise(0.0)
    two = lambda c: F.format_string("%.2f", F.bround(c, 2))
    return df.select("relative_path", two(F.col("initial")).alias("initial"), two(F.col("final")).alias("final"), two(pct).alias("retention"))


def as_json_lines(df: DataFrame, path: str) -> None:
    """One JSON object a line, added to what is there."""
    df.write.mode("append").json(path)


def log_lines(df: DataFrame, level: str, message: Column) -> DataFrame:
    """Structured log records: level, message and all other columns as fields, one JSON object each."""
    fields = F.struct(F.lit(level).alias("level"), message.alias("message"), *(F.col(c) for c in df.columns))
    return df.select(F.to_json(fields).alias("value"))


def shortened(text: Column, limit: int = 2048) -> Column:
    """message() as an expression (K19): as many whole characters as fit into so many bytes of UTF-8."""
    sizes = F.transform(F.split(F.left(text, F.lit(limit)), ""), lambda c: F.struct(c.alias("c"), F.octet_length(c).alias("n")))
    start = F.struct(F.lit(0).alias("bytes"), F.lit(0).alias("chars"))
    fit = F.aggregate(sizes, start, lambda a, x: F.struct((a["bytes"] + x["n"]).alias("bytes"), (a["chars"] + F.when(a["bytes"] + x["n"] <= limit, 1).otherwise(0)).alias("chars")))
    return F.when(F.octet_length(text) <= limit, text).otherwise(F.left(text, fit["chars"]))


SECRETS = ("token", "api_key", "apikey", "secret", "password", "passwd", "credential", "authorization")


def refuse_secrets(payload: object, at: str = "") -> None:
    """Raises if a key of a report could hold a secret."""
    if isinstance(payload, dict):
        for k, v in payload.items():
            if any(s in str(k).lower() for s in SECRETS):
                raise ValueError(f"a report may not hold {at}{k}")
            refuse_secrets(v, f"{at}{k}.")
    elif isinstance(payload, (list, tuple)):
        for v in payload:
            refuse_secrets(v, at)


def report(sections: dict[str, DataFrame], style: str = "md", rows: int = 200, thousands: str = ",") -> str:
    """A report of small result tables as txt, md or json (K11), whole numbers with a mark between thousands; larger ones show their first rows and say so."""
    import json

    tables = {}
    for name, df in sections.items():
        got = df.limit(rows + 1).collect()
        tables[name] = {"columns": df.columns, "rows": [[None if v is None else v if isinstance(v, (int, float, str, bool)) else str(v) for v in r] for r in got[:rows]], "more": len(got) > rows}
    refuse_secrets({k: dict.fromkeys(v["columns"]) for k, v in tables.items()})
    if style == "json":
        return json.dumps(tables, ensure_ascii=False, indent=1)
    out = []
    show = lambda v: "N/A" if v is None else f"{v:,.2f}" if isinstance(v, float) else f"{v:,}".replace(",", thousands) if isinstance(v, int) and not isinstance(v, bool) else str(v)
    for name, t in tables.items():
        lines = [list(map(show, r)) for r in t["rows"]]
        if style == "md":
            out += [f"## {name}", "", f"| {' | '.join(t['columns'])} |", f"|{'---|' * len(t['columns'])}", *(f"| {' | '.join(r)} |" for r in lines)]
        else:
            out += [name, "\t".join(t["columns"]), *("\t".join(r) for r in lines)]
        out += ["(more rows)"] * t["more"] + [""]
    return "\n".join(out)


def message(text: str, limit: int = 2048) -> str:
    """text cut to so many bytes of UTF-8, whole characters only."""
    return text.encode()[:limit].decode(errors="ignore")
