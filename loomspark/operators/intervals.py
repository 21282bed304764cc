"""Intervals of a chunk [seg_start, seg_end): overlaps between speakers, and windows over neighbours.

Nothing lists the pairs that overlap, which grow as the square of how densely a chunk is filled. Shared seconds
are differences of running sums over sorted starts and ends; the longest overlap is looked up among intervals that
no other one holds. Both go by chunk and bin of time, so that a chunk with very many intervals is spread over tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

BIN = 300.0


def _points(df: DataFrame, width: float, **columns: tuple) -> DataFrame:
    """Two rows for each interval, its end (kind 0) and its start (kind 1), with u its seconds after the begin of its bin; columns have a value at the end and one at the start."""
    point = lambda at, kind: F.struct(F.col(at).alias("at"), F.lit(kind).alias("kind"), *(v[kind].alias(c) for c, v in columns.items()))
    both = df.where("chunk_audio_path is not null and seg_start < seg_end").select("chunk_audio_path", F.col("speaker_id").alias("who"), F.explode(F.array(point("seg_end", 0), point("seg_start", 1))).alias("p"))
    return both.select("chunk_audio_path", "who", "p.*").withColumn("bin", F.floor(F.col("at") / width)).withColumn("u", F.col("at") - F.col("bin") * width)


def _carried(totals: DataFrame, keys: list[str], name: str) -> DataFrame:
    """For each bin the starts, the ends, and the sums of bins and of seconds in them, starts less ends, of all bins before it, by keys.

    Seconds are summed as whole ones and the rest, so that a busy time leaves no rounding to a quiet one after it.
    """
    each = totals.groupBy(*keys, "bin").agg(*(F.sum(c).alias(c) for c in ("starts", "ends", "whole", "rest")))
    w = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(w), F.lit(0))
    bins = F.col("bin") * (F.col("starts") - F.col("ends"))
    return each.select(*keys, "bin", F.struct(before("starts").alias("starts"), before("ends").alias("ends"), before(bins).alias("bins"), before("whole").alias("whole"), before("rest").alias("rest")).alias(name))


def shared_seconds(a: DataFrame, b: DataFrame, name: str, width: float = BIN) -> DataFrame:
    """chunk_audio_path and pos of a, and the seconds that b's intervals of other speakers share with it, all added up.

    Up to a time x, intervals have lasted sum(x - start) - sum(x - end) over starts and ends before x. What a turn shares is
    that at its end less that at its start, for all speakers less its own: two running sums in each bin, and totals of the bins before.
    """
    none, zero, one = F.lit(None).cast(a.schema["pos"].dataType), F.lit(0), F.lit(1)
    asked = _points(a, width, starts=(zero, zero), ends=(zero, zero), sign=(one, -one), pos=(F.col("pos"),) * 2)
    steps = _points(b, width, starts=(zero, one), ends=(one, zero)).groupBy("chunk_audio_path", "who", "at", "kind", "bin", "u").agg(F.sum("starts").cast("long").alias("starts"), F.sum("ends").cast("long").alias("ends"))
    points = steps.withColumns({"sign": zero, "pos": none}).unionByName(asked)

    seconds = F.sum((F.col("starts") - F.col("ends")) * F.col("u"))
    totals = points.groupBy("chunk_audio_path", "who", "bin").agg(F.sum("starts").alias("starts"), F.sum("ends").alias("ends"), seconds.alias("v"))
    totals = totals.select("chunk_audio_path", "who", "bin", "starts", "ends", F.floor("v").alias("whole"), (F.col("v") - F.floor("v")).alias("rest"))
    every, own = _carried(totals, ["chunk_audio_path"], "c_all"), _carried(totals, ["chunk_audio_path", "who"], "c_own")

    def running(w, name):
        w = w.orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return F.struct(F.sum("starts").over(w).alias("starts"), F.sum("ends").over(w).alias("ends"), seconds.over(w).alias("v")).alias(name)

    sums = points.select(
        "chunk_audio_path", "who", "bin", "u", "sign", "pos",
        running(Window.partitionBy("chunk_audio_path", "bin"), "r_all"), running(Window.partitionBy("chunk_audio_path", "bin", "who"), "r_own"),
    ).where("sign <> 0")
    same = (F.col("chunk_audio_path") == F.col("k_chunk")) & (F.col("bin") == F.col("k_bin"))
    own = own.withColumnsRenamed({"chunk_audio_path": "k_chunk", "who": "k_who", "bin": "k_bin"})
    sums = sums.join(every, ["chunk_audio_path", "bin"]).join(own, same & F.col("who").eqNullSafe(F.col("k_who")))

    other = lambda kind, c: F.col(f"{kind}_all.{c}") - F.col(f"{kind}_own.{c}")
    begun, ended = other("c", "starts") + other("r", "starts"), other("c", "ends") + other("r", "ends")
    exact = F.col("bin") * (other("c", "starts") - other("c", "ends")) - other("c", "bins")
    rough = (begun - ended) * F.col("u") - other("r", "v") - other("c", "rest")
    hits = sums.groupBy("chunk_audio_path", "pos").agg(
        F.sum(F.when(F.col("sign") > 0, begun).otherwise(-ended)).alias("n"), F.sum(F.col("sign") * exact).alias("bins"),
        F.sum(F.col("sign") * other("c", "whole")).alias("whole"), F.sum(F.col("sign") * rough).alias("rough"),
    )
    # n counts the others that overlap; without any the sum is 0 and not what rounding leaves
    hit = F.when(F.col("n") > 0, F.greatest(F.lit(0.0), F.col("bins") * width - F.col("whole") + F.col("rough"))).otherwise(0.0)
    return a.select("chunk_audio_path", "pos").join(hits.select("chunk_audio_path", "pos", hit.alias(name)), ["chunk_audio_path", "pos"], "left").withColumn(name, F.coalesce(name, F.lit(0.0)))


def contamination(turns: DataFrame) -> DataFrame:
    """chunk_audio_path, pos, hit: seconds of each turn that others speak in, all others added up."""
    return shared_seconds(turns, turns, "hit")


def foreign_overlap(segments: DataFrame, turns: DataFrame) -> DataFrame:
    """chunk_audio_path, pos, foreign: seconds of other speakers' turns in each segment."""
    return shared_seconds(segments, turns, "foreign")


def _outermost(gs, ge):
    """Starts and ends, both rising, of the intervals that no other one holds."""
    order = np.lexsort((-ge, gs))
    gs, ge = gs[order], ge[order]
    keep = np.ones(len(gs), bool)
    keep[1:] = ge[1:] > np.maximum.accumulate(ge)[:-1]
    return gs[keep], ge[keep]


def _longest(s, e, gs, ge):
    """The most that one interval [gs, ge) shares with each [s, e), nan if none meets it."""
    gs, ge = _outermost(gs, ge)
    n, best = len(gs), np.full(len(s), np.nan)
    i, j = np.searchsorted(gs, s, "right"), np.searchsorted(ge, e, "left")  # before i: begun by s; from j: open at e
    end, start = ge[np.maximum(i - 1, 0)], gs[np.minimum(j, n - 1)]
    best = np.fmax(best, np.where((i > 0) & (end > s), np.minimum(e, end) - s, np.nan))
    best = np.fmax(best, np.where((j < n) & (start < e), e - np.maximum(s, start), np.nan))
    inside = np.flatnonzero(i < j)  # those from i to j lie inside: the longest of a range, by ranges of powers of two
    if len(inside):
        a, b = i[inside], j[inside]
        level, found, most = np.frexp(b - a)[1] - 1, np.empty(len(inside)), ge - gs
        for k in range(level.max() + 1):
            at = level == k
            found[at] = np.maximum(most[a[at]], most[b[at] - (1 << k)])
            most = np.maximum(most[: -(1 << k)], most[1 << k :]) if len(most) > 1 << k else most
        best[inside] = np.fmax(best[inside], found)
    return best


def longest_shared(s, e, who, gs, ge, g_who):
    """_longest() among intervals of other speakers, speakers being numbers from 0.

    Different numbers differ in a bit, so intervals with a bit set are looked up by those without it and the other way round: as many
    lookups as bits, however many speakers there are.
    """
    best = np.full(len(s), np.nan)
    for bit in range(int(max(who.max(), g_who.max())).bit_length()):
        mine, theirs = who >> bit & 1, g_who >> bit & 1
        for v in (0, 1):
            ours, those = mine != v, theirs == v
            if ours.any() and those.any():
                best[ours] = np.fmax(best[ours], _longest(s[ours], e[ours], gs[those], ge[those]))
    return best


def _binned(df: DataFrame, width: float) -> DataFrame:
    first, last = F.floor(F.col("seg_start") / width), F.floor(F.col("seg_end") / width)
    return df.withColumn("_bin", F.explode(F.sequence(first, F.greatest(first, last))))


def _with_longest(a: DataFrame, b: DataFrame, width: float) -> DataFrame:
    """a, in bins, with _best: the most seconds that one of b's intervals of another speaker in the bin shares with it, null if none does."""
    cols = ["seg_start", "seg_end", "speaker_id"]
    b = b.where("seg_start <= seg_end").select("chunk_audio_path", *cols)
    before = Window.partitionBy("chunk_audio_path", "speaker_id", F.floor(F.col("seg_start") / width)).orderBy("seg_start", F.desc("seg_end")).rowsBetween(Window.unboundedPreceding, -1)
    b = b.withColumn("_last", F.max("seg_end").over(before)).where("_last is null or seg_end > _last").drop("_last")  # those inside one of the same speaker never share more

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        best = np.full(len(left), np.nan)
        if len(left) and len(right):
            names = pa.chunked_array(left["speaker_id"].chunks + right["b_speaker_id"].chunks, left.schema.field("speaker_id").type).combine_chunks().dictionary_encode("encode").indices.to_numpy()
            times = [t[c].to_numpy() for t, c in ((left, "seg_start"), (left, "seg_end"), (right, "b_seg_start"), (right, "b_seg_end"))]
            best = longest_shared(*times[:2], names[: len(left)], *times[2:], names[len(left) :])
        return left.append_column("_best", pa.array(best, from_pandas=True))

    schema = StructType([StructField(f.name, f.dataType) for f in a.schema] + [StructField("_best", DoubleType())])
    b = _binned(b, width).select(F.col("chunk_audio_path").alias("b_chunk"), F.col("_bin").alias("b_bin"), *(F.col(c).alias(f"b_{c}") for c in cols))  # own columns, a and b may be one frame
    return a.groupBy("chunk_audio_path", "_bin").cogroup(b.groupBy("b_chunk", "b_bin")).applyInArrow(run, schema)


def swallowed(reference: DataFrame, segments: DataFrame, part: float = 0.9, width: float = BIN) -> DataFrame:
    """Reference turns of which at least a part lies in one segment of another speaker, each once."""
    turns = reference.where("chunk_audio_path is not null and seg_end > seg_start")
    length = F.col("seg_end") - F.col("seg_start")
    # a segment over well more than half of a turn is in the bin of the turn's middle
    turns = turns.withColumn("_bin", F.floor((F.col("seg_start") + length / 2) / width)) if part > 0.6 else _binned(turns, width)
    return _with_longest(turns, segments, width).where(F.col("_best") >= part * length).select(*reference.columns).distinct()


def short_turn_recall(reference: DataFrame, found: DataFrame, longest: float = 1.5, part: float = 0.5, width: float = BIN) -> DataFrame:
    """Short reference turns with hit: whether some found segment covers at least a part of it."""
    short = reference.where((F.col("seg_end") - F.col("seg_start")).between(1e-9, longest))
    asked = short.where("chunk_audio_path is not null").select("chunk_audio_path", "pos", "seg_start", "seg_end", F.lit("a").alias("speaker_id"))
    anyone = found.withColumn("speaker_id", F.lit("b"))  # of whichever speaker
    best = _with_longest(_binned(asked, width), anyone, width).groupBy("chunk_audio_path", "pos").agg(F.max("_best").alias("best"))
    return short.join(best, ["chunk_audio_path", "pos"], "left").withColumn("hit", F.coalesce(F.col("best") >= part * (F.col("seg_end") - F.col("seg_start")), F.lit(False)))


def _chunk(*order: str):
    return Window.partitionBy("chunk_audio_path").orderBy(*order)


def denested(turns: DataFrame) -> DataFrame:
    """Turns that end after every turn before them."""
    before = F.max("seg_end").over(_chunk("seg_start", "pos").rowsBetween(Window.unboundedPreceding, -1))
    return turns.withColumn("_last", F.coalesce(before, F.lit(0.0))).where("seg_end > _last").drop("_last")


def with_grace(segments: DataFrame, before: float, after: float, audio: Column | None = None) -> DataFrame:
    """Segments widened, never into a neighbour: first ends, then starts up to the neighbour's new end."""
    w = _chunk("seg_start", "pos")
    limit = F.coalesce(F.lead("seg_start").over(w), audio if audio is not None else F.lit(None).cast("double"))
    wide = segments.withColumn("_end", F.least(F.col("seg_end") + after, limit))
    begin = F.greatest(F.col("seg_start") - before, F.coalesce(F.lag("_end").over(w), F.lit(0.0)), F.lit(0.0))
    return wide.withColumn("_start", begin).withColumn("seg_start", F.col("_start")).withColumn("seg_end", F.col("_end")).drop("_start", "_end")


def pair_categories(segments: DataFrame, gap: float = 0.8, longest: float = 30.0, shortest: float = 1.0) -> DataFrame:
    """Each segment with a predecessor in its chunk: gap and the first thing that keeps the two from merging."""
    w = _chunk("seg_start", "utt_id")
    prev = lambda c: F.lag(c).over(w)
    df = segments.select(
        "chunk_audio_path", "shard", "utt_id", prev("utt_id").alias("prev_id"), (F.col("seg_start") - prev("seg_end")).alias("raw_gap"),
        (F.col("seg_duration") + prev("seg_duration")).alias("pair_duration"), (~F.col("speaker_id").eqNullSafe(prev("speaker_id"))).alias("other"),
        ((F.col("seg_duration") < shortest) | (prev("seg_duration") < shortest)).alias("short"), (F.col("seg_end") - prev("seg_start")).alias("merged"),
    ).where("prev_id is not null")
    category = (
        F.when(F.col("other"), "different_speaker").when(F.col("short"), "no_embedding_short_segment").when(F.col("raw_gap") >= gap, "gap_too_large")
        .when(F.col("merged") >= longest, "merged_too_long").otherwise("mergeable_by_structure")
    )
    return df.select("chunk_audio_path", "shard", "utt_id", "prev_id", F.greatest("raw_gap", F.lit(0.0)).alias("gap"), "pair_duration", category.alias("category"))


def relabelled(turns: DataFrame, duration: float | None = None) -> DataFrame:
    """Turns inside [0, duration] with speakers named by first appearance."""
    end = F.least(F.col("seg_end"), F.lit(duration)) if duration is not None else F.col("seg_end")
    df = turns.withColumn("seg_start", F.greatest("seg_start", F.lit(0.0))).withColumn("seg_end", end).where("seg_end > seg_start")
    first = F.min(F.struct("seg_start", "pos")).over(Window.partitionBy("chunk_audio_path", "speaker_id"))
    place = F.dense_rank().over(Window.partitionBy("chunk_audio_path").orderBy("_first"))
    return df.withColumn("_first", first).withColumn("speaker", F.format_string("SPEAKER_%02d", place - 1)).drop("_first")


def silences(turns: DataFrame, least: float) -> DataFrame:
    """Gaps between neighbouring intervals that last long enough."""
    nxt = F.lead("seg_start").over(_chunk("seg_start", "pos"))
    df = turns.select("chunk_audio_path", F.col("seg_end").alias("gap_start"), nxt.alias("gap_end"))
    return df.where(F.col("gap_end") - F.col("gap_start") >= least)


def dominant_speaker(turns: DataFrame) -> DataFrame:
    """The speaker of each chunk who speaks longest, the first to speak on a tie."""
    each = turns.groupBy("chunk_audio_path", "speaker_id").agg(F.sum(F.col("seg_end") - F.col("seg_start")).alias("seconds"), F.min(F.struct("seg_start", "pos")).alias("first"))
    best = F.row_number().over(Window.partitionBy("chunk_audio_path").orderBy(F.col("seconds").desc(), "first"))
    return each.withColumn("_n", best).where("_n = 1").select("chunk_audio_path", "speaker_id", "seconds")


def embedding_windows(segments: DataFrame, size: float = 1.1, step: float = 0.4, shortest: float = 1.0, longest: float = 30.0) -> DataFrame:
    """Windows of segments to embed; segments over the longest go, those under the shortest have none (Q8)."""
    d = F.col("seg_duration")
    n = F.when(d < shortest, 0).when(d <= size, 1).otherwise(F.floor((d - size) / step + 1e-9) + 1)
    df = segments.where(d <= longest).withColumn("n_windows", n.cast("long"))
    df = df.where("n_windows > 0").withColumn("w", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_windows") - 1)))
    begin = F.col("seg_start") + F.col("w") * step
    return df.withColumn("win_start", begin).withColumn("win_end", F.least(begin + size, F.col("seg_end")))


def consistency(windows: DataFrame, reference: DataFrame, least: float) -> DataFrame:
    """utt_id, min_similarity over a segment's windows to its reference embedding, and whether all reach a bound."""
    from loomspark.functions.text import cosine

    sims = windows.join(reference, "utt_id").select("utt_id", cosine(F.col("embedding"), F.col("reference_embedding")).alias("sim"))
    return sims.groupBy("utt_id").agg(F.min("sim").alias("min_similarity"), F.count("*").alias("n_windows")).withColumn("consistent", F.col("min_similarity") >= least)
