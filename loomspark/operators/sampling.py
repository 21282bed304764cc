"""Deterministic samples, buckets, packing and rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sample_key(id_: Column) -> Column:
    """The key that samples order by: the first 48 bits of a digest, as hex digits (L1)."""
    return F.left(F.sha1(id_), F.lit(12))


def smallest(df: DataFrame, n: int, id_: str = "utt_id", by: str | None = None) -> DataFrame:
    """The n rows (per group) of the smallest keys, all if n is 0 (L1, L2, L7). Samples nest: a smaller n gives a part of a larger."""
    if n <= 0:
        return df
    order = [sample_key(F.col(id_)), F.col(id_)]
    if by is None:
        return df.orderBy(*order).limit(n)  # the n best of each task meet, not all rows
    k = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    return df.withColumn("_k", k).where(F.col("_k") <= n).drop("_k")


def with_population(sample: DataFrame, df: DataFrame, by: str) -> DataFrame:
    """Sample and population per group, and the rate (L2)."""
    all_, some = df.groupBy(by).agg(F.count("*").alias("population")), sample.groupBy(by).agg(F.count("*").alias("n"))
    return all_.join(some, by, "left").select(by, "population", F.coalesce("n", F.lit(0)).alias("n"), F.try_divide(F.coalesce("n", F.lit(0)).cast("double"), F.col("population")).alias("rate"))


def hash_bucket(id_: Column, n: int) -> Column:
    """Bucket of a digest's first four bytes."""
    return F.conv(F.left(F.sha1(id_), F.lit(8)), 16, 10).cast("long") % n


def pair_sample(pairs: DataFrame, n: int, buckets: int = 64) -> DataFrame:
    """Up to max(1, n // buckets in use) pairs of each bucket, keyed by both ids (L3)."""
    rows = pairs.withColumn("pair", F.concat_ws("|", "prev_id", "utt_id")).withColumn("bucket", hash_bucket(F.col("chunk_audio_path"), buckets))
    used = rows.agg(F.greatest(F.lit(1), F.floor(F.lit(n) / F.count_distinct("bucket"))).alias("budget"))
    k = F.row_number().over(Window.partitionBy("bucket").orderBy(sample_key(F.col("pair")), "pair"))
    return rows.withColumn("_k", k).join(used, how="cross").where("_k <= budget").drop("_k", "budget")


def preview(df: DataFrame, speakers: int = 5, segments: int = 5) -> DataFrame:
    """Some segments of some speakers of each chunk, in order."""
    who = F.dense_rank().over(Window.partitionBy("chunk_audio_path").orderBy("speaker_id"))
    which = F.row_number().over(Window.partitionBy("chunk_audio_path", "speaker_id").orderBy("pos"))
    return df.withColumn("who", who).withColumn("which", which).where((F.col("who") <= speakers) & (F.col("which") <= segments))


def packed(df: DataFrame, long_from: float = 2400.0, long_size: int = 6, short_size: int = 20) -> DataFrame:
    """kind and batch of each file: files in order of duration, fewer long ones to a batch (Q10). Batches are within a shard."""
    kind = F.when(F.col("duration") > long_from, "long").otherwise("short")
    k = F.row_number().over(Window.partitionBy("shard", "kind").orderBy("duration", "relative_path")) - 1
    size = F.when(F.col("kind") == "long", long_size).otherwise(short_size)
    return df.withColumn("kind", kind).withColumn("batch", F.floor(k / size))


def batches(df: DataFrame, n: int = 16) -> DataFrame:
    """Groups of n rows of a chunk in order (Q11)."""
    k = F.row_number().over(Window.partitionBy("chunk_audio_path").orderBy("pos")) - 1
    return df.withColumn("batch", F.floor(k / n))


def by_priority(df: DataFrame, high: Column) -> DataFrame:
    """High-priority rows first, else in order (Q12)."""
    return df.orderBy(F.when(high, 0).otherwise(1), "pos")


def biggest_first(df: DataFrame, by: str = "chunk_audio_path") -> DataFrame:
    """Groups by size, the largest first."""
    return df.groupBy(by).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), by)


def allocated(groups: DataFrame, total: int) -> DataFrame:
    """name, available and take: water-filling of a total over groups in order (Q9).

    Each round gives every open group ceil(remaining / open), in order, up to what it has. The groups
    are few (one row each), and one row of state is folded over them.
    """
    rows = groups.agg(F.array_sort(F.collect_list(F.struct("pos", "name", "available"))).alias("g")).select("g", F.lit(total).cast("long").alias("left"))
    out, left = [(r["name"], r["available"], 0) for r in (rows.first()["g"] or [])], total
    while left > 0 and (open_ := [i for i, (_, a, t) in enumerate(out) if t < a]):
        share = -(-left // len(open_))
        for i in open_:
            name, a, t = out[i]
            give = min(share, a - t, left)
            out[i], left = (name, a, t + give), left - give
    return groups.sparkSession.createDataFrame(out, "name string, available long, take long")


def folder_of(df: DataFrame, size: int, by: str = "shard") -> DataFrame:
    """Row number in a shard and the folder <shard>/<low>_<high> it goes to."""
    k = F.row_number().over(Window.partitionBy(by).orderBy("relative_path")) - 1
    low = F.floor(F.col("i") / size) * size
    return df.withColumn("i", k).withColumn("folder", F.concat(F.col(by), F.lit("/"), low.cast("string"), F.lit("_"), (low + size - 1).cast("string")))


def speaker_index(df: DataFrame) -> DataFrame:
    """Running number of each segment of a speaker."""
    return df.withColumn("index", F.row_number().over(Window.partitionBy("chunk_audio_path", "speaker_id").orderBy("pos")))
