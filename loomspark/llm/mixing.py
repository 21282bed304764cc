"""Mixing sources to target weights by systematic sampling.

Targets: sources by code point, null last, weigh 5, 2, 1, repeating; they share the total of all
sizes by weight, no target above CAP times its source's size, the excess reshared by weight. That
fixed point is min(cap, level * weight) with one level for all, found from prefix sums over the
sources ordered by cap / weight.

Sampling: within a source each document expects e = target / source size copies. With r its place in
the order of (size, doc_id) and one offset per source it gets floor(r e + offset) - floor((r - 1) e +
offset) copies: one per integer crossed. As copies keep within one of their expectation at every
place of an order by size, the words taken differ from the target by less than the largest document.
Offsets have 48 bits. Targets are found in one task from one row for each source: memory goes with the
number of sources (some 100 bytes each), not with documents.

Places come from a range partition by (source, size, doc_id), so a source that holds a third of the
rows lies in as many partitions as its rows need: rows are numbered inside partitions, and one small
row per partition and source carries how many came before. The offset comes from a digest of the
source, so reruns agree.

Defined cases: a null text has size 0; sources of size 0 have target 0 and are taken 0 times; a null
source is a source; rows that repeat a doc_id are rows of their own, next to one another in the
order; an empty table gives an empty result; columns other than doc_id, text, source are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomspark.llm.common import cut, sent_if_small, word_count

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = "mix-1"


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """source, source_size and target of each source; sources has one row each (source, source_size)."""
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(everything) - 1) % len(weights) + 1).cast("int"))
    w = sources.withColumn("w", weight.cast("long")).withColumn("limit", F.col("source_size") * cap)
    order = [F.col("limit") / F.col("w"), F.col("source").asc_nulls_last()]
    before, after = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1), Window.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    left = (F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0))).cast("double")
    w = w.withColumn("left", left).withColumn("rest", F.sum("w").over(after).cast("double")).withColumn("level", F.col("left") / F.col("rest"))
    # From the first source on that its limit does not hold down, one level holds.
    free = F.col("limit") * F.col("rest") >= F.col("left") * F.col("w")
    level = F.min(F.when(free, F.struct(F.col("limit") / F.col("w"), -F.col("rest"), "level"))).over(whole)["level"]
    return w.select("source", "source_size", F.least(F.col("limit").cast("double"), F.coalesce(level, F.lit(0.0)) * F.col("w")).alias("target"))


def placed(sized: DataFrame) -> DataFrame:
    """sized (doc_id, source, size) with place: 1, 2, ... within the source by size and doc_id."""
    order = [F.col("source").asc_nulls_last(), F.col("size"), F.col("doc_id").asc_nulls_last()]
    ranged = sized.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = cut(ranged.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("pos")))
    runs = ranged.groupBy("part", "source").agg(F.count("*").alias("n"), F.min("pos").alias("first"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("part", "source", (F.col("first") - F.coalesce(F.sum("n").over(earlier), F.lit(0)) - 1).alias("shift"))
    joined = ranged.alias("d").join(runs.alias("r"), (F.col("d.part") == F.col("r.part")) & F.col("d.source").eqNullSafe(F.col("r.source")))
    return joined.select("doc_id", "d.source", "size", (F.col("pos") - F.col("shift")).alias("place"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies and source of each row of docs (doc_id, text, source)."""
    sized = cut(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    goals = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
    offset = F.conv(F.substring(F.md5(F.coalesce(F.concat(F.lit(f"{seed}:"), F.col("source")), F.lit(seed))), 1, 12), 16, 10).cast("double") / float(1 << 48)
    goals = goals.select("*", F.coalesce(F.try_divide("target", F.col("source_size").cast("double")), F.lit(0.0)).alias("e"), offset.alias("offset"))
    rows = placed(sized).alias("d").join(goals.alias("g"), F.col("d.source").eqNullSafe(F.col("g.source")))
    upto = lambda r: F.floor(r.cast("double") * F.col("e") + F.col("offset"))
    copies = F.least(upto(F.col("place")) - upto(F.col("place") - 1), F.lit(cap)).cast("long")
    rows = rows.withColumn("copies", copies)
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", F.col("d.source").alias("source"))


def mixed(docs: DataFrame) -> DataFrame:
    """docs with all its columns, each row as often as the mix takes it.

    Rows that share a doc_id are numbered by source, size and place on both sides of the join; all
    others, as a rule all, meet their number of copies by doc_id alone.
    """
    takes = cut(mix(docs).select("doc_id", "source", "size", "copies"))
    shared = sent_if_small(takes.groupBy("doc_id").count().where("count > 1 or doc_id is null").select("doc_id"))
    same = F.col("d.doc_id").eqNullSafe(F.col("r.doc_id"))
    apart = lambda df, how: df.alias("d").join(shared.alias("r"), same, how).select("d.*")
    some = not shared.isEmpty()
    single = (apart(takes, "left_anti") if some else takes).where("copies > 0").select("doc_id", "copies").hint("merge")  # alike at every size
    row = F.struct("d.*").alias("row")
    out = docs.alias("d").join(single.alias("t"), F.col("d.doc_id") == F.col("t.doc_id")).select(row, "t.copies")
    if some:
        number = F.row_number().over(Window.partitionBy("id").orderBy("source", "size", "copies"))
        more = apart(docs, "left_semi").alias("d").select(row, F.col("d.doc_id").alias("id"), F.col("d.source").alias("source"), word_count(F.col("d.text")).alias("size"), F.lit(0).alias("copies"))
        more = more.withColumn("at", number).select("row", "id", "at")
        counts = apart(takes, "left_semi").withColumnRenamed("doc_id", "id").withColumn("at", number).select("id", "at", "copies")
        met = more.alias("m").join(counts.alias("c"), F.col("m.id").eqNullSafe(F.col("c.id")) & (F.col("m.at") == F.col("c.at")))
        out = out.union(met.where("c.copies > 0").select("row", "c.copies"))
    return out.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")
