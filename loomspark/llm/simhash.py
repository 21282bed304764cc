"""SimHash fingerprints and the groups of documents whose fingerprints differ in few bits.

Fingerprint: 64 bits over 3-word shingles (XXH64, seed 42), a bit being 1 if it is set in over half
of the shingles. Links: fingerprints at MAX_BITS = 2 or fewer differing bits.

Deletion-variant signatures: a fingerprint is cut into two segments of 32 bits, so that of two
fingerprints that differ in two bits one segment differs in at most one. Each segment is indexed
under its 32 variants with one bit masked out: fingerprints that link share a variant of one
segment. Equal variants meet in a hash aggregation or an equality join and are verified bit by bit.
Exact copies are one fingerprint before any of this.

A variant that more than MAX_BUCKET fingerprints share is not joined with itself. Its fingerprints
go an exact way that makes no pairs: each is put under the 65 centres at distance 0 or 1, and two
fingerprints are within 2 bits just if they share a centre. All members of a centre are linked, so
each (at most 65) is tied to the smallest; this loses no link and grows with the members only.

Defined cases: null and blank texts have fingerprint zero and link like others; a null doc_id takes
part, and is a component's id only if no row of it has one; repeated rows are repeated in the
result; an empty table gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.llm.common import cut, partitions, sent_if_small
from loomspark.llm.graph import components

SHINGLE = 3
SEED = 42
MAX_BITS = 2
MAX_BUCKET = 64


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text (UTF-8), as a signed 64-bit integer."""
    import numpy as np
    import xxhash

    words = (text or b"").lower().split()  # of bytes: A-Z and the six ASCII spaces only
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = xxhash.xxh64_digest(line, SEED)
    else:
        gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        starts, ends = [0, *(gaps + 1).tolist()], [*gaps.tolist(), len(line)]
        digest = xxhash.xxh64_digest
        hashes = b"".join([digest(line[s:e], SEED) for s, e in zip(starts, ends[shingle - 1 :], strict=False)])
    n = len(hashes) // 8
    bits = np.zeros(64, np.int64)
    table = np.frombuffer(hashes, np.uint8).reshape(n, 8)
    for at in range(0, n, 4096):
        bits += np.unpackbits(table[at : at + 4096], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (signed) of each row."""
    @F.pandas_udf("long")
    def _fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([fingerprint(t) for t in batch], dtype="int64")

    return docs.select("doc_id", _fingerprints(F.col("text").cast("binary")).alias("fp"))


def bit_distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def variants(fps: DataFrame) -> DataFrame:
    """fp and key: the number of segment and masked bit (0 to 63), above the 32 bits that are left of the segment."""
    key = "transform(sequence(0L, 63L), v -> shiftleft(v, 32) | (shiftrightunsigned(fp, 32 * cast(v div 32 as int)) & 4294967295L & ~shiftleft(1L, cast(v % 32 as int))))"
    return fps.select("fp", F.explode(F.expr(key)).alias("key"))


def links(fps: DataFrame, max_bits: int = MAX_BITS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Pairs u < v of the distinct fingerprints fps (fp) that connect all that are within 2 bits of one another."""
    if max_bits != MAX_BITS:
        raise ValueError("two segments with one masked bit find two differing bits")
    # Each fingerprint becomes 64 rows here: spread them first, whatever few partitions the narrow input came in.
    keys = variants(fps.repartition(partitions(fps.sparkSession)))
    # Keys alone are counted, combined on the map side, so a hot key is no hot task. Only fingerprints of shared keys are
    # kept. The join is by merge at every size: it spills, adaptive execution splits hot keys, and its cost stays in proportion.
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    crowd = cut(keys.join(shared.hint("merge"), "key"))
    some = crowd.where(F.col("n") <= max_bucket)
    # Fingerprints alike in a whole segment share its 32 variants; only the first of them makes the pair.
    segment = F.expr("shiftrightunsigned(a.fp ^ b.fp, 32 * cast(shiftright(a.key, 37) as int)) & 4294967295L")
    first = (segment != 0) | (F.expr("shiftright(a.key, 32) % 32") == 0)
    near = bit_distance(F.col("a.fp"), F.col("b.fp")) <= max_bits
    pairs = some.alias("a").join(some.alias("b"), (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp")) & near & first)
    many = crowd.where(F.col("n") > max_bucket).select("fp").distinct()
    return pairs.select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v")).union(centred(many)).distinct()


def centred(fps: DataFrame) -> DataFrame:
    """Edges u < v from the smallest fingerprint around each centre to the others within one bit of it."""
    balls = fps.select("fp", F.explode(F.expr("concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")).alias("centre"))
    least = balls.groupBy("centre").agg(F.min("fp").alias("u"), F.count("*").alias("n")).where("n > 1").select("centre", "u")
    return balls.join(least, "centre").where("fp <> u").select("u", F.col("fp").alias("v")).distinct()


def near_dedup(docs: DataFrame, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable) of each row of docs (doc_id, text)."""
    rows = cut(fingerprints(docs))
    fps = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    labels = components(links(fps.select("fp"), max_bucket=max_bucket), "u", "v")
    named = fps.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    roots = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    ids = named.join(roots, "component").select("fp", "component_id")
    return rows.join(ids, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """docs with all its columns, one document of each group: that of the smallest doc_id. Rows that share a doc_id stay or go together."""
    found = cut(near_dedup(docs))
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    ids = found.groupBy("doc_id").agg(F.bool_or(stays).alias("stays")).where("not stays").select("doc_id")
    return docs.alias("d").join(sent_if_small(ids).alias("r"), F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")), "left_anti").select("d.*")
