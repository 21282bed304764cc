"""Exact deduplication by a tree-merge of sorted digest runs.

Every row gives a key: the SHA-256 digest of its normalised text, its length in bytes and a second
hash. The keys of input partition p become the sorted run of node p mod 2**levels. In round r the nodes
whose numbers differ in bit r exchange halves of their runs: a record stays or goes by bit r of its
key's home. The node merges the runs that it then has (its own half and what came) by pairs into
one, a multiway merge of sorted runs, and joins neighbours with one key: the smallest identifier
and the number of rows remain. After as many rounds as bits each key is at its home alone. A key that
a third of all rows share is one record a run before anything is sent, so it makes no task hot.

Runs are found by their order: a record smaller than the one before it begins a new run. Whatever way
the shuffle lays out what it fetches, the result is right, and it costs a pass for each doubling of runs. A
node's runs are arrays in one Python worker, some 100 bytes a key for all keys / nodes; their number
is the next power of two above spark.sql.shuffle.partitions, which is to grow with the corpus.

Verified: digest, length and second hash must all agree, and at every level they are compared in full.

Defined cases: a null text counts as empty; a null doc_id is greater than every other (identifiers are
integers); rows that repeat a doc_id and a text are one document, and all have its verdict; an empty
table gives an empty result; columns other than doc_id and text are ignored, and their names may clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.llm.common import SPACE, cut, partitions, sent_if_small

#: Bytes of a key: digest, length, second hash.
KEY = 32 + 8 + 8
RECORD = "node int, key binary, keep_id long, group_size long"


def normal_text(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE}]+", " ")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id and key of each row."""
    normal = F.encode(normal_text(F.col("text")), "UTF-8")
    eight = lambda x: F.lpad(F.hex(x.cast("long")), 16, "0")
    return docs.select("doc_id", F.unhex(F.concat(F.sha2(normal, 256), eight(F.octet_length(normal)), eight(F.xxhash64(normal)))).alias("key"))


def merged(runs: list) -> tuple:
    """Sorted runs (keys, ids, known, sizes), of which neighbours are merged by pairs until one is left."""
    import numpy as np

    while len(runs) > 1:
        pairs, runs = [runs[k : k + 2] for k in range(0, len(runs), 2)], []
        for pair in pairs:
            if len(pair) == 1:
                runs += pair
                continue
            (a, *_), (b, *_) = pair
            at = np.searchsorted(a, b, side="right") + np.arange(len(b))
            from_a = np.ones(len(a) + len(b), bool)
            from_a[at] = False
            out = []
            for x, y in zip(*pair, strict=True):
                both = np.empty(len(from_a), x.dtype)
                both[from_a], both[at] = x, y
                out.append(both)
            runs.append(tuple(out))
    return runs[0]


def combined(run: tuple) -> tuple:
    """A sorted run with neighbours of one key joined: the smallest known id, whether there is one, and the number of rows."""
    import numpy as np

    keys, ids, known, sizes = run
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    none = np.iinfo(np.int64).max
    return keys[first], np.minimum.reduceat(np.where(known, ids, none), first), np.logical_or.reduceat(known, first), np.add.reduceat(sizes, first)


def natural_runs(arrays: tuple) -> list:
    """arrays cut before each key that is smaller than the one before it; if that gives very many, sorted."""
    import numpy as np

    keys = arrays[0]
    cuts = np.flatnonzero(keys[1:] < keys[:-1]) + 1
    if len(cuts) > 64:
        order = np.argsort(keys, kind="stable")
        return [tuple(x[order] for x in arrays)]
    edges = [0, *cuts.tolist(), len(keys)]
    return [tuple(x[a:b] for x in arrays) for a, b in zip(edges, edges[1:], strict=False)]


def merge_step(levels: int, level: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What a node does once its records are there: merge them, and address each for the exchange over bit level."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        parts = []
        for b in batches:
            if b.num_rows:
                column = {name: b.column(name) for name in b.schema.names}
                key = np.array(column["key"].to_pylist(), f"S{KEY}")
                known = np.asarray(column["keep_id"].is_valid())
                ids = column["keep_id"].fill_null(0).to_numpy(zero_copy_only=False)
                parts.append((column["node"].to_numpy(), key, ids, known, column["group_size"].to_numpy()))
        if not parts:
            return
        node, *arrays = (np.concatenate(x) for x in zip(*parts, strict=True))
        keys, ids, known, sizes = combined(merged(natural_runs(tuple(arrays))))
        here = int(node[0])
        if level < levels:
            home = keys.view(np.uint8).reshape(len(keys), KEY)[:, :4].copy().view(">u4").ravel().astype(np.int64)
            bit = 1 << level
            to = (here & ~bit) | (home & bit)
        else:
            to = np.full(len(keys), here)
        for k in range(0, len(keys), 1 << 16):
            some = slice(k, k + (1 << 16))
            raw = keys[some]
            offsets = pa.py_buffer((np.arange(len(raw) + 1, dtype=np.int32) * KEY).tobytes())
            binary = pa.Array.from_buffers(pa.binary(), len(raw), [None, offsets, pa.py_buffer(raw.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [pa.array(to[some].astype(np.int32)), binary, pa.array(ids[some], mask=~known[some]), pa.array(sizes[some].astype(np.int64))], names=["node", "key", "keep_id", "group_size"]
            )

    return work


def tree_merge(rows: DataFrame, nodes: int) -> DataFrame:
    """key, keep_id (smallest identifier, null if there is none) and group_size of the keys of rows (doc_id, key)."""
    levels = max(1, (max(nodes, 2) - 1).bit_length())
    node = (F.spark_partition_id() % (1 << levels)).cast("int")
    runs = rows.select(node.alias("node"), "key", F.col("doc_id").cast("long").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    runs = runs.mapInArrow(merge_step(levels, 0), RECORD)
    for level in range(1, levels + 1):
        runs = runs.repartitionById(1 << levels, "node").mapInArrow(merge_step(levels, level), RECORD)
    return runs.drop("node")


def exact_dedup(docs: DataFrame, nodes: int | None = None) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256."""
    rows = cut(digests(docs))
    groups = tree_merge(rows, nodes or partitions(docs.sparkSession)).where("group_size > 1")
    joined = rows.join(groups, "key", "left")
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id").cast(docs.schema["doc_id"].dataType))
    return joined.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), F.lower(F.hex(F.substring("key", 1, 32))).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """docs with all its columns, one row for each normalised text: that of the smallest doc_id.

    A row that repeats both doc_id and text is a copy too. Rows that share a doc_id but not the text
    are told apart by the digest, which is only taken of rows whose doc_id is among those in question.
    """
    found = cut(exact_dedup(docs))
    digest = F.sha2(F.encode(normal_text(F.col("d.text")), "UTF-8"), 256)
    same = F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")) & ~(digest != F.col("r.text_sha256"))
    gone = sent_if_small(found.where("not kept").select("doc_id", "text_sha256").distinct())
    left = docs.alias("d").join(gone.alias("r"), same, "left_anti").select("d.*")
    twice = sent_if_small(found.where("kept and group_size > 1").groupBy("doc_id", "text_sha256").count().where("count > 1").drop("count"))
    if twice.isEmpty():
        return left
    once = left.alias("d").join(twice.alias("r"), same, "left_anti").select("d.*")
    again = left.alias("d").join(twice.alias("r"), same, "left_semi").select(F.struct("d.*").alias("row"), digest.alias("digest"))
    return once.union(again.dropDuplicates(["digest"]).select("row.*"))
