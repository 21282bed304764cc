"""Token counts by an exact length histogram.

Documents are aggregated by encoded length. The histogram has one row for each length that occurs,
so it is as small as the longest document, not as large as the corpus. Sums over all lengths below
and from each length on then answer, for every context limit, how many documents exceed it, how many
tokens there are in all, and how many are left when longer documents are cut to it.

Lengths are byte-level BPE tokens of the whole text, special tokens being ordinary text.

Sums go in two levels: within blocks of BLOCK lengths, and over blocks, so no task sees all lengths. The
one task that sums over blocks sees the longest length / BLOCK rows: 80,000 for a document of ten million tokens.
Any context limit is answered from the table's two rows around it (truncated_total), whether it occurs or not.

Defined cases: null and empty texts have 0 tokens and are counted; rows that repeat are counted as
often; an empty table gives an empty histogram, and a limit of 0 truncates everything; columns other
than text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomspark.llm.common import cut

#: Lengths of one window: no task sorts more rows for a block, and there are as many blocks as the longest document has tokens / BLOCK.
BLOCK = 128


@lru_cache(maxsize=4)
def encoding(name: str):
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def lengths(docs: DataFrame, name: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """n_tokens of each row of docs (text)."""
    @F.pandas_udf("long")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoding(name).encode_ordinary
        for batch in texts:
            yield pd.Series([len(encode(t)) if t else 0 for t in batch], dtype="int64")

    return docs.select(count("text").alias("n_tokens"))


def length_table(rows: DataFrame) -> DataFrame:
    """One row for each length that occurs in rows (n_tokens).

    n_tokens, n_docs; docs_from and tokens_from: documents of that length or more and their tokens;
    docs_below and tokens_below; kept_tokens: tokens left when every document is cut to n_tokens;
    share_below: the part of all documents that is not longer (for quantiles).
    """
    hist = rows.groupBy("n_tokens").agg(F.count("*").alias("n_docs")).withColumn("block", F.floor(F.col("n_tokens") / BLOCK))
    # Used twice below: kept, so that no text is encoded twice. It has a row for each length, not for each document.
    hist = cut(hist.withColumn("tokens", F.col("n_tokens") * F.col("n_docs")))
    inside = Window.partitionBy("block").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    blocks = hist.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    earlier, whole = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    blocks = blocks.select(
        "block", F.coalesce(F.sum("d").over(earlier), F.lit(0)).alias("d0"), F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("t0"),
        F.sum("d").over(whole).alias("all_docs"), F.sum("t").over(whole).alias("all_tokens"),
    )
    below = lambda c: F.coalesce(F.sum(c).over(inside), F.lit(0))
    hist = hist.withColumn("d1", below("n_docs")).withColumn("t1", below("tokens")).join(blocks, "block")
    hist = hist.withColumn("docs_below", F.col("d0") + F.col("d1")).withColumn("tokens_below", F.col("t0") + F.col("t1"))
    hist = hist.withColumn("docs_from", F.col("all_docs") - F.col("docs_below"))
    return hist.select(
        "n_tokens", "n_docs", "docs_from", (F.col("all_tokens") - F.col("tokens_below")).alias("tokens_from"), "docs_below", "tokens_below",
        (F.col("tokens_below") + F.col("n_tokens") * F.col("docs_from")).alias("kept_tokens"),
        ((F.col("docs_below") + F.col("n_docs")) / F.col("all_docs")).alias("share_below"),
    )


def truncated_total(table: DataFrame, limit: int) -> DataFrame:
    """tokens: what is left when every document is cut to limit, for any limit, from the table's two rows around it."""
    longer = F.col("n_tokens") > limit
    over = F.max(F.when(longer, F.col("docs_from"))) * limit
    below = F.max(F.when(~longer, F.col("tokens_below") + F.col("n_tokens") * F.col("n_docs")))
    return table.agg((F.coalesce(below, F.lit(0)) + F.coalesce(over, F.lit(0))).alias("tokens"))


def quantile(table: DataFrame, q: float) -> DataFrame:
    """n_tokens: the smallest length that at least the part q of all documents does not exceed."""
    return table.where(F.col("share_below") >= q).agg(F.min("n_tokens").alias("n_tokens"))
