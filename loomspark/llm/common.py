"""What the operators of this subpackage share: words, lineage cuts and small expression helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

#: The characters between words, as a regular expression class body and as a literal set.
SPACE = r"\x20\x09-\x0D"
SPACES = " \t\n\x0b\x0c\r"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.

    Only where it is unset, and only in local mode (tests), a temporary folder stands in: on a
    cluster a machine-local folder would be out of reach of the other machines.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if not named:
            if not sc.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            named = tempfile.mkdtemp(prefix="loomspark-checkpoint-")
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df computed once and kept in the shared checkpoint folder, so that losing executors loses nothing."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def word_array(text: Column) -> Column:
    """The words of a text (runs of anything but the six spaces) in order; null and blank texts: none."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{SPACE}]+"))


def word_count(text: Column) -> Column:
    """How many words a text has, without making them."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once, also where body uses it inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Bytes of identifiers and hashes that may be sent to every executor.
BROADCAST_BYTES = 4 << 20


def weight(df: DataFrame) -> int:
    """Bytes that the values of df take, and 16 more a row."""
    sizes = [F.coalesce(F.octet_length(f.name), F.lit(0)) if f.dataType in (StringType(), BinaryType()) else F.lit(8) for f in df.schema.fields]
    return df.agg(F.coalesce(F.sum(sum(sizes, F.lit(16)).cast("long")), F.lit(0))).first()[0]


def sent_if_small(keys: DataFrame) -> DataFrame:
    """Narrow keys (numbers and strings), computed once; broadcast only if their bytes are summed and few, else joined by a shuffle."""
    keys = cut(keys)
    return F.broadcast(keys) if weight(keys) <= BROADCAST_BYTES else keys
