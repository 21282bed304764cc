"""Small files in any store that Spark can reach: put, read, append-free state with a backup, and copies of whole files.

State files are small and few, so the driver writes them, through the same Hadoop file system that Spark
writes tables with. Copies run in tasks: each task streams its own files between two stores.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _at(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def put(spark: SparkSession, path: str, content: bytes) -> None:
    """Writes a file beside its place and renames it, so readers see the old or the new one, never a part."""
    p, fs = _at(spark, path)
    part, _ = _at(spark, f"{path}.temp")
    out = fs.create(part, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
    fs.delete(p, False)
    if not fs.rename(part, p):
        raise OSError(f"can't rename to {path}")


def get(spark: SparkSession, path: str) -> bytes | None:
    """The content of a small file, None if there is none."""
    p, fs = _at(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def save_state(spark: SparkSession, path: str, state: Any) -> None:
    """State as JSON, what was there before being kept as a backup."""
    before = get(spark, path)
    if before is not None:
        put(spark, f"{path}.backup", before)
    put(spark, path, json.dumps(state, ensure_ascii=False, sort_keys=True).encode())


def load_state(spark: SparkSession, path: str, default: Any = None) -> Any:
    """The state, or the backup if the file is torn or missing, or the default."""
    for name in (path, f"{path}.backup"):
        found = get(spark, name)
        if found is not None:
            try:
                return json.loads(found)
            except ValueError:
                continue
    return default


COPIED = "relative_path string, status string, n_bytes long, attempts int"


def copied(plan: DataFrame, source: str, target: str, tries: int = 3) -> DataFrame:
    """Copies the files of plan (relative_path, file_size) from one folder to another and verifies them.

    A file that is there with its size is left alone, so a copy that was broken off goes on where it
    stopped. Others are streamed to a name of their own, compared by size and digest, and renamed. A file
    that fails every try is a row with its status, not a failed job. status: copied, there, missing, failed.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        from pyarrow import fs as afs

        (a, a_root), (b, b_root) = (afs.FileSystem.from_uri(x if "://" in x else f"file://{x.removeprefix('file:')}") for x in (source, target))

        def digest(where, path: str) -> tuple[int, str]:
            h, n = hashlib.md5(usedforsecurity=False), 0
            with where.open_input_stream(path) as f:
                while block := f.read(1 << 20):
                    h.update(block)
                    n += len(block)
            return n, h.hexdigest()

        def copy(name: str, size: int | None) -> tuple[str, int, int]:
            src, dst = f"{a_root}/{name}", f"{b_root}/{name}"
            there = b.get_file_info(dst)
            if there.type == afs.FileType.File and there.size == size:
                return "there", there.size, 0
            if a.get_file_info(src).type != afs.FileType.File:
                return "missing", 0, 0
            for attempt in range(1, tries + 1):
                try:
                    b.create_dir(dst.rpartition("/")[0], recursive=True)
                    with a.open_input_stream(src) as f, b.open_output_stream(f"{dst}.temp") as out:
                        while block := f.read(1 << 20):
                            out.write(block)
                    n, h = digest(b, f"{dst}.temp")
                    if (n, h) == digest(a, src):
                        b.move(f"{dst}.temp", dst)
                        return "copied", n, attempt
                except OSError:
                    continue
            return "failed", 0, tries

        for pdf in frames:
            sizes = [None if pd.isna(x) else int(x) for x in pdf["file_size"]]
            yield pd.DataFrame([(p, *copy(p, n)) for p, n in zip(pdf["relative_path"], sizes, strict=True)], columns=[c.split()[0] for c in COPIED.split(", ")])

    return plan.select("relative_path", F.col("file_size").cast("long").alias("file_size")).mapInPandas(run, COPIED)


def _little(x: Column, size: int) -> Column:
    digits = F.lpad(F.hex(x.cast("long")), 2 * size, "0")
    return F.concat(*(F.substring(digits, 2 * k + 1, 2) for k in reversed(range(size))))


def wav_bytes(samples: Column, rate: int, channels: int = 1) -> Column:
    """A PCM wav file of 16-bit little-endian samples, as bytes (K8)."""
    n = F.octet_length(samples)
    fixed = lambda x, size: F.lit(x.to_bytes(size, "little").hex())
    head = F.concat(
        F.hex(F.lit(b"RIFF")), _little(n + 36, 4), F.hex(F.lit(b"WAVEfmt ")), fixed(16, 4), fixed(1, 2), fixed(channels, 2), fixed(rate, 4), fixed(rate * channels * 2, 4),
        fixed(channels * 2, 2), fixed(16, 2), F.hex(F.lit(b"data")), _little(n, 4),
    )
    return F.concat(F.unhex(head), samples)
