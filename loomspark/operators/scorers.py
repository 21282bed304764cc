"""Models as plug-ins behind Arrow UDFs.

A scorer is a function from a batch of inputs to as many outputs in the same order, made once per Python
worker by its factory. One that fails, for a batch or an item, gives its failure value and never drops a
row. The built-in ones are stubs: deterministic functions of their input, clearly named so, that let whole
pipelines run without models. Real models are registered under their own names.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

Batch = Callable[[list], list]


@dataclass(frozen=True)
class Scorer:
    make: Callable[[], Batch]
    returns: str
    failure: Any = None


_REGISTRY: dict[str, Scorer] = {}


def register(name: str, returns: str, failure: Any = None):
    """Registers a factory of batch functions under a name."""

    def put(make: Callable[[], Batch]) -> Callable[[], Batch]:
        _REGISTRY[name] = Scorer(make, returns, failure)
        return make

    return put


def names() -> list[str]:
    return sorted(_REGISTRY)


def guarded(batch: Batch, items: list, failure: Any) -> list:
    """batch(items); if it fails or miscounts, each item alone, with the failure value for those that fail."""
    try:
        out = batch(items)
        if len(out) == len(items):
            return out
    except Exception:  # noqa: S110  each item gets its own try below
        pass
    out = []
    for x in items:
        try:
            (one,) = batch([x])
        except Exception:
            one = failure
        out.append(one)
    return out


#: Rows that a scorer gets at once: inputs may be large files, and are made Python objects for so many rows only.
SLICE = 256


def score(name: str, *inputs: Column) -> Column:
    """The scorer's output for each row; several inputs come as tuples.

    No iterator UDF, so that Spark computes several scores of a row in one worker and not in a chain of them.
    """
    scorer, made = _REGISTRY[name], []
    kind = to_arrow_type(DataType.fromDDL(scorer.returns))

    @F.arrow_udf(scorer.returns)
    def run(*columns: pa.Array) -> pa.Array:
        if not made:
            made.append(scorer.make())
        out = []
        for at in range(0, len(columns[0]), SLICE):
            parts = [c.slice(at, SLICE).to_pylist() for c in columns]
            items = parts[0] if len(parts) == 1 else list(zip(*parts, strict=True))
            out.append(pa.array(guarded(made[0], items, scorer.failure), kind, from_pandas=True))
        return pa.concat_arrays(out) if out else pa.array([], kind)

    return run(*inputs)


def score_alive(df: DataFrame, name: str, out: str, alive: Column, *inputs: str, key: str = "utt_id") -> DataFrame:
    """df with a score for rows that are alive only; the others keep -1. Casualties of cheap filters cost no model time."""
    some = df.where(alive).select(key, score(name, *map(F.col, inputs)).alias(out))
    return df.drop(out).join(some, key, "left").withColumn(out, F.coalesce(out, F.lit(_REGISTRY[name].failure)))


def score_by_language(
    df: DataFrame, text: str, out: str, returns: str, make: Callable[[str | None], Batch], language: str = "language", salts: int = 16
) -> DataFrame:
    """df with a score by the model of each row's language, every model loaded once per task and language.

    Rows are dealt by language and a salt from the text, so that a language with most of the rows
    is scored by many tasks; at most that many tasks load its model.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models: dict[str | None, Batch] = {}
        for pdf in frames:
            parts = []
            for key, rows in pdf.groupby(language, sort=False, dropna=False):
                name = None if pd.isna(key) else key
                if name not in models:
                    models.clear()  # rows come sorted by language: the last model is over
                    models[name] = make(name)
                parts.append(rows.assign(**{out: models[name](list(rows[text]))}))
            if parts:
                yield pd.concat(parts)

    dealt = df.repartition(F.col(language), F.pmod(F.xxhash64(text), F.lit(salts))).sortWithinPartitions(language)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + f", `{out}` {returns}"
    return dealt.mapInPandas(run, schema)


def _unit(text: Any, salt: str) -> float:
    return int(hashlib.sha1(f"{salt}:{text}".encode()).hexdigest()[:8], 16) / 0xFFFFFFFF


def _stub(salt: str, low: float, high: float) -> Callable[[], Batch]:
    return lambda: lambda items: [-1.0 if x is None or x == "" else low + (high - low) * _unit(x, salt) for x in items]


for _name, _low, _high in (("stub_ppl", 10, 2000), ("stub_alignment", 0, 1), ("stub_dnsmos", 1, 5), ("stub_c50", 0, 60), ("stub_snr", 0, 60), ("stub_llm", 0, 1), ("stub_spell", 0, 1)):
    register(_name, "double", -1.0)(_stub(_name, _low, _high))


@register("stub_asr", "string", None)
def stub_asr() -> Batch:
    """A transcript: the text itself with every tenth word left out."""
    return lambda items: [None if x is None else " ".join(w for i, w in enumerate(x.split()) if i % 10 != 9) for x in items]


@register("stub_embedding", "array<double>", None)
def stub_embedding() -> Batch:
    return lambda items: [None if x is None else [_unit(x, str(k)) - 0.5 for k in range(16)] for x in items]


@register("stub_language", "string", "unknown")
def stub_language() -> Batch:
    return lambda items: ["unknown" if not x else ("en", "fr", "de")[int(_unit(x, "l") * 2.999)] for x in items]


@register("stub_domain", "string", '{"domain": "unknown"}')
def stub_domain() -> Batch:
    kinds = ("news", "talk", "lecture", "unknown")
    return lambda items: [json.dumps({"domain": kinds[int(_unit(x, "d") * 3.999)]}) for x in items]


@register("stub_speakers", "long", None)
def stub_speakers() -> Batch:
    return lambda items: [None if x is None else 1 + int(_unit(x, "s") > 0.9) for x in items]


def decode_pcm(raw: bytes, channels: int = 1) -> list[float]:
    """Mono samples of -1 to 1 from signed 16-bit little-endian ones."""
    import numpy as np

    x = np.frombuffer(raw[: len(raw) // (2 * channels) * 2 * channels], "<i2").astype(np.float32) / 32768
    return x.reshape(-1, channels).mean(axis=1).tolist()


def wav(raw: bytes) -> tuple[int, int, float, bytes]:
    """Sample rate, channels, seconds and sample bytes of a PCM wav file."""
    import io
    import wave

    with wave.open(io.BytesIO(raw)) as w:
        return w.getframerate(), w.getnchannels(), w.getnframes() / w.getframerate(), w.readframes(w.getnframes())


def wav_duration(raw: Column) -> Column:
    """Seconds of wav files, 0 for those that can't be read."""

    def seconds(x: bytes | None) -> float:
        try:
            return wav(x)[2]
        except Exception:
            return 0.0

    @F.pandas_udf("double")
    def run(s: pd.Series) -> pd.Series:
        return s.map(seconds).astype("float64")

    return run(raw)


def clip(samples: list[float], rate: int, start: float, end: float) -> list[float]:
    """Samples of [start, end), clamped to what there is."""
    return samples[max(0, round(start * rate)) : max(0, min(len(samples), round(end * rate)))]


def normalised(samples: list[float], target_db: float = -20.0, most_db: float = 3.0) -> list[float]:
    """Samples at a loudness, the gain within bounds and no peak above 1."""
    import numpy as np

    x = np.asarray(samples, np.float64)
    rms = float(np.sqrt(np.mean(x * x))) if len(x) else 0.0
    if rms <= 0:
        return x.tolist()
    gain = 10 ** (float(np.clip(target_db - 20 * np.log10(rms), -most_db, most_db)) / 20)
    x = x * gain
    peak = float(np.max(np.abs(x)))
    return (x / peak if peak > 1 else x).tolist()
