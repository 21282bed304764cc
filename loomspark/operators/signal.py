"""Classical stand-ins for speech models: energy for activity, band spectra for voices. They need no weights and give real results on clean audio.

Registered with the other scorers; each takes wav files as bytes, and gives null for one that can't be read.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomspark.operators.scorers import Batch, register, score, wav

#: Seconds of a frame of activity and of a window of voice.
FRAME = 0.02
WINDOW = 0.5
SPANS = "array<struct<start:double,end:double>>"
TURNS = "array<struct<start:double,end:double,speaker:string>>"


def samples_of(raw: bytes):
    """Mono samples of -1 to 1 and their rate."""
    import numpy as np

    rate, channels, _, data = wav(raw)
    return np.frombuffer(data, "<i2").reshape(-1, channels).mean(axis=1) / 32768, rate


def frame_levels(x, rate: int, frame: float = FRAME):
    """Root mean square of each whole frame."""
    import numpy as np

    n = max(1, round(frame * rate))
    whole = x[: len(x) // n * n].reshape(-1, n)
    return np.sqrt((whole * whole).mean(axis=1)), n / rate


def speech_spans(x, rate: int, least_db: float = -40.0, min_speech: float = 0.1, min_silence: float = 0.1) -> list[tuple[float, float]]:
    """Where frames are loud: silences shorter than a bound are speech, and what speech is then shorter than a bound is not (M1)."""
    import numpy as np

    level, step = frame_levels(x, rate)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], level >= 10 ** (least_db / 20), [0]])))
    out: list[list[float]] = []
    for a, b in zip(edges[::2] * step, edges[1::2] * step, strict=True):
        if out and a - out[-1][1] < min_silence - 1e-9:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(float(a), float(b)) for a, b in out if b - a >= min_speech - 1e-9]


def band_embedding(x, bands: int = 16):
    """Shares of energy in bands of equal width, of length 1 (M4)."""
    import numpy as np

    power = np.abs(np.fft.rfft(x)) ** 2
    power[:1] = 0
    parts = np.array([p.sum() for p in np.array_split(power, bands)])
    norm = np.linalg.norm(parts)
    return parts / norm if norm else parts


def voice_turns(x, rate: int, window: float = WINDOW, same: float = 0.9) -> list[tuple[float, float, str]]:
    """Windows given to the first voice that they are alike, else to a new one; neighbours of a voice are one turn, quiet windows none (M2)."""
    import numpy as np

    n, voices, out = round(window * rate), [], []
    for k in range(0, len(x), n):
        e = band_embedding(x[k : k + n])
        if not e.any():
            continue
        who = next((i for i, v in enumerate(voices) if float(np.dot(v, e)) >= same), len(voices))
        if who == len(voices):
            voices.append(e)
        start, end = k / rate, min(k + n, len(x)) / rate
        if out and out[-1][2] == f"S{who}" and out[-1][1] == start:
            out[-1] = (out[-1][0], end, f"S{who}")
        else:
            out.append((start, end, f"S{who}"))
    return out


def snr_db(x, rate: int) -> float:
    """Level of the loud half of frames over that of the quiet half, within 0 to 60 dB (M5)."""
    import numpy as np

    level = np.sort(frame_levels(x, rate)[0])
    quiet, loud = level[: len(level) // 2], level[len(level) // 2 :]
    if not len(quiet) or not loud.any():
        return 0.0
    return float(np.clip(20 * np.log10(loud.mean() / max(quiet.mean(), 1e-6)), 0, 60))


def _each(f) -> Batch:
    return lambda items: [f(*samples_of(x)) for x in items]


register("energy_vad", SPANS)(lambda: _each(lambda x, rate: [{"start": a, "end": b} for a, b in speech_spans(x, rate)]))
register("band_turns", TURNS)(lambda: _each(lambda x, rate: [{"start": a, "end": b, "speaker": s} for a, b, s in voice_turns(x, rate)]))
register("band_embedding", "array<double>")(lambda: _each(lambda x, rate: band_embedding(x).tolist()))
register("energy_snr", "double", -1.0)(lambda: _each(snr_db))


@register("no_separation", "binary", None)
def no_separation() -> Batch:
    """A separator that this machine has no model for: it always fails."""

    def fail(items: list) -> list:
        raise OSError("no model")

    return fail


def separated(raw: Column, name: str = "no_separation") -> Column:
    """The speech of a wav file without its background by a scorer; the file itself where that fails (M3)."""
    return F.coalesce(score(name, raw), raw)
