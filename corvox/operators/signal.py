"""Waveforms: array expressions where these are enough, numpy kernels within Arrow batches elsewhere."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import once


@dataclass(frozen=True)
class AudioSpec:
    """How clips are normalised; the values are fixed by the corpus format."""

    sample_rate: int = 16_000
    min_seconds: float = 3.0
    max_seconds: float = 10.0
    target_rms_dbfs: float = -23.0
    peak_ceiling_dbfs: float = -1.0
    trim_top_db: float = 35.0
    keep_silence_ms: float = 60.0
    long_policy: str = "split"
    short_policy: str = "drop"
    clipping_threshold: float = 0.999
    clipping_max_ratio: float = 0.001

    @property
    def min_samples(self) -> int:
        return int(self.min_seconds * self.sample_rate)

    @property
    def max_samples(self) -> int:
        return int(self.max_seconds * self.sample_rate)


SPEC = AudioSpec()
FRAME, HOP = 2048, 512

# --- array expressions


def sanitized(signal: Column) -> Column:
    """Samples that are no finite numbers become 0."""
    return F.transform(signal, lambda x: F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), F.lit(0.0)).otherwise(x.cast("double")))


def rms(signal: Column) -> Column:
    return F.sqrt(F.aggregate(signal, F.lit(0.0), lambda s, x: s + x * x) / F.size(signal))


def peak(signal: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(signal, F.abs)), F.lit(0.0))


def levelled(signal: Column, spec: AudioSpec = SPEC) -> Column:
    """Scaled to the target RMS, then below the peak ceiling; nearly silent signals aren't scaled up."""
    loud = rms(signal)
    gain = F.when(loud > 1e-8, 10 ** (spec.target_rms_dbfs / 20) / loud).otherwise(1.0)
    ceiling = 10 ** (spec.peak_ceiling_dbfs / 20)
    top = peak(signal) * gain
    scale = F.when(top > ceiling, gain * ceiling / top).otherwise(gain)
    return once(scale, lambda c: F.transform(signal, lambda x: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x * c))))


def chunks(signal: Column, spec: AudioSpec = SPEC) -> Column:
    """An array of clips between the least and the greatest length."""
    n, low, high = F.size(signal), spec.min_samples, spec.max_samples
    none = F.array().cast("array<array<double>>")
    padded = F.array(F.concat(signal, F.array_repeat(F.lit(0.0), F.greatest(F.lit(0), low - n))))
    if spec.long_policy == "drop":
        long = none
    elif spec.long_policy == "crop":
        long = F.array(F.slice(signal, F.floor((n - high) / 2).cast("int") + 1, high))
    else:
        cut = F.transform(F.sequence(F.lit(0), n - 1, F.lit(high)), lambda i: F.slice(signal, i + 1, high))
        long = F.filter(cut, lambda c: F.size(c) >= low)
    return F.when(n < low, padded if spec.short_policy == "pad" else none).when(n <= high, F.array(signal)).otherwise(long)


def quality(signal: Column, spec: AudioSpec = SPEC) -> Column:
    """Codes of what is wrong with a clip; an empty one has no other."""
    n = F.size(signal)
    bad = F.exists(signal, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    clean = sanitized(signal)
    clipped = F.size(F.filter(clean, lambda x: F.abs(x) >= spec.clipping_threshold)) / n
    seconds = n / spec.sample_rate
    codes = F.array(
        F.when(bad, F.lit("nan_inf")), F.when(seconds < spec.min_seconds - 1e-3, F.lit("too_short")), F.when(seconds > spec.max_seconds + 1e-3, F.lit("too_long")),
        F.when(clipped > spec.clipping_max_ratio, F.lit("clipping")), F.when(rms(clean) < 1e-5, F.lit("silent")),
    )
    return F.when(F.coalesce(n, F.lit(0)) <= 0, F.array(F.lit("empty"))).otherwise(F.filter(codes, lambda c: c.isNotNull()))


def joined(signals: Column, gap_samples: int) -> Column:
    """Clips one after another with silence between them."""
    gap = F.array_repeat(F.lit(0.0), gap_samples)
    return F.flatten(F.transform(signals, lambda s, i: F.when(i > 0, F.concat(gap, s)).otherwise(s)))


# --- kernels


def resample(x: np.ndarray, old: int, new: int, taps: int = 32) -> np.ndarray:
    """Band-limited interpolation with a windowed sinc, `taps` zero crossings to each side."""
    if old == new or not len(x):
        return x.astype(np.float32)
    n = int(round(len(x) * new / old))
    scale = min(1.0, new / old)
    half = int(np.ceil(taps / scale))
    out = np.empty(n, dtype=np.float64)
    padded = np.pad(x.astype(np.float64), half + 1)
    offsets = np.arange(-half, half + 1)
    for a in range(0, n, 8192):
        at = np.arange(a, min(n, a + 8192)) * (old / new)
        near = np.floor(at).astype(np.int64)
        t = (near[:, None] + offsets) - at[:, None]
        weight = np.sinc(t * scale) * scale * np.cos(np.clip(t / (half + 1), -1, 1) * np.pi / 2) ** 2
        out[a : a + len(at)] = (padded[near[:, None] + offsets + half + 1] * weight).sum(1)
    return out.astype(np.float32)


def trim(x: np.ndarray, spec: AudioSpec = SPEC) -> np.ndarray:
    """Without silence at both ends: frames more than trim_top_db below the loudest; some silence is kept."""
    if not len(x):
        return x
    padded = np.pad(x.astype(np.float64), FRAME // 2)
    sums = np.r_[0, np.cumsum(padded**2)]
    starts = np.arange(0, len(padded) - FRAME + 1, HOP)
    power = (sums[starts + FRAME] - sums[starts]) / FRAME
    loud = np.flatnonzero(power > power.max() * 10 ** (-spec.trim_top_db / 10)) if power.max() > 0 else np.array([], dtype=int)
    if not len(loud):
        return x
    pad = int(spec.keep_silence_ms / 1000 * spec.sample_rate)
    out = x[max(0, int(loud[0]) * HOP - pad) : min(len(x), (int(loud[-1]) + 1) * HOP + pad)]
    return out if len(out) else x


def level(x: np.ndarray, spec: AudioSpec = SPEC) -> np.ndarray:
    loud = float(np.sqrt(np.mean(x.astype(np.float64) ** 2))) if len(x) else 0.0
    if loud > 1e-8:
        x = x * (10 ** (spec.target_rms_dbfs / 20) / loud)
    top, ceiling = float(np.abs(x).max(initial=0)), 10 ** (spec.peak_ceiling_dbfs / 20)
    return np.clip(x * (ceiling / top) if top > ceiling else x, -1, 1).astype(np.float32)


def fit(x: np.ndarray, spec: AudioSpec = SPEC) -> list[np.ndarray]:
    n, low, high = len(x), spec.min_samples, spec.max_samples
    if n < low:
        return [np.pad(x, (0, low - n))] if spec.short_policy == "pad" else []
    if n <= high:
        return [x]
    if spec.long_policy == "drop":
        return []
    if spec.long_policy == "crop":
        return [x[(n - high) // 2 :][:high]]
    return [c for k in range(0, n, high) if len(c := x[k : k + high]) >= low]


def normalized_clips(x: np.ndarray, rate: int, spec: AudioSpec = SPEC) -> list[np.ndarray]:
    """The whole chain: finite samples, target rate, trimmed, cut to length, levelled."""
    x = np.nan_to_num(np.asarray(x, dtype=np.float32).ravel(), nan=0.0, posinf=0.0, neginf=0.0)
    x = resample(x, rate, spec.sample_rate)
    return [level(c, spec) for c in fit(trim(x, spec), spec)] if len(x) else []


def decode_wav(content: bytes) -> tuple[np.ndarray, int]:
    """Mono samples and rate of a RIFF WAV with 16, 24 or 32-bit integers or 32-bit floats; channels are averaged."""
    if len(content) < 12 or content[:4] != b"RIFF" or content[8:12] != b"WAVE":
        raise ValueError("no RIFF WAVE file")
    at, form, data = 12, None, None
    while at + 8 <= len(content) and data is None:
        size = int.from_bytes(content[at + 4 : at + 8], "little")
        body = content[at + 8 : at + 8 + size]
        if content[at : at + 4] == b"fmt ":
            form = np.frombuffer(body[:16], dtype=np.dtype([("tag", "<u2"), ("channels", "<u2"), ("rate", "<u4"), ("x", "<u4"), ("y", "<u2"), ("bits", "<u2")]))[0], int.from_bytes(body[24:26], "little") if len(body) >= 26 else 0
        elif content[at : at + 4] == b"data":
            data = body
        at += 8 + size + size % 2
    if form is None or data is None:
        raise ValueError("no format or data chunk")
    head, sub = form
    tag = sub if head["tag"] == 0xFFFE else int(head["tag"])
    bits, channels = int(head["bits"]), max(1, int(head["channels"]))
    data = data[: len(data) // (bits // 8 * channels) * (bits // 8 * channels)]
    if tag == 3 and bits == 32:
        x = np.frombuffer(data, dtype="<f4").astype(np.float64)
    elif tag == 1 and bits == 16:
        x = np.frombuffer(data, dtype="<i2") / 2.0**15
    elif tag == 1 and bits == 24:
        b = np.frombuffer(data, dtype=np.uint8).reshape(-1, 3)
        x = (np.column_stack([np.zeros(len(b), dtype=np.uint8), b]).view("<i4").ravel() >> 8) / 2.0**23
    elif tag == 1 and bits == 32:
        x = np.frombuffer(data, dtype="<i4") / 2.0**31
    else:
        raise ValueError(f"WAV format {tag} with {bits} bits")
    return x.reshape(-1, channels).mean(1).astype(np.float32), int(head["rate"])


def encode_wav(x: np.ndarray, rate: int) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(np.asarray(x), -1, 1) * 32767).round().astype("<i2").tobytes())
    return out.getvalue()


#: The error of an item without contents.
NO_AUDIO = "no audio"
CLIPS = "key string, chunk int, signal array<float>, raw_seconds double, error string"


def normalise(items: DataFrame, spec: AudioSpec = SPEC) -> DataFrame:
    """items: key, content (WAV bytes). A row for each clip: key, chunk, signal, raw_seconds, error. A file that can't
    be read or has no usable clip is one row with an error. A waveform goes to Python once; keep
    spark.sql.execution.arrow.maxRecordsPerBatch low for long files."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                if r.content is None:
                    yield pd.DataFrame([(r.key, 0, None, None, NO_AUDIO)], columns=["key", "chunk", "signal", "raw_seconds", "error"])
                    continue
                try:
                    x, rate = decode_wav(r.content)
                    clips, seconds = normalized_clips(x, rate, spec), len(x) / rate
                    out = [(r.key, k, c.tolist(), seconds, None) for k, c in enumerate(clips)] or [(r.key, 0, None, seconds, "no usable clip")]
                except (ValueError, ZeroDivisionError) as e:
                    out = [(r.key, 0, None, None, str(e))]
                yield pd.DataFrame(out, columns=["key", "chunk", "signal", "raw_seconds", "error"])

    return items.select("key", "content").mapInPandas(run, CLIPS)
