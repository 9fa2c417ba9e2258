"""Signals as arrays of floats: measures, levels, mixing, rooms and channels, in numpy through Arrow.

What needs a package that isn't here (loudness standards, room simulation) has a plain stand-in: peak level, a
decaying noise tail, a band-pass by the Fourier transform.
"""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RATE = 16_000
#: Bounds of a clip's measures.
FRAME, CLIPPED, SNR_MOST, TRANSIENT_DB = 0.025, 0.999, 80.0, -9.0


def mono(x: np.ndarray) -> np.ndarray:
    """Channels (last axis) averaged, as 32-bit floats."""
    x = np.asarray(x, np.float32)
    return x if x.ndim == 1 else x.mean(axis=-1, dtype=np.float32)


def resample(x: np.ndarray, old: int, new: int) -> np.ndarray:
    """By the Fourier transform: what the new rate can't hold is cut off."""
    if old == new or not len(x):
        return np.asarray(x, np.float32)
    n = round(len(x) * new / old)
    spectrum = np.fft.rfft(x)
    kept = np.zeros(n // 2 + 1, complex)
    m = min(len(kept), len(spectrum))
    kept[:m] = spectrum[:m]
    return (np.fft.irfft(kept, n) * n / len(x)).astype(np.float32)


def read_wav(data: bytes, rate: int = RATE) -> np.ndarray:
    with wave.open(io.BytesIO(data)) as w:
        width, channels, raw = w.getsampwidth(), w.getnchannels(), w.readframes(w.getnframes())
        if width == 3:
            padded = np.zeros((len(raw) // 3, 4), np.uint8)
            padded[:, 1:] = np.frombuffer(raw, np.uint8).reshape(-1, 3)
            x = padded.view("<i4").ravel() / 2**31
        else:
            x = np.frombuffer(raw, {1: np.uint8, 2: "<i2", 4: "<i4"}[width]).astype(np.float64)
            x = (x - 128) / 128 if width == 1 else x / 2 ** (8 * width - 1)
        return resample(mono(x.reshape(-1, channels)), w.getframerate(), rate)


def write_wav(x: np.ndarray, rate: int = RATE, width: int = 2) -> bytes:
    """16 or 24 bits a sample."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(width)
        w.setframerate(rate)
        whole = np.clip(np.round(np.asarray(x, np.float64) * (2 ** (8 * width - 1) - 1)), -(2 ** (8 * width - 1)), 2 ** (8 * width - 1) - 1).astype("<i4")
        w.writeframes(whole.astype("<i2").tobytes() if width == 2 else whole.view(np.uint8).reshape(-1, 4)[:, :3].tobytes())
    return out.getvalue()


def rms(x: np.ndarray) -> float:
    return float(np.sqrt(np.mean(np.square(x, dtype=np.float64)))) if len(x) else 0.0


def frames(x: np.ndarray, seconds: float = FRAME, rate: int = RATE) -> np.ndarray:
    size = int(seconds * rate)
    return np.asarray(x[: len(x) // size * size], np.float64).reshape(-1, size)


def frame_rms(x: np.ndarray, seconds: float = FRAME, rate: int = RATE) -> np.ndarray:
    return np.sqrt(np.mean(np.square(frames(x, seconds, rate)), axis=1))


def active_rms(x: np.ndarray, below: float = 30.0) -> float:
    """Of the frames within so many dB of the loudest."""
    r = frame_rms(x)
    return float(np.sqrt(np.mean(np.square(r[r >= r.max() * 10 ** (-below / 20)])))) if len(r) and r.max() > 0 else rms(x)


def peak_db(x: np.ndarray) -> float:
    top = float(np.abs(x).max()) if len(x) else 0.0
    return 20 * np.log10(top) if top > 0 else -999.0


def to_peak(x: np.ndarray, db: float = -1.0) -> np.ndarray:
    top = np.abs(x).max() if len(x) else 0
    return np.asarray(x * (10 ** (db / 20) / top), np.float32) if top > 0 else np.asarray(x, np.float32)


def to_level(x: np.ndarray, db: float, ceiling: float = -1.0) -> np.ndarray:
    """Active level to so many dB below full scale, peaks under a ceiling."""
    level = active_rms(x)
    out = np.asarray(x * (10 ** (db / 20) / level), np.float32) if level > 0 else np.asarray(x, np.float32)
    return to_peak(out, ceiling) if peak_db(out) > ceiling else out


def speech(x: np.ndarray, rate: int = RATE, over_floor: float = 12.0, join: float = 0.2, least: float = 0.1) -> list[tuple[float, float]]:
    """Stretches (start, end) of frames well above the noise floor; short gaps are closed, short stretches dropped."""
    r = frame_rms(x, FRAME, rate)
    if not len(r) or r.max() <= 0:
        return []
    floor = max(np.percentile(r, 10), r.max() * 1e-4)
    on = np.flatnonzero(r > min(floor * 10 ** (over_floor / 20), r.max() * 0.5))
    if not len(on):
        return []
    cuts = np.flatnonzero(np.diff(on) * FRAME > join)
    spans = zip(on[np.r_[0, cuts + 1]] * FRAME, (on[np.r_[cuts, len(on) - 1]] + 1) * FRAME, strict=True)
    return [(float(a), float(b)) for a, b in spans if b - a >= least]


def speech_mask(n: int, segments: list[tuple[float, float]], rate: int = RATE) -> np.ndarray:
    out = np.zeros(n, bool)
    for a, b in segments:
        out[int(a * rate) : int(b * rate)] = True
    return out


def measure(x: np.ndarray, segments: list[tuple[float, float]], rate: int = RATE) -> dict[str, float]:
    """Duration, speech, signal to noise, peak, clipping and transients a minute."""
    seconds = len(x) / rate
    if seconds < 0.05:
        return {"durada_s": round(seconds, 3), "durada_parla_s": 0.0, "ratio_parla": 0.0, "snr_db": -999.0, "pic_dbfs": -999.0, "ratio_clipping": 0.0, "transitoris_per_min": 999.0}
    mask, r = speech_mask(len(x), segments, rate), frame_rms(x, FRAME, rate)
    spoken = frames(mask, FRAME, rate).mean(axis=1) > 0.5
    level, floor = float(np.median(r[spoken])) if spoken.any() else 0.0, float(np.percentile(r, 10)) if len(r) else 0.0
    snr = -999.0 if level <= 0 else SNR_MOST if floor <= 0 else min(SNR_MOST, 20 * np.log10(level / floor))
    loud = int((r[~spoken] > level * 10 ** (TRANSIENT_DB / 20)).sum()) if level > 0 else 0
    return {
        "durada_s": round(seconds, 3), "durada_parla_s": round(float(mask.sum()) / rate, 3), "ratio_parla": round(float(mask.mean()), 3), "snr_db": round(float(snr), 1), "pic_dbfs": round(float(peak_db(x)), 1),
        "ratio_clipping": round(float(np.mean(np.abs(x) >= CLIPPED)), 5), "transitoris_per_min": round(loud * 60 / seconds, 1),
    }


def constancy(x: np.ndarray, segments: list[tuple[float, float]], rate: int = RATE) -> float:
    """How even the level of speech is, from 0 to 1."""
    r = frame_rms(x, 0.05, rate)
    spoken = r[frames(speech_mask(len(x), segments, rate), 0.05, rate).mean(axis=1) > 0.5]
    return 0.0 if len(spoken) < 4 or spoken.mean() <= 0 else float(np.clip(1 - spoken.std() / spoken.mean() / 1.2, 0, 1))


def trim(x: np.ndarray, segments: list[tuple[float, float]], margin: float = 0.15, rate: int = RATE) -> tuple[np.ndarray, list[tuple[float, float]]]:
    """From a margin before the first speech to one after the last; segments count from the new start."""
    if not segments:
        return x, segments
    start, end = max(0.0, segments[0][0] - margin), min(len(x) / rate, segments[-1][1] + margin)
    return x[int(start * rate) : int(end * rate)], clipped(segments, start, end)


def clipped(segments: list[tuple[float, float]], start: float, end: float) -> list[tuple[float, float]]:
    return [(max(a, start) - start, min(b, end) - start) for a, b in segments if b > start and a < end]


def cut_point(x: np.ndarray, around: float, reach: float = 0.3, rate: int = RATE) -> float:
    """The quietest moment near a time."""
    low = max(0, int((around - reach) * rate))
    r = frame_rms(x[low : int((around + reach) * rate)], 0.01, rate)
    return (low / rate + float(r.argmin()) * 0.01) if len(r) else around


def best_window(segments: list[tuple[float, float]], total: float, length: float) -> float:
    """The start, among those of segments, from which a window holds the most speech."""
    starts = [min(a, max(0.0, total - length)) for a, _ in segments] or [0.0]
    held = lambda s: sum(b - a for a, b in clipped(segments, s, s + length))
    return max(starts, key=lambda s: (held(s), -s))


def crop(noise: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """So many samples of a noise from a random place, repeated if it is shorter."""
    if not len(noise):
        return np.zeros(n, np.float32)
    start = int(rng.integers(0, max(1, len(noise) - n + 1)))
    return np.resize(noise[start:] if len(noise) - start >= n else noise, n).astype(np.float32)


def mix_at(x: np.ndarray, noise: np.ndarray, snr: float) -> np.ndarray:
    """Noise added so that speech stands so many dB above it."""
    level, other = active_rms(x), rms(noise)
    return np.asarray(x + noise * (level / other * 10 ** (-snr / 20)), np.float32) if other > 0 and level > 0 else np.asarray(x, np.float32)


def coloured(n: int, slope: float, rng: np.random.Generator) -> np.ndarray:
    """Noise whose power falls with frequency to the power slope: 0 white, 1 pink, 2 brown."""
    f = np.fft.rfftfreq(n)
    f[0] = f[1] if n > 1 else 1
    x = np.fft.irfft((rng.normal(size=len(f)) + 1j * rng.normal(size=len(f))) * f ** (-slope / 2), n)
    return to_peak(x.astype(np.float32))


def babble(voices: list[np.ndarray], n: int, rng: np.random.Generator) -> np.ndarray:
    """Several voices at one level, each from a random place."""
    parts = [crop(v, n, rng) for v in voices]
    return to_peak(np.sum([p / max(rms(p), 1e-9) for p in parts], axis=0).astype(np.float32)) if parts else np.zeros(n, np.float32)


def room(rt60: float, distance: float, rng: np.random.Generator, rate: int = RATE) -> np.ndarray:
    """A direct sound and a tail that decays by 60 dB in rt60 seconds, louder from farther away."""
    n = max(1, int(rt60 * rate))
    tail = rng.normal(size=n) * 10 ** (-3 * np.arange(n) / n) * 0.05 * max(distance, 0.1)
    tail[0] = 1
    return tail.astype(np.float32)


def convolve(x: np.ndarray, response: np.ndarray) -> np.ndarray:
    """Length and level stay; the delay of the direct sound is taken out."""
    n = len(x) + len(response) - 1
    y = np.fft.irfft(np.fft.rfft(x, n) * np.fft.rfft(response, n), n)
    start = int(np.abs(response).argmax())
    y = y[start : start + len(x)]
    level = rms(y)
    return np.asarray(y * (rms(x) / level) if level > 0 else y, np.float32)


def rt60(response: np.ndarray, rate: int = RATE) -> float:
    """Decay time by backward integration, from the slope between -5 and -25 dB."""
    energy = np.cumsum(np.square(response[::-1], dtype=np.float64))[::-1]
    db = 10 * np.log10(np.maximum(energy / energy[0], 1e-12))
    at = lambda level: int(np.argmax(db <= level))
    return 3 * (at(-25) - at(-5)) / rate


#: Bands in Hz and quantisation steps of channels.
CHANNELS = {"telephone": (300, 3400, 256), "voip": (80, 7000, 4096), "walkie": (500, 2800, 64), "lapel": (120, 7600, 0), "lectern": (90, 7800, 0), "studio": (40, 8000, 0)}


def channel(x: np.ndarray, name: str, rate: int = RATE) -> np.ndarray:
    low, high, steps = CHANNELS[name]
    spectrum, f = np.fft.rfft(x), np.fft.rfftfreq(len(x), 1 / rate)
    spectrum[(f < low) | (f > high)] = 0
    y = np.fft.irfft(spectrum, len(x))
    return np.asarray(np.round(y * steps) / steps if steps else y, np.float32)


def cross_fade(parts: list[np.ndarray], seconds: float = 0.05, rate: int = RATE) -> np.ndarray:
    """Parts one after the other, each fading into the next."""
    out = np.asarray(parts[0], np.float32)
    for p in parts[1:]:
        n = min(int(seconds * rate), len(out), len(p))
        ramp = np.linspace(0, 1, n, dtype=np.float32)
        out = np.concatenate([out[: len(out) - n], out[len(out) - n :] * (1 - ramp) + p[:n] * ramp, p[n:]])
    return out


def health(x: np.ndarray) -> dict[str, float | bool]:
    """Whether a signal has no-numbers or clipping, and its crest factor in dB."""
    bad = bool(np.isnan(x).any())
    level = rms(np.nan_to_num(x))
    return {"nan": bad, "clipped": bool((np.abs(np.nan_to_num(x)) >= CLIPPED).any()), "crest_db": round(peak_db(np.nan_to_num(x)) - 20 * float(np.log10(level)), 2) if level > 0 else 0.0}


def simulate(x: np.ndarray, setting: dict, seed: int, noise: np.ndarray | None = None) -> tuple[np.ndarray, dict]:
    """Room, noise, channel and level of a setting; all that is random comes from the seed."""
    rng, meta = np.random.default_rng(seed), {}
    between = lambda r: float(rng.uniform(*r))
    if setting.get("rt60"):
        x = convolve(x, room(setting["rt60"], setting.get("distance", 1.0), rng))
        meta["rt60"] = setting["rt60"]
    if setting.get("snr_db"):
        meta["snr_db"] = round(between(setting["snr_db"]), 2)
        x = mix_at(x, crop(noise, len(x), rng) if noise is not None else coloured(len(x), 1.0, rng), meta["snr_db"])
    if setting.get("channel"):
        x = channel(x, setting["channel"])
        meta["channel"] = setting["channel"]
    meta["level_db"] = round(between(setting.get("level_db", (-23, -23))), 2)
    return to_level(x, meta["level_db"]), meta


# --- as columns and tables

MEASURES = "durada_s double, durada_parla_s double, ratio_parla double, snr_db double, pic_dbfs double, ratio_clipping double, transitoris_per_min double, constancia double"


def measured(rows: DataFrame, key: str, samples: str) -> DataFrame:
    """Rows (key, measures) of signals as arrays; null signals are silent."""

    names = [c.split()[0] for c in MEASURES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            out = []
            for x in part.column(1):
                x = np.zeros(0, np.float32) if x.values is None else _floats(x)
                s = speech(x)
                out.append(measure(x, s) | {"constancia": round(constancy(x, s), 3)})
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array([o[n] for o in out], pa.float64(), from_pandas=True) for n in names)], ["key", *names])

    return rows.select(F.col(key).cast("string").alias("key"), F.col(samples).alias("x")).mapInArrow(run, f"key string, {MEASURES}")


#: Values of signals that are worked on and handed back at once.
PART_VALUES = 1_000_000


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of batches (column 1: signals) of PART_VALUES values or a single row; they share the batches' memory."""
    for batch in batches:
        ends = np.cumsum([0, *(len(x.values) if x.values is not None else 0 for x in batch.column(1))])
        at = 0
        while at < batch.num_rows:
            upto = max(at + 1, int(np.searchsorted(ends, ends[at] + PART_VALUES, side="right")) - 1)
            yield batch.slice(at, upto - at)
            at = upto


def _floats(x: pa.ListScalar) -> np.ndarray:
    return np.asarray(x.values.to_numpy(zero_copy_only=False), np.float32)


def simulated(rows: DataFrame, key: str, samples: str, seed: str, setting: dict) -> DataFrame:
    """Rows (key, samples, snr_db, level_db) of signals put into a setting."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            done = [simulate(_floats(x), setting, int(s.as_py())) for x, s in zip(part.column(1), part.column(2), strict=True)]
            out = pa.array([np.asarray(y, np.float32) for y, _ in done], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([part.column(0), out, pa.array([m.get("snr_db") for _, m in done], pa.float64()), pa.array([m["level_db"] for _, m in done], pa.float64())], ["key", "samples", "snr_db", "level_db"])

    slim = rows.select(F.col(key).cast("string").alias("key"), F.col(samples).alias("x"), F.col(seed).alias("s"))
    return slim.mapInArrow(run, "key string, samples array<float>, snr_db double, level_db double")


def unit(x: Column, low: float, high: float) -> Column:
    """How far a value has come from low to high, within 0 and 1."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (x - low) / (high - low)))


def quality_score(least_snr: float = 20.0, good_snr: float = 45.0, least_speech: float = 0.5, most_transients: float = 30.0, most_clipping: float = 0.001) -> Column:
    """A clip's score: signal to noise .45, speech .25, few transients .20, no clipping .10."""
    clean = F.when(F.col("ratio_clipping") > most_clipping, 0.0).otherwise(1.0)
    return F.bround(0.45 * unit(F.col("snr_db"), least_snr, good_snr) + 0.25 * unit(F.col("ratio_parla"), least_speech, 0.95) + 0.20 * (1 - unit(F.col("transitoris_per_min"), 0, most_transients)) + 0.10 * clean, 3)


def duration_score(d: Column, least: float = 2.5, low: float = 3.0, high: float = 5.0, most: float = 8.0) -> Column:
    """1 for the ideal lengths, falling to 0 at the bounds."""
    return F.when(d.between(low, high), 1.0).when(d < low, F.greatest(F.lit(0.0), (d - least) / (low - least))).otherwise(F.greatest(F.lit(0.0), (most - d) / (most - high)))


def clip_score(least_snr: float = 20.0, good_snr: float = 45.0, least_speech: float = 0.5, most_transients: float = 30.0) -> Column:
    """A reference clip's score: .35 signal to noise, .20 speech, .15 each for transients, duration and constancy."""
    return F.bround(
        0.35 * unit(F.col("snr_db"), least_snr, good_snr) + 0.20 * unit(F.col("ratio_parla"), least_speech, 0.98) + 0.15 * (1 - unit(F.col("transitoris_per_min"), 0, most_transients)) + 0.15 * duration_score(F.col("durada_s")) + 0.15 * F.col("constancia"), 3
    )


def clipped_segments(segments: Column | str, start: Column, end: Column) -> Column:
    """Segments (ini, fi) that meet a span, cut to it and counted from its start."""
    s = F.col(segments) if isinstance(segments, str) else segments
    met = F.filter(s, lambda x: (x["fi"] > start) & (x["ini"] < end))
    return F.transform(met, lambda x: F.struct((F.greatest(x["ini"], start) - start).alias("ini"), (F.least(x["fi"], end) - start).alias("fi")))
