"""Frames of sound by short-time Fourier transforms: rhythm, bands and harmony, of pieces that overlap.

A sound comes in pieces of samples (``sources.files.audio_pieces``), each with
a margin of its neighbours' samples as wide as any of its frames reaches. So
the frames of a piece need no other piece, and a long sound is as many tasks
as it has pieces; frames are the same wherever it is cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Band in hertz (0: open) and weights of onset, flux and harmonic change in the novelty of each role.
PROFILES = {
    "drums": (30.0, 0.0, 0.70, 0.30, 0.00),
    "bass": (30.0, 1200.0, 0.65, 0.25, 0.10),
    "guitar": (70.0, 6500.0, 0.45, 0.45, 0.10),
    "piano": (40.0, 7000.0, 0.45, 0.20, 0.35),
    "full": (30.0, 0.0, 0.45, 0.35, 0.20),
}
OTHER = (30.0, 0.0, 0.60, 0.30, 0.10)
WINDOW = 2048  # samples of a transform
AROUND = 8  # frames before and after, among which what lasts is told from what strikes
LOW = 150.0  # hertz, upper end of the low band
FRAME = "frame bigint, t double, level double, low double, onset double, flux double, change double, chroma array<double>"


def margin(hop: int) -> int:
    """Samples that a piece needs of its neighbours on either side."""
    return WINDOW // 2 + (AROUND + 1) * hop


def _middle(values: np.ndarray, reach: int, axis: int) -> np.ndarray:
    """Running medians over 2 * reach + 1 places; beyond the ends nothing sounds."""
    wide = [(0, 0), (0, 0)]
    wide[axis] = (reach, reach)
    return np.median(np.lib.stride_tricks.sliding_window_view(np.pad(values, wide), 2 * reach + 1, axis=axis), axis=-1)


def frames_of(samples: np.ndarray, rate: float, first: int, before: int, count: int, hop: int, band: tuple[float, float]) -> dict[str, np.ndarray]:
    """Features of ``count`` frames, the first of which is frame ``first`` of its sound and is centred ``before`` samples into ``samples``.

    ``onset`` is the mean rise of the logarithmic spectrum over the frame
    before, ``flux`` the rise within ``band``, ``chroma`` the energy of each
    pitch class (C is 0) in what lasts, ``change`` how far chroma moved.
    """
    extra = AROUND + 1
    span = count + 2 * extra
    start = before - extra * hop - WINDOW // 2
    need = start + (span - 1) * hop + WINDOW
    padded = np.concatenate((np.zeros(max(0, -start)), samples, np.zeros(max(0, need - len(samples)))))[max(0, start) :]
    windows = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[:: hop][:span]
    power = np.abs(np.fft.rfft(windows * np.hanning(WINDOW + 1)[:-1], axis=1))
    hertz = np.fft.rfftfreq(WINDOW, 1 / rate)
    loud = np.log1p(10 * power)
    rise = np.maximum(0.0, np.diff(loud, axis=0)).mean(axis=1)
    inside = (hertz >= band[0]) & (hertz <= (band[1] or rate))
    flux = np.sqrt((np.maximum(0.0, np.diff(power[:, inside], axis=0)) ** 2).sum(axis=1))
    tuned = (hertz >= 55.0) & (hertz <= 5000.0)
    lasting, striking = _middle(power, AROUND, 0)[:, tuned], _middle(power[extra - 1 : -extra], AROUND, 1)[:, tuned]
    kept = np.where(lasting[extra - 1 : -extra] >= striking, lasting[extra - 1 : -extra] ** 2, 0.0)
    classes = np.rint(12 * np.log2(hertz[tuned] / 440.0) + 69).astype(int) % 12
    chroma = np.stack([kept[:, classes == k].sum(axis=1) for k in range(12)], axis=1)
    chroma /= np.maximum(np.linalg.norm(chroma, axis=1, keepdims=True), 1e-9)
    own = slice(extra, extra + count)
    centre = windows[own, WINDOW // 2 - hop // 2 : WINDOW // 2 - hop // 2 + hop]
    quiet = np.arange(first, first + count) == 0  # the first frame of a sound rises over nothing
    return {
        "frame": np.arange(first, first + count), "t": np.arange(first, first + count) * (hop / rate), "level": np.sqrt((centre**2).mean(axis=1)), "low": np.sqrt((power[own][:, hertz <= LOW] ** 2).sum(axis=1)),
        "onset": np.where(quiet, 0.0, rise[extra - 1 : extra - 1 + count]), "flux": np.where(quiet, 0.0, flux[extra - 1 : extra - 1 + count]), "change": np.where(quiet, 0.0, np.linalg.norm(np.diff(chroma, axis=0), axis=1)), "chroma": chroma[1:],
    }


def spectral_frames(pieces: DataFrame, keys: list[str], hop: int = 256, role: str | None = None) -> DataFrame:
    """(keys, frame, t, level, low, onset, flux, change, chroma) of pieces (keys, rate, first, count, before, samples: float32 bytes); ``role`` names the column whose profile gives the band."""
    kinds = dict(pieces.dtypes)
    carried = [*keys, *([role] if role and role not in keys else [])]
    schema = ", ".join([*(f"{k} {kinds[k]}" for k in carried), FRAME])

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for piece in batch.to_dict("records"):
                band = PROFILES.get(str(piece[role]).lower(), OTHER)[:2] if role else OTHER[:2]
                made = frames_of(np.frombuffer(piece["samples"], np.float32).astype(np.float64), piece["rate"], piece["first"], piece["before"], piece["count"], hop, band)
                out = pd.DataFrame({n: list(v) if n == "chroma" else v for n, v in made.items()})
                for at, k in enumerate(carried):
                    out.insert(at, k, piece[k])
                yield out

    return pieces.mapInPandas(work, schema)


def _scaled(column: str, by) -> Column:
    low, high = F.min(column).over(by), F.max(column).over(by)
    return F.when(high - low > 1e-12, (F.col(column) - low) / (high - low)).otherwise(0.0)


def role_novelty(frames: DataFrame, keys: list[str], role: str) -> DataFrame:
    """Adds ``novelty``, 0 to 1 by key: onset, flux and harmonic change, each scaled by key and weighed by the role's profile."""
    by = Window.partitionBy(*keys)
    weight = lambda at: F.coalesce(F.element_at(F.create_map(*(x for name, p in PROFILES.items() for x in (F.lit(name), F.lit(p[at])))), F.lower(F.coalesce(role, F.lit("")))), F.lit(OTHER[at]))
    mixed = weight(2) * _scaled("onset", by) + weight(3) * _scaled("flux", by) + weight(4) * _scaled("change", by)
    return frames.withColumn("_mixed", mixed).withColumn("novelty", _scaled("_mixed", by)).drop("_mixed")
