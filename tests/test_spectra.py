import wave

import numpy as np
import pytest

from timeloom.operators import spectra
from timeloom.sources import files

RATE, HOP = 22050, 256


def tone(hertz, seconds, at=0.0):
    t = np.arange(int(seconds * RATE)) / RATE
    return 0.3 * np.sin(2 * np.pi * hertz * t) * (t >= at)


def write(path, sound, channels=1):
    path.parent.mkdir(parents=True, exist_ok=True)
    with wave.open(str(path), "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(2)
        w.setframerate(RATE)
        w.writeframes(np.repeat((sound * 32767).astype("<i2"), channels).tobytes())


@pytest.fixture(scope="module")
def songs(tmp_path_factory):
    folder = tmp_path_factory.mktemp("songs")
    rng = np.random.default_rng(1)
    write(folder / "one" / "piano.wav", np.concatenate((tone(440, 1.0), tone(261.63, 1.0) + tone(329.63, 1.0))), 2)
    clicks = np.zeros(RATE * 2)
    for at in (0.5, 1.0, 1.5):
        clicks[int(at * RATE) : int(at * RATE) + 300] = rng.normal(size=300) * 0.4
    write(folder / "one" / "drums.wav", clicks)
    write(folder / "two" / "bass.wav", tone(55, 0.7, 0.3))
    write(folder / "two" / "empty.wav", np.zeros(0))
    return folder


def test_frames_do_not_depend_on_where_a_sound_is_cut(spark, songs):
    made = {}
    for frames in (7, 50, 100_000):
        pieces = files.audio_pieces(spark, f"{songs}/*/*.wav", frames, HOP)
        rows = spectra.spectral_frames(pieces, ["song", "stem"], HOP, "stem").orderBy("song", "stem", "frame").collect()
        made[frames] = [(r.song, r.stem, r.frame) for r in rows], np.array([(r.t, r.level, r.low, r.onset, r.flux, r.change, *r.chroma) for r in rows])
    for frames in (7, 50):
        assert made[frames][0] == made[100_000][0]
        assert np.allclose(made[frames][1], made[100_000][1], atol=1e-9)
    assert {r[1] for r in made[7][0]} == {"piano", "drums", "bass"}  # a file without samples has no frames


def test_chroma_and_levels_of_known_sounds(spark, songs):
    frames = spectra.spectral_frames(files.audio_pieces(spark, f"{songs}/*/*.wav", 40, HOP), ["song", "stem"], HOP, "stem")
    piano = sorted((r.t, r.chroma, r.level) for r in frames.where("stem = 'piano'").collect())
    at = lambda s: np.array(min(piano, key=lambda r: abs(r[0] - s))[1])
    assert at(0.5).argmax() == 9 and at(0.5)[9] > 0.95
    assert set(np.argsort(at(1.5))[-2:]) == {0, 4} and at(1.5)[9] < 0.1
    assert min(piano, key=lambda r: abs(r[0] - 0.5))[2] == pytest.approx(0.3 / np.sqrt(2), rel=0.05)
    bass = [(r.t, r.low) for r in frames.where("stem = 'bass'").collect()]
    assert max(v for t, v in bass if t < 0.2) < 0.05 * max(v for t, v in bass if t > 0.4)


def test_novelty_follows_the_role(spark, songs):
    frames = spectra.spectral_frames(files.audio_pieces(spark, f"{songs}/one/*.wav", 64, HOP), ["song", "stem"], HOP, "stem")
    rows = spectra.role_novelty(frames, ["song", "stem"], "stem").collect()
    assert min(r.novelty for r in rows) == 0.0 and max(r.novelty for r in rows) == 1.0
    drums = sorted((r.t, r.novelty) for r in rows if r.stem == "drums")
    strong = [t for t, v in drums if v > 0.5]
    assert all(min(abs(t - s) for s in (0.5, 1.0, 1.5)) < 0.06 for t in strong) and all(min(abs(t - s) for t in strong) < 0.06 for s in (0.5, 1.0, 1.5))
    piano = max((r for r in rows if r.stem == "piano" and 0.2 < r.t < 1.8), key=lambda r: r.novelty)
    assert abs(piano.t - 1.0) < 0.12
    assert spectra.role_novelty(frames.limit(0), ["song", "stem"], "stem").collect() == []
