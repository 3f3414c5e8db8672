"""Song folders as tables: what files there are and what they are for, and scans of scores, performances, anchors and packages.

Every scan reads through Spark's file sources, so paths may lie on any file
system. A song is the folder that holds its files.
"""

from __future__ import annotations

import io
import json
import struct
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Roles with performances, sound files by suffix, words that name the whole mix, text members of packages.
PERFORMED = ("piano", "guitar", "bass", "drums")
SOUNDS = ("ogg", "wav", "flac", "mp3", "m4a", "opus")
WHOLE_MIX = ("full", "mix", "song", "master")
TEXT_MEMBERS = ("json", "yaml", "yml", "txt", "csv", "md", "log")


def listing(spark: SparkSession, pattern: str) -> DataFrame:
    """(song, path, name, stem, suffix, bytes) of the files of a glob pattern; contents are not read."""
    found = spark.read.format("binaryFile").load(pattern).select("path", F.col("length").alias("bytes"))
    name = F.element_at(F.split("path", "/"), -1)
    made = found.withColumn("name", name).withColumn("song", F.element_at(F.split("path", "/"), -2))
    return made.withColumn("suffix", F.lower(F.regexp_extract("name", r"\.([^.]*)$", 1))).withColumn("stem", F.regexp_replace("name", r"\.[^.]*$", ""))


def performances(files: DataFrame, roles: tuple[str, ...] = PERFORMED) -> DataFrame:
    """MIDI files named after a role, whatever their case and further suffixes, with the ``role``."""
    role = F.substring_index(F.lower("name"), ".", 1)
    return files.withColumn("role", F.when(role.isin(*roles) & (F.col("suffix") == "mid"), role)).where("role is not null")


def stems(files: DataFrame) -> DataFrame:
    """Sound files with ``stem_id`` (``full`` for the whole mix, else a safe name) and ``is_default``: the mix only where it is alone."""
    sounds = files.where(F.col("suffix").isin(*SOUNDS))
    plain = F.regexp_replace(F.regexp_replace(F.lower("stem"), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    marked = sounds.withColumn("stem_id", F.when(F.lower(F.col("stem")).isin(*WHOLE_MIX), "full").otherwise(plain))
    return marked.withColumn("is_default", (F.col("stem_id") != "full") | (F.count("*").over(Window.partitionBy("song")) == 1))


def select_stem(found: DataFrame, asked: Column, aliases: list[str]) -> DataFrame:
    """Per song the stem that was asked for by id; nothing for none, off or disabled; else the first alias that there is."""
    want = F.lower(F.trim(F.coalesce(asked, F.lit(""))))
    rank = F.coalesce(*(F.when(F.col("stem_id") == a, F.lit(i)) for i, a in enumerate(aliases)), F.lit(None).cast("int"))
    placed = found.withColumn("_w", want).withColumn("_r", F.when(F.col("_w").isin("none", "off", "disabled"), None).when(F.col("_w") != "", F.when(F.col("stem_id") == F.col("_w"), 0)).otherwise(rank))
    best = F.row_number().over(Window.partitionBy("song").orderBy("_r", "path"))
    return placed.where("_r is not null").withColumn("_b", best).where("_b = 1").drop("_w", "_r", "_b")


def metadata(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """One row per metadata file; a file that is no JSON gives nulls, a pattern without files no row."""
    if not spark.read.format("binaryFile").option("pathGlobFilter", "*").load(pattern).take(1):
        return spark.createDataFrame([], f"{schema}, song string")
    return spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(pattern).withColumn("song", F.element_at(F.split(F.input_file_name(), "/"), -2))


def reusable(caches: DataFrame, inputs: DataFrame, version: int = 3) -> DataFrame:
    """Cached results that still hold: same digest of the input (``sha256``) and a version of at least ``version``."""
    return caches.join(inputs.select("song", F.col("sha256").alias("_now")), "song").where((F.col("sha256") == F.col("_now")) & (F.col("version") >= version)).drop("_now")


def digests(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, sha256) of whole files."""
    return spark.read.format("binaryFile").load(pattern).select("path", F.sha2("content", 256).alias("sha256"))


def text_members(spark: SparkSession, pattern: str, suffixes: tuple[str, ...] = TEXT_MEMBERS) -> DataFrame:
    """(path, member, text) of the UTF-8 members with such a suffix in each package; other members are left out. Packages that are no archives give one row with nulls."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                rows = []
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        for member in z.namelist():
                            if member.rsplit(".", 1)[-1].lower() in suffixes:
                                try:
                                    rows.append((path, member, z.read(member).decode("utf-8")))
                                except UnicodeDecodeError:
                                    continue
                except zipfile.BadZipFile:
                    rows.append((path, None, None))
                yield pd.DataFrame(rows, columns=["path", "member", "text"])

    return spark.read.format("binaryFile").load(pattern).select("path", "content").mapInPandas(work, "path string, member string, text string")


def _length(data: bytes, at: int) -> tuple[int, int]:
    value = 0
    while True:
        byte = data[at]
        at += 1
        value = value << 7 | byte & 0x7F
        if byte < 0x80:
            return value, at


def read_midi(data: bytes) -> list[tuple[float, float, int, int, int]]:
    """(seconds, duration, channel, pitch, velocity) of every note of a standard MIDI file, in order of onset.

    Tempo changes of all tracks hold for all. The k-th sounding onset of a
    channel and pitch ends with the next release there, first in, first out;
    a release without an onset is ignored and an onset without a release
    lasts no time.
    """
    if data[:4] != b"MThd":
        raise ValueError("not a MIDI file")
    head = struct.unpack(">I", data[4:8])[0]
    _, tracks, division = struct.unpack(">HHh", data[8:14])
    at, events = 8 + head, []
    for number in range(tracks):
        if data[at : at + 4] != b"MTrk":
            break
        end, at, tick, running = at + 8 + struct.unpack(">I", data[at + 4 : at + 8])[0], at + 8, 0, 0
        while at < end:
            step, at = _length(data, at)
            tick += step
            if data[at] >= 0x80:
                running, at = data[at], at + 1
            if running == 0xFF:
                kind, (size, at) = data[at], _length(data, at + 1)
                if kind == 0x51:
                    events.append((tick, 0, number, "tempo", int.from_bytes(data[at : at + size], "big"), 0, 0))
                at += size
            elif running in (0xF0, 0xF7):
                size, at = _length(data, at)
                at += size
            else:
                size = 1 if running >> 4 in (0xC, 0xD) else 2
                if running >> 4 in (0x8, 0x9):
                    on = running >> 4 == 0x9 and data[at + 1] > 0
                    events.append((tick, 2 if on else 1, number, "on" if on else "off", running & 15, data[at], data[at + 1]))
                at += size
        at = end
    events.sort(key=lambda e: (e[0], e[1], e[2]))
    seconds, last, tempo = 0.0, 0, 500_000
    notes: list[list] = []
    waiting: dict[tuple[int, int], list[int]] = {}
    for tick, _, _, kind, a, b, c in events:
        seconds += (tick - last) * (tempo / 1e6 / division if division > 0 else 1 / (-(division >> 8) * (division & 0xFF)))
        last = tick
        if kind == "tempo":
            tempo = a
        elif kind == "on":
            waiting.setdefault((a, b), []).append(len(notes))
            notes.append([seconds, 0.0, a, b, c])
        elif waiting.get((a, b)):
            first = waiting[a, b].pop(0)
            notes[first][1] = seconds - notes[first][0]
    return [tuple(n) for n in notes]


def midi_notes(spark: SparkSession, pattern: str, padding: float = 0.0) -> DataFrame:
    """(song, path, source_time, audio_time, duration, channel, pitch, velocity) of performances; ``padding`` shifts the audio clock. A file that is no MIDI fails the scan."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for song, path, content in zip(batch["song"], batch["path"], batch["content"], strict=True):
                rows = [(song, path, t, t + padding, d, channel, pitch, velocity) for t, d, channel, pitch, velocity in read_midi(content)]
                yield pd.DataFrame(rows, columns=["song", "path", "source_time", "audio_time", "duration", "channel", "pitch", "velocity"])

    files = spark.read.format("binaryFile").load(pattern).select(F.element_at(F.split("path", "/"), -2).alias("song"), "path", "content")
    return files.mapInPandas(work, "song string, path string, source_time double, audio_time double, duration double, channel int, pitch int, velocity int")


def manual_anchors(spark: SparkSession, pattern: str, basis: str = "original") -> DataFrame:
    """(song, id, playback_bar, source_bar, occurrence, beat, beat_fraction, time, basis, mode) of anchor files; resolve them with ``maps.resolve_manual``."""
    score = "score struct<playback_bar:bigint,source_bar:bigint,occurrence:bigint,beat:double,beat_fraction:double>"
    schema = f"alignment struct<manual_anchor_time_basis:string,manual_anchors:array<struct<id:string,mode:string,{score.replace(' struct', ':struct', 1)},audio:struct<time:double,time_basis:string>>>>"
    rows = spark.read.schema(schema).option("multiLine", True).json(pattern).withColumn("song", F.element_at(F.split(F.input_file_name(), "/"), -2))
    flat = rows.select("song", F.col("alignment.manual_anchor_time_basis").alias("_b"), F.posexplode("alignment.manual_anchors").alias("_i", "a"))
    given = F.lower(F.coalesce("a.audio.time_basis", "_b", F.lit(basis)))
    return flat.select("song", F.coalesce("a.id", F.concat(F.lit("anchor-"), F.col("_i") + 1)).alias("id"), *(F.col(f"a.score.{c}").alias(c) for c in ("playback_bar", "source_bar", "occurrence")), F.coalesce("a.score.beat", F.lit(1.0)).alias("beat"), F.coalesce("a.score.beat_fraction", F.lit(0.0)).alias("beat_fraction"), F.col("a.audio.time").alias("time"), F.when(given == "source", "original").otherwise(given).alias("basis"), F.lower(F.coalesce("a.mode", F.lit("exact"))).alias("mode"))


def audio_frames(spark: SparkSession, pattern: str, hop: int = 256) -> DataFrame:
    """(song, stem, t, level, attack, peak) of uncompressed 16-bit WAV files, by frames of ``hop`` samples; other sounds come as tables of frames.

    ``level`` is the root mean square, ``attack`` its rise over the frame before.
    """
    import wave

    import numpy as np

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for song, stem, content in zip(batch["song"], batch["stem"], batch["content"], strict=True):
                with wave.open(io.BytesIO(content)) as w:
                    if w.getsampwidth() != 2:
                        raise ValueError(f"{song}/{stem}: only 16-bit sounds are decoded")
                    rate, raw = w.getframerate(), np.frombuffer(w.readframes(w.getnframes()), "<i2").reshape(-1, w.getnchannels()).astype(np.float32) / 32768
                n = -(-len(raw) // hop)
                framed = np.zeros((n * hop, raw.shape[1]), np.float32)
                framed[: len(raw)] = raw
                framed = framed.reshape(n, hop, -1)
                level = np.sqrt((framed.mean(axis=2) ** 2).mean(axis=1))
                yield pd.DataFrame({"song": song, "stem": stem, "t": np.arange(n) * (hop / rate), "level": level, "attack": np.maximum(0, np.diff(level, prepend=0.0)), "peak": np.abs(framed).max(axis=(1, 2))})

    name = F.element_at(F.split("path", "/"), -1)
    files = spark.read.format("binaryFile").load(pattern).select(F.element_at(F.split("path", "/"), -2).alias("song"), F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), "content")
    return files.mapInPandas(work, "song string, stem string, t double, level double, attack double, peak double")


def audio_pieces(spark: SparkSession, pattern: str, frames: int = 4096, hop: int = 256) -> DataFrame:
    """(song, stem, rate, first, count, before, samples) of uncompressed 16-bit WAV files: pieces of ``frames`` frames, mixed to one channel.

    ``samples`` (float32 bytes) reach ``spectra.margin`` beyond the piece on
    both sides, as far as there is sound; frame ``first`` is centred
    ``before`` samples into them. A file is decoded in slices, and its pieces
    are dealt over all tasks.
    """
    import wave

    import numpy as np

    from timeloom.operators import spectra

    reach = spectra.margin(hop)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for song, stem, content in zip(batch["song"], batch["stem"], batch["content"], strict=True):
                with wave.open(io.BytesIO(content)) as w:
                    if w.getsampwidth() != 2:
                        raise ValueError(f"{song}/{stem}: only 16-bit sounds are decoded")
                    total, rate, channels = w.getnframes(), w.getframerate(), w.getnchannels()
                    whole = -(-total // hop)
                    for first in range(0, whole, frames):
                        count = min(frames, whole - first)
                        start = max(0, first * hop - reach)
                        w.setpos(start)
                        stop = min(total, (first + count) * hop + reach)
                        samples = np.frombuffer(w.readframes(stop - start), "<i2").reshape(-1, channels).astype(np.float32).mean(axis=1) / 32768
                        yield pd.DataFrame({"song": [song], "stem": [stem], "rate": [float(rate)], "first": [first], "count": [count], "before": [first * hop - start], "samples": [samples.astype(np.float32).tobytes()]})

    name = F.element_at(F.split("path", "/"), -1)
    files = spark.read.format("binaryFile").load(pattern).select(F.element_at(F.split("path", "/"), -2).alias("song"), F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), "content")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.mapInPandas(work, "song string, stem string, rate double, first bigint, count bigint, before bigint, samples binary").repartition(tasks, "song", "stem", "first")


def timed_words(rows: DataFrame) -> DataFrame:
    """Recognised words (speaker, start, end, word) that have a time; the recogniser itself is an outside step."""
    return rows.where(F.col("start").isNotNull()).select("song", "speaker", F.col("start").alias("t"), F.greatest(F.lit(0.0), F.coalesce("end", F.col("start")) - F.col("start")).alias("d"), F.col("word").alias("w"))


def pitch_frames(rows: DataFrame, least: float = 0.0) -> DataFrame:
    """Tracked pitch frames (t, hz, confidence) with a positive frequency and enough confidence; the tracker itself is an outside step."""
    return rows.where((F.col("hz") > 0) & (F.coalesce("confidence", F.lit(0.0)) >= least))


def canonical_json(value: dict) -> str:
    """JSON with sorted keys and no blanks, for fingerprints of settings."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
