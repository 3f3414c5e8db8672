"""Sung text and pitch: syllables, slots, pitch regions of syllables, one voice out of overlapping notes.

Kernels take one syllable or one voice of a song; both are bounded by the song.
"""

from __future__ import annotations

from bisect import insort

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timeloom.functions import notation, vectors
from timeloom.operators import dealt, joins
from timeloom.operators.sequence import per_group

HOP = 0.01  # seconds between pitch frames
SHORTEST = 0.04  # of an emitted note


def lyric_tokens(text: Column) -> Column:
    """Syllables of a lyric line: words split at blanks and after hyphens, which stay; ``_`` carries the syllable before on and gives ``+``."""
    spaced = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), "-+(?=\\S)", "- "), "\\s+", " ")
    parts = F.filter(F.split(F.trim(spaced), " "), lambda p: p != "")
    return F.transform(parts, lambda p: F.when(p.rlike("^_+$"), "+").otherwise(F.regexp_replace(p, "_+", " ")))


def syllable_spans(start: Column, end: Column, syllables: Column) -> Column:
    """(t, d, w) of each syllable: a word's time shared out by letters, a hyphen at the end not counted."""
    sizes = F.transform(syllables, lambda s: F.greatest(F.lit(1), F.length(F.regexp_replace(s, "-+$", ""))).cast("double"))
    whole = vectors.total(sizes)
    span = end - start
    return F.transform(syllables, lambda s, i: F.struct((start + span * vectors.total(F.slice(sizes, F.lit(1), i)) / whole).alias("t"), (span * F.get(sizes, i) / whole).alias("d"), s.alias("w")))


def allocate(syllables: DataFrame, slots: DataFrame, keys: list[str], order: list[str], slot_order: list[str]) -> DataFrame:
    """Syllables on slots in order: the k-th syllable of a key takes its k-th slot; what is left over on either side stays, with nulls."""
    number = lambda df, by: df.withColumn("position", F.row_number().over(Window.partitionBy(*keys).orderBy(*by)))
    return number(syllables, order).join(number(slots, slot_order), [*keys, "position"], "full")


def allocate_lines(lines: DataFrame, slots: DataFrame, keys: list[str], line: str, size: str, slot_order: list[str]) -> DataFrame:
    """(keys, line, first, last): the run of slots that each line of ``size`` syllables takes, one line after the other, as far as slots go."""
    up_to = Window.partitionBy(*keys).orderBy(line).rowsBetween(Window.unboundedPreceding, 0)
    counted = slots.groupBy(*keys).agg(F.count("*").alias("_n"))
    placed = lines.join(counted, keys, "left").withColumn("_z", F.sum(size).over(up_to))
    return placed.select(*keys, line, (F.col("_z") - F.col(size) + 1).alias("first"), F.least("_z", F.coalesce("_n", F.lit(0))).alias("last")).where("first <= last")


def with_continuations(words: DataFrame, notes: DataFrame, keys: list[str], tolerance: float = 0.0) -> DataFrame:
    """Each pitch note with the text of the word that holds its middle: the first of a word keeps the text, further ones get ``+``; words without a note stay.

    Words: t, d, w; where words overlap the earliest holds the note.
    """
    numbered = words.withColumn("_word", F.row_number().over(Window.partitionBy(*keys).orderBy("t", "w"))).withColumn("_a", F.col("t") - tolerance).withColumn("_z", F.col("t") + F.col("d") + tolerance)
    own = notes.withColumn("_note", F.row_number().over(Window.partitionBy(*keys).orderBy("t", "d", "midi"))).withColumn("_mid", F.col("t") + F.col("d") / 2)
    met = joins.members_of(numbered.select(*keys, "_word", "_a", "_z", "w"), own.select(*keys, "_note", "_mid", F.col("t").alias("_t"), F.col("d").alias("_d"), "midi"), keys, "_a", "_z", "_mid", 8.0)
    first = met.groupBy(*keys, "_note").agg(F.min_by(F.struct("_word", "w", "_t", "_d", "midi"), "_word").alias("m"))
    order = F.row_number().over(Window.partitionBy(*keys, "m._word").orderBy("m._t", "_note"))
    sung = first.withColumn("_o", order).select(*keys, F.col("m._t").alias("t"), F.col("m._d").alias("d"), F.when(F.col("_o") == 1, F.col("m.w")).otherwise("+").alias("w"), F.col("m.midi").alias("midi"), F.col("m._word").alias("_word"))
    silent = numbered.join(sung.select(*keys, "_word").distinct(), [*keys, "_word"], "left_anti")
    return sung.drop("_word").unionByName(silent.select(*keys, "t", "d", "w", F.lit(None).cast(dict(notes.dtypes)["midi"]).alias("midi")))


def _regions(t: np.ndarray, pitch: np.ndarray, sure: np.ndarray, step: float, gap: float, shortest: float) -> list[list]:
    """(start, end, pitch, confidence) of the steady stretches of one syllable's frames, in order.

    A stretch ends at a gap or where the rounded pitch leaves its own upper
    median by ``step``. Stretches too short are given to the neighbour whose
    pitch is nearest, the earlier one on ties, from the front, until none is left.
    """
    middle = lambda held: int(np.rint(held[len(held) // 2]))
    at, sung = t.tolist(), pitch.tolist()
    parts: list[tuple[int, int, list[float]]] = []  # first and last frame, sorted pitches
    for i, p in enumerate(sung):
        if parts and at[i] - at[i - 1] <= gap and abs(np.rint(p) - middle(parts[-1][2])) < step:
            insort(parts[-1][2], p)
            parts[-1] = (parts[-1][0], i, parts[-1][2])
        else:
            parts.append((i, i, [p]))

    def joined(a: tuple, b: tuple) -> tuple:
        few, many = sorted((a[2], b[2]), key=len)
        if len(few) < 8:
            for p in few:
                insort(many, p)
        else:
            many = sorted(many + few)
        return a[0], b[1], many

    ahead, done = parts[::-1], []  # all in ``done`` are long enough, so the first short one is never behind
    while ahead:
        now = ahead.pop()
        if at[now[1]] - at[now[0]] + HOP >= shortest or not (done or ahead):
            done.append(now)
        elif done and (not ahead or abs(middle(done[-1][2]) - middle(now[2])) <= abs(middle(ahead[-1][2]) - middle(now[2]))):
            ahead.append(joined(done.pop(), now))
        else:
            ahead.append(joined(now, ahead.pop()))
    out: list[list] = []
    for first, last, held in done:
        start, end, note, confidence = t[first], t[last] + HOP, middle(held), float(sure[first : last + 1].mean())
        if t[last] - t[first] + HOP < shortest:
            continue
        if out and out[-1][2] == note and start <= out[-1][1] + gap:
            out[-1][1], out[-1][3] = max(out[-1][1], end), max(out[-1][3], confidence)
        else:
            out.append([start, end, note, confidence])
    return out


def pitch_regions(frames: DataFrame, keys: list[str], least: float = 0.5, step: float = 1.0, gap: float = 0.06, shortest: float = 0.08) -> DataFrame:
    """(keys, start, end, midi, confidence): steady pitch regions of each syllable (keys) from frames (t, hz, confidence)."""
    voiced = frames.where((F.col("confidence") >= least) & (F.col("hz") > 0)).withColumn("_p", notation.hz_to_pitch(F.col("hz")))

    def kernel(g: pd.DataFrame) -> dict:
        found = _regions(g["t"].to_numpy(float), g["_p"].to_numpy(float), g["confidence"].to_numpy(float), step, gap, shortest)
        return {n: [r[i] for r in found] for i, n in enumerate(("start", "end", "midi", "confidence"))}

    return per_group(voiced, keys, ["t", "_p", "confidence"], kernel, "start double, end double, midi bigint, confidence double")


def partition_syllables(syllables: DataFrame, regions: DataFrame, keys: list[str], fallback: str = "pitch") -> DataFrame:
    """(keys, t, d, midi, confidence): notes that cover each syllable (t, d, ``fallback`` pitch, confidence) without gaps.

    Neighbouring regions meet half way; notes shorter than ``SHORTEST`` go to
    the one before. A syllable without regions has one note of its fallback
    pitch, without that none.
    """
    by = Window.partitionBy(*keys).orderBy("start")
    joined = syllables.where("d > 0").select(*keys, F.col("t").alias("_t"), F.col("d").alias("_d"), F.col(fallback).alias("_f"), F.col("confidence").alias("_c")).join(regions, keys, "left")
    edge = F.coalesce((F.lag("end").over(by) + F.col("start")) / 2.0, F.col("_t"))
    placed = joined.where(F.col("_f").isNotNull()).withColumn("_a", F.greatest("_t", F.least(F.col("_t") + F.col("_d"), edge)))
    placed = placed.withColumn("_n", F.coalesce(F.lead("_a").over(by), F.col("_t") + F.col("_d")))
    long = placed.where((F.col("_n") - F.col("_a") >= SHORTEST) | F.col("start").isNull()).withColumn("_first", F.row_number().over(by) == 1)
    begun = long.withColumn("_a", F.when(F.col("_first"), F.col("_t")).otherwise(F.col("_a")))
    covered = begun.withColumn("_n", F.coalesce(F.lead("_a").over(by), F.col("_t") + F.col("_d")))
    kept = covered.select(*keys, F.col("_a").alias("t"), (F.col("_n") - F.col("_a")).alias("d"), F.coalesce("midi", F.col("_f").cast("long")).alias("midi"), F.coalesce("confidence", F.col("_c").cast("double")).alias("confidence"))
    none = syllables.where(F.col(fallback).isNotNull() & (F.col("d") > 0)).join(kept.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(none.select(*keys, "t", "d", F.col(fallback).cast("long").alias("midi"), F.col("confidence").cast("double").alias("confidence")))


def representative_pitch(syllables: DataFrame, frames: DataFrame, keys: list[str], ident: str, least: float = 0.5) -> DataFrame:
    """Adds ``pitch``: the rounded upper median of the sure frames within each syllable, null where there are none."""
    sure = frames.where((F.col("confidence") >= least) & (F.col("hz") > 0)).select(*keys, F.col("t").alias("_at"), notation.hz_to_pitch(F.col("hz")).alias("_p"))
    met = joins.members_of(syllables.select(*keys, ident, F.col("t").alias("_a"), (F.col("t") + F.col("d")).alias("_z")), sure, keys, "_a", "_z", "_at", 8.0)
    found = met.groupBy(*keys, ident).agg(F.rint(vectors.upper_middle(F.collect_list("_p"))).cast("long").alias("pitch"))
    return syllables.drop("pitch").join(found, [*keys, ident], "left")


def monophonic(notes: DataFrame, keys: list[str], shortest: float = SHORTEST, width: float | None = None) -> DataFrame:
    """(keys, t, d, midi, confidence): one note at a time. Of notes that overlap, equal pitches join; else the surer one keeps the time both claim.

    Rests shorter than ``shortest`` of a trimmed note go. A key is one voice of a song. With ``width`` a voice is dealt out: a note that
    starts when all before have ended owes them nothing, so each unbroken stretch of sound is a group of its own.
    """

    def kernel(g: pd.DataFrame) -> dict:
        line: list[list] = []  # start, end, pitch, confidence
        for t, d, midi, sure in zip(g["t"].to_numpy(float), g["d"].to_numpy(float), g["midi"], g["confidence"].fillna(0.0), strict=True):
            end = t + d
            if line and t < line[-1][1]:
                last = line[-1]
                if t < last[1] - 0.001:
                    if midi == last[2]:
                        last[1], last[3] = max(last[1], end), max(last[3], sure)
                        continue
                    if sure > last[3]:
                        last[1] = t
                        if last[1] - last[0] < shortest:
                            line.pop()
                        line.append([t, end, midi, sure])
                        continue
                t = last[1]
                if end - t < shortest:
                    continue
            line.append([t, end, midi, sure])
        return {"t": [n[0] for n in line], "d": [n[1] - n[0] for n in line], "midi": [n[2] for n in line], "confidence": [n[3] for n in line]}

    ordered = notes.where("d > 0").withColumn("_c", -F.coalesce("confidence", F.lit(0.0)))
    schema = "t double, d double, midi bigint, confidence double"
    if not width:
        return per_group(ordered, keys, ["t", "_c"], kernel, schema)
    parted = dealt.regions(ordered.withColumn("_z", F.col("t") + F.col("d")), keys, "t", "_z", width)
    return per_group(parted, [*keys, "_region"], ["t", "_c"], kernel, schema).drop("_region")
