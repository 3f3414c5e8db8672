"""Nested scores, read with a fixed schema and laid flat: notes, measures, tempo, keys, by role."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from timeloom.functions import notation
from timeloom.operators import islands, tempo
from timeloom.sources.shared import cut

SUPPORTED = 4
NAMED = "struct<value:int,name:string>"
TECHNIQUES = f"struct<harmonic_type:{NAMED},palm_mute:boolean,dead:boolean,ghost:boolean,fret_hand_mute:boolean,vibrato:{NAMED},accentuation:{NAMED},tapping:boolean,slap:boolean,pop:boolean,left_hand_finger:{NAMED},right_hand_finger:{NAMED},slide_out_type:{NAMED},bend_type:{NAMED},bend_points:array<struct<position:double,value:double>>,trill_value:int,ornament:{NAMED},dynamics:{NAMED},staccato:boolean,let_ring:boolean>"
NOTE = f"struct<note_id:bigint,string:int,fret:int,midi:int,techniques:{TECHNIQUES},links:struct<tie_destination_id:bigint,hammer_pull_destination_id:bigint,slide_destination_id:bigint>>"
BEAT = f"struct<beat_id:bigint,text:string,notes:array<{NOTE}>,state:struct<palm_mute:boolean,tremolo:boolean,whammy_bar:boolean,rasgueado:boolean>,rhythm:struct<pick_stroke:{NAMED},tremolo_speed:{NAMED},grace_type:{NAMED},brush_duration:int>,dynamics:{NAMED},whammy_bar_points:array<double>>"
TRACK = f"struct<track_index:int,name:string,is_percussion:boolean,staves:array<struct<staff_index:int,tuning:array<int>,bars:array<struct<voices:array<struct<beats:array<{BEAT}>>>>>>>>"
PLAYED = "struct<track_index:int,staff_index:int,voice_index:int,note_id:bigint,beat_id:bigint,playback_master_bar_index:int,playback_segment_index:int,absolute_start_tick:double,duration_ticks:double>"
VISIT = "struct<playback_index:int,source_master_bar_index:int,start_tick:double,end_tick:double,playback_segment_index:int,ts_num:int>"
SCORE = f"schema_version int, source struct<ppq:int>, metadata struct<title:string,tempo:double>, tracks array<{TRACK}>, playback struct<master_bar_visits:array<{VISIT}>,playback_notes:array<{PLAYED}>,tempo_events:array<struct<tick:bigint,tempo:double>>>"


def read(spark: SparkSession, pattern: str, strict: bool = True) -> DataFrame:
    """One row per score file with ``song``; a wrong version, no playback or no resolution is an error, or leaves the row out if not ``strict``."""
    rows = spark.read.schema(SCORE).option("multiLine", True).json(pattern).withColumn("song", F.element_at(F.split(F.input_file_name(), "/"), -2))
    return checked(rows, strict)


def checked(rows: DataFrame, strict: bool = True) -> DataFrame:
    good = F.coalesce((F.col("schema_version") == SUPPORTED) & F.col("playback").isNotNull() & (F.col("source.ppq") > 0), F.lit(False))
    if not strict:
        return rows.where(good)
    said = F.concat(F.lit("unusable score: version "), F.coalesce(F.col("schema_version").cast("string"), F.lit("none")))
    return rows.withColumn("_ok", F.assert_true(good, said)).where("_ok is null").drop("_ok")


def visits(scores: DataFrame) -> DataFrame:
    """(song, playback_index, source, start_tick, end_tick, ts_num, segment, occurrence, segment_end) of every playback of a measure."""
    flat = scores.select("song", F.explode("playback.master_bar_visits").alias("v")).select("song", "v.playback_index", F.col("v.source_master_bar_index").alias("source"), "v.start_tick", "v.end_tick", F.coalesce("v.ts_num", F.lit(4)).alias("ts_num"), F.col("v.playback_segment_index").alias("_given"))
    made = islands.playback_segments(flat, ["song"], "playback_index", "source", "_given").drop("_given")
    return made.withColumn("segment_end", F.max_by(F.coalesce("end_tick", "start_tick"), "playback_index").over(Window.partitionBy("song", "segment")))


def tempo_events(scores: DataFrame) -> DataFrame:
    """(song, tick, bpm) from tick 0 on, repeats dropped."""
    initial = F.coalesce("metadata.tempo", F.lit(tempo.FALLBACK))
    flat = scores.select("song", initial.alias("_initial"), F.explode_outer("playback.tempo_events").alias("e")).select("song", "_initial", F.coalesce("e.tick", F.lit(0)).alias("tick"), F.coalesce("e.tempo", "_initial").alias("bpm"))
    return tempo.tempo_events(flat, ["song"], "tick", "bpm", initial=F.col("_initial"))


def written_notes(scores: DataFrame) -> DataFrame:
    """(song, track_index, staff_index, track, percussion, tuning, note_id, note, beat) of every written note."""
    t = scores.select("song", F.explode("tracks").alias("t"))
    s = t.select("song", "t.track_index", F.col("t.name").alias("track"), F.coalesce("t.is_percussion", F.lit(False)).alias("percussion"), F.explode("t.staves").alias("s"))
    b = s.select("song", "track_index", "track", "percussion", "s.staff_index", "s.tuning", F.explode("s.bars").alias("b"))
    v = b.select("song", "track_index", "track", "percussion", "staff_index", "tuning", F.explode("b.voices").alias("v"))
    e = v.select("song", "track_index", "track", "percussion", "staff_index", "tuning", F.explode("v.beats").alias("beat"))
    return e.select("song", "track_index", "track", "percussion", "staff_index", "tuning", "beat", F.explode("beat.notes").alias("note")).withColumn("note_id", F.col("note.note_id"))


def played_notes(scores: DataFrame) -> DataFrame:
    """(song, segment, track_index, staff_index, voice_index, note_id, start_tick, end_tick, segment_end) of every playback of a note, each once."""
    flat = scores.select("song", F.explode("playback.playback_notes").alias("n")).select("song", "n.*")
    placed = flat.join(visits(scores).select("song", F.col("playback_index").alias("playback_master_bar_index"), F.col("segment").alias("_segment"), "segment_end"), ["song", "playback_master_bar_index"], "left")
    made = placed.withColumn("segment", F.coalesce(F.col("playback_segment_index").cast("long"), F.col("_segment").cast("long"), F.lit(0).cast("long"))).withColumn("end_tick", F.least(F.col("absolute_start_tick") + F.coalesce("duration_ticks", F.lit(0.0)), F.coalesce("segment_end", F.lit(float("inf")))))
    keys = ["song", "segment", "track_index", "staff_index", "voice_index", "note_id"]
    return made.select(*keys, F.col("absolute_start_tick").alias("start_tick"), "end_tick", "segment_end").dropDuplicates([*keys, "start_tick"])


def resolve_ties(notes: DataFrame, keys: list[str], ident: str, start: str, end: str, link: str) -> DataFrame:
    """Adds ``resolved_end``: the greatest end along the chain of ties that a note opens.

    A tie leads to the note ``link`` of the same keys, if that starts later
    (or at the same tick with a greater id, so that no chain runs in a
    circle). Chains are followed by doubling, in as many rounds as the
    logarithm of the longest; each round is written to the shared folder.
    """
    me = notes.groupBy(*keys, ident).agg(F.min_by(F.struct(start, link), start).alias("_n"), F.max(end).alias("_end")).select(*keys, F.col(ident).alias("_id"), F.col(f"_n.{start}").alias("_start"), "_end", F.col(f"_n.{link}").alias("_to"))
    other = me.select(*keys, F.col("_id").alias("_to"), F.col("_start").alias("_s2"))
    later = (F.col("_s2") > F.col("_start")) | ((F.col("_s2") == F.col("_start")) & (F.col("_to") > F.col("_id")))
    state = cut(me.join(other, [*keys, "_to"], "left").select(*keys, "_id", "_end", F.when(later, F.col("_to")).alias("_to")))
    while not state.where("_to is not null").isEmpty():
        ahead = state.select(*keys, F.col("_id").alias("_to"), F.col("_end").alias("_e2"), F.col("_to").alias("_t2"))
        state = cut(state.join(ahead, [*keys, "_to"], "left").select(*keys, "_id", F.greatest("_end", "_e2").alias("_end"), F.col("_t2").alias("_to")))
    found = state.select(*keys, F.col("_id").alias(ident), F.col("_end").alias("resolved_end"))
    return notes.drop("resolved_end").join(found, [*keys, ident], "left")


def products(scores: DataFrame, roles: DataFrame | None = None) -> dict[str, DataFrame]:
    """Flat tables of scores: notes (with role, seconds, sounding length, pitch, drum piece and techniques), measures, tempo.

    ``roles`` (song, track, role) overrides the role that a track's name says. Tie destinations that continue a note are not notes of their own.
    """
    tempos, written, played = tempo_events(scores), written_notes(scores), played_notes(scores)
    own = ["song", "segment", "track_index", "staff_index", "voice_index"]
    tied = written.select("song", "track_index", "note_id", F.col("note.links.tie_destination_id").alias("_tie"))
    linked = played.join(tied, ["song", "track_index", "note_id"], "left")
    resolved = resolve_ties(linked, own, "note_id", "start_tick", "end_tick", "_tie")
    continued = linked.where("_tie is not null").select(*own, F.col("_tie").alias("note_id")).distinct()
    heads = resolved.join(continued, [*own, "note_id"], "left_anti")
    ppq = scores.select("song", F.col("source.ppq").alias("ppq"))
    noted = heads.join(written, ["song", "track_index", "staff_index", "note_id"]).join(ppq, "song")
    scaled = noted.withColumn("_a", F.col("start_tick") * 960.0 / F.col("ppq")).withColumn("_z", F.least("resolved_end", F.coalesce("segment_end", F.lit(float("inf")))) * 960.0 / F.col("ppq"))
    ticks = tempos.join(ppq, "song").select("song", (F.col("tick") * 960.0 / F.col("ppq")).cast("long").alias("tick"), "bpm")
    timed = tempo.seconds_at(tempo.seconds_at(scaled, ticks, ["song"], "_a", "t"), ticks, ["song"], "_z", "_end")
    role = notation.role_of_name(F.col("track"))
    placed = timed if roles is None else timed.join(roles.select("song", "track", F.col("role").alias("_role")), ["song", "track"], "left")
    placed = placed.withColumn("role", role if roles is None else F.coalesce("_role", role)).withColumn("authored", F.greatest(F.lit(0.0), F.col("_end") - F.col("t")))
    lane = Window.partitionBy("song", "segment", "track_index", "staff_index", F.col("note.string")).orderBy("t")
    t = F.col("note.techniques")
    sus = notation.sounding_length(F.col("authored"), t["staccato"], t["let_ring"], t["dead"], F.lead("t").over(lane) - F.col("t"), F.lit(None).cast("double"), F.lit(None).cast("double"))
    strings = F.size("tuning")
    pitch = F.coalesce(F.col("note.midi"), F.get("tuning", F.col("note.string") - 1) + F.col("note.fret"))
    notes = placed.withColumn("sustain", sus).select("song", "role", "track", "segment", "note_id", "t", "sustain", pitch.alias("pitch"), notation.string_from_top(F.col("note.string"), strings).alias("string"), F.col("note.fret").alias("fret"), F.when(F.col("role") == "drums", notation.drum_piece(pitch)).alias("piece"), notation.techniques(notation.from_tree(F.col("note").withField("fret", F.col("note.fret")), F.col("beat")), F.col("sustain")).alias("techniques"))
    bars = visits(scores).join(ppq, "song").withColumn("_a", F.col("start_tick") * 960.0 / F.col("ppq"))
    measures = tempo.seconds_at(bars, ticks, ["song"], "_a", "t").select("song", (F.col("playback_index") + 1).alias("measure"), (F.col("source") + 1).alias("source_bar"), "occurrence", "segment", "ts_num", "t")
    return {"notes": notes, "measures": measures, "tempo": tempos}


def drum_hits(notes: DataFrame) -> DataFrame:
    """Decoded drum notes (t, pitch, velocity) as hits of the reduced kit, velocities within 1..127, in order."""
    return notes.select("song", "t", notation.drum_piece(F.col("pitch")).alias("piece"), F.least(F.lit(127), F.greatest(F.lit(1), F.coalesce("velocity", F.lit(95)))).alias("velocity"))


def keyboard_hands(notes: DataFrame, combined: str = "piano_combined", split: int = 60) -> DataFrame:
    """Decoded keyboard notes by hand: the role says it, a combined one is split at middle C. Notes that start together are one chord: (song, hand, t, pitches)."""
    hand = F.when(F.col("role") == combined, F.when(F.col("pitch") >= split, "rh").otherwise("lh")).when(F.col("role").endswith("left"), "lh").otherwise("rh")
    return notes.withColumn("hand", hand).groupBy("song", "hand", "t").agg(F.array_sort(F.collect_set("pitch")).alias("pitches"), F.max("sustain").alias("d"))


def fretted_notes(notes: DataFrame, shortest: float = 0.03) -> DataFrame:
    """Decoded fretted notes (voice, string, t, d, tie, let_ring, staccato, dead): ties lengthen the note before on their string, and every note gets its sounding length."""
    lane = Window.partitionBy("song", "track", "string").orderBy("t")
    opens = notes.withColumn("_new", F.when(F.coalesce("tie", F.lit(False)) & (F.row_number().over(lane) > 1), 0).otherwise(1)).withColumn("_no", F.sum("_new").over(lane))
    whole = opens.groupBy("song", "track", "string", "_no").agg(F.min("t").alias("t"), (F.max(F.col("t") + F.col("d")) - F.min("t")).alias("_d"), *(F.min_by(c, "t").alias(c) for c in ("fret", "let_ring", "staccato", "dead")))
    after = F.lead("t").over(Window.partitionBy("song", "track", "string").orderBy("t")) - F.col("t")
    null = F.lit(None).cast("double")
    return whole.withColumn("sustain", notation.sounding_length(F.col("_d"), F.col("staccato"), F.col("let_ring"), F.col("dead"), after, null, null, shortest=shortest)).drop("_no", "_d")
