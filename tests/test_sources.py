import io
import json
import struct
import wave
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from timeloom.sources import files, scores, sinks


def varlen(n):
    out = [n & 0x7F]
    while n := n >> 7:
        out.insert(0, n & 0x7F | 0x80)
    return bytes(out)


def midi(events, ppq=480):
    """events: (delta, bytes)"""
    track = b"".join(varlen(d) + e for d, e in events) + b"\x00\xff\x2f\x00"
    return b"MThd" + struct.pack(">IHHh", 6, 0, 1, ppq) + b"MTrk" + struct.pack(">I", len(track)) + track


def test_midi_pairs_first_in_first_out():
    song = midi([(0, b"\xff\x51\x03" + (500_000).to_bytes(3, "big")), (0, b"\x80\x3c\x00"), (0, b"\x90\x3c\x40"), (240, b"\x3c\x50"), (240, b"\xff\x51\x03" + (1_000_000).to_bytes(3, "big")), (0, b"\x80\x3c\x00"), (480, b"\x90\x3c\x00"), (0, b"\x91\x30\x01")])
    got = files.read_midi(song)
    assert [(round(t, 6), round(d, 6), c, p, v) for t, d, c, p, v in got] == [(0.0, 0.5, 0, 60, 64), (0.25, 1.25, 0, 60, 80), (1.5, 0.0, 1, 48, 1)]
    with pytest.raises(ValueError):
        files.read_midi(b"nothing")


def test_song_folder(spark, tmp_path):
    song = tmp_path / "one"
    song.mkdir()
    (song / "Piano.take2.MID").write_bytes(midi([(0, b"\x90\x3c\x40"), (480, b"\x80\x3c\x00")]))
    (song / "Full.ogg").write_bytes(b"x")
    (song / "Lead Guitar.wav").write_bytes(b"x")
    (song / "metadata.json").write_text('{"title": "T"}')
    with zipfile.ZipFile(song / "p.zip", "w") as z:
        z.writestr("a.json", '{"k": 1}')
        z.writestr("b.bin", b"\xff")
        z.writestr("c.txt", b"\xff\xfe\xff")
    (song / "broken.zip").write_bytes(b"no")
    listed = files.listing(spark, f"{tmp_path}/*/*")
    assert [(r.role, r.song) for r in files.performances(listed).collect()] == [("piano", "one")]
    stems = files.stems(listed)
    assert {(r.stem_id, r.is_default) for r in stems.collect()} == {("full", False), ("lead_guitar", True)}
    pick = lambda asked: [r.stem_id for r in files.select_stem(stems, F.lit(asked), ["vocals", "full"]).collect()]
    assert pick("lead_guitar") == ["lead_guitar"] and pick("off") == [] and pick(None) == ["full"] and pick("drums") == []
    assert [r.title for r in files.metadata(spark, f"{tmp_path}/*/metadata.json", "title string").collect()] == ["T"]
    got = files.text_members(spark, f"{song}/*.zip").collect()
    assert {(r.member, r.text) for r in got} == {("a.json", '{"k": 1}'), (None, None)}
    notes = files.midi_notes(spark, f"{song}/*.MID", 2.0).collect()
    assert [(n.song, n.source_time, n.audio_time, n.duration, n.pitch) for n in notes] == [("one", 0.0, 2.0, 0.5, 60)]


def test_sound_frames_and_anchors(spark, tmp_path):
    song = tmp_path / "s"
    song.mkdir()
    with wave.open(str(song / "bass.wav"), "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(1024)
        w.writeframes((np.concatenate((np.zeros(512), np.full(300, 0.5))) * 32767).astype("<i2").tobytes())
    rows = files.audio_frames(spark, f"{song}/*.wav").orderBy("t").collect()
    assert [round(r.peak, 2) for r in rows] == [0.0, 0.0, 0.5, 0.5] and rows[2].t == 0.5 and rows[2].attack > 0.4
    (song / "anchors.json").write_text(json.dumps({"alignment": {"manual_anchors": [{"id": "a", "score": {"playback_bar": 2, "beat": 3.0}, "audio": {"time": 4.5, "time_basis": "source"}}, {"score": {"source_bar": 1}, "audio": {"time": 9.0}}]}}))
    got = files.manual_anchors(spark, f"{song}/anchors.json").orderBy("time").collect()
    assert [(r.id, r.playback_bar, r.beat, r.time, r.basis, r.mode) for r in got] == [("a", 2, 3.0, 4.5, "original", "exact"), ("anchor-2", None, 1.0, 9.0, "original", "exact")]


def score():
    note = lambda i, s, f, **k: {"note_id": i, "string": s, "fret": f, "techniques": k.get("t", {}), "links": k.get("l", {})}
    beats = [{"beat_id": 1, "notes": [note(1, 1, 3, l={"tie_destination_id": 2})]}, {"beat_id": 2, "notes": [note(2, 1, 3)]}, {"beat_id": 3, "notes": [note(3, 2, 0, t={"palm_mute": True, "vibrato": {"value": 1, "name": "Slight"}})]}]
    played = [(1, 0, 0, 960), (2, 0, 960, 960), (3, 0, 1920, 480), (1, 1, 3840, 960), (2, 1, 4800, 960), (3, 1, 5760, 480)]
    return {
        "schema_version": 4, "source": {"ppq": 960}, "metadata": {"title": "x", "tempo": 120.0},
        "tracks": [{"track_index": 0, "name": "Bass", "staves": [{"staff_index": 0, "tuning": [43, 38, 33, 28], "bars": [{"voices": [{"beats": beats}]}]}]}],
        "playback": {
            "master_bar_visits": [{"playback_index": i, "source_master_bar_index": 0, "start_tick": 3840 * i, "end_tick": 3840 * (i + 1)} for i in range(2)],
            "playback_notes": [{"track_index": 0, "staff_index": 0, "voice_index": 0, "note_id": n, "playback_master_bar_index": b, "absolute_start_tick": t, "duration_ticks": d} for n, b, t, d in played],
            "tempo_events": [{"tick": 0, "tempo": 120.0}, {"tick": 3840, "tempo": 60.0}],
        },
    }


def test_nested_score(spark, tmp_path):
    song = tmp_path / "s"
    song.mkdir()
    (song / "score.json").write_text(json.dumps(score()))
    made = scores.products(scores.read(spark, f"{song}/score.json"))
    notes = [(r.role, r.segment, r.note_id, r.t, round(r.sustain, 4), r.pitch, r.string) for r in made["notes"].orderBy("t").collect()]
    assert notes == [("bass", 0, 1, 0.0, 0.95, 46, 3), ("bass", 0, 3, 1.0, 0.2375, 38, 2), ("bass", 1, 1, 2.0, 1.9, 46, 3), ("bass", 1, 3, 4.0, 0.475, 38, 2)]
    flags = made["notes"].where("note_id = 3").first().techniques
    assert flags.pm and flags.vb and flags.ho is None
    assert [(r.measure, r.source_bar, r.occurrence, r.segment, r.t) for r in made["measures"].orderBy("measure").collect()] == [(1, 1, 1, 0, 0.0), (2, 1, 2, 1, 2.0)]
    (song / "score.json").write_text(json.dumps(score() | {"schema_version": 3}))
    assert scores.read(spark, f"{song}/score.json", strict=False).count() == 0
    with pytest.raises(Exception, match="unusable score"):
        scores.read(spark, f"{song}/score.json").collect()


def test_ties_against_walking(spark):
    rng = np.random.default_rng(2)
    rows = [(1, int(i), float(i // 3), float(i // 3 + rng.integers(1, 4)), int(rng.integers(0, 40)) if rng.random() < 0.8 else None) for i in range(40)]
    by = {r[1]: r for r in rows}

    def walk(i):
        end = by[i][3]
        while (to := by[i][4]) is not None and to in by and (by[to][2], to) > (by[i][2], i):
            end, i = max(end, by[to][3]), to
        return end

    df = spark.createDataFrame(rows, "song int, id int, t double, z double, tie int")
    assert {r.id: r.resolved_end for r in scores.resolve_ties(df, ["song"], "id", "t", "z", "tie").collect()} == {i: walk(i) for i in by}


def test_decoded_instruments(spark):
    drums = spark.createDataFrame([("s", 0.0, 36, 200), ("s", 0.5, 999, None)], "song string, t double, pitch int, velocity int")
    assert [(r.piece, r.velocity) for r in scores.drum_hits(drums).orderBy("t").collect()] == [("kick", 127), ("ride", 95)]
    keys = spark.createDataFrame([("s", "piano_combined", 0.0, 59, 1.0), ("s", "piano_combined", 0.0, 60, 2.0), ("s", "piano_left", 1.0, 72, 1.0)], "song string, role string, t double, pitch int, sustain double")
    assert sorted((r.hand, r.t, r.pitches) for r in scores.keyboard_hands(keys).collect()) == [("lh", 0.0, [59]), ("lh", 1.0, [72]), ("rh", 0.0, [60])]
    rows = [("s", "g", 1, 0.0, 1.0, 3, False, False, False, False), ("s", "g", 1, 1.0, 1.0, 3, True, False, False, False), ("s", "g", 1, 2.0, 1.0, 5, False, True, False, False)]
    fretted = spark.createDataFrame(rows, "song string, track string, string int, t double, d double, fret int, tie boolean, let_ring boolean, staccato boolean, dead boolean")
    assert [(r.t, round(r.sustain, 3)) for r in scores.fretted_notes(fretted).orderBy("t").collect()] == [(0.0, 1.9), (2.0, 1.0)]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1.5, None), ("b", 2.0, "x")], "k string, v double, n string")
    sinks.write_json(rows, f"{tmp_path}/j", ["k"])
    assert {(r.k, r.v, r.n) for r in spark.read.json(f"{tmp_path}/j").collect()} == {("a", 1.5, None), ("b", 2.0, "x")}
    with pytest.raises(Exception, match="not finite"):
        sinks.write_json(rows.withColumn("v", F.lit(float("nan"))), f"{tmp_path}/bad")
    sinks.write_csv([rows, rows.select("k", F.lit(1).alias("z"))], f"{tmp_path}/c")
    assert spark.read.option("header", True).csv(f"{tmp_path}/c").columns == ["k", "n", "v", "z"]
    one, two = sinks.write_cache(rows, f"{tmp_path}/cache", {"b": 1, "a": 2}), sinks.write_cache(rows, f"{tmp_path}/cache", {"a": 2, "b": 1})
    assert one == two and spark.read.parquet(one).count() == 2
    songs = spark.createDataFrame([("s", "T", None, "", [], "a/b.json", -1)], "song string, title string, album string, note string, tags array<string>, file string, capo int")
    assert json.loads(sinks.manifests(songs, ["title", "album", "note", "tags", "file"]).first().manifest) == {"title": "T", "file": "a/b.json"}
    assert sinks.manifest_errors(songs, ["file"], "capo").first().reasons == ["negative_capo"]
    words = spark.createDataFrame([("s", "B", 1.0, 0.5, "hi"), ("s", "A", 0.0, 0.5, "oh")], "song string, speaker string, t double, d double, w string")
    assert [w.w for w in sinks.merged_lyrics(words).first().lines] == ["oh", "hi"] and sinks.lyric_tracks(words).count() == 2
    hits = spark.createDataFrame([("s", 1.0, "kick", 90), ("s", 0.0, "ride", 80)], "song string, t double, piece string, velocity int")
    assert sinks.drum_tab(hits).first().kit == ["kick", "ride"]
    packed = sinks.packages(spark.createDataFrame([("s", "b.txt", "2"), ("s", "a.txt", "1")], "song string, path string, text string")).first().content
    assert zipfile.ZipFile(io.BytesIO(packed)).namelist() == ["a.txt", "b.txt"]
    light = sinks.report_skeletons(spark.createDataFrame([("x/r.json", '{"a": {"b": 1}, "c": 2}'), ("x/q.json", "{}")], "path string, text string"), {"r.json": ["a"]})
    assert {r.path: json.loads(r.text) for r in light.collect()} == {"x/r.json": {"a": '{"b":1}'}, "x/q.json": {"bytes": 2}}
    tracks = spark.createDataFrame([("s", "Lead 1", 0)], "song string, track string, track_index int")
    notes = spark.createDataFrame([("s", "Lead 1", 1.0, 5), ("s", "Lead 1", 0.0, 3)], "song string, track string, t double, note int")
    entry = sinks.with_notation(sinks.arrangements(notes, tracks), spark.createDataFrame([("s", "lead_1")], "song string, id string")).first()
    assert (entry.file, entry.notes, entry.notation_file) == ("arrangements/lead_1.json", [3, 5], "notation/lead_1.json")
    voice = spark.createDataFrame([("s", 0.0, 1.0, 60, 0.9), ("s", 0.5, 1.0, 62, 0.5)], "song string, t double, d double, midi bigint, confidence double")
    contour = spark.createDataFrame([("s", 0.0, 440.0), ("s", 0.0, 440.0)], "song string, t double, hz double")
    merged = sinks.merged_pitch(voice, contour).first()
    assert [(n.t, n.d, n.midi) for n in merged.notes] == [(0.0, 1.0, 60), (1.0, 0.5, 62)] and len(merged.contour) == 1
