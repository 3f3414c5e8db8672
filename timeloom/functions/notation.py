"""Scalar derivations of written music as columns: pitches, strings, keys, drums, durations, names, symbols, paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Percussion note numbers by piece, the reference note of each piece, open strings low to high.
DRUM_PIECES = {"kick": (35, 36), "snare": (37, 38, 40), "hh_closed": (42, 44, 46), "tom_floor": (41, 43), "tom_mid": (45, 47), "tom_hi": (48, 50), "crash_r": (49, 52, 55, 57), "ride": (51, 53, 59)}
DRUM_REFERENCE = (("kick", 36), ("snare", 38), ("hh_closed", 42), ("tom_floor", 42), ("tom_mid", 46), ("tom_hi", 49), ("crash_r", 49), ("ride", 51))
OPEN_STRINGS = {False: (40, 45, 50, 55, 59, 64), True: (28, 33, 38, 43)}
# Identifiers of drum families, by word and by percussion note number.
FAMILY_WORDS = (("kick", 1000), ("snare", 1001), ("hihat", 1002), ("hi_hat", 1002), ("hh_closed", 1002), ("hh_open", 1002), ("cymbal", 1003), ("crash", 1003), ("ride", 1003), ("tom", 1004))
FAMILY_NOTES = {1000: (35, 36), 1001: (37, 38, 39, 40), 1002: (42, 44, 46), 1003: (49, 51, 52, 53, 55, 57, 59), 1004: (41, 43, 45, 47, 48, 50)}
UNKNOWN_FAMILY = 1999


def rounded(value: Column, digits: int) -> Column:
    """Half-even rounding of the double times a power of ten, as a wire format wants it."""
    return F.rint(value * float(10**digits)) / float(10**digits)


def hz_to_pitch(hz: Column) -> Column:
    """Continuous note number; null unless the frequency is positive."""
    return F.when(hz > 0, 69.0 + 12.0 * F.log2(hz / 440.0))


def drum_piece(note: Column) -> Column:
    """Piece of a reduced kit: by table, else that of the nearest reference note, the first listed on ties."""
    known = F.coalesce(*(F.when(note.isin(*notes), F.lit(piece)) for piece, notes in DRUM_PIECES.items()))
    near = F.array_min(F.array(*(F.struct(F.abs(note - ref).alias("d"), F.lit(i).alias("i"), F.lit(piece).alias("piece")) for i, (piece, ref) in enumerate(DRUM_REFERENCE))))
    return F.when(note.isNotNull(), F.coalesce(known, near["piece"]))


def string_from_top(number: Column, strings: Column) -> Column:
    """0 for the lowest string, from numbers that give 1 to the highest."""
    return strings - number


def standard_tuning(strings: Column, bass: bool) -> Column:
    """Open strings low to high: of few strings the lowest ones, further strings each five below the one above."""
    base = OPEN_STRINGS[bass]
    reference = F.array(*(F.lit(p) for p in base))
    more = F.transform(F.sequence(strings - len(base), F.lit(1), F.lit(-1)), lambda i: F.lit(base[0]) - i * 5)
    return F.when(strings <= 0, F.array().cast("array<int>")).when(strings > len(base), F.concat(more, reference)).otherwise(F.slice(reference, 1, F.greatest(strings, F.lit(1))))


def tuning_supported(strings: Column, bass: bool) -> Column:
    return strings.between(4, 6) if bass else strings.between(6, 8)


def tuning_offsets(high_to_low: Column, bass: bool, strict: bool = True) -> Column:
    """Each string's distance from standard tuning, lowest first; beyond an octave an error, or null if not ``strict``."""
    offsets = F.zip_with(F.reverse(high_to_low), standard_tuning(F.size(high_to_low), bass), lambda a, b: a - b)
    wrong = F.exists(offsets, lambda o: F.abs(o) > 12)
    failed = F.raise_error(F.concat(F.lit("tuning beyond an octave: "), F.to_json(offsets))).cast("array<int>") if strict else F.lit(None).cast("array<int>")
    return F.when(wrong, failed).otherwise(offsets)


def key_name(accidentals: Column, minor: Column) -> Column:
    """Name of the key with that many sharps (flats below 0), by the circle of fifths; null beyond seven."""
    place = accidentals + F.when(minor, 4).otherwise(1)
    letter = F.substring(F.lit("FCGDAEB"), F.pmod(place, F.lit(7)) + 1, F.lit(1))
    sign = F.floor(place / 7)
    name = F.concat(letter, F.when(sign > 0, "#").when(sign < 0, "b").otherwise(""), F.when(minor, "m").otherwise(""))
    return F.when(accidentals.between(-7, 7), name)


def fretted_pitch(open_pitch: Column, fret: Column, strict: bool = False) -> Column:
    """Open string plus fret; outside 0..127 null, or an error if ``strict``."""
    pitch = open_pitch + fret
    outside = F.raise_error(F.format_string("pitch %s outside 0..127", pitch)).cast("int") if strict else F.lit(None).cast("int")
    return F.when(pitch.between(0, 127), pitch).otherwise(outside)


def virtual_key(pitch: Column) -> Column:
    """Block and place of a piano pitch in blocks of two octaves; null outside 21..108."""
    return F.when(pitch.between(21, 108), F.struct(F.floor(pitch / 24).cast("int").alias("block"), F.pmod(pitch, F.lit(24)).cast("int").alias("place")))


def quantised_duration(seconds: Column, quantum_ms: float) -> Column:
    """A positive duration as whole quanta, one at least; a quantum of 0 leaves it."""
    value = F.greatest(F.lit(0.0), seconds.cast("double"))
    q = quantum_ms / 1000.0
    return value if q <= 0 else F.when(value > 0, F.greatest(F.lit(q), F.rint(value / q) * q)).otherwise(value)


def shifted(t: Column, offset: float, digits: int | None = None) -> Column:
    """A time on another clock; ``digits`` rounds it for the wire."""
    moved = t + F.lit(float(offset))
    return moved if digits is None else rounded(moved, digits)


def shifted_rows(rows: Column, offset: float, field: str = "t", digits: int = 4) -> Column:
    """The same for the time field of nested rows."""
    return F.transform(rows, lambda r: r.withField(field, shifted(r[field], offset, digits)))


def sounding_length(authored: Column, staccato: Column, let_ring: Column, dead: Column, next_same_string: Column, texture_boundary: Column, segment_left: Column, gate: float = 0.95, shortest: float = 0.03) -> Column:
    """How long a fretted note sounds.

    The authored length times the gate; half of it if staccato, a tenth of a
    second at most if dead. A ringing note lasts to its first boundary. None
    crosses the end of its segment, and an authored note is never shorter
    than ``shortest``. Null flags are false, null boundaries absent.
    """
    yes = lambda c: F.coalesce(c, F.lit(False))
    length = F.greatest(F.lit(0.0), F.coalesce(authored.cast("double"), F.lit(0.0)))
    s = F.when(yes(let_ring), length).otherwise(length * gate)
    s = F.when(yes(staccato), s * 0.5).otherwise(s)
    s = F.when(yes(dead), F.least(s, F.lit(0.1))).otherwise(s)
    bounds = F.array_min(F.filter(F.array(*(b.cast("double") for b in (next_same_string, texture_boundary, segment_left))), lambda b: b >= 0))
    s = F.when(yes(let_ring), F.coalesce(bounds, s)).otherwise(s)
    s = F.when(segment_left.isNotNull(), F.least(s, F.greatest(F.lit(0.0), segment_left.cast("double")))).otherwise(s)
    return F.when(length > 0, F.greatest(F.lit(shortest), s)).otherwise(F.greatest(F.lit(0.0), s))


def enum_name(value: Column) -> Column:
    """A name without case, blanks and separators; null is empty."""
    return F.lower(F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), "[_\\- ]", ""))


def active(value: Column) -> Column:
    return ~enum_name(value).isin("", "none", "0", "false")


def finger(value: Column) -> Column:
    """0 (thumb) to 4 (little finger) from a name or a number; -1 for anything else."""
    n = enum_name(value)
    named = F.when(n == "thumb", 0).when(n.isin("indexfinger", "index"), 1).when(n.isin("middlefinger", "middle"), 2).when(n.isin("annularfinger", "ringfinger", "ring"), 3).when(n.isin("littlefinger", "pinky", "little"), 4)
    number = F.try_to_number(F.when(n.rlike("^[0-4]$"), n), F.lit("9")).cast("int")
    return F.coalesce(named, number, F.lit(-1))


def pick_direction(value: Column) -> Column:
    return F.when(enum_name(value).contains("down"), 0).when(enum_name(value).contains("up"), 1).otherwise(-1)


def bend_intent(value: Column) -> Column:
    """0 bend, 1 release, 2 prebend, 3 prebend and release, 4 round."""
    n = enum_name(value)
    pre, release = n.contains("prebend"), n.contains("release")
    return F.when(pre & release, 3).when(n.contains("round"), 4).when(pre, 2).when(release, 1).otherwise(0)


def bend_curve(points: Column, duration: Column, position_max: float, divisor: float = 2.0) -> Column:
    """(t, v) of ``points`` of (position, value): within the duration, in order of time, repeats in a row once.

    Points with a null are left out; a null list is empty.
    """
    length = duration.cast("double")
    kept = F.filter(F.coalesce(points, F.array().cast("array<struct<position:double,value:double>>")), lambda p: p["position"].isNotNull() & p["value"].isNotNull())
    made = F.transform(kept, lambda p: F.struct(rounded(F.greatest(F.lit(0.0), F.least(length, p["position"] / position_max * length)), 4).alias("t"), rounded(p["value"] / divisor, 3).alias("v")))
    once = F.filter(F.transform(made, lambda p, i: F.struct(p["t"].alias("t"), i.alias("i"), p["v"].alias("v"), ((i == 0) | (F.get(made, F.greatest(i - 1, F.lit(0))) != p)).alias("new"))), lambda p: p["new"])
    return F.transform(F.array_sort(once), lambda p: F.struct(p["t"].alias("t"), p["v"].alias("v")))


def techniques(note: dict[str, Column], duration: Column, destination_fret: Column | None = None, position_max: float = 60.0) -> Column:
    """One struct of all playing techniques of a fretted note; absent ones are null.

    ``note`` maps names to columns, absent names count as null: flags (legato,
    palm_mute, dead, fret_hand_mute, tapping, slap, pop, tremolo), names
    (harmonic, vibrato, accent, pick, finger, slide, bend), fret and
    bend_points. ``from_tree`` and ``from_binary`` fill it from the two
    source layouts, whose bend positions run to 60 and to 12.
    """
    null = F.lit(None)
    get = lambda n, kind="string": note.get(n, null.cast(kind))
    mark = lambda c: F.when(F.coalesce(c, F.lit(False)), F.lit(True))
    flag = lambda n: mark(get(n, "boolean"))
    to = null.cast("int") if destination_fret is None else destination_fret.cast("int")
    harmonic, slide = enum_name(get("harmonic")), enum_name(get("slide"))
    pulls = F.coalesce(to < F.coalesce(get("fret", "int"), F.lit(0)), F.lit(False))
    legato = F.coalesce(get("legato", "boolean"), F.lit(False))
    slides = active(get("slide")) & to.isNotNull()
    lands = slide.contains("out") | slide.contains("pickslide")
    curve = bend_curve(get("bend_points", "array<struct<position:double,value:double>>"), F.greatest(F.lit(0.0), duration), position_max)
    peak = F.coalesce(F.array_max(F.transform(curve, lambda p: F.abs(p["v"]))), F.lit(0.0))
    peak = F.when(peak > 0, peak).otherwise(F.coalesce(F.abs(get("bend_value", "double")) / 2, F.lit(0.0)))
    bends, intent = peak > 0, bend_intent(get("bend"))
    pick, hand = pick_direction(get("pick")), finger(get("finger"))
    return F.struct(
        mark(legato & ~pulls).alias("ho"), mark(legato & pulls).alias("po"),
        mark(harmonic.contains("natural")).alias("hm"), mark(harmonic.contains("pinch") & ~harmonic.contains("natural")).alias("hp"),
        flag("palm_mute").alias("pm"), flag("dead").alias("mt"), flag("fret_hand_mute").alias("fhm"),
        mark(active(get("vibrato"))).alias("vb"), mark(active(get("accent"))).alias("ac"),
        flag("tapping").alias("tp"), flag("slap").alias("slp"), flag("pop").alias("plk"), flag("tremolo").alias("tr"),
        F.when(pick >= 0, pick).alias("pkd"), F.when(hand >= 0, hand).alias("fg"),
        F.when(slides & ~lands, to).alias("sl"), F.when(slides & lands, to).alias("slu"),
        F.when(bends, rounded(peak, 3)).alias("bn"), F.when(bends & (intent > 0), intent).alias("bt"), F.when(bends & (F.size(curve) > 1), curve).alias("bnv"),
    )


def from_tree(note: Column, beat: Column) -> dict[str, Column]:
    """Columns for ``techniques`` from the nested JSON layout: a note's ``techniques`` and ``links``, its beat's ``state`` and ``rhythm``."""
    t, state, rhythm = note["techniques"], beat["state"], beat["rhythm"]
    return {
        "legato": note["links"]["hammer_pull_destination_id"].isNotNull(), "harmonic": t["harmonic_type"]["name"],
        "palm_mute": F.coalesce(t["palm_mute"], F.lit(False)) | F.coalesce(state["palm_mute"], F.lit(False)), "dead": t["dead"], "fret_hand_mute": t["fret_hand_mute"],
        "vibrato": t["vibrato"]["name"], "accent": t["accentuation"]["name"], "tapping": t["tapping"], "slap": t["slap"], "pop": t["pop"],
        "tremolo": F.coalesce(state["tremolo"], F.lit(False)) | active(rhythm["tremolo_speed"]["name"]), "pick": rhythm["pick_stroke"]["name"],
        "finger": t["left_hand_finger"]["name"], "slide": t["slide_out_type"]["name"], "bend": t["bend_type"]["name"], "bend_points": t["bend_points"], "fret": note["fret"],
    }


def from_binary(note: Column, beat: Column) -> dict[str, Column]:
    """The same from the layout of decoded tablature files: ``effect`` structs of note and beat."""
    ne, be = note["effect"], beat["effect"]
    slap = enum_name(be["slap_effect"])
    either = lambda *cs: F.coalesce(*(F.when(c, F.lit(True)) for c in cs), F.lit(False))
    return {
        "legato": ne["hammer"], "harmonic": ne["harmonic"], "palm_mute": either(ne["palm_mute"], be["palm_mute"]),
        "dead": either(ne["ghost_note"], enum_name(note["type"]) == "dead"), "fret_hand_mute": ne["fret_hand_mute"], "vibrato": ne["vibrato"].cast("string"),
        "accent": either(ne["accentuated"], ne["heavy_accentuated"]).cast("string"), "slap": slap.contains("slap"), "pop": slap.contains("pop") & ~slap.contains("slap"),
        "tapping": slap.contains("tap"), "tremolo": be["tremolo_picking"], "pick": be["pick_stroke"], "finger": ne["left_hand_finger"],
        "slide": F.array_join(ne["slides"], " "), "bend": ne["bend"]["type"], "bend_points": ne["bend"]["points"], "bend_value": ne["bend"]["value"], "fret": note["value"],
    }


def unsupported_techniques(note: Column, beat: Column) -> Column:
    """Names of what the nested layout says and ``techniques`` cannot, in a fixed order."""
    t, rhythm, state = note["techniques"], beat["rhythm"], beat["state"]
    h = enum_name(t["harmonic_type"]["name"])
    found = {
        "ghost": t["ghost"], "trill": t["trill_value"].isNotNull(), "ornament": active(t["ornament"]["name"]), "grace": active(rhythm["grace_type"]["name"]),
        "whammy_bar": F.coalesce(state["whammy_bar"], F.lit(False)) | (F.size(F.coalesce(beat["whammy_bar_points"], F.array().cast("array<double>"))) > 0),
        "rasgueado": state["rasgueado"], "brush_or_strum": rhythm["brush_duration"] > 0, "dynamics": active(t["dynamics"]["name"]) | active(beat["dynamics"]["name"]),
        "right_hand_fingering": finger(t["right_hand_finger"]["name"]) >= 0, "unsupported_harmonic_subtype": (h != "") & ~h.rlike("natural|pinch|none|0"),
    }
    return F.filter(F.array(*(F.when(c, F.lit(n)) for n, c in found.items())), lambda n: n.isNotNull())


def technique_counts(encoded: str, fields: list[str]) -> list[Column]:
    """Aggregates that count the notes with each field of the ``techniques`` struct."""
    return [F.count(F.col(f"{encoded}.{f}")).alias(f) for f in fields]


def normal_name(name: Column) -> Column:
    """NFKC, lower case, brackets and separators as blanks, blanks folded; null is empty."""
    plain = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), F.coalesce(name, F.lit("")), F.lit(True))
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.trim(plain)), r"[()\[\]{}_/\\-]+", " "), r"\s+", " "))


def _has(text: Column, *words: str) -> Column:
    return text.rlike("|".join(words))


def role_of_name(name: Column) -> Column:
    """Role of a track from words anywhere in its name, the first rule that fits."""
    n = F.lower(F.coalesce(name, F.lit("")))
    keys = _has(n, "piano", "keyboard", "keys")
    return (
        F.when(_has(n, "drum", "kit", "percussion", "tambourine", "triangle"), "drums")
        .when(_has(n, "vocal", "voice", "singer"), F.when(n.contains("back"), "ignore").otherwise("lead_vocal"))
        .when(keys & _has(n, "lh", "left"), "piano_left").when(keys & _has(n, "rh", "right"), "piano_right").when(keys, "piano_combined")
        .when(n.contains("bass"), "bass").when(_has(n, "guitar", "lead", "rhythm"), "guitar").otherwise("ignore")
    )


def class_of_name(name: Column, percussion: Column) -> Column:
    """Stricter role of a track: whole names for voices and drums, words for hands."""
    n = normal_name(name)
    words = F.split(n, " ")
    hand = lambda *w: F.arrays_overlap(words, F.array(*(F.lit(x) for x in w)))
    keys = _has(n, "piano", "keys", "keyboard")
    return (
        F.when(n.rlike("^(lead|main) (vocals?|vox)$"), "lead_vocal")
        .when(n.isin("backing vocals", "backing vocal", "background vocals", "harmony vocals", "harmony vocal"), "ignored_vocal")
        .when(n.isin("drums", "drum kit", "main drums", "kit"), "drums")
        .when(n.isin("tambourine", "triangle", "shaker", "cowbell", "aux percussion", "percussion") | F.coalesce(percussion, F.lit(False)), "ignored_percussion")
        .when(keys & hand("lh", "left"), "piano_left").when(keys & hand("rh", "right"), "piano_right")
        .when(n.isin("piano", "keys", "keyboard", "grand piano"), "piano_combined").when(n.contains("bass"), "bass").when(n.contains("guitar"), "guitar").otherwise("unsupported")
    )


def safe_id(name: Column, number: Column) -> Column:
    """Lower-case letters and digits joined by underscores; ``track_`` and the number where nothing is left."""
    made = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.when(made == "", F.concat(F.lit("track_"), number.cast("string"))).otherwise(made)


def symbol_id(value: Column) -> Column:
    """A whole number as it is, a drum word's family, else the unknown family; a null is unknown too."""
    text = F.regexp_replace(F.lower(F.trim(F.coalesce(value.cast("string"), F.lit("")))), "[- ]", "_")
    family = F.coalesce(*(F.when(text.contains(w), F.lit(i)) for w, i in FAMILY_WORDS))
    return F.coalesce(value.cast("string").try_cast("int"), family, F.lit(UNKNOWN_FAMILY))


def family_of_note(note: Column) -> Column:
    return F.coalesce(*(F.when(note.isin(*notes), F.lit(i)) for i, notes in FAMILY_NOTES.items()), F.lit(UNKNOWN_FAMILY))


def symbol_set(canonical: Column, pitches: Column, pieces: Column, piece: Column, pitch: Column, drums: Column) -> Column:
    """Sorted distinct symbols of an event from the first of its fields that is not null; a drum's number gives its family."""
    ids = lambda a: F.transform(a, symbol_id)
    one = lambda c: F.when(c.isNotNull(), F.array(symbol_id(c)))
    note = F.when(pitch.isNotNull(), F.array(F.when(F.coalesce(drums, F.lit(False)), family_of_note(symbol_id(pitch))).otherwise(symbol_id(pitch))))
    return F.array_sort(F.array_distinct(F.coalesce(one(canonical), ids(pitches), ids(pieces), one(piece), note, F.array().cast("array<int>"))))


def stable_symbol(value: Column) -> Column:
    """A whole number as it is, any other text by the first 32 bits of its SHA-256, modulo 4096."""
    text = value.cast("string")
    return F.coalesce(text.try_cast("int"), (F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long") % 4096).cast("int"))


def number_or_null(value: Column) -> Column:
    return value.cast("string").try_cast("double")


def residual_seconds(*seconds: Column, milliseconds: Column) -> Column:
    """The first residual that is a number, seconds before milliseconds."""
    return F.coalesce(*(number_or_null(s) for s in seconds), number_or_null(milliseconds) / 1000.0)


def valid_path(path: Column) -> Column:
    """Relative, with single slashes, no colon, backslash or parent folder."""
    return F.coalesce(path.rlike(r"^(?!/)(?!.*//)(?!.*:)(?!.*\\)(?!.*(^|/)\.\.(/|$)).+$"), F.lit(False))


def joined_path(*parts: Column, strict: bool = True) -> Column:
    """Parts joined by single slashes, empty ones left out; an invalid path is an error, or null if not ``strict``."""
    cleaned = F.filter(F.array(*(F.regexp_replace(p, r"^[/\\]+|[/\\]+$", "") for p in parts)), lambda p: p.isNotNull() & (p != ""))
    path = F.translate(F.array_join(cleaned, "/"), "\\", "/")
    bad = F.raise_error(F.concat(F.lit("not a relative path: "), path)).cast("string") if strict else F.lit(None).cast("string")
    return F.when(valid_path(path), path).otherwise(bad)
