"""Queries of the scalar functions: notation, scoring, likeness of arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.functions import notation, scoring, vectors
from timeloom.plans.registry import query, scaled, sql_scaled
from timeloom.sources.tables import events, table

_PIECE = """case when note in (35, 36) then 'kick' when note in (37, 38, 40) then 'snare' when note in (42, 44, 46) then 'hh_closed' when note in (41, 43) then 'tom_floor'
when note in (45, 47) then 'tom_mid' when note in (48, 50) then 'tom_hi' when note in (49, 52, 55, 57) then 'crash_r' when note in (51, 53, 59) then 'ride'
else (select arg_min(piece, {'d': abs(ref - note), 'i': i}) from (values ('kick', 36, 0), ('snare', 38, 1), ('hh_closed', 42, 2), ('tom_floor', 42, 3), ('tom_mid', 46, 4), ('tom_hi', 49, 5), ('crash_r', 49, 6), ('ride', 51, 7)) r(piece, ref, i)) end"""


@query(f"""with e as (select event_id, cast(user_id % 128 as int) note, cast(user_id % 25 as int) fret, cast(user_id % 15 - 7 as int) acc, event_id % 2 = 0 as minor, value from EVENTS),
names(acc, major, low) as (values (-7, 'Cb', 'Abm'), (-6, 'Gb', 'Ebm'), (-5, 'Db', 'Bbm'), (-4, 'Ab', 'Fm'), (-3, 'Eb', 'Cm'), (-2, 'Bb', 'Gm'), (-1, 'F', 'Dm'), (0, 'C', 'Am'), (1, 'G', 'Em'), (2, 'D', 'Bm'), (3, 'A', 'F#m'), (4, 'E', 'C#m'), (5, 'B', 'G#m'), (6, 'F#', 'D#m'), (7, 'C#', 'A#m'))
select event_id, {sql_scaled("case when value > 0 then 69::double + 12::double * log2(value * 10::double / 440::double) end")} pitch, {_PIECE} piece, 6 - fret % 6 as string,
case when minor then low else major end as key_name, case when note + fret <= 127 then note + fret end as fretted, case when note between 21 and 108 then note // 24 end as block, case when note between 21 and 108 then note % 24 end as place,
case when value > 0 then greatest(62500::bigint, cast(round_even(value / 0.0625::double, 0) as bigint) * 62500) else 0 end as quantised_us
from e join names using (acc)""")
def note_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("event_id", "value", (F.col("user_id") % 128).cast("int").alias("note"), (F.col("user_id") % 25).cast("int").alias("fret"), (F.col("user_id") % 15 - 7).cast("int").alias("acc"))
    note, fret, key = F.col("note"), F.col("fret"), notation.virtual_key(F.col("note"))
    return rows.select(
        "event_id", scaled(notation.hz_to_pitch(F.col("value") * 10)).alias("pitch"), notation.drum_piece(note).alias("piece"), notation.string_from_top(fret % 6, F.lit(6)).alias("string"),
        notation.key_name(F.col("acc"), F.col("event_id") % 2 == 0).alias("key_name"), notation.fretted_pitch(note, fret).alias("fretted"), key["block"].alias("block"), key["place"].alias("place"),
        F.rint(notation.quantised_duration(F.col("value"), 62.5) * 1e6).cast("long").alias("quantised_us"),
    )


@query("""with p as (select p_partkey, cast(p_size % 9 + 1 as int) n, p_partkey % 7 - 3 as off from part),
t as (select *, case when n > 6 then list_concat(list_transform(range(n - 6, 0, -1), lambda i: 40 - 5 * i), [40, 45, 50, 55, 59, 64]) else [40, 45, 50, 55, 59, 64][1:n] end g, case when n > 4 then list_concat(list_transform(range(n - 4, 0, -1), lambda i: 28 - 5 * i), [28, 33, 38, 43]) else [28, 33, 38, 43][1:n] end b from p)
select p_partkey, array_to_string(g, ' ') guitar, array_to_string(b, ' ') bass, n between 6 and 8 as supported, array_to_string(list_transform(g, lambda x: off), ' ') as offsets from t""")
def tuning_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") % 9 + 1).cast("int").alias("n"), (F.col("p_partkey") % 7 - 3).cast("int").alias("off"))
    n = F.col("n")
    guitar = notation.standard_tuning(n, False)
    high_to_low = F.reverse(F.transform(guitar, lambda p: p + F.col("off")))
    return rows.select("p_partkey", F.array_join(guitar, " ").alias("guitar"), F.array_join(notation.standard_tuning(n, True), " ").alias("bass"), notation.tuning_supported(n, False).alias("supported"), F.array_join(notation.tuning_offsets(high_to_low, False), " ").alias("offsets"))


@query(f"""with l as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity::double / 50::double a, l_partkey % 3 = 0 as st, l_suppkey % 2 = 0 as lr, l_partkey % 5 = 0 as de, case when l_linenumber > 1 then l_suppkey % 7 / 10::double end nx, (l_partkey % 20)::double / 10::double seg from lineitem),
s as (select *, case when lr then least(coalesce(nx, 1e9::double), seg) else (case when de then least((a * 0.95::double) * (case when st then 0.5::double else 1::double end), 0.1::double) else (a * 0.95::double) * (case when st then 0.5::double else 1::double end) end) end v from l)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, {sql_scaled("greatest(0.03::double, least(v, greatest(0::double, seg)))", 100000)} sounding from s""")
def sounding_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    after = F.when(F.col("l_linenumber") > 1, F.col("l_suppkey") % 7 / 10)
    length = notation.sounding_length(F.col("l_quantity").cast("double") / 50, F.col("l_partkey") % 3 == 0, F.col("l_suppkey") % 2 == 0, F.col("l_partkey") % 5 == 0, after, F.lit(None).cast("double"), F.col("l_partkey") % 20 / 10)
    return table(spark, sf_dir, "lineitem").select(*keys, scaled(length, 100_000).alias("sounding"))


@query("""with n as (select p_partkey, p_type || ' ' || (['Drum Kit', 'Back Vocals', 'Lead Vocal', 'Piano LH', 'Keys (right)', 'Grand-Piano', 'Bass', 'Rhythm Guitar', '__', 'Main Vox'])[p_partkey % 10 + 1] as long, (['Drum Kit', 'Back Vocals', 'Lead Vocal', 'Piano LH', 'Keys (right)', 'Grand-Piano', 'Bass', 'Rhythm Guitar', '__', 'Main Vox'])[p_partkey % 10 + 1] as name from part),
l as (select *, lower(name) s, trim(regexp_replace(regexp_replace(lower(trim(name)), '[()\\[\\]{}_/\\\\-]+', ' ', 'g'), '\\s+', ' ', 'g')) m, trim(regexp_replace(lower(name), '[^a-z0-9]+', '_', 'g'), '_') i from n)
select p_partkey, case when regexp_matches(s, 'drum|kit|percussion|tambourine|triangle') then 'drums' when regexp_matches(s, 'vocal|voice|singer') then case when s like '%back%' then 'ignore' else 'lead_vocal' end
when regexp_matches(s, 'piano|keyboard|keys') then case when regexp_matches(s, 'lh|left') then 'piano_left' when regexp_matches(s, 'rh|right') then 'piano_right' else 'piano_combined' end when s like '%bass%' then 'bass' when regexp_matches(s, 'guitar|lead|rhythm') then 'guitar' else 'ignore' end role,
case when m in ('lead vocals', 'lead vocal', 'main vocals', 'main vocal', 'lead vox', 'main vox') then 'lead_vocal' when m in ('backing vocals', 'harmony vocals') then 'ignored_vocal' when m in ('drums', 'drum kit', 'main drums', 'kit') then 'drums'
when regexp_matches(m, 'piano|keys|keyboard') and list_has_any(string_split(m, ' '), ['lh', 'left']) then 'piano_left' when regexp_matches(m, 'piano|keys|keyboard') and list_has_any(string_split(m, ' '), ['rh', 'right']) then 'piano_right'
when m in ('piano', 'keys', 'keyboard', 'grand piano') then 'piano_combined' when m like '%bass%' then 'bass' when m like '%guitar%' then 'guitar' else 'unsupported' end cls,
m as normal, case when i = '' then 'track_' || p_partkey else i end as safe,
cast(case when s like '%kit%' then 1999 else 1999 end as int) symbol, cast(('0x' || substr(sha256(long), 1, 8))::bigint % 4096 as int) stable, not contains(name, '/') as path_ok from l""")
def name_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*(F.lit(n) for n in ("Drum Kit", "Back Vocals", "Lead Vocal", "Piano LH", "Keys (right)", "Grand-Piano", "Bass", "Rhythm Guitar", "__", "Main Vox")))
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_type", F.get(names, (F.col("p_partkey") % 10).cast("int")).alias("name"))
    name = F.col("name")
    return rows.select("p_partkey", notation.role_of_name(name).alias("role"), notation.class_of_name(name, F.lit(False)).alias("cls"), notation.normal_name(name).alias("normal"), notation.safe_id(name, F.col("p_partkey")).alias("safe"), notation.symbol_id(name).alias("symbol"), notation.stable_symbol(F.concat_ws(" ", "p_type", "name")).alias("stable"), notation.valid_path(name).alias("path_ok"))


@query("""with t as (select event_id, (['kick', 'Snare L', 'hi-hat', 'crash', 'Tom 1', 'bell', '42', '7.5'])[event_id % 8 + 1] w, (['thumb', 'Ring-Finger', '3', '7', 'x', 'little', 'index', ''])[event_id % 8 + 1] f,
(['down', 'Up', 'none', 'pick_down', '', 'upstroke', '0', 'DOWN'])[event_id % 8 + 1] p, (['prebend', 'release', 'Pre-Bend Release', 'bend', 'round', '', 'none', 'bend release'])[event_id % 8 + 1] b, (['a/b', '/a', 'a//b', 'a/../b', 'a..b/c', 'c:/x', 'a', 'a\\b'])[event_id % 8 + 1] as path, cast(user_id % 128 as int) note, value from EVENTS),
r as (select *, replace(replace(replace(lower(b), '_', ''), '-', ''), ' ', '') n from t)
select event_id, cast((case w when 'kick' then 1000 when 'Snare L' then 1001 when 'hi-hat' then 1002 when 'crash' then 1003 when 'Tom 1' then 1004 when '42' then 42 else 1999 end) as int) symbol,
cast((case f when 'thumb' then 0 when 'Ring-Finger' then 3 when '3' then 3 when 'little' then 4 when 'index' then 1 else -1 end) as int) finger, cast((case when lower(p) like '%down%' then 0 when lower(p) like '%up%' then 1 else -1 end) as int) pick,
cast((case when n like '%prebend%' and n like '%release%' then 3 when n like '%round%' then 4 when n like '%prebend%' then 2 when n like '%release%' then 1 else 0 end) as int) bend, path in ('a/b', 'a..b/c', 'a') as path_ok,
cast((case when note in (35, 36) then 1000 when note in (37, 38, 39, 40) then 1001 when note in (42, 44, 46) then 1002 when note in (49, 51, 52, 53, 55, 57, 59) then 1003 when note in (41, 43, 45, 47, 48, 50) then 1004 else 1999 end) as int) family,
cast(floor(coalesce(try_cast(w as double), value / 1000::double) * 1000000::double + 0.5::double) as bigint) residual, case when event_id % 2 = 0 then 'x/' || event_id || '/y' else event_id || '/y' end as joined from r""")
def symbol_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = lambda *words: F.get(F.array(*(F.lit(w) for w in words)), (F.col("event_id") % 8).cast("int"))
    word = pick("kick", "Snare L", "hi-hat", "crash", "Tom 1", "bell", "42", "7.5")
    finger, bend = pick("thumb", "Ring-Finger", "3", "7", "x", "little", "index", ""), pick("prebend", "release", "Pre-Bend Release", "bend", "round", "", "none", "bend release")
    stroke, path = pick("down", "Up", "none", "pick_down", "", "upstroke", "0", "DOWN"), pick("a/b", "/a", "a//b", "a/../b", "a..b/c", "c:/x", "a", "a\\b")
    joined = notation.joined_path(F.when(F.col("event_id") % 2 == 0, F.lit("/x/")), F.col("event_id").cast("string"), F.lit("y\\"))
    return events(spark, sf_dir).select("event_id", notation.symbol_id(word).alias("symbol"), notation.finger(finger).alias("finger"), notation.pick_direction(stroke).alias("pick"), notation.bend_intent(bend).alias("bend"), notation.valid_path(path).alias("path_ok"), notation.family_of_note((F.col("user_id") % 128).cast("int")).alias("family"), scaled(notation.residual_seconds(word, milliseconds=F.col("value")), 1_000_000).alias("residual"), joined.alias("joined"))


@query(f"""with e as (select event_id, value / 100::double s, (user_id % 100)::double / 100::double c, (t % 1000000)::double / 1000000::double r, cast(user_id % 40 as int) m from EVENTS)
select event_id, {sql_scaled("greatest(0.05::double, 0.55::double * s + 0.30::double * c + 0.15::double * exp(-r / 0.12::double))", 1000000)} weight,
{sql_scaled("0.88::double * exp(-0.5::double * (r / 0.45::double) * (r / 0.45::double)) + 0.12::double * exp(-0.5::double * (r / 2.5::double) * (r / 2.5::double))", 1000000)} prior,
{sql_scaled("greatest(0::double, least(1::double, s / 0.75::double)) * 0.35::double + greatest(0::double, least(1::double, c / 0.18::double)) * 0.30::double + greatest(0::double, 1::double - r / 0.8::double) * 0.25::double + least(1::double, m::double / 6::double) * 0.10::double", 1000000)} confidence,
{sql_scaled("greatest(0::double, least(1::double, (s - 0.2::double) / 0.5::double))", 1000000)} ramp, {sql_scaled("case when m between 5 and 30 then least(1::double, (m - 4)::double / 3::double, (31 - m)::double / 3::double) else 0::double end", 1000000)} taper,
cast((case when s - c > 0.045::double then 1 when s - c < -0.045::double then -1 else 0 end) as int) dir, {sql_scaled("s + (r - 0.5::double) * ((s + c) - s) / (1.5::double - 0.5::double)", 1000000)} mapped, {sql_scaled("case when c > 0 then r / c end", 1000)} beats from e""")
def scoring_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("event_id", (F.col("value") / 100).alias("s"), (F.col("user_id") % 100 / 100).alias("c"), (F.col("t") % 1_000_000 / 1_000_000).alias("r"), (F.col("user_id") % 40).cast("int").alias("m"))
    s, c, r, m = (F.col(x) for x in "scrm")
    made = {
        "weight": (scoring.support_weight(s, c, r), 10**6), "prior": (scoring.temporal_prior(r), 10**6), "confidence": (scoring.calibrated_confidence(s, c, r, F.lit(0.8), m), 10**6), "ramp": (scoring.ramp(s, 0.2, 0.7), 10**6),
        "taper": (scoring.taper(m, F.lit(5), F.lit(30)), 10**6), "mapped": (scoring.through_two_points(r, F.lit(0.5), F.lit(1.5), s, s + c), 10**6), "beats": (scoring.phase_units(r, c, F.lit(None).cast("double"))["beats"], 1000),
    }
    return rows.select("event_id", *(scaled(v, by).alias(n) for n, (v, by) in made.items()), scoring.direction(s - c).alias("dir"))


@query(f"""with h as (select role, hour, list_sort(list_distinct(list(cast(user_id % 60 as int)))) a, list_sort(list(cast(t % 3600000000 as double) / 3600000000::double)) o from EVENTS group by all),
p as (select x.role, x.hour, x.a a, y.a b, x.o p, y.o q from h x join h y on x.role = y.role and y.hour = x.hour + 1),
s as (select *, list_transform(range(1, len(a)), lambda i: a[i + 1] - a[i]) da, list_transform(range(1, len(b)), lambda i: b[i + 1] - b[i]) db from p), n as (select *, least(len(da), len(db)) k, least(len(p), len(q)) j, greatest(len(p), len(q)) w from s)
select role, hour, {sql_scaled("list_sum(list_transform(a, lambda x: case when list_contains(b, x) then 1::double when list_contains(list_transform(b, lambda y: y % 12), x % 12) then 0.72::double else 0::double end)) / len(a)::double", 1000)} agreement,
{sql_scaled("case when k > 0 then list_sum(list_transform(range(1, k + 1), lambda i: case when da[i] = db[i] then 1::double when da[i] % 12 = db[i] % 12 then 0.5::double else 0::double end)) / k::double else 0::double end", 1000)} step_likeness,
{sql_scaled("case when len(p) >= 4 and len(q) >= 4 then list_sum(list_transform(range(1, j + 1), lambda i: greatest(0::double, 1::double - abs(p[i] - q[i]) / 0.14::double))) / w::double * 0.55::double + greatest(0::double, 1::double - abs(len(p) - len(q))::double / w::double) * 0.25::double + len(list_intersect(a, b))::double / len(list_distinct(list_concat(a, b)))::double * 0.20::double else 0::double end", 1000)} phrase,
cast(a[len(a) // 2 + 1] as int) upper from n""")
def array_likeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).withColumn("note", (F.col("user_id") % 60).cast("int")).withColumn("at", (F.col("t") % 3_600_000_000).cast("double") / 3_600_000_000)
    sets = rows.groupBy("role", "hour").agg(F.sort_array(F.collect_set("note")).alias("a"), F.sort_array(F.collect_list("at")).alias("p"))
    after = sets.select("role", (F.col("hour") - 1).alias("hour"), F.col("a").alias("b"), F.col("p").alias("q"))
    both = sets.join(after, ["role", "hour"])
    return both.select("role", "hour", scaled(vectors.pitch_agreement(F.col("a"), F.col("b"))).alias("agreement"), scaled(vectors.step_agreement(F.col("a"), F.col("b"))).alias("step_likeness"), scaled(vectors.phrase_agreement(F.col("p"), F.col("q"), F.col("a"), F.col("b"))).alias("phrase"), vectors.upper_middle(F.col("a")).alias("upper"))
