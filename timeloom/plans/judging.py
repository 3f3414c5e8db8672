"""Queries of gates, evidence and features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from timeloom.operators import evidence, features, gates
from timeloom.plans.registry import query, scaled, sql_scaled
from timeloom.sources.tables import HOUR_US, events, table

_C = "c as (select user_id % 30 g, row_number() over (partition by user_id % 30 order by t, event_id) i, t::double / 1000000::double cs, t::double / 1000000::double + 8::double + value ce, 0.95::double + value / 100::double st, 3::double - value / 20::double tr from EVENTS), m as (select *, tr + st * cs ms, tr + st * ce me from c), p as (select *, lag({'cs': cs, 'ce': ce, 'st': st, 'tr': tr, 'ms': ms, 'me': me}) over (partition by g order by i) a from m)"


@query(f"""with {_C}, o as (select *, greatest(a.cs, cs) lo, least(a.ce, ce) hi from p where a is not null), d as (select *, greatest(abs((tr + st * lo) - (a.tr + a.st * lo)), abs((tr + st * hi) - (a.tr + a.st * hi))) apart, list_sum(list_transform([0.0::double, 0.25::double, 0.5::double, 0.75::double, 1.0::double], lambda f: abs((tr + st * (lo + (hi - lo) * f)) - (a.tr + a.st * (lo + (hi - lo) * f))))) / 5::double mean from o)
select g, i, concat_ws(',', case when cs <= a.cs then 'chart_window_did_not_advance' end, case when ce <= a.ce then 'chart_window_end_did_not_advance' end, case when ms <= a.ms then 'midi_window_start_did_not_advance' end, case when me <= a.me then 'midi_window_end_did_not_advance' end, case when hi > lo and apart > 0.35::double then 'overlap_mapping_disagreement' end,
case when hi > lo and tr + st * least(hi, (lo + hi) / 2::double + least(0.01::double, greatest(0.000001::double, (hi - lo) / 1000::double))) <= a.tr + a.st * greatest(lo, (lo + hi) / 2::double - least(0.01::double, greatest(0.000001::double, (hi - lo) / 1000::double))) then 'crossing_or_reversing_overlap_maps' end, case when hi <= lo and ms <= a.me then 'non_overlapping_sections_reverse_or_overlap_midi_time' end) reasons,
{sql_scaled("-(abs(st - a.st) * 0.8::double + abs(tr - a.tr) * 0.08::double + case when hi > lo then mean * 1.5::double else 0::double end)", 100)} adjustment from d""")
def transition_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = (F.col("user_id") % 30).alias("g")
    at = F.col("t").cast("double") / 1e6
    c = events(spark, sf_dir).select(g, "t", "event_id", at.alias("chart_start"), (at + 8.0 + F.col("value")).alias("chart_end"), (F.col("value") / 100 + 0.95).alias("stretch"), (3.0 - F.col("value") / 20).alias("translation"))
    c = c.withColumn("midi_start", F.col("translation") + F.col("stretch") * F.col("chart_start")).withColumn("midi_end", F.col("translation") + F.col("stretch") * F.col("chart_end"))
    by = Window.partitionBy("g").orderBy("t", "event_id")
    whole = c.withColumn("i", F.row_number().over(by)).withColumn("c", F.struct("chart_start", "chart_end", "midi_start", "midi_end", "stretch", "translation"))
    paired = whole.withColumn("p", F.lag("c").over(by)).where("p is not null")
    return paired.select("g", F.col("i").cast("long").alias("i"), F.array_join(gates.transition_reasons("p", "c"), ",").alias("reasons"), scaled(gates.transition_adjustment("p", "c"), 100).alias("adjustment"))


@query("""with e as (select event_id, user_id % 40 - 1 + value / 10::double chart, (user_id % 40 - 1 + value / 10::double) * (0.7::double + (event_id % 61)::double / 100::double) - (event_id % 5)::double / 10::double audio, event_id % 3 = 0 ep, user_id % 60 m from EVENTS), s as (select *, audio / chart st, abs(audio - chart) co from e),
j as (select *, chart > 0 and audio > 0 and (st between 0.85::double and 1.15::double or (chart <= 10 and co <= 0.25::double)) ok, least(0.5::double, 0.25::double + greatest(0, m - 16)::double * 0.005::double) al from s),
k as (select *, not ok and ep and chart <= 10 and chart > 0 and audio > 0 and co <= al and st between 0.7::double and 1.3::double saved from j)
select event_id, ok or saved accepted, case when saved then 'length_adjusted_episode_delta_exception' when not (chart > 0 and audio > 0) then 'catastrophic_non_positive_geometry' when st between 0.85::double and 1.15::double then 'normal_stretch_range' when chart <= 10 and co <= 0.25::double then 'short_region_delta_exception' else 'geometry_out_of_policy' end basis,
case when chart <= 0 then 'chart_control_did_not_advance' when audio <= 0 then 'midi_control_did_not_advance' when not (st between 0.9::double and 1.1::double or (chart <= 16 and co <= 0.5::double)) then 'unsafe_fused_edge_geometry' end fused,
case when user_id_ok = 'C' then 'C' else user_id_ok end tier from (select *, case when (event_id % 7 < 3 or event_id % 5 < 2 or (event_id % 5)::double / greatest(1, event_id % 7)::double < 0.4::double) or event_id % 4 > greatest(1, m // 16) then 'C' when event_id % 7 >= 3 and event_id % 5 >= 3 and (event_id % 5)::double / greatest(1, event_id % 7)::double >= 0.75::double and event_id % 4 = 0 then 'A' else 'B' end user_id_ok from k)""")
def edge_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    policy = gates.MODES["permissive"]
    chart = (F.col("user_id") % 40 - 1) + F.col("value") / 10
    e = events(spark, sf_dir).select("event_id", chart.alias("chart"), (F.col("event_id") % 3 == 0).alias("in_episode"), (F.col("user_id") % 60).alias("measures"))
    e = e.withColumn("audio", F.col("chart") * (F.col("event_id") % 61 / 100 + 0.7) - F.col("event_id") % 5 / 10)
    got = gates.assess_edges(e, policy)
    tier = gates.evidence_tier(F.col("event_id") % 7, F.col("event_id") % 5, F.col("event_id") % 4, F.col("measures"), policy)
    return got.select("event_id", "accepted", "basis", gates.fused_edge(F.col("chart"), F.col("audio")).alias("fused"), tier.alias("tier"))


@query(f"""with s as (select hour // 24 g, role source, case when count(*) % 7 <> 3 then min(t)::double / 1000000::double end as first, count(*) % 9 n, (hour // 24) * 86400::double ss, (hour // 24) * 86400::double + 1::double cs, case when count(*) % 5 <> 1 then (hour // 24) * 86400::double + (count(*) % 8)::double end heard, count(*) % 6 <> 2 has_audio from EVENTS group by hour // 24, role),
e as (select *, coalesce(abs(first - min(first) over (partition by g)) <= 500::double, false) er, first - ss delay from s), f as (select *, first is null or n < case when er then 1 else 4 end few from e), b as (select *, first is null or coalesce(delay < -0.025::double or delay > 9000::double, false) or not er or few or not has_audio bad from f)
select g, source, concat_ws(',', case when few then 'insufficient_events' end, case when delay < -0.025::double or delay > 9000::double then 'not_an_early_score_entrance' end, case when not er then 'later_than_earliest_configured_score_entrance' end, case when er and not has_audio then 'missing_audio' end, case when not bad and heard is null then 'missing_audio_first_onset' end, case when not bad and abs(heard - cs) > 4::double then 'opening_anchor_shift_too_large' end) reasons from b""")
def opening_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.opening_gates(_openings(spark, sf_dir), ["g"], latest=9000.0, together=500.0).select("g", "source", F.array_join("reasons", ",").alias("reasons"))


def _openings(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, g = F.count("*"), F.expr("hour div 24")
    rows = events(spark, sf_dir).groupBy(g.alias("g"), F.col("role").alias("source")).agg(n.alias("k"), (F.min("t").cast("double") / 1e6).alias("_f"))
    day, k = F.col("g") * 86400.0, F.col("k")
    return rows.select("g", "source", F.when(k % 7 != 3, F.col("_f")).alias("first"), (k % 9).alias("n"), day.alias("score_start"), (day + 1.0).alias("content_start"), F.when(k % 5 != 1, day + k % 8).alias("heard"), (k % 6 != 2).alias("has_audio"), k.alias("priority"))


@query(f"""with m as (select user_id g, row_number() over (partition by user_id order by t, event_id) i, t::double / 1000000::double b, (t % 300)::double c from EVENTS), s as (select *, b + c / 1000::double p from m), d as (select *, b - lag(b) over w db, p - lag(p) over w dp, abs(c - lag(c) over w) j from s window w as (partition by g order by i)),
a as (select g, count(*) filter (dp <= 0) e, count(*) filter (dp > 0 and db > 0 and not (dp / db between 0.9::double and 1.1::double)) w, coalesce(max(j), 0::double) jump from d group by g) select g, e + case when jump >= 180 then 1 else 0 end errors, w + case when jump >= 60 and jump < 180 then 1 else 0 end warnings, {sql_scaled("jump", 10)} jump, case when e + case when jump >= 180 then 1 else 0 end > 0 then 'error' when w + case when jump >= 60 then 1 else 0 end > 0 then 'warning' else 'ok' end as status from a""")
def proposal_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select(F.col("user_id").alias("g"), F.struct("t", "event_id").alias("i"), (F.col("t").cast("double") / 1e6).alias("b"), (F.col("t") % 300).cast("double").alias("c")).withColumn("p", F.col("b") + F.col("c") / 1000)
    return gates.validate_proposals(rows, ["g"], "i", "b", "p", "c").select("g", "errors", "warnings", scaled("jump", 10).alias("jump"), "status")


@query("""with s as (select user_id g, t::double / 1000000::double x, t::double / 1000000::double * (0.99::double + (user_id % 3)::double / 100::double) - case when user_id % 11 = 0 then 1e12::double else 0::double end m, event_id from EVENTS), d as (select *, m - lag(m) over w dm, x - lag(x) over w dx from s window w as (partition by g order by x)),
r as (select user_id g, min(t)::double / 1000000::double cs, user_id % 4 off from EVENTS where user_id % 22 = 0 group by user_id), a as (select g, bool_or(m < 0) negative, coalesce(bool_or(dm <= 0), false) nonmonotonic, coalesce(bool_or(dx > 0 and not (dm / dx between 0.5::double and 1.5::double)), false) implausible from d group by g)
select a.g, negative, nonmonotonic, implausible, case when not (negative or nonmonotonic or implausible) then 'none' when r.off is not null then 'root_identity_clock' else 'blocked' end fallback from a left join r using (g)""")
def baseline_sanity(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.col("t").cast("double") / 1e6
    e = events(spark, sf_dir)
    samples = e.select(F.col("user_id").alias("g"), x.alias("x"), (x * (F.col("user_id") % 3 / 100 + 0.99) - F.when(F.col("user_id") % 11 == 0, 1e12).otherwise(0.0)).alias("m"))
    roots = e.where("user_id % 22 = 0").groupBy(F.col("user_id").alias("g")).agg(F.min(x).alias("chart_start"), F.first(F.col("user_id") % 4).alias("offset"))
    return gates.baseline_sanity(samples, ["g"], "x", "m", roots).select("g", "negative", "nonmonotonic", "implausible", "fallback")


@query("""with p as (select user_id g, t::double / 1000000::double x, role from EVENTS where event_id % 3 = 0), s as (select *, x - lag(x) over (partition by g order by x) d from p), a as (select g, min(x) a, max(x) z, coalesce(max(d), 0::double) gap, count(distinct role) roles from s group by g), c as (select user_id g, count(*) n from EVENTS where event_id % 15 = 0 group by user_id)
select a.g, concat_ws(',', case when coalesce(n, 0) < 4 then 'too_few_controls' end, case when (z - a) / greatest(z, 0.000001::double) < 0.0009::double then 'low_coverage' end, case when gap > 300000 then 'long_gap' end, case when roles < 3 then 'too_few_roles' end) reasons from a left join c using (g)""")
def midi_authority(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumn("g", F.col("user_id")).withColumn("x", F.col("t").cast("double") / 1e6)
    got = gates.midi_authority(e.where("event_id % 3 = 0"), e.where("event_id % 15 = 0"), ["g"], "x", "role", coverage=0.0009, gap=300_000.0, roles=3)
    return got.select("g", F.array_join("reasons", ",").alias("reasons"))


@query("""with i as (select n_regionkey g, n_name track from nation union all select n_regionkey, n_name from nation where n_nationkey % 9 = 4), a as (select n_regionkey g, n_name track, case when n_nationkey % 3 = 0 then 'bass' when n_nationkey % 3 = 1 then 'ignore' else 'kazoo' end role from nation union all select n_regionkey, n_name, 'drums' from nation where n_nationkey % 4 = 1),
k as (select g, track, count(*) n from i group by all) select distinct a.g, 'configured_track_name_ambiguous' code, a.track, null::varchar detail from a join k using (g, track) where n > 1 union all select g, 'unknown_override_role', track, role from a where role = 'kazoo'
union all select g, 'incompatible_duplicate_assignment', track, array_to_string(list_sort(list_distinct(list(role))), ' ') from a where role <> 'ignore' group by g, track having count(distinct role) > 1 union all select distinct a.g, 'active_track_also_ignored', a.track, null from a join a b using (g, track) where a.role <> 'ignore' and b.role = 'ignore'""")
def config_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("g"), F.col("n_name").alias("track"), F.col("n_nationkey").alias("k"))
    inventory = n.select("g", "track").unionByName(n.where("k % 9 = 4").select("g", "track"))
    role = F.when(F.col("k") % 3 == 0, "bass").when(F.col("k") % 3 == 1, "ignore").otherwise("kazoo")
    assigned = n.select("g", "track", role.alias("role")).unionByName(n.where("k % 4 = 1").select("g", "track", F.lit("drums").alias("role")))
    return gates.config_errors(assigned, inventory, ["g"], ("bass", "drums", "ignore")).select("g", "code", "track", "detail")


@query("""select n_regionkey g, n_name track from nation where n_nationkey not in (select s_nationkey from supplier where s_suppkey % 3 = 0)""")
def unused_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    used = table(spark, sf_dir, "supplier").where("s_suppkey % 3 = 0").join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    shape = [F.col("n_regionkey").alias("g"), F.col("n_name").alias("track")]
    return gates.unused_tracks(n.select(*shape), used.select(*shape), ["g"])


@query(f"""with r as (select user_id g, t::double / 1000000::double x, cast(floor(value * 100::double) as bigint) % 800 - 400 res, event_id % 90 - 45 cor from EVENTS), m as (select g, count(*) n, median(abs(res)) bm, median(abs(res - cor)) am from r group by g), c as (select g, median(res) a, median(res - cor) b from r group by g), d as (select g, median(abs(res - a)) base_mad, median(abs(res - cor - b)) mad from r join c using (g) group by g)
select g, n, {sql_scaled("bm - am", 10)} improvement, {sql_scaled("base_mad", 10)} base_mad, {sql_scaled("mad", 10)} mad from m join d using (g)""")
def proposal_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select(F.col("user_id").alias("g"), (F.floor(F.col("value") * 100) % 800 - 400).alias("res"), (F.col("event_id") % 90 - 45).alias("cor"))
    return evidence.fit_metrics(rows, ["g"], "res", "cor").select("g", "n", scaled("improvement", 10).alias("improvement"), scaled("base_mad", 10).alias("base_mad"), scaled("mad", 10).alias("mad"))


@query(f"""with o as (select user_id g, (t - 1704067200000000)::double / 1000000::double x, (cast(floor(value * 100::double) as bigint) % 900)::double y from EVENTS), n as (select *, case when row_number() over (partition by g order by x, y) <= count(*) over (partition by g) // 2 then 1 else 2 end h from o),
s as (select a.g, a.h, median((b.y - a.y) / (b.x - a.x)) slope from n a join n b on a.g = b.g and a.h = b.h and b.x > a.x group by all), w as (select g, h, count(*) n, max(x) - min(x) span from n group by all), k as (select *, coalesce(n >= 4 and span >= 30 and abs(slope) >= 1::double and abs(slope * span) >= 75::double, false) sig from w left join s using (g, h))
select g, cast(sum(n) as bigint) n, {sql_scaled("max(slope) filter (h = 1)", 1000000)} first_slope, {sql_scaled("max(slope) filter (h = 2)", 1000000)} second_slope from k group by g""")
def half_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select(F.col("user_id").alias("g"), ((F.col("t") - 1_704_067_200_000_000).cast("double") / 1e6).alias("x"), (F.floor(F.col("value") * 100) % 900).cast("double").alias("y"))
    return evidence.half_shapes(rows, ["g"], "x", "y").select("g", F.col("n").cast("long").alias("n"), scaled("first_slope", 10**6).alias("first_slope"), scaled("second_slope", 10**6).alias("second_slope"))


@query("""with g as (select hour // 24 g, role, hour, t::double / 1000000::double x, 1 + user_id % 3 k from EVENTS), o as (select *, min(x) over (partition by g) f from g), c as (select g, role, count(*) n, sum(k) p from o where x <= f + 20000::double group by all), r as (select *, row_number() over w i, coalesce(lead(n) over w, 0) s from c window w as (partition by g order by n desc, p desc, role))
select g, case when n < 5 then 'uncertain' when s = 0 or n >= greatest(3, 2 * s) then 'solo' when n::double >= 1.35::double * greatest(1, s)::double then 'dominant' else 'ensemble' end classification, case when n >= 5 and (s = 0 or n >= greatest(3, 2 * s) or n::double >= 1.35::double * greatest(1, s)::double) then role end role, n as groups, s runner_up from r where i = 1""")
def opening_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select(F.expr("hour div 24").alias("g"), "role", (F.col("t").cast("double") / 1e6).alias("x"), F.sequence(F.lit(1), (F.col("user_id") % 3 + 1).cast("int")).alias("s"))
    return evidence.opening_role(rows, ["g"], "role", "x", "s", horizon=20_000.0).select("g", "classification", "role", "groups", F.col("runner_up").cast("long").alias("runner_up"))


@query("""with a as (select user_id % 30 g, role, count(*) n, min(t)::double / 1000000::double f from EVENTS group by all) select g, role, n, n >= 3 and f <= min(f) over (partition by g) + 40000::double opening_eligible from a""")
def role_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select((F.col("user_id") % 30).alias("g"), "role", (F.col("t").cast("double") / 1e6).alias("x"))
    return evidence.role_activity(rows, ["g"], "role", "x", within=40_000.0).select("g", "role", "n", "opening_eligible")


@query(f"""with c as (select event_id, user_id % 20 g, (event_id % 30)::double st, value a, value + (event_id % 9)::double / 4::double ex, case when event_id % 3 = 0 then value - 1::double end ob, value / 120::double co, (event_id % 11)::double / 11::double di, (event_id % 13)::double / 60::double ma, event_id % 4 <> 0 el from EVENTS),
s as (select *, co * 0.45::double + di * 0.22::double + greatest(0::double, least(1::double, ma / 0.15::double)) * 0.18::double + greatest(0::double, 1::double - least(abs(a - ex), abs(a - coalesce(ob, ex))) / 8::double) * 0.15::double - case when el then 0::double else 0.12::double end k from c where st <= 1::double + 20::double), r as (select *, row_number() over (partition by g order by k desc, event_id) rank from s)
select g, event_id, rank, {sql_scaled("k", 100000)} consensus from r where rank <= 12""")
def incipit_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, e = F.col("value"), F.col("event_id")
    rows = events(spark, sf_dir).select("event_id", (F.col("user_id") % 20).alias("g"), (e % 30).cast("double").alias("score_time"), v.alias("audio_time"), (v + e % 9 / 4).alias("expected"), F.when(e % 3 == 0, v - 1.0).alias("observed"), (v / 120).alias("confidence"), (e % 11 / 11).alias("distinctiveness"), (e % 13 / 60).alias("margin"), (e % 4 != 0).alias("eligible"), F.lit(1.0).alias("song_first"))
    return evidence.incipit_consensus(rows, ["g"], "event_id").select("g", "event_id", F.col("rank").cast("long").alias("rank"), scaled("consensus", 10**5).alias("consensus"))


@query("""with r as (select event_id, event_id % 9 n, (event_id % 97)::double span, (event_id % 23 - 11)::double / 4::double slope, (event_id % 301 - 150)::double med, event_id % 3 ef, event_id % 4 % 3 sf, event_id % 10 = 7 fd, event_id % 14 = 9 sd, event_id % 17 = 5 sc, event_id % 12 = 3 dr, (event_id % 500)::double mad from EVENTS),
d as (select *, coalesce(n >= 4 and span >= 30 and abs(slope) >= 1 and abs(slope * span) >= 75, false) st, abs(slope * span) < 75 mi, fd or sd cl from r), k as (select *, case when ef = 0 then case when n >= 4 and mi then 'minor_local_variation' else 'insufficient_evidence' end when dr then 'possible_nonlinear_timing' when cl then 'conflicting_evidence' when sf > 0 or st then 'possible_drift' when abs(med) >= 80 then 'possible_offset' when mi then 'minor_local_variation' else 'stable' end c from d)
select event_id, c as classification, case when sc then 'test_regional_source_fusion' when dr then 'test_structural_jump_then_regional_alignment' when c = 'possible_drift' then 'test_piecewise_regional_warp' when c in ('conflicting_evidence', 'insufficient_evidence') then 'manual_anchor_assisted' else 'retain_global_map' end strategy, case when sf >= 2 and not (cl or sc or mad > 250) then 'high' when c not in ('conflicting_evidence', 'insufficient_evidence') then 'moderate' else 'low' end confidence from k""")
def region_interpretation(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    rows = events(spark, sf_dir).select("event_id", (e % 9).alias("n"), (e % 97).cast("double").alias("span"), ((e % 23 - 11) / 4).alias("slope"), (e % 301 - 150).cast("double").alias("median"), (e % 3).alias("eligible_families"), (e % 4 % 3).alias("significant_families"), (e % 10 == 7).alias("families_disagree"), (e % 14 == 9).alias("sources_disagree"), (e % 17 == 5).alias("scales_conflict"), (e % 12 == 3).alias("direction_reversal"), (e % 500).cast("double").alias("mad"))
    return evidence.interpret_regions(rows).select("event_id", "classification", "strategy", "confidence")


@query("""with o as (select hour measure, role, event_id % 3 <> 0 acc from EVENTS where event_id % 5 = 0), g as (select measure, count(*) n, count(*) filter (acc) a, array_to_string(list_sort(list_distinct(list(role))), ' ') r from o group by measure), m as (select distinct hour measure from EVENTS)
select measure, coalesce(n, 0) observations, coalesce(a, 0) accepted_observations, coalesce(r, '') roles, case when a > 0 then 'supported' when n > 0 then 'observed' else 'not_observed' end as status from m left join g using (measure)""")
def measure_annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).select(F.lit(0).alias("song"), F.col("hour").alias("measure"), F.array("role").alias("roles"), (F.col("event_id") % 3 != 0).alias("accepted"), "event_id")
    seen = evidence.normalise_observations({"onset": e.where("event_id % 10 = 0"), "pitch": e.where("event_id % 10 = 5")}, ["song"])
    got = evidence.annotate_measures(e.select("song", "measure").distinct(), seen, ["song"], "measure")
    return got.select("measure", "observations", "accepted_observations", F.coalesce(F.array_join("roles", " "), F.lit("")).alias("roles"), "status")


@query(f"""with f as (select role g, t::double / 1000000::double x, value l, value * (event_id % 4) a from EVENTS), k as (select g, quantile_cont(l, 0.2) f20, quantile_cont(l, 0.75) a75, quantile_cont(a, 0.75) o75 from f group by g), s as (select f.*, greatest(f20 * 3::double, a75 * 0.12::double, 0.000001::double) th, o75, sum(case when l >= greatest(f20 * 3::double, a75 * 0.12::double, 0.000001::double) then 1 else 0 end) over (partition by f.g order by x rows between 2 preceding and 2 following) >= 3 su from f join k using (g))
select g, {sql_scaled("min(x) filter (su)", 1)} first_activity, {sql_scaled("max(x) filter (su)", 1)} last_activity, {sql_scaled("min(x) filter (a >= greatest(o75, 0.000000001::double))", 1)} first_attack from s group by g""")
def activity_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = features.activity_span(_frames(spark, sf_dir), ["g"], "x", "l", "a", 5)
    return got.select("g", *(scaled(c, 1).alias(c) for c in ("first_activity", "last_activity", "first_attack")))


def _frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(F.col("role").alias("g"), (F.col("t").cast("double") / 1e6).alias("x"), F.col("value").alias("l"), (F.col("value") * (F.col("event_id") % 4)).alias("a"))


@query(f"""with f as (select role g, t::double / 1000000::double x, value l, value * (event_id % 4) a from EVENTS), k as (select g, quantile_cont(l, 0.3) lo, quantile_cont(l, 0.75) hi, quantile_cont(a, 0.6) o from f group by g), s as (select distinct role g, hour h, hour * 3600::double st from EVENTS), m as (select s.g, h, avg(l) m, avg(a) d from s join f on f.g = s.g and f.x >= st and f.x < st + 3600::double group by all),
c as (select m.g, h, greatest(0::double, least(1::double, 1::double - (m - lo) / greatest(hi - lo, 0.000000001::double))) q, greatest(0::double, least(1::double, 1::double - d / greatest(o, 0.000000001::double))) r from m join k using (g)) select g, h, {sql_scaled("q * 0.65::double + r * 0.35::double", 10000)} confidence from c""")
def silence_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = events(spark, sf_dir).select(F.col("role").alias("g"), F.col("hour").alias("h")).distinct().withColumn("st", F.col("h") * 3600.0).withColumn("en", F.col("h") * 3600.0 + 3600.0)
    got = features.inactivity(spans, _frames(spark, sf_dir), ["g"], "h", ("st", "en"), "x", "l", "a", 3600.0)
    return got.select("g", "h", scaled("confidence", 10_000).alias("confidence"))


@query(f"""with e as (select event_id, user_id % 8 g, t::double / 1000000::double p from EVENTS where role = 'view'), f as (select user_id % 8 g, t::double / 1000000::double x, value / 20::double s from EVENTS where role = 'click'), n as (select e.event_id, p, max({{'s': s, 'm': -x}}) b from e join f on f.g = e.g and f.x between p - 1800::double and p + 1800::double group by all)
select event_id, {sql_scaled("-b.m", 1000)} observed, {sql_scaled("greatest(0::double, least(1::double, least(1::double, b.s) * 0.65::double + (1::double - abs(-b.m - p) / 1800::double) * 0.35::double))", 100000)} confidence from n where b.s >= 0.2::double""")
def onset_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).select("event_id", "role", (F.col("user_id") % 8).alias("g"), (F.col("t").cast("double") / 1e6).alias("x"), (F.col("value") / 20).alias("s"))
    got = features.peak_within(e.where("role = 'view'").select("event_id", "g", F.col("x").alias("p")), e.where("role = 'click'"), ["g"], "event_id", "p", "x", "s", 1800.0)
    return got.select("event_id", scaled("observed").alias("observed"), scaled("confidence", 10**5).alias("confidence"))
