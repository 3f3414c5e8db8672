"""Queries of grouping in time and of agreement between sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from timeloom.operators import fusion, islands
from timeloom.plans.registry import query, scaled, sql_scaled
from timeloom.sources.tables import HOUR_US, events, table

_HEADS = """with recursive o as (select user_id, t, hour % 12 s, role, row_number() over (partition by user_id order by t, event_id) r from EVENTS),
f as (select user_id, t, s, role, r, t head from o where r = 1 union all select o.user_id, o.t, o.s, o.role, o.r, case when o.t - f.head > 7200000000 then o.t else f.head end from f join o on o.user_id = f.user_id and o.r = f.r + 1)"""


@query(f"""{_HEADS} select user_id, head as time, array_to_string(list_sort(list_distinct(list(s))), ' ') symbols, count(*) members, array_to_string(list_sort(list_distinct(list(role))), ' ') roles from f group by user_id, head""")
def onset_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("user_id", "t", F.array(F.col("hour") % 12).alias("s"), "role")
    got = islands.onset_groups(rows, ["user_id"], "t", "s", 7_200_000_000, ["role"], 24.0 * HOUR_US)
    return got.select("user_id", "time", F.array_join("symbols", " ").alias("symbols"), "members", F.array_join("role", " ").alias("roles"))


@query(f"""{_HEADS}, p as (select distinct user_id, head t from f union all select user_id, min(t) - 5 from EVENTS group by user_id union all select user_id, max(t) + 5 from EVENTS group by user_id), n as (select *, lead(t) over (partition by user_id order by t) z from p) select user_id, t as start, z as stop from n where z > t""")
def score_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("user_id", "t")
    heads = islands.head_groups(rows, ["user_id"], "t", 7_200_000_000, 24.0 * HOUR_US).select("user_id", F.col("start").alias("t"))
    edges = rows.groupBy("user_id").agg((F.min("t") - 5).alias("start"), (F.max("t") + 5).alias("stop"))
    return islands.between(heads, edges, ["user_id"], "t")


@query("""with v as (select event_id, role, hour, t, lag(hour) over w p from EVENTS window w as (partition by role order by t, event_id)) select event_id, cast(sum(case when p is not null and hour <> p + 1 then 1 else 0 end) over (partition by role order by t, event_id) as bigint) segment, row_number() over (partition by role, hour order by t, event_id) occurrence from v""")
def playback_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).withColumn("o", F.struct("t", "event_id"))
    return islands.playback_segments(rows, ["role"], "o", "hour").select("event_id", F.col("segment").cast("long").alias("segment"), F.col("occurrence").cast("long").alias("occurrence"))


@query("""with i as (select user_id g, t s, t + cast(floor(value * 60000000::double) as bigint) e from EVENTS), f as (select *, case when s <= max(e) over (partition by g order by s, e rows between unbounded preceding and 1 preceding) then 0 else 1 end n from i),
r as (select g, min(s) s, max(e) e from (select *, sum(n) over (partition by g order by s, e) k from f) group by g, k), q as (select *, s - lag(e) over (partition by g order by s) silence from r), b as (select distinct user_id g, hour * 3600000000 st, 3600000000 * (1 + hour % 3) d from EVENTS), a as (select q.*, b.d from q asof left join b on q.g = b.g and q.s >= b.st)
select g, s as start, silence, case when silence is null then 'entrance' else 'restart_after_silence' end kind from a where silence is null or silence >= d""")
def score_entrances(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    spans = e.select(F.col("user_id").alias("g"), F.col("t").alias("s"), (F.col("t") + F.floor(F.col("value") * 6e7)).alias("e"))
    regions = islands.merge_intervals(spans, ["g"], "s", "e")
    bars = e.select(F.col("user_id").alias("g"), (F.col("hour") * HOUR_US).alias("start"), (F.lit(HOUR_US) * (1 + F.col("hour") % 3)).alias("duration")).distinct()
    return islands.entrances(regions, bars, ["g"]).select("g", "start", "silence", "kind")


_EDGES = "e as (select role, row_number() over (partition by role order by t, event_id) i, 1::double + (value - 5::double) / 50::double s from EVENTS), n as (select role, i first_edge, lead(i) over w second_edge, s a, lead(s) over w b from e window w as (partition by role order by i)), c as (select * from n where (a - 1::double) * (b - 1::double) < 0 and abs(a - 1::double) >= 0.06::double and abs(b - 1::double) >= 0.06::double)"


@query(f"""with {_EDGES}, f as (select *, case when first_edge <= lag(second_edge) over (partition by role order by first_edge) then 0 else 1 end st from c), g as (select *, sum(st) over (partition by role order by first_edge) k from f) select role, min(first_edge) first_edge, max(second_edge) last_edge, count(*) pairs from g group by role, k""")
def correction_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = Window.partitionBy("role").orderBy("t", "event_id")
    edges = events(spark, sf_dir).select("role", F.row_number().over(by).cast("long").alias("i"), (1.0 + (F.col("value") - 5) / 50).alias("s"))
    return islands.episodes(islands.catch_ups(edges, ["role"], "i", "s"), ["role"]).select("role", "first_edge", "last_edge", "pairs")


@query("""with f as (select event_id, user_id, coalesce(sum(case when event_id % 5 = 0 then 1 else 0 end) over (partition by user_id order by t, event_id rows between unbounded preceding and 1 preceding), 0) fragment from EVENTS) select event_id, cast(fragment as bigint) fragment, count(*) over (partition by user_id, fragment) < 2 as short from f""")
def region_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).withColumn("o", F.struct("t", "event_id")).withColumn("ok", F.col("event_id") % 5 != 0)
    return islands.fragments(rows, ["user_id"], "o", "ok").select("event_id", F.col("fragment").cast("long").alias("fragment"), "short")


@query("""with recursive o as (select user_id, t, row_number() over (partition by user_id order by t) r, count(*) over (partition by user_id) n from (select distinct user_id, t from EVENTS)), f as (select user_id, t, r, n, t kept from o where r = 1 union all select o.user_id, o.t, o.r, o.n, case when o.t - f.kept >= 10800000000 then o.t else f.kept end from f join o on o.user_id = f.user_id and o.r = f.r + 1)
select user_id, t from f where t = kept or r = n""")
def spaced_controls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return islands.spaced(events(spark, sf_dir).select("user_id", "t"), ["user_id"], "t", 10_800_000_000).select("user_id", "t")


@query("""with s as (select role, hour, min(t)::double a, max(t)::double z from EVENTS group by all) select distinct role, cast(unnest([a, (a + z) / 2::double, z]) as bigint) as time from s""")
def support_knots(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = events(spark, sf_dir).groupBy("role", "hour").agg(F.min("t").cast("double").alias("a"), F.max("t").cast("double").alias("z"))
    return islands.knots(spans, ["role"], "a", "z").select("role", F.rint("time").cast("long").alias("time"))


@query("""with b as (select distinct user_id % 5 g, hour measure, hour * 3600::double s, (hour + 1) * 3600::double e from EVENTS), o as (select user_id % 5 g, role, t::double / 1000000::double t from EVENTS), m as (select b.g, measure, role, min(t) t from b join o on o.g = b.g and o.t >= b.s - 0.000001::double and o.t < b.s + 0.4::double * (b.e - b.s) group by all),
f as (select g, measure, min(t) e from m group by all), r as (select f.g, f.measure, f.e, array_to_string(list_sort(list(role)), ' ') roles from f join m on m.g = f.g and m.measure = f.measure and abs(m.t - f.e) <= 600 group by all)
select b.g, b.measure, cast(floor(coalesce(r.e, b.s) * 1000::double + 0.5::double) as bigint) landmark, coalesce(r.roles, '') roles, case when r.e is null then 'bar_boundary' else 'first_event' end kind from b left join r using (g, measure)""")
def bar_landmarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumn("g", F.col("user_id") % 5)
    bars = e.select("g", F.col("hour").alias("measure")).distinct().withColumn("start", F.col("measure") * 3600.0).withColumn("end", (F.col("measure") + 1) * 3600.0)
    got = islands.landmarks(e.select("g", "role", (F.col("t") / 1e6).alias("t")), bars, ["g"], "role", "t", near=600.0)
    return got.select("g", "measure", scaled("landmark").alias("landmark"), F.array_join("roles", " ").alias("roles"), "kind")


@query("""with c as (select role, user_id, t, case when t - lag(t) over w <= 1200000000 then 0 else 1 end s from EVENTS window w as (partition by user_id % 20 order by t, role)), n as (select *, user_id % 20 g, sum(s) over (partition by user_id % 20 order by t, role) k from c)
select g, cast(k as bigint) group_no, cast(floor(median(t)) as bigint) as time, array_to_string(list_sort(list_distinct(list(role))), ' ') sources, count(*) n from n group by g, k""")
def score_match_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).withColumn("g", F.col("user_id") % 20)
    got = fusion.score_clusters(rows, ["g"], "t", "role", 1_200_000_000)
    return got.select("g", "group_no", F.floor("time").alias("time"), F.array_join("sources", " ").alias("sources"), "n")


_OBS = "o as (select hour g, (t % 3600000000)::double / 1000000::double as time, role source, case when event_id % 3 = 0 then role else 'full' end evidence, value / (value + 10::double) confidence, (t % 1000)::double / 250::double - 2::double residual, event_id % 7 = 0 single from EVENTS)"


@query(f"""with {_OBS}, c as (select *, case when time - lag(time) over (partition by g order by time, source) <= 400::double then 0 else 1 end s from o), n as (select *, sum(s) over (partition by g order by time, source) k from c), u as (select *, row_number() over (partition by g, k, source order by confidence desc, time) r from n),
m as (select g, k, median(time) audio_time, sum(confidence) / count(*) confidence, median(residual) residual, count(*) n_sources, count(*) filter (evidence = source) own, bool_or(single) single from u where r = 1 group by g, k),
e as (select *, confidence + own::double * 0.18::double + least(0.24::double, (n_sources - 1)::double * 0.08::double) + case when single then 0.12::double else 0::double end - abs(residual) / 6::double * 0.15::double emission from m)
select g, row_number() over (partition by g order by emission desc, abs(residual), audio_time) as rank, {sql_scaled("audio_time", 1000)} audio_time, {sql_scaled("emission", 1000)} emission, n_sources, single from e qualify row_number() over (partition by g order by emission desc, abs(residual), audio_time) <= 8""")
def candidate_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = fusion.candidate_states(_observations(spark, sf_dir), ["g"], 6.0, 400.0)
    return got.select("g", F.col("rank").cast("long").alias("rank"), scaled("audio_time").alias("audio_time"), scaled("emission").alias("emission"), "n_sources", "single")


def _observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    within = (F.col("t") % HOUR_US).cast("double") / 1e6
    return events(spark, sf_dir).select(F.col("hour").alias("g"), within.alias("time"), F.col("role").alias("source"), F.when(F.col("event_id") % 3 == 0, F.col("role")).otherwise("full").alias("evidence"), (F.col("value") / (F.col("value") + 10)).alias("confidence"), ((F.col("t") % 1000) / 250 - 2).alias("residual"), (F.col("event_id") % 7 == 0).alias("single"))


@query(f"""with {_OBS}, c as (select *, case when time - lag(time) over (partition by g order by time, source) <= 400::double then 0 else 1 end s from o), n as (select *, sum(s) over (partition by g order by time, source) k from c), u as (select *, row_number() over (partition by g, k, source order by confidence desc, time) r from n),
m as (select g, k, sum(time * confidence) / sum(confidence) fused, max(time) - min(time) spread, count(*) role_count, sum(confidence) / count(*) w, bool_or(single) strong from u where r = 1 group by g, k)
select g, cast(k as bigint) group_no, {sql_scaled("fused", 100)} fused_time, role_count, case when role_count >= 2 and spread <= 0.1::double then 'multi_role_corroborated' when role_count >= 2 then 'multi_role_compatible' when strong then 'single_role_strong' else 'single_role_provisional' end classification,
{sql_scaled("w + (role_count - 1)::double * 0.3::double - case when role_count >= 2 then 0::double else 0.1::double end - spread * 1.2::double", 100)} confidence from m""")
def fused_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = fusion.fused_predictions(_observations(spark, sf_dir).withColumnRenamed("single", "strong"), ["g"], "time", "source", "confidence", 400.0)
    return got.select("g", "group_no", scaled("fused_time", 100).alias("fused_time"), "role_count", "classification", scaled("confidence", 100).alias("confidence"))


@query(f"""with {_OBS}, c as (select *, case when time - lag(time) over (partition by g order by time, confidence) <= 400::double then 0 else 1 end s from o), n as (select *, sum(s) over (partition by g order by time, confidence) k from c), u as (select *, row_number() over (partition by g, k order by confidence desc, time) r from n)
select g, {sql_scaled("time", 1000)} as time, row_number() over (partition by g order by confidence desc, time) as rank from u where r = 1""")
def distinct_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = fusion.distinct_locations(_observations(spark, sf_dir), ["g"], "time", "confidence", 400.0)
    return got.select("g", scaled("time").alias("time"), F.col("rank").cast("long").alias("rank"))


_REC = "r as (select hour measure, t // 400000000 % 9 as cluster, role, (t % 70000)::double / 1000::double res, cast(floor(value * 100::double) as bigint) + 1 w, value / (value + 2::double) c, event_id % 3 = 0 sel, event_id % 4 = 0 acc from EVENTS)"
_SCORE = f"""{_REC}, a as (select measure, cluster, res v, sum(w) w from r group by all), b as (select *, sum(w) over (partition by measure, cluster order by v) run, sum(w) over (partition by measure, cluster) al from a), m as (select measure, cluster, min(v) residual_ms from b where run * 2 >= al group by all),
a2 as (select measure, cluster, c v, sum(w) w from r group by all), b2 as (select *, sum(w) over (partition by measure, cluster order by v) run, sum(w) over (partition by measure, cluster) al from a2), m2 as (select measure, cluster, min(v) confidence from b2 where run * 2 >= al group by all),
md as (select measure, cluster, median(res) med from r group by all), d as (select measure, cluster, median(abs(res - med)) disp from r join md using (measure, cluster) group by all), k as (select measure, cluster, count(distinct role) role_count, count(*) filter (sel) path_selected_count, count(*) filter (acc) accepted_count from r group by all),
s as (select k.*, residual_ms, confidence, disp, greatest(0::double, least(1::double, confidence + least(0.3::double, (role_count - 1)::double * 0.12::double) + least(0.15::double, path_selected_count::double * 0.05::double) - least(0.35::double, disp / 200::double))) fs from k join m using (measure, cluster) join m2 using (measure, cluster) join d using (measure, cluster))"""


def _hypotheses(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select(F.col("hour").alias("measure"), (F.expr("t div 400000000") % 9).alias("cluster"), "role", ((F.col("t") % 70_000).cast("double") / 1000).alias("res"), (F.floor(F.col("value") * 100) + 1).alias("w"), (F.col("value") / (F.col("value") + 2)).alias("c"), (F.col("event_id") % 3 == 0).alias("sel"), (F.col("event_id") % 4 == 0).alias("acc"))
    return fusion.score_residual_clusters(rows, ["measure"], "role", "res", "w", "c", "sel", "acc")


@query(f"""with {_SCORE} select measure, cluster, role_count, path_selected_count, accepted_count, {sql_scaled("residual_ms", 1000)} residual_ms, {sql_scaled("fs", 100000)} fusion_score from s""")
def cluster_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hypotheses(spark, sf_dir).select("measure", "cluster", "role_count", "path_selected_count", "accepted_count", scaled("residual_ms").alias("residual_ms"), scaled("fusion_score", 100_000).alias("fusion_score"))


_BEST = f"""{_SCORE}, o as (select *, count(*) over (partition by measure) - 1 as alternatives, row_number() over (partition by measure order by fs desc, role_count desc, path_selected_count desc, cluster) rn from s),
h as (select measure, residual_ms, alternatives, case when role_count >= 2 and fs >= 0.52::double then 'multi_role_consensus' when role_count = 1 and fs >= 0.88::double and disp <= 55::double and path_selected_count >= 1 then 'exceptional_single_role' else 'unresolved' end route from o where rn = 1)"""


@query(f"""with {_BEST}, p as (select x.measure, count(*) n from h x join h y on y.measure between x.measure - 2 and x.measure + 2 and y.measure <> x.measure and abs(x.residual_ms - y.residual_ms) <= 20::double where x.route <> 'unresolved' and y.route <> 'unresolved' group by x.measure)
select measure, alternatives, case when route <> 'unresolved' then coalesce(n, 0) end support, case when route = 'exceptional_single_role' and coalesce(n, 0) < 2 then 'unresolved_single_role_without_neighbours' else route end route, route <> 'unresolved' and not (route = 'exceptional_single_role' and coalesce(n, 0) < 2) accepted from h left join p using (measure)""")
def regional_hypotheses(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = fusion.best_hypothesis(_hypotheses(spark, sf_dir), ["measure"]).withColumn("song", F.lit(0))
    got = fusion.neighbour_support(best, ["song"], "measure", "residual_ms", near=20.0)
    return got.select("measure", F.col("alternatives").cast("long").alias("alternatives"), "support", "route", "accepted")


@query("""with r as (select role, hour measure, min(t % 3600000000)::double / 10000000::double res from EVENTS group by all), x as (select *, (lag(measure) over w = measure - 1 and abs(lag(res) over w - res) <= 90::double) p, (lead(measure) over w = measure + 1 and abs(lead(res) over w - res) <= 90::double) q from r window w as (partition by role order by measure)),
c as (select a.role, a.measure, array_to_string(list_sort(list(b.role)), ' ') s from r a join r b on a.measure = b.measure and a.role <> b.role and abs(a.res - b.res) <= 70::double group by all) select x.role, x.measure, coalesce(p, false) or coalesce(q, false) supported, coalesce(s, '') supporting from x left join c using (role, measure)""")
def role_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).groupBy("role", F.col("hour").alias("measure")).agg((F.min(F.col("t") % HOUR_US).cast("double") / 1e7).alias("res")).withColumn("song", F.lit(0))
    one = fusion.adjacent_support(rows, ["role"], "measure", "res")
    return fusion.cross_role_support(one, ["song"], "role", "measure", "res").select("role", "measure", "supported", F.array_join("supporting_roles", " ").alias("supporting"))


@query(f"""with w as (select user_id % 6 family, hour // 40 * 40 s, hour // 40 * 40 + 8 e, cast(user_id % 9 - 4 as int) shift, value / 100::double score from EVENTS), o as (select *, row_number() over (partition by family order by score desc) r from w), m as (select family, min(s) a, max(e) z, cast(round_even(median(shift), 0) as int) sh, count(*) n, max(score) b, coalesce(max(score) filter (r = 2), 0::double) sec from o group by family),
v as (select x.family, max(y.b) rival from m x join m y on x.family <> y.family and abs(x.sh - y.sh) > 1 and least(x.z, y.z) - greatest(x.a, y.a) + 1 >= 0.5::double * (least(x.z - x.a, y.z - y.a) + 1) group by x.family)
select family, a as first, z as last, sh as shift, n as windows, {sql_scaled("b", 1000000)} best, {sql_scaled("sec", 1000000)} as second, case when rival is null then 'uniqueness_not_established' when b - rival >= 0.04::double then 'locally_distinctive' else 'ambiguous_repeated_occurrence' end uniqueness from m left join v using (family)""")
def shift_family_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.expr("hour div 40 * 40")
    rows = events(spark, sf_dir).select((F.col("user_id") % 6).alias("family"), at.alias("s"), (at + 8).alias("e"), (F.col("user_id") % 9 - 4).cast("int").alias("shift"), (F.col("value") / 100).alias("score")).withColumn("song", F.lit(0))
    got = fusion.describe_families(rows, ["song"], "s", "e", "shift", "score")
    return got.select("family", "first", "last", "shift", "windows", scaled("best", 10**6).alias("best"), scaled("second", 10**6).alias("second"), "uniqueness")


@query(f"""with m as (select hour // 12 w, role, hour measure, max(value / 100::double) c from EVENTS where event_id % 4 <> 0 group by all), s as (select w, role, count(*) n, median(c) sc, min(c) mn from m group by all), v as (select * from s where n >= 2), k as (select w, median(sc) combined, median(sc - 0.05::double) improvement, count(*) n from v group by w), a as (select distinct hour // 12 w from EVENTS)
select a.w, {sql_scaled("combined", 1000000)} combined, coalesce(k.n, 0)::bigint effective, case when k.n is null then 'insufficient_valid_source_count' when combined < 0.1::double then 'below_absolute_match_score' when improvement < 0.08::double then 'below_baseline_improvement' when k.n < 1.65::double then 'insufficient_effective_independence' end reason from a left join k using (w)""")
def combined_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select(F.expr("hour div 12").alias("w"), "role", F.col("hour").alias("measure"), (F.col("value") / 100).alias("c"), (F.col("event_id") % 4 != 0).alias("ok"))
    scores = fusion.window_scores(rows, ["w", "role"], "c", "ok").withColumn("baseline_score", F.lit(0.05))
    got = fusion.combine_sources(scores, ["w"], "role", least=0.1)
    return got.select("w", scaled("combined", 10**6).alias("combined"), F.rint("effective").cast("long").alias("effective"), "reason")


@query("""with c as (select user_id % 10 g, hour // 24 region, min(t) / 1000000::double as time, first(role order by t, event_id) role, max(value) / 20::double confidence from EVENTS group by all), n as (select *, coalesce((lag(time) over w + time) / 2::double, time - 1.5::double) l, coalesce((lead(time) over w + time) / 2::double, time + 1.5::double) h from c window w as (partition by g order by time)),
s as (select user_id % 10 g, role r, t / 1000000::double a, t / 1000000::double + value z from EVENTS where event_id % 6 = 1), x as (select n.g, n.time, list_sort(list_distinct(list(s.r))) e from n join s on s.g = n.g and s.a <= n.h and s.z >= n.l group by all), y as (select n.*, coalesce(e, []) e from n left join x on x.g = n.g and x.time = n.time)
select g, region, array_to_string(e, ' ') expected, list_contains(e, role) supported, len(e) = 1 and list_contains(e, role) and confidence >= 0.6::double promoted from y""")
def solo_authority(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumn("g", F.col("user_id") % 10).withColumn("all", F.lit(0))
    controls = e.groupBy("g", F.expr("hour div 24").alias("region"), "all").agg((F.min("t") / 1e6).alias("time"), F.array(F.min_by("role", F.struct("t", "event_id"))).alias("roles"), (F.max("value") / 20).alias("confidence")).withColumn("classification", F.lit("single_role_provisional"))
    sounds = e.where("event_id % 6 = 1").select("g", "role", (F.col("t") / 1e6).alias("a"), (F.col("t") / 1e6 + F.col("value")).alias("z"))
    got = fusion.solo_authority(controls, sounds, ["g"], "all", "time", "role", ("a", "z"))
    return got.select("g", "region", F.array_join("expected_roles", " ").alias("expected"), (F.size("supporting_roles") > 0).alias("supported"), "promoted")


@query("""with r as (select user_id g, min(t)::double / 1000000::double cs, max(t)::double / 1000000::double ce, min(t)::double / 1000000::double + user_id % 12 ms, max(t)::double / 1000000::double + user_id % 7 me, count(*) % 4 solo from EVENTS group by user_id), f as (select min(cs) o from r)
select g, cast(ms - cs as bigint) as off, coalesce(cs <= o + 200000 + 3::double and solo >= 2 and abs(ms - cs) <= 12::double and case when ce > cs then (me - ms) / (ce - cs) end between 0.7::double and 1.3::double, false) root from r, f""")
def root_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("t").cast("double") / 1e6
    r = events(spark, sf_dir).groupBy(F.col("user_id").alias("g")).agg(F.min(at).alias("chart_start"), F.max(at).alias("chart_end"), (F.count("*") % 4).alias("solo_count"))
    r = r.withColumn("midi_start", F.col("chart_start") + F.col("g") % 12).withColumn("midi_end", F.col("chart_end") + F.col("g") % 7)
    first = r.agg(F.min("chart_start").alias("o"))
    got = fusion.root_validation(r.join(F.broadcast(first)), F.col("o") + 200_000)  # one row
    return got.select("g", F.col("offset").cast("long").alias("off"), "root")


@query(f"""with c as (select event_id, user_id % 15 g, t::double / 1000000::double cs, t::double / 1000000::double + 60::double * value ce, value / 100::double score from EVENTS where role = 'view'), o as (select user_id % 15 g, t::double / 1000000::double ch, t::double / 1000000::double + (t % 10)::double / 15::double mi from EVENTS where role = 'click'),
e as (select c.event_id, max(abs(case when ce > cs then cs + 0.1::double + (ch - cs) * ((ce + 0.2::double) - (cs + 0.1::double)) / (ce - cs) else cs + 0.1::double end - mi)) err from c join o on o.g = c.g and ch >= cs - 0.000000001::double and ch <= ce + 0.000000001::double group by c.event_id)
select c.event_id, {sql_scaled("score + case when err <= 0.35::double then (1::double - err / 0.35::double) * 0.22::double when err > 0.35::double then -least(0.1::double, (err / 0.35::double - 1::double) * 0.1::double) else 0::double end", 10000)} score, case when err <= 0.35::double then 'phrase_ordinal_compatible' when err > 0.35::double then 'phrase_ordinal_incompatible' end support from c left join e using (event_id)""")
def rooted_rescoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("t").cast("double") / 1e6
    e = events(spark, sf_dir).withColumn("g", F.col("user_id") % 15)
    c = e.where("role = 'view'").select("event_id", "g", at.alias("chart_start"), (at + F.col("value") * 60.0).alias("chart_end"), (F.col("value") / 100).alias("score"))
    c = c.withColumn("midi_start", F.col("chart_start") + 0.1).withColumn("midi_end", F.col("chart_end") + 0.2)
    o = e.where("role = 'click'").select("g", at.alias("chart"), (at + (F.col("t") % 10).cast("double") / 15).alias("midi"))
    return fusion.rescore_rooted(c, o, ["g"], "event_id", width=3600.0).select("event_id", scaled("score", 10_000).alias("score"), "support")
