"""Queries of ties, phrases, sung text, proposals and layered maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from timeloom.functions import robust, vectors
from timeloom.operators import evidence, gates, joins, maps, phrases, vocals
from timeloom.plans.judging import _openings
from timeloom.plans.registry import query, scaled, sql_scaled
from timeloom.sources import scores
from timeloom.sources.tables import HOUR_US, events, micros, table

_DAY = "epoch_us(o_orderdate) // 86400000000"


@query(f"""with recursive o as (select o_custkey g, o_orderkey id, {_DAY} t, {_DAY} + o_orderkey % 400 z, case when o_orderkey % 3 <> 0 then lead(o_orderkey) over (partition by o_custkey order by {_DAY}, o_orderkey) end tie from orders),
w as (select g, id, id cur, z, tie from o union all select w.g, w.id, o.id, greatest(w.z, o.z), o.tie from w join o on o.g = w.g and o.id = w.tie) select id, max(z) resolved_end from w group by id""")
def tie_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.expr(f"{micros('o_orderdate')} div 86400000000")
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("g"), F.col("o_orderkey").alias("id"), day.alias("t")).withColumn("z", F.col("t") + F.col("id") % 400)
    after = F.lead("id").over(Window.partitionBy("g").orderBy("t", "id"))
    linked = rows.withColumn("tie", F.when(F.col("id") % 3 != 0, after))
    return scores.resolve_ties(linked, ["g"], "id", "t", "z", "tie").select("id", "resolved_end")


@query("""with d as (select user_id % 40 g, hour // 24 as day, t::double as time, array_agg(distinct user_id % 50) s from EVENTS group by all), l as (select g, day, list({'t': time, 's': s} order by time) x from d group by all), f as (select g, day, x, unnest(range(0, len(x) - 4, 3)) s from l where len(x) >= 5), p as (select g, day, s // 3 as phrase, x[s + 1:s + 10] w from f)
select g, day, phrase, cast(w[1].t as bigint) as start, cast(w[-1].t as bigint) as stop, len(w) n from p""")
def phrase_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = events(spark, sf_dir).groupBy((F.col("user_id") % 40).alias("g"), F.expr("hour div 24").alias("day"), F.col("t").cast("double").alias("time")).agg(F.collect_set((F.col("user_id") % 50).cast("int")).alias("symbols"))
    got = phrases.phrase_windows(groups, ["g", "day"])
    return got.select("g", "day", F.col("phrase").cast("long").alias("phrase"), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("stop"), F.size("groups").cast("long").alias("n"))


@query(f"""with p as (select user_id g, t::double / 1000000::double x, t::double / 1000000::double * 1.01::double + (event_id % 5)::double / 30::double y from EVENTS), c as (select *, case when x - lag(x) over (partition by g order by x, y) <= 40000::double then 0 else 1 end s from p), n as (select *, sum(s) over (partition by g order by x, y) k from c),
z as (select g, k, count(*) n, min(x) a, max(x) b from n group by g, k having count(*) >= 3 and max(x) - min(x) >= 1), s as (select a.g, a.k, median((b.y - a.y) / (b.x - a.x)) m from n a join n b on a.g = b.g and a.k = b.k and b.x - a.x >= 0.25::double group by all), i as (select n.g, n.k, any_value(m) m, median(y - m * x) c from n join s using (g, k) group by n.g, n.k),
r as (select n.g, n.k, median(abs(y - (c + m * x))) md, max(abs(y - (c + m * x))) mx from n join i using (g, k) group by n.g, n.k) select z.g, cast(z.k as bigint) group_no, n, {sql_scaled("m", 100000)} slope, m between 0.9::double and 1.1::double and md <= 0.12::double and mx <= 0.35::double trusted from z join i using (g, k) join r using (g, k)""")
def trusted_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.col("t").cast("double") / 1e6
    path = events(spark, sf_dir).select(F.col("user_id").alias("g"), x.alias("x"), (x * 1.01 + F.col("event_id") % 5 / 30).alias("y"))
    got = phrases.trusted_segments(path, ["g"], "x", "y", gap=40_000.0)
    return got.select("g", "group_no", "n", scaled("slope", 10**5).alias("slope"), "trusted")


@query("""with w as (select conv_id, turn, list_filter(string_split(trim(regexp_replace(regexp_replace(coalesce(text, ''), '-+(\\S)', '- \\1', 'g'), '\\s+', ' ', 'g')), ' '), lambda x: x <> '') s from conversations) select conv_id, turn, len(s) n, len(list_filter(s, lambda x: regexp_matches(x, '^_+$'))) carried, len(list_filter(s, lambda x: x like '%-')) hyphened from w""")
def lyric_syllables(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", vocals.lyric_tokens(F.col("text")).alias("s"))
    return rows.select("conv_id", "turn", F.size("s").cast("long").alias("n"), F.size(F.filter("s", lambda x: x == "+")).cast("long").alias("carried"), F.size(F.filter("s", lambda x: x.endswith("-"))).cast("long").alias("hyphened"))


@query("""with w as (select user_id % 30 g, hour * 3600::double t, 3000::double d, 'w' || hour w, row_number() over (partition by user_id % 30 order by hour) k from (select distinct user_id % 30 user_id, hour from EVENTS where role = 'view')), n as (select user_id % 30 g, t::double / 1000000::double t, value * 10::double d, cast(user_id % 60 as int) midi, row_number() over (partition by user_id % 30 order by t, value, user_id % 60) i from EVENTS where role = 'click'),
m as (select n.g, n.i, min(w.k) k from n join w on w.g = n.g and n.t + n.d / 2::double >= w.t and n.t + n.d / 2::double < w.t + w.d group by all), s as (select m.g, n.t, case when row_number() over (partition by m.g, m.k order by n.t, m.i) = 1 then w.w else '+' end w, n.midi from m join n on n.g = m.g and n.i = m.i join w on w.g = m.g and w.k = m.k)
select g, cast(t as bigint) as time, w, midi from s union all select w.g, cast(w.t as bigint), w.w, null from w where not exists (select 1 from m where m.g = w.g and m.k = w.k)""")
def word_continuations(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumn("g", F.col("user_id") % 30)
    words = e.where("role = 'view'").select("g", (F.col("hour") * 3600.0).alias("t"), F.lit(3000.0).alias("d"), F.concat(F.lit("w"), "hour").alias("w")).distinct()
    notes = e.where("role = 'click'").select("g", (F.col("t").cast("double") / 1e6).alias("t"), (F.col("value") * 10).alias("d"), (F.col("user_id") % 60).cast("int").alias("midi"))
    return vocals.with_continuations(words, notes, ["g"]).select("g", F.rint("t").cast("long").alias("time"), "w", "midi")


@query(f"""with r as (select user_id % 40 g, t::double / 1000000::double x, value + (event_id % 10)::double y from EVENTS), s as (select a.g, median((b.y - a.y) / (b.x - a.x)) m from r a join r b on a.g = b.g and b.x > a.x group by a.g), i as (select r.g, any_value(m) m, median(y - m * x) c, count(*) n from r join s using (g) group by r.g), d as (select r.g, median(abs(y - (c + m * x))) md from r join i using (g) group by r.g)
select g, n, {sql_scaled("m * 1000000::double", 1000)} slope, {sql_scaled("md", 1000)} median_residual from i join d using (g)""")
def robust_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select((F.col("user_id") % 40).alias("g"), (F.col("t").cast("double") / 1e6).alias("x"), (F.col("value") + F.col("event_id") % 10).alias("y"))
    got = robust.theil_sen_line(rows, ["g"], "x", "y")
    return got.select("g", "n", scaled(F.col("slope") * 1e6).alias("slope"), scaled("median_residual").alias("median_residual"))


@query(f"""with b as (select distinct user_id % 6 g, hour m, hour * 3600::double x from EVENTS), e as (select g, min(x) x, min(x) + 1::double y from b group by g union all select g, max(x), max(x) + 1::double from b group by g), a as (select user_id % 6 g, hour * 3600::double x, hour * 3600::double + (user_id % 50)::double y, cast(event_id as varchar) id from EVENTS where event_id % 40 = 5),
u as (select g, x, y, 1 p, 'baseline' kind from e union all select g, x, y, 0, id from a), k as (select g, x, arg_min({{'y': y, 'k': kind}}, {{'p': p, 'k': kind}}) b from u group by all), l as (select g, x, b.y y, b.k kind, b.y > lag(b.y) over (partition by g order by x) r from k)
select g, {sql_scaled("x", 1)} x, {sql_scaled("y", 1)} y, kind, bool_and(coalesce(r, true)) over (partition by g) monotonic from l""")
def exact_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumn("g", F.col("user_id") % 6).withColumn("x", F.col("hour") * 3600.0)
    ends = e.groupBy("g").agg(F.min("x").alias("a"), F.max("x").alias("z")).select("g", F.explode(F.array("a", "z")).alias("x")).withColumn("y", F.col("x") + 1.0)
    manual = e.where("event_id % 40 = 5").select("g", "x", (F.col("x") + F.col("user_id") % 50).alias("y"), F.col("event_id").alias("id"))
    return maps.exact_layer(ends, manual, ["g"]).select("g", scaled("x", 1).alias("x"), scaled("y", 1).alias("y"), "kind", "monotonic")


@query(f"""with a as (select event_id id, hour // 24 as day, case when event_id % 3 <> 0 then hour end bar, event_id % 5 sb, (1 + event_id % 6)::double beat, (event_id % 4)::double / 4::double fr, (t // 1000000)::double tm, case when event_id % 7 = 0 then 'padded' else 'original' end basis from EVENTS where event_id % 4 = 1),
b as (select hour // 24 as day, hour m, hour % 5 sb, min(t) // 1000000 t, 4 n from EVENTS group by hour), c as (select *, lead(t) over (partition by day order by m) e from b), j as (select a.*, c.m, c.t bt, c.n ts, c.e from a left join c on a.day = c.day and (a.bar = c.m or (a.bar is null and a.sb = c.sb))),
k as (select id, day, beat, fr, tm, basis, count(m) k, any_value(bt) bt, any_value(e) e from j group by all), r as (select *, beat - 1::double + fr pl from k)
select id, concat_ws(',', case when k <> 1 then 'not_one_bar' end, case when pl < 0 or pl >= 4 then 'beat_outside_meter' end, case when pl <> 0 and e is null then 'final_bar_without_end' end) reasons from r where k = 1""")
def manual_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    i, day = F.col("event_id"), F.expr("hour div 24").alias("day")
    anchors = e.where("event_id % 4 = 1").select(i.alias("id"), day, F.when(i % 3 != 0, F.col("hour")).alias("playback_bar"), (i % 5).alias("source_bar"), F.lit(None).cast("long").alias("occurrence"), (i % 6 + 1).cast("double").alias("beat"), (i % 4 / 4).alias("beat_fraction"), F.expr("t div 1000000").cast("double").alias("time"), F.when(i % 7 == 0, "padded").otherwise("original").alias("basis"))
    bars = e.groupBy(day, F.col("hour").alias("measure")).agg(F.expr("min(t) div 1000000").alias("t_gp")).withColumn("source_bar", F.col("measure") % 5).withColumn("occurrence", F.lit(1)).withColumn("ts_num", F.lit(4)).withColumn("end", F.lit(None).cast("long"))
    got = maps.resolve_manual(anchors, bars, ["day"])
    return got.where("bars = 1").select("id", F.array_join("reasons", ",").alias("reasons"))


@query(f"""with c as (select user_id % 10 g, hour * 3600::double x, max(hour * 3600::double + (user_id % 7)::double * 400::double) y from EVENTS where event_id % 30 = 0 group by all), p as (select *, lead(x) over w x2, lead(y) over w y2 from c window w as (partition by g order by x)), f as (select g, min(x) fx, arg_min(y, x) fy from c group by g),
r as (select user_id % 10 g, t::double / 1000000::double t, 60::double + value bpm from EVENTS where event_id % 5 = 0), m as (select r.*, case when f.fx is null then t when p.x is null then f.fy + (t - f.fx) when p.x2 is null then p.y + (t - p.x) else p.y + (t - p.x) * (p.y2 - p.y) / (p.x2 - p.x) end n from r asof left join p on r.g = p.g and r.t >= p.x left join f on f.g = r.g),
q as (select *, (lead(n) over w - n) / (lead(t) over w - t) ra from m window w as (partition by g order by t)), s as (select *, case when ra > 0 then ra end ga from q), u as (select *, coalesce(ga, last_value(ga ignore nulls) over (partition by g order by t rows between unbounded preceding and 1 preceding), 1::double) rt from s)
select g, {sql_scaled("n", 10)} as time, {sql_scaled("bpm / rt", 100)} bpm from u""")
def retimed_tempos(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumn("g", F.col("user_id") % 10)
    x = F.col("hour") * 3600.0
    controls = e.where("event_id % 30 = 0").select("g", x.alias("x"), (x + (F.col("user_id") % 7) * 400.0).alias("y"))
    rows = e.where("event_id % 5 = 0").select("g", (F.col("t").cast("double") / 1e6).alias("t"), (F.col("value") + 60.0).alias("bpm"))
    got = maps.rewrite_tempos(rows, controls, ["g"], "t", "bpm")
    return got.select("g", scaled("t", 10).alias("time"), scaled("bpm", 100).alias("bpm"))


@query("""with a as (select o_custkey % 300 k, list({'p': (o_orderkey % 50)::double, 's': o_orderpriority} order by o_orderkey) x from orders where o_orderkey % 7 = 1 group by 1), b as (select o_custkey % 450 k, list({'p': (o_orderkey % 50)::double, 's': o_orderpriority} order by o_orderkey) x from orders where o_orderkey % 7 = 2 group by 1),
j as (select coalesce(a.k, b.k) k, a.x is not null l, b.x is not null r, unnest(list_transform(list_concat(coalesce(a.x, []), coalesce(b.x, [])), lambda e, i: {'p': e.p, 's': e.s, 'i': i})) e from a full join b on a.k = b.k), d as (select k, l, r, e.s s, e.p p, min(e.i) i from j group by all)
select k, any_value(l) in_left, any_value(r) in_right, count(*) n, cast(sum(p) as bigint) total from d group by k""")
def merged_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    item = F.struct((F.col("o_orderkey") % 50).cast("double").alias("p"), F.col("o_orderpriority").alias("s"))
    side = lambda rest, mod: o.where(f"o_orderkey % 7 = {rest}").groupBy((F.col("o_custkey") % mod).alias("k")).agg(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", item.alias("x")))), lambda z: z["x"]).alias("x"))
    got = joins.full_merge(side(1, 300), side(2, 450), ["k"], "x", "p", "s", 0.0)
    return got.select("k", "in_left", "in_right", F.size("x").cast("long").alias("n"), vectors.total(F.transform("x", lambda e: e["p"])).cast("long").alias("total"))


@query(f"""with s as (select hour // 24 g, role source, case when count(*) % 7 <> 3 then min(t)::double / 1000000::double end as first, count(*) % 9 n, (hour // 24) * 86400::double ss, (hour // 24) * 86400::double + 1::double cs, case when count(*) % 5 <> 1 then (hour // 24) * 86400::double + (count(*) % 8)::double end heard, count(*) % 6 <> 2 has_audio, count(*) pr from EVENTS group by hour // 24, role),
e as (select *, coalesce(abs(first - min(first) over (partition by g)) <= 500::double, false) er, first - ss delay from s), k as (select *, first is not null and not (n < case when er then 1 else 4 end) and not (delay < -0.025::double or delay > 9000::double) and er and has_audio and heard is not null and abs(heard - cs) <= 4::double ok from e),
c as (select *, coalesce(ok and abs(first - min(first) filter (ok) over (partition by g)) <= 500::double, false) i from k), a as (select g, count(*) filter (i) n, max(heard) filter (i) - min(heard) filter (i) sp, median(heard) filter (i) ma, median(first) filter (i) ms, min(first) fs, any_value(ss) ss, any_value(cs) cs, arg_min({{'h': heard, 'f': first}}, {{'d': abs(heard - cs), 'p': pr}}) filter (i) b from c group by g)
select g, {sql_scaled("case when n = 0 then coalesce(fs, ss) when n > 1 and sp <= 0.25::double then ms else b.f end", 1000)} score_anchor, {sql_scaled("case when n = 0 then cs when n > 1 and sp <= 0.25::double then ma else b.h end", 1000)} audio_anchor, case when n = 0 then 'fallback_content_start' when n > 1 and sp <= 0.25::double then 'fused_early_anchors' else 'selected_early_anchor' end as status from a""")
def opening_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    gated = gates.opening_gates(_openings(spark, sf_dir), ["g"], latest=9000.0, together=500.0)
    got = gates.choose_opening(gated, ["g"], together=500.0)
    return got.select("g", scaled("score_anchor").alias("score_anchor"), scaled("audio_anchor").alias("audio_anchor"), "status")


@query(f"""with s as (select user_id % 25 g, role source, cast(sum(cast(floor(value * 100::double) as bigint)) as double) / 4000::double sc from EVENTS group by all), w as (select *, exp(sc - max(sc) over (partition by g)) e from s), p as (select g, source, e / sum(e) over (partition by g) wt from w), a as (select user_id % 25 g, min(user_id % 4) < 1 ag from EVENTS where user_id % 25 % 3 <> 1 group by 1),
j as (select p.*, coalesce(ag, true) ag, count(*) over (partition by p.g) n, row_number() over (partition by p.g order by wt desc, source) r, max(wt) over (partition by p.g) mx from p left join a on p.g = a.g)
select g, source, {sql_scaled("wt", 100000)} weight, case when n = 1 or ag then case when n = 1 or mx >= 0.55::double then 'selected' else 'probability_fusion' end else 'selected_due_to_disagreement' end mode from j""")
def source_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumn("g", F.col("user_id") % 25)
    made = e.groupBy("g", F.col("role").alias("source")).agg((F.sum(F.floor(F.col("value") * 100)).cast("double") / 4000).alias("score"))
    apart = e.where("g % 3 <> 1").groupBy("g").agg(F.when(F.min(F.col("user_id") % 4) < 1, 10.0).otherwise(500.0).alias("median_ms")).withColumn("p95_ms", F.lit(0.0)).withColumn("max_ms", F.lit(0.0))
    got = evidence.choose_source(made, apart, ["g"], "source", "score")
    return got.select("g", "source", scaled("weight", 10**5).alias("weight"), "mode")


@query(f"""with r as (select user_id g, t::double / 1000000::double x, (cast(floor(value * 100::double) as bigint) % 300 - 100)::double res from EVENTS), a as (select g, count(*) n, median(res) o, max(x) - min(x) sp from r group by g), s as (select a.g, median((b.res - a.res) / (b.x - a.x)) m from r a join r b on a.g = b.g and b.x > a.x group by a.g)
select g, 'retain_baseline' as method, 0::bigint off from a union all select g, 'regional_constant_offset', {sql_scaled("o", 10)} from a where n >= 4 and abs(o) >= 40 union all select g, 'regional_linear_scale', null from a join s using (g) where n >= 4 and sp >= 8 and abs(coalesce(m, 1::double)) >= 0.00001::double""")
def regional_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select(F.col("user_id").alias("g"), (F.col("t").cast("double") / 1e6).alias("x"), (F.floor(F.col("value") * 100) % 300 - 100).cast("double").alias("res"))
    got = evidence.proposals(rows, ["g"], "res", "x", "g", least_slope=0.00001)
    return got.select("g", "method", F.when(F.col("method") != "regional_linear_scale", scaled("offset_ms", 10)).alias("off"))


@query("""with v as (select role, hour, cast(floor(median(cast(floor(value * 100::double) as bigint) - 1500) * 10::double) as bigint) res, count(*) n from EVENTS where event_id % 3 <> 0 group by all), l as (select *, lead(hour) over w nx, lead(res) over w nr from v window w as (partition by role order by hour)) select role, hour, nx as next, res, nr as next_residual from l where res::double * nr < 0 and abs(res - nr) >= 80""")
def residual_reversals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select(F.col("role"), "hour", (F.floor(F.col("value") * 100) - 1500).alias("res"), (F.col("event_id") % 3 != 0).alias("accepted"), F.lit("x").alias("r"))
    votes = evidence.one_vote(rows, ["role"], "hour", "res", "r").withColumn("res", F.floor(F.col("res") * 10).cast("long"))
    return evidence.reversals(votes, ["role"], "hour", "res").select("role", "hour", "next", "res", "next_residual")


@query("""with r as (select hour // 24 section, case event_id % 4 when 0 then 'conflict' when 1 then 'gap' when 2 then 'stable' else 'drift' end k from EVENTS), o as (select *, case k when 'conflict' then 1 when 'drift' then 2 when 'gap' then 3 else 4 end p from r) select section, arg_min(k, p) state, count(*) n, count(*) filter (k = 'drift') drift from o group by section""")
def section_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.get(F.array(*(F.lit(x) for x in ("conflict", "gap", "stable", "drift"))), (F.col("event_id") % 4).cast("int"))
    rows = events(spark, sf_dir).select(F.lit(0).alias("song"), F.expr("hour div 24").alias("section"), kind.alias("k"))
    got = evidence.phase_rollup(rows, ["song"], "section", "k", {"conflict": 1, "drift": 2, "gap": 3, "stable": 4})
    return got.select("section", "state", "n", "drift")
