"""Queries of tempo maps, measures, range joins and time maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.operators import joins, maps, tempo
from timeloom.plans.registry import query, scaled, sql_scaled
from timeloom.sources.tables import HOUR_US, events, table

_TICKS = """with t as (select l_orderkey k, l_linenumber * 960 - 960 * (l_orderkey % 2) tick, max(60 + l_partkey % 90)::double bpm from lineitem group by all),
w as (select * from t union all select k, 0, 100::double from t group by k having min(tick) <> 0), e as (select k, tick, bpm from (select *, lag(bpm) over (partition by k order by tick) p from w) where p is null or p <> bpm),"""
_SEGMENTS = """s as (select *, coalesce(sum(d) over (partition by k order by tick rows between unbounded preceding and 1 preceding), 0::double) sec from (select *, (lead(tick) over (partition by k order by tick) - tick)::double / 960::double * (60::double / bpm) d from e)),"""


def _tempo(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), (F.col("l_linenumber") * 960 - 960 * (F.col("l_orderkey") % 2)).alias("tick"), (60 + F.col("l_partkey") % 90).cast("double").alias("bpm"))
    return tempo.tempo_events(lines, ["k"], "tick", "bpm", initial=100.0)


@query(f"""{_TICKS} {_SEGMENTS} q as (select o_orderkey k, o_custkey % 9000 tick from orders)
select q.k, q.tick, {sql_scaled("coalesce(s.sec + (q.tick - s.tick)::double / 960::double * (60::double / s.bpm), q.tick::double / 960::double * 0.5::double)", 100000)} as seconds, coalesce(s.bpm, 120::double) bpm from q asof left join s on q.k = s.k and q.tick >= s.tick""")
def tempo_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), (F.col("o_custkey") % 9000).alias("tick"))
    made = _tempo(spark, sf_dir)
    both = tempo.active_tempo(tempo.seconds_at(asked, made, ["k"], "tick"), made, ["k"], "tick")
    return both.select("k", "tick", scaled("seconds", 100_000).alias("seconds"), "bpm")


@query(f"""{_TICKS} f as (select e.*, 1500 + k % 7 * 300 as first from e)
select k, 0::bigint tick, coalesce(arg_max(bpm, tick) filter (tick <= first), arg_min(bpm, tick)) bpm from f group by k union all select k, cast(tick - first as bigint), bpm from f where tick > first""")
def tempo_rebased(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tempo.rebase(_tempo(spark, sf_dir), ["k"], 1500 + F.col("k") % 7 * 300)


@query("""with v as (select o_orderkey k, o_custkey % 5 bar, row_number() over (partition by o_custkey % 50 order by o_orderkey) i, o_custkey % 50 g from orders), p as (select g, i, bar, (i - 1) * 3840 s from v),
a as (select p_partkey % 5 bar, p_size::double * 2 r, (60 + p_partkey % 60)::double bpm from part where p_partkey <= 20), l as (select g, i, cast(round_even(s + (case when r > 1 then r / 100::double else r end) * 3840, 0) as bigint) tick, bpm, case when r > 1 then r / 100::double else r end r2 from p join a using (bar)),
o as (select *, arg_max(bpm, {'i': i, 'r': r2, 'b': bpm}) over (partition by g) op from l), t as (select g, tick, arg_max(bpm, {'i': i, 'r': r2, 'b': bpm}) bpm from o group by all), w as (select g, tick, bpm from t union all select g, 0, any_value(op) from o group by g having min(tick) <> 0)
select g, cast(tick as bigint) tick, bpm from (select *, lag(bpm) over (partition by g order by tick) q from w) where q is null or q <> bpm""")
def tempo_expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = "row_number() over (partition by o_custkey % 50 order by o_orderkey)"
    visits = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).alias("g"), (F.col("o_custkey") % 5).alias("bar"), F.expr(by).alias("i")).withColumn("s", (F.col("i") - 1) * 3840).withColumn("n", F.lit(3840))
    rises = table(spark, sf_dir, "part").where("p_partkey <= 20").select((F.col("p_partkey") % 5).alias("bar"), (F.col("p_size") * 2).cast("double").alias("r"), (60 + F.col("p_partkey") % 60).cast("double").alias("bpm"))
    whole = visits.select("g").distinct().join(F.broadcast(rises))  # at most 20 rows
    return tempo.expected_events(visits, whole, ["g"], "bar", "s", "n", "i", "r", "bpm")


def _downbeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).groupBy("role", "hour").agg((F.min("t") / 1e6).alias("t"), (F.min("user_id") % 4 + 2).cast("int").alias("meter"))


_DOWN = "d as (select role, hour, min(t)::double / 1000000::double t, cast(min(user_id) % 4 + 2 as int) meter from EVENTS group by all)"


@query(f"""with {_DOWN}, m as (select *, lead(t) over (partition by role order by t) e from d), b as (select * from m where e > t), f as (select role, arg_min({{'t': t, 'e': e, 'm': meter, 'h': hour}}, t) x from b group by role),
r as (select event_id, role, t::double / 1000000::double t from EVENTS), p as (select r.event_id, r.t, coalesce(b.t, f.x.t) s, coalesce(b.e, f.x.e) e, coalesce(b.meter, f.x.m) m, coalesce(b.hour, f.x.h) h from r asof left join b on r.role = b.role and r.t >= b.t join f on f.role = r.role)
select event_id, h as hour, {sql_scaled("(t - s) / (e - s) * greatest(1, m) + 1::double", 1000)} beat from p""")
def beat_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = tempo.measures(_downbeats(spark, sf_dir), ["role"], "t")
    rows = events(spark, sf_dir).select("event_id", "role", (F.col("t") / 1e6).alias("t"))
    placed = tempo.position(rows, bars, ["role"], "t", "meter", 86_400)
    hours = tempo.measure_at(rows, bars, ["role"], "t", ["hour"], 86_400).select("event_id", "hour")
    return placed.join(hours, "event_id").select("event_id", "hour", scaled("beat").alias("beat"))


@query(f"""with {_DOWN}, m as (select *, lead(t) over w e, lag(t) over w p from d window w as (partition by role order by t)), i as (select role, hour, t, coalesce(e, 2 * t - p) e from m where coalesce(e, 2 * t - p) is not null)
select i.role, hour, {sql_scaled("i.e - i.t", 1000)} length, {sql_scaled("max(i.e) over (partition by i.role)", 1)} final from i""")
def measure_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    down = _downbeats(spark, sf_dir)
    ends = tempo.final_end(down, ["role"], "t").withColumnRenamed("end", "final")
    return tempo.measures(down, ["role"], "t", infer_end=True).join(ends, "role").select("role", "hour", scaled("duration").alias("length"), scaled("final", 1).alias("final"))


@query(f"""with {_DOWN}, n as (select role, hour, t, meter, row_number() over (partition by role order by t) i, t + hour % 5 w from d), k as (select *, coalesce(lead(t) over o - t, t - lag(t) over o) nd, coalesce(lead(w) over o - w, w - lag(w) over o) wd from n window o as (partition by role order by i)),
b as (select *, case when wd > 0 then wd end / case when nd > 0 then nd end st, unnest(range(greatest(1, meter))) j from k)
select role, format('seg{{:03d}}.m{{:04d}}.o{{:02d}}.b{{:02d}}', hour % 7, i, 1, j) beat_id, {sql_scaled("t + coalesce(nd, 0::double) * (j::double / meter::double)", 100)} score_time, {sql_scaled("w + coalesce(wd, 0::double) * (j::double / meter::double)", 100)} audio_time, {sql_scaled("meter::double * 60::double / nd", 1000)} nominal_bpm,
case when st not between 0.9::double and 1.1::double then 'stretch_outside_safe_range' else '' end flags, case when j = 0 then 'downbeat' else 'beat' end structural_role from b""")
def beatmap_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _beatmap(spark, sf_dir).select("role", "beat_id", scaled("score_time", 100).alias("score_time"), scaled("audio_time", 100).alias("audio_time"), scaled("nominal_bpm").alias("nominal_bpm"), F.array_join("flags", ",").alias("flags"), "structural_role")


def _beatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _downbeats(spark, sf_dir).withColumn("i", F.expr("row_number() over (partition by role order by t)")).withColumn("seg", F.col("hour") % 7).withColumn("occ", F.lit(1))
    warped = rows.select("role", "i", (F.col("t") + F.col("hour") % 5).alias("w"))
    return tempo.beatmap(rows, warped, ["role"], "i", "t", "w", "meter", "seg", "i", "occ")


@query(f"""with {_DOWN}, n as (select role, hour, t, meter, row_number() over (partition by role order by t) i, t + hour % 5 w from d), k as (select *, coalesce(lead(t) over o - t, t - lag(t) over o) nd, coalesce(lead(w) over o - w, w - lag(w) over o) wd from n window o as (partition by role order by i)),
b as (select role, hour % 7 seg, i, j, wd / nd st, w + coalesce(wd, 0::double) * (j::double / meter::double) u from (select *, unnest(range(greatest(1, meter))) j from k)), c as (select *, lag(u) over (partition by role, seg order by i, j) p from b)
select role, count(*) filter (u <= p) non_monotonic, count(*) filter (st not between 0.9::double and 1.1::double) unsafe_stretch, case when count(*) filter (u <= p) > 0 then 'error' when count(*) filter (st not between 0.9::double and 1.1::double) > 0 then 'warning' else 'ok' end as status from c group by role""")
def beatmap_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tempo.validate_beatmap(_beatmap(spark, sf_dir), ["role"], ["measure", "beat_index"]).select("role", "non_monotonic", "unsafe_stretch", "status")


@query(f"""with {_DOWN}, k as (select *, lead(t) over o l from d window o as (partition by role order by t, hour)), g as (select *, coalesce(l - t, last_value(l - t ignore nulls) over (partition by role order by t, hour rows between unbounded preceding and 1 preceding)) n from k)
select role, {sql_scaled("t + case when j > 0 then j * n / meter::double else 0::double end", 1000)} time, case when j = 0 then hour else -1 end measure from (select *, unnest(range(meter)) j from g)""")
def beats_of_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = tempo.explicit_beats(_downbeats(spark, sf_dir), ["role"], "t", "meter", "hour")
    return made.select("role", scaled("time").alias("time"), "measure")


@query("""with c as (select conv_id, turn, case when turn % 3 <> 2 then role end r from conversations), n as (select *, lag(r) over (partition by conv_id order by turn) p from c where r is not null) select conv_id, turn, r as role from n where p is null or p <> r""")
def value_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.col("turn") % 3 != 2, F.col("role")).alias("role"))
    return tempo.changes(rows, ["conv_id"], ["turn"], "role")


@query("""with a as (select role, t, value from EVENTS where event_id % 50 <> 7), b as (select role, t + case when event_id % 40 = 3 then 500000 else 0 end t, value from EVENTS), x as (select *, row_number() over (partition by role order by t, value) i from a), y as (select *, row_number() over (partition by role order by t, value) i from b)
select role, count(x.t) n_a, count(y.t) n_b, count(*) filter (x.t is null or y.t is null or abs(x.t - y.t) > 0 or x.value is distinct from y.value) mismatches from x full join y using (role, i) group by role""")
def series_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("event_id", "role", "t", "value")
    moved = rows.withColumn("t", F.col("t") + F.when(F.col("event_id") % 40 == 3, 500_000).otherwise(0))
    return tempo.compare_series(rows.where("event_id % 50 <> 7"), moved, ["role"], ["t", "value"], "t", ["value"], 0).select("role", "n_a", "n_b", "mismatches")


@query(f"""with s as (select role, hour // 6 as part, min(t) a, min(t) + 9000000000 z from EVENTS group by all) select s.role, s.part, e.event_id from s join EVENTS e on e.role = s.role and e.t >= s.a and e.t < s.z""")
def window_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = events(spark, sf_dir).groupBy("role", F.expr("hour div 6").alias("part")).agg(F.min("t").alias("a")).withColumn("z", F.col("a") + 9_000_000_000)
    return joins.members_of(spans, events(spark, sf_dir).select("role", "event_id", "t"), ["role"], "a", "z", "t", 6.0 * HOUR_US).select("role", "part", "event_id")


_SPANS = "select event_id, user_id % 20 g, role, t a, t + cast(floor(value * 60000000::double) as bigint) z from EVENTS"


def _spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", (F.col("user_id") % 20).alias("g"), "role", F.col("t").alias("a"), (F.col("t") + F.floor(F.col("value") * 6e7)).alias("z"))


@query(f"""with s as ({_SPANS}) select x.event_id, count(*) n, cast(count(distinct y.role) as bigint) roles from (select * from s where role = 'view') x join (select * from s where role <> 'view') y on x.g = y.g and greatest(x.a, y.a) <= least(x.z, y.z) group by x.event_id""")
def overlapping_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _spans(spark, sf_dir)
    views, others = s.where("role = 'view'").drop("role"), s.where("role <> 'view'").select("g", F.col("role").alias("other"), F.col("a").alias("oa"), F.col("z").alias("oz"))
    met = joins.overlapping(views, others, ["g"], ("a", "z"), ("oa", "oz"), float(HOUR_US), closed=True)
    return met.groupBy("event_id").agg(F.count("*").alias("n"), F.count_distinct("other").alias("roles"))


@query(f"""with s as ({_SPANS}), d as (select x.event_id, y.role as kind, y.a ya, y.z yz, case when greatest(x.a, y.a) < least(x.z, y.z) + 0.000000001::double then 0 else least(abs(x.a - y.a), abs(x.a - y.z), abs(x.z - y.a), abs(x.z - y.z)) end d from (select * from s where role = 'view') x join (select * from s where role <> 'view') y on x.g = y.g),
b as (select event_id, min({{'d': d, 'a': ya, 'z': yz, 'k': kind}}) m from d where d <= 7200000000 group by event_id) select s.event_id, m.k near_kind, cast(m.d as bigint) near_distance from s left join b using (event_id) where s.role = 'view'""")
def nearest_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _spans(spark, sf_dir)
    got = joins.nearest_span(s.where("role = 'view'"), s.where("role <> 'view'"), ["g"], "event_id", ("a", "z"), ("a", "z"), "role", 2.0 * HOUR_US)
    return got.select("event_id", "near_kind", F.col("near_distance").cast("long").alias("near_distance"))


@query("""select event_id from EVENTS x where role = 'view' and not exists (select 1 from EVENTS y where y.role = 'click' and y.user_id % 5 = x.user_id % 5 and abs(y.t - x.t) <= 900000000)""")
def suppressed_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("event_id", "role", (F.col("user_id") % 5).alias("g"), "t")
    return joins.without_near(rows.where("role = 'view'"), rows.where("role = 'click'"), ["g"], "t", "t", 900e6).select("event_id")


@query("""with a as (select n_nationkey k, n_name v from nation where n_nationkey % 3 = 0), b as (select n_nationkey k, case when n_nationkey % 2 = 0 then 'even' end v from nation where n_nationkey % 5 < 3)
select s_suppkey, case when a.k is not null then a.v when b.k is not null then b.v else 'none' end v from supplier left join a on s_nationkey = a.k left join b on s_nationkey = b.k""")
def layered_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    a = n.where("n_nationkey % 3 = 0").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("v"))
    b = n.where("n_nationkey % 5 < 3").select(F.col("n_nationkey").alias("k"), F.when(F.col("n_nationkey") % 2 == 0, "even").alias("v"))
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("k"))
    return joins.lookup_layers(rows, "k", [a, b], "v", "none").drop("k")


@query(f"""with c as (select user_id % 40 g, hour // 8 * 8 * 3600::double x, max(hour // 8 * 8 * 3600::double + user_id % 60) y from EVENTS group by all), p as (select *, lead(x) over w x2, lead(y) over w y2, first_value(x) over w fx, first_value(y) over w fy from c window w as (partition by g order by x rows between unbounded preceding and unbounded following)),
r as (select event_id, user_id % 40 g, t::double / 1000000::double + 3600::double * (event_id % 3 - 1) * 20 t from EVENTS), m as (select r.event_id, r.t, p.*, f.fx ax, f.fy ay, row_number() over (partition by r.event_id order by p.x desc) k from r asof left join p on r.g = p.g and r.t >= p.x join (select distinct g, fx, fy from p) f on f.g = r.g)
select event_id, {sql_scaled("case when x is null then ay when x2 is null then y + (t - x) else y + (t - x) * (y2 - y) / (x2 - x) end", 1000)} mapped from m""")
def map_clamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumn("g", F.col("user_id") % 40)
    controls = e.select("g", (F.expr("hour div 8 * 8") * 3600.0).alias("x"), (F.expr("hour div 8 * 8") * 3600.0 + F.col("user_id") % 60).alias("y"))
    rows = e.select("event_id", "g", (F.col("t") / 1e6 + (F.col("event_id") % 3 - 1) * 20 * 3600.0).alias("t"))
    return maps.map_times(rows, controls, ["g"], "t", "mapped", "clamp", "unit").select("event_id", scaled("mapped").alias("mapped"))


@query(f"""with c as (select user_id % 40 g, hour // 8 * 8 * 3600::double x, max((user_id % 60)::double / 10::double) r from EVENTS group by all), p as (select *, lead(x) over w x2, lead(r) over w r2 from c window w as (partition by g order by x)),
q as (select event_id, user_id % 40 g, t::double / 1000000::double + 3600::double * (event_id % 3 - 1) * 20 t from EVENTS), m as (select q.event_id, q.t, p.x, p.r, p.x2, p.r2, l.lr from q asof left join p on q.g = p.g and q.t >= p.x join (select g, arg_max(r, x) lr from c group by g) l on l.g = q.g)
select event_id, {sql_scaled("t * 1.5::double + case when x is null then 0::double when x2 is null then lr else r + (t - x) * (r2 - r) / (x2 - x) end", 1000)} mapped from m""")
def map_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumn("g", F.col("user_id") % 40)
    controls = e.select("g", (F.expr("hour div 8 * 8") * 3600.0).alias("x"), (F.col("user_id") % 60 / 10).alias("r"))
    rows = e.select("event_id", "g", (F.col("t") / 1e6 + (F.col("event_id") % 3 - 1) * 20 * 3600.0).alias("t")).withColumn("base", F.col("t") * 1.5)
    return maps.add_residuals(rows, controls, ["g"], "t", "base", "mapped", "base", "hold").select("event_id", scaled("mapped").alias("mapped"))


@query(f"""with s as (select role, user_id % 10 g, min(t)::double a, max(t)::double z from EVENTS group by all), v as (select g, a, z from s where role = 'view'), c as (select g, a, z from s where role = 'click')
select g, {sql_scaled("(c.z - c.a) / (v.z - v.a)", 1000000)} scale, {sql_scaled("c.a - v.a * ((c.z - c.a) / (v.z - v.a))", 0.000001)} shift, coalesce((c.z - c.a) / (v.z - v.a) between 0.95::double and 1.05::double, false) accepted, {sql_scaled("c.a + ((c.z - c.a) / (v.z - v.a)) * (v.z - v.a)", 0.000001)} end_s from v join c using (g)""")
def linear_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("role", (F.col("user_id") % 10).alias("g"), F.col("t").cast("double").alias("t"))
    got = maps.simple_map(rows.where("role = 'view'"), rows.where("role = 'click'"), ["g"], "t")
    guard = maps.guarded_scale(F.col("score_first"), F.col("score_last"), F.col("audio_first"), F.col("audio_last"))
    end = maps.reanchored(F.col("score_last"), F.col("scale"), F.col("score_first"), F.col("audio_first"))
    return got.select("g", scaled("scale", 1_000_000).alias("scale"), F.floor(F.col("offset") * 1e-6 + 0.5).cast("long").alias("shift"), guard["accepted"].alias("accepted"), F.floor(end * 1e-6 + 0.5).cast("long").alias("end_s"))


@query(f"""with a as (select user_id id, min(hour) measure, min(t)::double / 1000000::double padded, min(hour) * 3600::double expected, case when user_id % 2 = 0 then 'original' else 'padded' end basis from EVENTS group by user_id), b as (select distinct hour near, hour * 3600::double e from EVENTS),
n as (select id, min({{'d': abs(padded - e), 'm': near}}) m from a join b on near between measure - 2 and measure + 2 group by id), r as (select a.*, m, padded - expected res, padded - expected + case when basis = 'padded' then 4::double else -4::double end alt from a left join n using (id))
select id, {sql_scaled("res", 1000)} residual, m.m best_measure, concat_ws(',', case when m.m <> measure and m.d + 0.1::double < abs(res) then 'nearby_bar_fits_better' end, case when abs(alt) + 0.1::double < abs(res) then 'possible_time_basis_error' end) warnings,
case when abs(res) <= 0.1::double then 'high' when abs(res) <= 0.25::double then 'moderate' when abs(res) <= 0.6::double then 'warning' else 'suspicious' end confidence from r""")
def manual_assessment(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    anchors = e.groupBy(F.col("user_id").alias("id")).agg(F.min("hour").alias("measure"), (F.min("t") / 1e6).alias("padded_time")).withColumn("expected", F.col("measure") * 3600.0).withColumn("basis", F.when(F.col("id") % 2 == 0, "original").otherwise("padded")).withColumn("song", F.lit(0))
    bars = e.select(F.lit(0).alias("song"), F.col("hour").alias("measure")).distinct().withColumn("expected", F.col("measure") * 3600.0)
    got = maps.assess_manual(anchors, bars, ["song"], 4.0)
    return got.select("id", scaled("residual").alias("residual"), "best_measure", F.array_join("warnings", ",").alias("warnings"), "confidence")
