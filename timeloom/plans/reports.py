"""Queries of retiming, priors, reports and phrase context."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from timeloom.functions import notation, scoring
from timeloom.operators import features, fusion, gates, joins, maps, refine, tempo
from timeloom.plans.registry import query, scaled, sql_scaled
from timeloom.sources.tables import HOUR_US, events

#: SQL of piecewise-linear maps: controls c (g, x, y) and points q (g, id, side, t) become m with the mapped time n.
_MAPPED = """p as (select *, lead(x) over w x2, lead(y) over w y2 from c window w as (partition by g order by x)), f as (select g, min(x) fx, arg_min(y, x) fy from c group by g),
m as (select q.*, case when f.fx is null then t when p.x is null then f.fy + (t - f.fx) when p.x2 is null then p.y + (t - p.x) else p.y + (t - p.x) * (p.y2 - p.y) / (p.x2 - p.x) end n from q asof left join p on q.g = p.g and q.t >= p.x left join f on f.g = q.g)"""


@query(f"""with c as (select user_id % 10 g, hour * 3600::double x, max(hour * 3600::double + (user_id % 7)::double * 400::double) y from EVENTS where event_id % 30 = 0 group by all), s as (select event_id id, user_id % 10 g, t::double / 1000000::double a, value * 100::double d from EVENTS),
q as (select id, g, 0 side, a t from s union all select id, g, 1, a + d from s), {_MAPPED}
select id, {sql_scaled("max(n) filter (side = 0)", 10)} as time, {sql_scaled("greatest(0.5::double, max(n) filter (side = 1) - max(n) filter (side = 0))", 10)} as length from m group by id""")
def mapped_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumn("g", F.col("user_id") % 10)
    x = F.col("hour") * 3600.0
    controls = e.where("event_id % 30 = 0").select("g", x.alias("x"), (x + (F.col("user_id") % 7) * 400.0).alias("y"))
    start = F.col("t").cast("double") / 1e6
    rows = e.select(F.col("event_id").alias("id"), "g", start.alias("a"), (start + F.col("value") * 100).alias("z"))
    return maps.map_spans(rows, controls, ["g"], "a", "z", 0.5).select("id", scaled("t", 10).alias("time"), scaled("d", 10).alias("length"))


@query(f"""with d as (select user_id % 10 * 100000 + hour // 24 g, event_id, hour, role, t::double / 1000000::double a, case when event_id % 5 > 0 then value * 100::double end d, hour // 24 % 3 kind, row_number() over (partition by user_id % 10, hour // 24 order by t, event_id) i from EVENTS),
c as (select g, hour * 3600::double x, max(hour * 3600::double + (event_id % 7)::double * 400::double) y from d where event_id % 6 = 0 group by all), q as (select g, i, 0 side, a t from d where kind < 2 union all select g, i, 1, a + coalesce(d, 0::double) from d where kind < 2), {_MAPPED},
k as (select g, i, max(n) filter (side = 0) s, max(n) filter (side = 1) e from m group by all)
select d.g, d.i, d.role as name, {sql_scaled("coalesce(k.s, d.a)", 10)} as time, {sql_scaled("case when k.s is null or d.d is null then d.d else greatest(0::double, k.e - k.s) end", 10)} as length from d left join k on d.g = k.g and d.i = k.i""")
def retimed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested documents, two kinds of which hold times; names and order stay."""
    e = events(spark, sf_dir).withColumn("g", F.col("user_id") % 10 * 100000 + F.expr("hour div 24"))
    row = F.struct((F.col("t").cast("double") / 1e6).alias("t"), F.when(F.col("event_id") % 5 > 0, F.col("value") * 100).alias("d"), F.col("role").alias("name"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("t", "event_id", row.alias("r")))), lambda s: s["r"])
    kind = F.element_at(F.array(F.lit("notes"), F.lit("beats"), F.lit("text")), (F.expr("hour div 24") % 3 + 1).cast("int"))
    documents = e.groupBy("g", kind.alias("kind")).agg(listed.alias("rows"))
    controls = e.where("event_id % 6 = 0").groupBy("g", (F.col("hour") * 3600.0).alias("x")).agg(F.max(F.col("hour") * 3600.0 + (F.col("event_id") % 7) * 400.0).alias("y"))
    done = maps.rewrite_documents(documents, controls, ["g"], "kind", {"notes": ["rows"], "beats": ["rows"]})
    flat = done.select("g", F.posexplode("rows").alias("i", "r"))
    return flat.select("g", (F.col("i") + 1).cast("long").alias("i"), F.col("r.name").alias("name"), scaled("r.t", 10).alias("time"), scaled("r.d", 10).alias("length"))


@query(f"""with i as (select user_id g, (lead(t) over (partition by user_id order by t, event_id) - t)::double / 1000000::double nominal, 0.8::double + (event_id % 50)::double / 100::double r, event_id % 97 = 0 bad, event_id % 389 = 0 unresolved from EVENTS), k as (select g, case when nominal > 0 and nominal * r > 0 then nominal * r / nominal end q, bad, unresolved from i)
select g, {sql_scaled("min(q)", 10000)} least, {sql_scaled("max(q)", 10000)} most, count(*) filter (abs(q - 1::double) > 0.155::double) stretched, case when bool_or(unresolved) then 'severe' when bool_or(bad) or count(*) filter (abs(q - 1::double) > 0.155::double) > 0 then 'warning' else 'ok' end severity from k group by g""")
def alignment_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    step = (F.lead("t").over(Window.partitionBy("user_id").orderBy("t", "event_id")) - F.col("t")).cast("double") / 1e6
    rows = events(spark, sf_dir).select(F.col("user_id").alias("g"), step.alias("nominal"), (F.col("event_id") % 50 / 100 + 0.8).alias("r"), (F.col("event_id") % 97 == 0).alias("bad"), (F.col("event_id") % 389 == 0).alias("unresolved"))
    got = gates.alignment_severity(rows.withColumn("warped", F.col("nominal") * F.col("r")), ["g"], "nominal", "warped", 0.155)
    return got.select("g", scaled("least_stretch", 10_000).alias("least"), scaled("most_stretch", 10_000).alias("most"), "stretched", "severity")


@query("""with r as (select event_id, case when event_id % 11 > 0 then 0.3::double end root, event_id % 13 > 0 found, event_id % 7 > 0 rep, case event_id % 3 when 0 then 'matching_phrase_run' when 1 then 'matching_phrase_run' else 'phrase_count_mismatch' end c, (event_id % 10)::double / 10::double b, (event_id % 17)::double / 17::double j, event_id % 5 cc, event_id % 5 - case when event_id % 19 = 0 then 1 else 0 end mc, value off from EVENTS)
select event_id, case when root is null then 'no_validated_root' when not found then 'missing_run_detail' when not rep then 'not_selected_cluster_representative' when c <> 'matching_phrase_run' then 'occurrence_count_not_exact' when b < 0.45::double then 'boundary_context_too_weak' when j < 0.76::double then 'joint_confidence_too_weak' when cc <> mc then 'ordinal_count_mismatch' when abs(off - root) > 0.75::double then 'phrase_origin_disagrees_with_validated_root' end reason from r""")
def run_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    run = F.struct((i % 13 > 0).alias("found"), (i % 7 > 0).alias("representative"), F.when(i % 3 < 2, "matching_phrase_run").otherwise("phrase_count_mismatch").alias("classification"), (i % 10 / 10).alias("boundary_score"), (i % 17 / 17).alias("joint_confidence"), (i % 5).alias("chart_count"), (i % 5 - F.when(i % 19 == 0, 1).otherwise(0)).alias("midi_count"), F.lit(0.0).alias("chart_start"), F.col("value").alias("midi_start"))
    rows = events(spark, sf_dir).select("event_id", "value", run.alias("run"), F.when(i % 11 > 0, 0.3).alias("root"))
    return rows.select("event_id", gates.run_reason(F.col("run"), F.col("root")).alias("reason"))


@query("""with k as (select user_id g, count(*) filter (role = 'click') notes, count(*) filter (role = 'view' and event_id % 6 = 0) timed, count(*) filter (role = 'view' and event_id % 3 = 0) lines, count(distinct case when role = 'view' and event_id % 3 = 0 then hour end) starts, (max(t) - min(t))::double / 1000000::double + 50000::double dur from EVENTS group by 1),
w as (select user_id g, count(*) n, max(t)::double / 1000000::double e from EVENTS where role = 'view' group by 1), p as (select user_id g, count(*) n, max(t::double / 1000000::double + value) e from EVENTS where role = 'click' group by 1), o as (select user_id g, min(t)::double / 1000000::double o from EVENTS group by 1),
j as (select k.*, coalesce(w.n, 0) nw, coalesce(p.n, 0) np, w.e - o.o we, p.e - o.o pe from k join o using (g) left join w using (g) left join p using (g)), c as (select *, case when notes = 0 and timed = 0 and lines = 0 then 'no_vocal_material' when timed > 0 then 'timed_beat_text' when lines >= 2 and starts >= 2 then 'measure_allocated_lyrics' when lines > 0 then 'flat_untimed_lyrics' else 'notes_only' end kind,
greatest(0::double, dur - greatest(we, pe)) tail from j)
select g, kind, kind in ('timed_beat_text', 'measure_allocated_lyrics') direct, concat_ws(',', case when nw = 0 then 'no_timed_words' end, case when np = 0 then 'no_pitch_notes' end, case when tail > greatest(45::double, dur * 0.25::double) then 'large_unexplained_song_tail_without_vocals' end, case when abs(we - pe) > 30 then 'lyrics_and_pitch_end_times_diverge' end) warnings from c""")
def vocal_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumn("g", F.col("user_id"))
    line = F.col("role").eqNullSafe("view") & (F.col("event_id") % 3 == 0)
    first = e.groupBy("g").agg((F.min("t").cast("double") / 1e6).alias("o"))
    counts = e.groupBy("g").agg(F.count_if(F.col("role") == "click").alias("notes"), F.count_if(line & (F.col("event_id") % 6 == 0)).alias("timed"), F.count_if(line).alias("lines"), F.count_distinct(F.when(line, F.col("hour"))).alias("starts"), ((F.max("t") - F.min("t")).cast("double") / 1e6 + 50_000.0).alias("duration"))
    timed = e.join(first, "g").withColumn("x", F.col("t").cast("double") / 1e6 - F.col("o"))
    words = timed.where("role = 'view'").select("g", F.col("x").alias("t"), F.lit(None).cast("double").alias("d"))
    pitches = timed.where("role = 'click'").select("g", F.col("x").alias("t"), F.col("value").alias("d"))
    warned = gates.vocal_coverage(counts.select("g", "duration"), words, pitches, ["g"]).select("g", F.array_join("reasons", ",").alias("warnings"))
    kinds = counts.select("g", gates.vocal_capability(F.col("notes"), F.col("timed"), F.col("lines"), F.col("starts")).alias("c"))
    return kinds.join(warned, "g").select("g", "c.kind", "c.direct", "warnings")


@query(f"""with f as (select role g, t::double / 1000000::double x, value l from EVENTS), k as (select g, quantile_cont(l, 0.7) a70 from f group by g), s as (select f.*, sum(case when l >= greatest(a70 * 0.03::double, 0.00001::double) and x >= 1704100000 then 1 else 0 end) over (partition by f.g order by x rows between 2 preceding and 2 following) >= 3 su from f join k using (g))
select g, {sql_scaled("max(x) filter (su) + 0.5::double", 10)} content_end from s group by g""")
def content_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = events(spark, sf_dir).select(F.col("role").alias("g"), (F.col("t").cast("double") / 1e6).alias("x"), F.col("value").alias("l"))
    return features.content_end(frames, ["g"], "x", "l", 1_704_100_000.0, 0.5, 5).select("g", scaled("content_end", 10).alias("content_end"))


@query("""with s as (select user_id % 40 g, (hour // 24) * 86400::double s, max(2 + hour // 24 % 3) m from EVENTS where hour % 24 < 3 group by all) select e.event_id, greatest(1, coalesce(s.m, 4))::bigint meter from EVENTS e asof left join s on e.user_id % 40 = s.g and e.t::double / 1000000::double + 0.000000001::double >= s.s""")
def meters_at_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumn("g", F.col("user_id") % 40).withColumn("day", F.expr("hour div 24"))
    signatures = e.where("hour % 24 < 3").select("g", (F.col("day") * 86400.0).alias("s"), (F.col("day") % 3 + 2).alias("meter")).distinct()
    rows = e.select("event_id", "g", (F.col("t").cast("double") / 1e6).alias("x"))
    return tempo.meter_at(rows, signatures, ["g"], "x", "s", "meter").select("event_id", F.col("meter").cast("long").alias("meter"))


@query(f"""with c as (select user_id % 20 g, (hour // 24) * 86400::double x, (count(*) % 9)::double * 100::double y from EVENTS group by all), h as (select distinct user_id % 20 g, hour * 3600::double b from EVENTS), p as (select *, lead(x) over w x2, lead(y) over w y2 from c window w as (partition by g order by x)), f as (select g, arg_min(y, x) fy from c group by g),
m as (select h.g, b, case when p.x is null then fy when p.x2 is null then p.y else p.y + (b - p.x) / (p.x2 - p.x) * (p.y2 - p.y) end k from h asof left join p on h.g = p.g and h.b >= p.x join f on f.g = h.g), n as (select g, b, k, b + k / 1000::double q, b > lag(b) over w and b + k / 1000::double > lag(b + k / 1000::double) over w r from m window w as (partition by g order by b))
select g, {sql_scaled("b", 1)} x, {sql_scaled("q", 100)} y, bool_and(coalesce(r, true)) over (partition by g) strict from n""")
def proposal_controls(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumn("g", F.col("user_id") % 20)
    days = e.groupBy("g", (F.expr("hour div 24") * 86400.0).alias("x")).agg((F.count("*") % 9 * 100.0).alias("y"))
    curve = days.groupBy("g").agg(F.collect_list(F.struct("x", "y")).alias("curve"))
    downbeats = e.select("g", (F.col("hour") * 3600.0).alias("b")).distinct().join(curve, "g")
    mapped = maps.full_mapping(downbeats, "b", maps.piecewise_correction(F.col("b"), F.col("curve")))
    return maps.proposal_map(mapped, ["g"], "b").select("g", scaled("x", 1).alias("x"), scaled("y", 100).alias("y"), "strict")


@query("""with h as (select hour // 24 as day, role, list_distinct(list(hour % 24)) v from EVENTS where event_id % 4 < 3 group by all) select a.day, a.role a, b.role b, cast(len(list_intersect(a.v, b.v)) as bigint) common, len(list_intersect(a.v, b.v))::double / len(list_distinct(list_concat(a.v, b.v)))::double >= 0.55::double as twins from h a join h b on a.day = b.day and a.role < b.role""")
def source_twins(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = events(spark, sf_dir).where("event_id % 4 < 3").groupBy(F.expr("hour div 24").alias("day"), "role").agg(F.collect_set(F.col("hour") % 24).alias("v"))
    share = lambda x, y: F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))
    got = joins.similar_sources(sets, ["day"], "role", "v", share, 0.55)
    both = sets.select("day", F.col("role").alias("a"), F.col("v").alias("va")).join(got, ["day", "a"]).join(sets.select("day", F.col("role").alias("b"), F.col("v").alias("vb")), ["day", "b"])
    return both.select("day", "a", "b", F.size(F.array_intersect("va", "vb")).cast("long").alias("common"), F.col("similar").alias("twins"))


@query("""with h as (select user_id % 30 g, hour, case when count(*) % 3 > 0 then 2 + count(*) % 3 end m from EVENTS group by all) select g, hour, coalesce(last_value(m ignore nulls) over (partition by g order by hour rows between unbounded preceding and current row), 4)::bigint ts_num from h""")
def timeline_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.count("*")
    headers = events(spark, sf_dir).groupBy((F.col("user_id") % 30).alias("g"), "hour").agg(F.when(n % 3 > 0, n % 3 + 2).alias("m"))
    measures, _ = tempo.song_timeline(headers, ["g"], "hour", "hour", "m")
    return measures.select("g", "hour", F.col("ts_num").cast("long").alias("ts_num"))


@query(f"""select event_id, {sql_scaled("t::double / 1000000::double + 12.5::double", 100)} shifted, {sql_scaled("3::double + (0.9::double + (event_id % 20)::double / 100::double) * value", 10000)} placed, {sql_scaled("case when event_id % 3 > 0 then 2::double + coalesce(case when event_id % 4 > 0 then 1.01::double end, 1::double) * (value - 1::double) else value end", 10000)} opened from EVENTS""")
def clock_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    known = i % 3 > 0
    opened = maps.opening_prior(F.col("value"), F.when(known, F.lit(1.0)), F.when(known, F.lit(2.0)), F.when(i % 4 > 0, 1.01))
    return events(spark, sf_dir).select("event_id", scaled(notation.shifted(F.col("t").cast("double") / 1e6, 12.5), 100).alias("shifted"), scaled(scoring.affine(F.col("value"), i % 20 / 100 + 0.9, F.lit(3.0)), 10_000).alias("placed"), scaled(opened, 10_000).alias("opened"))


@query(f"""with r as (select event_id, user_id % 300 g, (event_id % 40)::double cs, (event_id % 40)::double + value / 10::double ms, event_id % 5 n, event_id % 4 k, 1 + event_id % 2 nr, (event_id % 40)::double - 1::double rc, (event_id % 40)::double - 1::double + (event_id % 9)::double / 10::double ra from EVENTS),
f as (select *, nr = 1 and cs <= rc + 3::double and n >= 2 and k >= 2 and abs(ra - rc) <= 0.75::double and ms - ra between 0::double and 4::double fits from r), c as (select *, fits and cs = min(cs) filter (fits) over (partition by g) rec from f)
select event_id, coalesce(rec, false) reconciled, {sql_scaled("ms - case when rec then ms - ra else 0::double end", 1000)} midi_start from c""")
def opening_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    cs = (i % 40).cast("double")
    roles = F.when(i % 2 == 0, F.array(F.lit("a"))).otherwise(F.array(F.lit("a"), F.lit("b")))
    rows = events(spark, sf_dir).select("event_id", (F.col("user_id") % 300).alias("g"), cs.alias("chart_start"), (cs + F.col("value") / 10).alias("midi_start"), (cs + F.col("value")).alias("midi_end"), (i % 5).alias("controls"), (i % 4).alias("candidates"), roles.alias("roles"), (cs - 1.0).alias("role_chart_start"), (cs - 1.0 + i % 9 / 10).alias("role_audio_start"))
    return fusion.reconcile_opening(rows, ["g"]).select("event_id", "reconciled", scaled("midi_start").alias("midi_start"))


_CLASSES = "'matching_phrase_run', 'phrase_count_mismatch', 'other', 'probable_complete_run', 'another'"


@query(f"""with h as (select user_id % 12 g, hour e, count(*) n from EVENTS where event_id % 3 > 0 group by all), e as (select g, e, e * 3600::double a, e * 3600::double + (600 * n)::double z from h), r as (select event_id run, user_id % 12 g, t::double / 1000000::double - 1.7e9::double + 1.7e9::double a, t::double / 1000000::double + value * 60::double z, [{_CLASSES}][event_id % 5 + 1] c, (event_id % 10)::double / 10::double b from EVENTS where event_id % 3 = 0),
j as (select e.g, e.e, r.*, least(e.z, r.z) - greatest(e.a, r.a) shared from e join r on e.g = r.g and greatest(e.a, r.a) < least(e.z, r.z) + 0.000000001::double), k as (select g, e, bool_or(c = 'matching_phrase_run' and b >= 0.45::double) ex, bool_or(c in ('phrase_count_mismatch', 'probable_complete_run')) am, string_agg(run::varchar, ',' order by run) ids, arg_min(run, {{'s': -shared, 'a': a, 'run': run}}) dom from j group by g, e)
select e.g, e.e episode, coalesce(ex, false) exact_phrase, coalesce(am, false) ambiguous_phrase, coalesce(ids, '') runs, dom dominant_run from e left join k on e.g = k.g and e.e = k.e""")
def phrase_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumn("g", F.col("user_id") % 12)
    spans = e.where("event_id % 3 > 0").groupBy("g", F.col("hour").alias("episode")).agg((F.count("*") * 600.0).alias("d")).select("g", "episode", (F.col("episode") * 3600.0).alias("start"), (F.col("episode") * 3600.0 + F.col("d")).alias("stop"))
    kind = F.element_at(F.array(*(F.lit(c.strip("' ")) for c in _CLASSES.split(", "))), (F.col("event_id") % 5 + 1).cast("int"))
    x = F.col("t").cast("double") / 1e6
    runs = e.where("event_id % 3 = 0").select("g", F.col("event_id").alias("run"), x.alias("start"), (x + F.col("value") * 60).alias("stop"), kind.alias("classification"), (F.col("event_id") % 10 / 10).alias("boundary_score"))
    got = refine.phrase_context(spans, runs, ["g"], 7200.0)
    return got.select("g", "episode", "exact_phrase", "ambiguous_phrase", F.array_join("phrase_runs", ",").alias("runs"), "dominant_run")


@query()
def phase_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phase episodes of every user's day with root and phrase context; the order of runs has no SQL form here."""
    e = events(spark, sf_dir).select((F.col("user_id") % 60).alias("g"), "event_id", "role", (F.col("t") / 6e10).alias("x"), "value")
    controls = e.groupBy("g", F.floor("x").alias("k")).agg(F.min("x").alias("chart_time"), (F.avg("value") / 40).alias("offset"), F.count_distinct("role").alias("roles")).drop("k")
    gaps = e.where("event_id % 40 = 7").select("g", F.col("x").alias("start"), (F.col("x") + 2.0).alias("stop"), F.lit("phase_gap").alias("kind"))
    roots = e.groupBy("g").agg((F.min("value") < 2).alias("root_valid"), (F.min("value") / 40).alias("root_offset"))
    runs = e.where("event_id % 9 = 0").select("g", F.col("event_id").alias("run"), F.col("x").alias("start"), (F.col("x") + 6.0).alias("stop"), F.when(F.col("event_id") % 2 == 0, "matching_phrase_run").otherwise("phrase_count_mismatch").alias("classification"), F.lit(0.5).alias("boundary_score"))
    return refine.phase_episodes(controls, ["g"], gaps, roots=roots, runs=runs).drop("phrase_runs", "reasons")
