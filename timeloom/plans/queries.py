"""Named queries over the driver's tables, with equivalent DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from timeloom.functions import robust, vectors
from timeloom.operators import evidence, gates, islands, joins, select, sequence, tempo
from timeloom.plans.registry import query
from timeloom.plans.registry import scaled as _scaled
from timeloom.plans.registry import sql_scaled as _sql_scaled
from timeloom.sources.tables import HOUR_US, events, micros, table
from timeloom.streaming import onsets

@query("""with g as (select *, case when t - lag(t) over w <= 1200000000 then 0 else 1 end s from EVENTS window w as (partition by role order by t, event_id)),
n as (select *, sum(s) over (partition by role order by t, event_id) group_no from g)
select role, cast(group_no as bigint) group_no, min(t) first_us, max(t) last_us, count(*) n from n group by all""")
def onset_group_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = islands.chain_groups(events(spark, sf_dir), ["role"], "t", 1_200_000_000, ["event_id"])
    return grouped.groupBy("role", "group_no").agg(F.min("t").alias("first_us"), F.max("t").alias("last_us"), F.count("*").alias("n"))


@query("""with recursive o as (select user_id, t, row_number() over (partition by user_id order by t) r from EVENTS),
f as (select user_id, t, r, t head from o where r = 1 union all select o.user_id, o.t, o.r, case when o.t - f.head > 7200000000 then o.t else f.head end from f join o on o.user_id = f.user_id and o.r = f.r + 1)
select user_id, head start_us, max(t) stop_us, count(*) n from f group by user_id, head""")
def onset_group_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = islands.head_groups(events(spark, sf_dir), ["user_id"], "t", 7_200_000_000)
    return got.select("user_id", F.col("start").alias("start_us"), F.col("stop").alias("stop_us"), "n")


_ROLE_HEADS = """with recursive o as (select role, t, row_number() over (partition by role order by t) r from EVENTS),
f as (select role, t, r, t head from o where r = 1 union all select o.role, o.t, o.r, case when o.t - f.head > 14400000000 then o.t else f.head end from f join o on o.role = f.role and o.r = f.r + 1)
select role, head first_us, max(t) last_us, count(*) n from f group by role, head"""


@query(_ROLE_HEADS)
def role_head_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few keys, each nearly one unbroken chain, dealt out in stretches."""
    got = islands.head_groups(events(spark, sf_dir), ["role"], "t", 14_400_000_000, 48 * HOUR_US)
    return got.select("role", F.col("start").alias("first_us"), F.col("stop").alias("last_us"), "n")


@query(_ROLE_HEADS)
def head_group_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of a stream of files, replayed to its end."""
    schema = table(spark, sf_dir, "events").schema
    files = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(f"{sf_dir}/*.parquet")
    rows = files.select(F.col("event_type").alias("role"), F.expr(f"timestamp_micros({micros('ts')})").alias("at"))
    return onsets.replay_heads(spark, onsets.head_groups(rows, ["role"], "at", 14_400_000_000, "1 hour"), ["role"])


@query("""with i as (select role, t s, t + cast(floor(value * 1000000::double) as bigint) e from EVENTS),
f as (select *, case when s <= max(e) over (partition by role order by s, e rows between unbounded preceding and 1 preceding) then 0 else 1 end n from i),
r as (select *, sum(n) over (partition by role order by s, e) region from f)
select role, min(s) start_us, max(e) stop_us, count(*) n from r group by role, region""")
def interval_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = events(spark, sf_dir).select("role", F.col("t").alias("s"), (F.col("t") + F.floor(F.col("value") * 1e6).cast("long")).alias("e"))
    return islands.merge_intervals(spans, ["role"], "s", "e").select("role", F.col("start").alias("start_us"), F.col("stop").alias("stop_us"), "n")


@query("""with h as (select distinct role, hour from EVENTS), n as (select *, lead(hour) over (partition by role order by hour) nx from h)
select role, hour + 1 as first_hour, nx - 1 as last_hour, nx - hour - 1 as n from n where nx > hour + 1""")
def coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = islands.coverage_gaps(events(spark, sf_dir), ["role"], "hour")
    return gaps.select("role", F.col("first").alias("first_hour"), F.col("last").alias("last_hour"), "n")


@query("""with m as (select role, hour, min(t) start_us from EVENTS where user_id % 2 = 0 group by all)
select e.event_id, m.hour as measure, m.start_us from EVENTS e asof left join m on e.role = m.role and e.t >= m.start_us""")
def asof_measure(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir)
    measures = rows.where("user_id % 2 = 0").groupBy("role", "hour").agg(F.min("t").alias("start_us")).select("role", F.col("hour").alias("measure"), "start_us")
    return joins.asof(rows.select("role", "event_id", "t"), measures, ["role"], "t", "start_us", ["measure", "start_us"], 24 * HOUR_US).select("event_id", "measure", "start_us")


@query("""with c as (select (t // 86400000000) * 86400000000 x from EVENTS group by all), k as (select x, x + (x // 86400000000 % 7) * 1000000 y from c),
p as (select *, lead(x) over (order by x) x2, lead(y) over (order by x) y2 from k)
select e.event_id, cast(floor(coalesce(p.y - p.x + ((e.t - p.x)::double * (p.y2 - p.y)::double / (p.x2 - p.x)::double) - (e.t - p.x)::double + (e.t - p.x)::double, (p.y - p.x + e.t - p.x)::double)) as bigint) offset_us
from EVENTS e asof left join p on e.t >= p.x""")
def warp_apply_lerp(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("event_id", "t")
    days = rows.select(F.expr("t div 86400000000 * 86400000000").alias("x")).distinct()
    controls = days.select("x", (F.col("x") + F.expr("x div 86400000000 % 7") * 1_000_000).alias("y"))
    by = Window.orderBy("x")  # one row per day
    pieces = controls.withColumn("x2", F.lead("x").over(by)).withColumn("y2", F.lead("y").over(by)).withColumn("k", F.lit(0))
    placed = joins.asof(rows.withColumn("k", F.lit(0)), pieces, ["k"], "t", "x", ["x", "y", "x2", "y2"], 24 * HOUR_US)
    within = (F.col("t") - F.col("x")).cast("double")
    line = (F.col("y") - F.col("x")) + within * (F.col("y2") - F.col("y")).cast("double") / (F.col("x2") - F.col("x")).cast("double") - within + within
    return placed.select("event_id", F.floor(F.coalesce(line, (F.col("y") - F.col("x") + F.col("t") - F.col("x")).cast("double"))).cast("long").alias("offset_us"))


@query("""with v as (select event_id id, t from EVENTS where role = 'view'), c as (select event_id other_id, t u from EVENTS where role = 'click'),
n as (select v.id, c.other_id, c.u - v.t residual, row_number() over (partition by v.id order by abs(c.u - v.t), c.u, c.other_id) r from v join c on c.u between v.t - 600000000 and v.t + 600000000)
select id, other_id, residual from n where r = 1""")
def nearest_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir)
    return joins.nearest_within(rows.where("role = 'view'"), rows.where("role = 'click'"), "event_id", "t", "event_id", "t", 600_000_000)


@query("""with r as (select o_orderpriority priority, (epoch_us(l_shipdate) - epoch_us(o_orderdate)) // 86400000000 - 60 d from lineitem join orders on l_orderkey = o_orderkey)
select priority, count(*) n, cast(floor(median(abs(d)) * 1000::double + 0.5::double) as bigint) median_abs, cast(floor(quantile_cont(abs(d), 0.95) * 1000::double + 0.5::double) as bigint) p95_abs, max(abs(d)) max_abs, cast(floor(median(d) * 1000::double + 0.5::double) as bigint) signed_median from r group by priority""")
def residual_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.expr(micros("l_shipdate")).alias("s"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("priority"), F.expr(micros("o_orderdate")).alias("o"))
    late = lines.join(orders, "k").select("priority", (F.expr("(s - o) div 86400000000") - 60).alias("d"))
    got = robust.residual_metrics(late, ["priority"], "d")
    return got.select("priority", "n", _scaled("median_abs").alias("median_abs"), _scaled("p95_abs").alias("p95_abs"), "max_abs", _scaled("signed_median").alias("signed_median"))


@query("""with s as (select l_suppkey supplier, l_extendedprice v, sum(cast(l_quantity as bigint)) w from lineitem group by all),
r as (select *, sum(w) over (partition by supplier order by v) run, sum(w) over (partition by supplier) total from s)
select supplier, cast(floor(min(v) * 1000::double + 0.5::double) as bigint) price from r where run * 2 >= total group by supplier""")
def weighted_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("supplier"), F.col("l_extendedprice").alias("v"), F.col("l_quantity").cast("long").alias("w"))
    return robust.weighted_median(lines, ["supplier"], "v", "w").select("supplier", _scaled("weighted_median").alias("price"))


@query("""with m as (select role, median(value) m from EVENTS group by role)
select role, cast(floor(any_value(m) * 1000::double + 0.5::double) as bigint) median, cast(floor(median(abs(value - m)) * 1000::double + 0.5::double) as bigint) mad from EVENTS e join m using (role) group by role""")
def median_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = robust.median_and_mad(events(spark, sf_dir), ["role"], "value")
    return got.select("role", _scaled("median").alias("median"), _scaled("mad").alias("mad"))


@query("""with o as (select o_custkey customer, epoch_us(o_orderdate) // 86400000000 x, cast(floor(o_totalprice * 100::double + 0.5::double) as bigint) y from orders)
select a.customer, cast(floor(median((b.y - a.y)::double / (b.x - a.x)::double) * 1000::double + 0.5::double) as bigint) slope, count(*) pairs from o a join o b on a.customer = b.customer and b.x > a.x group by a.customer""")
def theil_sen_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("customer"), F.expr(f"{micros('o_orderdate')} div 86400000000").alias("x"), F.floor(F.col("o_totalprice") * 100 + 0.5).cast("long").alias("y"))
    return robust.theil_sen(orders, ["customer"], "x", "y").select("customer", _scaled("slope").alias("slope"), "pairs")


@query("""with r as (select s_nationkey nation, s_suppkey best, cast(floor(s_acctbal * 100::double + 0.5::double) as bigint) score from supplier),
o as (select *, row_number() over w n, lead(score) over w runner from r window w as (partition by nation order by score desc, best))
select nation, best, score, score - runner as margin from o where n = 1""")
def best_second_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), "s_suppkey", F.floor(F.col("s_acctbal") * 100 + 0.5).cast("long").alias("balance"))
    return robust.best_and_margin(rows, ["nation"], "s_suppkey", "balance")


@query("""with h as (select role, hour, list_distinct(list(user_id)) u from EVENTS group by all)
select a.role, a.hour, cast(len(list_intersect(a.u, b.u)) as bigint) common, cast(len(a.u) + len(b.u) - len(list_intersect(a.u, b.u)) as bigint) whole from h a join h b on a.role = b.role and b.hour = a.hour + 1""")
def set_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = events(spark, sf_dir).groupBy("role", "hour").agg(F.collect_set("user_id").alias("u"))
    after = sets.select("role", (F.col("hour") - 1).alias("hour"), F.col("u").alias("w"))
    common = F.size(F.array_intersect("u", "w")).cast("long")
    return sets.join(after, ["role", "hour"]).select("role", "hour", common.alias("common"), (F.size("u") + F.size("w") - common).cast("long").alias("whole"))


@query("""select a.vec_id, cast(floor(list_cosine_similarity(a.embedding::double[], b.embedding::double[]) * 1000000::double + 0.5::double) as bigint) cosine from embeddings a join embeddings b on b.vec_id = a.vec_id + 1""")
def cosine_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), F.col("x").alias("y"))
    likeness = vectors.dot(F.col("x"), F.col("y")) / F.sqrt(vectors.dot(F.col("x"), F.col("x")) * vectors.dot(F.col("y"), F.col("y")))
    return a.join(b, "vec_id").select("vec_id", _scaled(likeness, 1_000_000).alias("cosine"))


@query("""with c as (select conv_id, turn, role, case when role is not distinct from lag(role) over w and row_number() over w > 1 then 0 else 1 end s from conversations window w as (partition by conv_id order by turn))
select conv_id, turn, cast(sum(s) over (partition by conv_id order by turn) as bigint) run_no, row_number() over (partition by conv_id, role order by turn) occurrence from c""")
def repeat_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return islands.runs(turns, ["conv_id"], ["turn"], F.col("role")).select("conv_id", "turn", "run_no", F.col("occurrence").cast("long").alias("occurrence"))


@query("""with h as (select role, hour, count(*) n from EVENTS group by all)
select role, hour, n, cast(sum(n) over (partition by role order by hour range between 2 preceding and 2 following) - n as bigint) support from h""")
def neighbour_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = events(spark, sf_dir).groupBy("role", "hour").agg(F.count("*").alias("n"))
    near = F.sum("n").over(Window.partitionBy("role").orderBy("hour").rangeBetween(-2, 2))
    return hours.select("role", "hour", "n", (near - F.col("n")).alias("support"))


@query("""with h as (select role, hour, min(t) t from EVENTS group by all)
select a.role, a.hour, count(b.role) supported_by from h a left join h b on a.hour = b.hour and a.role <> b.role and abs(a.t - b.t) <= 600000000 group by all""")
def cross_role_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = events(spark, sf_dir).groupBy("role", "hour").agg(F.min("t").alias("t"))
    other = first.select("hour", F.col("role").alias("other"), F.col("t").alias("u"))
    near = (F.col("role") != F.col("other")) & (F.abs(F.col("t") - F.col("u")) <= 600_000_000)
    return first.join(other, "hour").groupBy("role", "hour").agg(F.count(F.when(near, 1)).alias("supported_by"))


@query("""with h as (select role, hour, count(*) n from EVENTS group by all)
select a.role a, b.role b, count(*) n, cast(floor(median(abs(a.n - b.n)) * 1000::double + 0.5::double) as bigint) median_abs, max(abs(a.n - b.n)) max_abs from h a join h b on a.hour = b.hour and a.role < b.role group by all""")
def pairwise_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = events(spark, sf_dir).groupBy("role", "hour").agg(F.count("*").alias("n"))
    pairs = joins.self_pairs(hours, ["hour"], "role", "n").withColumn("d", F.abs(F.col("va") - F.col("vb")))
    got = pairs.groupBy("a", "b").agg(F.count("*").alias("n"), F.median("d").alias("m"), F.max("d").alias("max_abs"))
    return got.select("a", "b", "n", _scaled("m").alias("median_abs"), "max_abs")


@query("""select role, count(*) n, sum(cast(json_extract(props, '$.k') as bigint)) total from EVENTS group by role""")
def nested_score_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = events(spark, sf_dir).groupBy("role", "hour").agg(F.to_json(F.collect_list(F.struct("event_id", F.get_json_object("props", "$.k").cast("long").alias("k")))).alias("notes"))
    flat = nested.select("role", F.explode(F.from_json("notes", "array<struct<event_id:bigint,k:bigint>>")).alias("note"))
    return flat.groupBy("role").agg(F.count("*").alias("n"), F.sum("note.k").alias("total"))


@query("""select l_orderkey, l_linenumber, cast(sum(cast(l_quantity as bigint) * 60000 // (60 + l_linenumber)) over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey rows between unbounded preceding and current row) as bigint) ms from lineitem""")
def tempo_integral(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    by = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey").rowsBetween(Window.unboundedPreceding, 0)
    return lines.select("l_orderkey", "l_linenumber", F.sum(F.expr("cast(l_quantity as bigint) * 60000 div (60 + l_linenumber)")).over(by).alias("ms"))


@query("""with w as (select doc_id, string_split_regex(trim(regexp_replace(coalesce(text, ''), '[ \\t\\n\\r]+', ' ', 'g'), ' '), ' ') w from documents)
select doc_id, cast(case when w = [''] then 0 else len(w) end as bigint) tokens from w""")
def lyric_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.expr(r"split(trim(' ' from regexp_replace(coalesce(text, ''), '[ \\t\\n\\r]+', ' ')), ' ')")
    rows = table(spark, sf_dir, "documents").select("doc_id", words.alias("w"))
    return rows.select("doc_id", F.when(F.col("w") == F.array(F.lit("")), 0).otherwise(F.size("w")).cast("long").alias("tokens"))


@query("""with recursive o as (select p_brand brand, p_partkey::double pos, p_retailprice sc, row_number() over (partition by p_brand order by p_retailprice desc, p_partkey) r from part), f as (select brand, r, [pos] kept, sc, true k from o where r = 1
union all select o.brand, o.r, case when len(list_filter(f.kept, lambda p: abs(p - o.pos) < 50)) = 0 then list_append(f.kept, o.pos) else f.kept end, o.sc, len(list_filter(f.kept, lambda p: abs(p - o.pos) < 50)) = 0 from f join o on o.brand = f.brand and o.r = f.r + 1) select brand, cast(len(kept) - 1 as int) as rank, kept[-1] as position, sc as score from f where k""")
def nms_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(F.col("p_brand").alias("brand"), F.col("p_partkey").alias("position"), F.col("p_retailprice").alias("score"))
    return select.suppress(parts, ["brand"], "position", "score", 50.0)


@query("""with d as (select role, t // 86400000000 as day, min(t) t from EVENTS group by all), n as (select *, lead(t) over (partition by role order by day) - t gap from d)
select role, day, cast(last_value(4 * 60000000000 // gap ignore nulls) over (partition by role order by day rows between unbounded preceding and current row) as bigint) milli_bpm from n""")
def dense_tempo(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = events(spark, sf_dir).groupBy("role", F.expr("t div 86400000000").alias("day")).agg(F.min("t").alias("t"))
    paced = tempo.dense_tempo(days, ["role"], "t", F.lit(4), 1e9, float("nan"))
    return paced.select("role", "day", F.when(~F.isnan("bpm"), F.floor("bpm").cast("long")).alias("milli_bpm"))


@query("""with h as (select role, hour, min(t) t from EVENTS group by all), n as (select *, lead(t) over (partition by role order by hour) nx from h)
select role, cast(i as bigint) sub, t + (nx - t) * i // 4 as beat_us, case when i = 0 then hour else -1 end measure from n, range(4) r(i) where nx is not null""")
def explicit_beats(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = events(spark, sf_dir).groupBy("role", "hour").agg(F.min("t").alias("t"))
    bars = hours.withColumn("nx", F.lead("t").over(Window.partitionBy("role").orderBy("hour"))).where("nx is not null")
    split = bars.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(3))))
    return split.select("role", F.col("i").cast("long").alias("sub"), F.expr("t + (nx - t) * i div 4").alias("beat_us"), F.expr("if(i = 0, hour, -1L)").alias("measure"))


@query("""with h as (select distinct role, hour from EVENTS), n as (select *, lag(hour) over (partition by role order by hour) p from h)
select role, hour, hour - p - 1 as silent from n where hour - p > 1""")
def restart_after_silence(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = events(spark, sf_dir).select("role", "hour").distinct()
    quiet = F.col("hour") - F.lag("hour").over(Window.partitionBy("role").orderBy("hour"))
    return hours.withColumn("silent", quiet - 1).where("silent > 0")


@query("""with o as (select o_custkey % 100 k, count(*) orders, sum(o_orderkey) a from orders group by all), l as (select l_suppkey % 150 k, count(*) lines, sum(l_orderkey) b from lineitem group by all)
select coalesce(o.k, l.k) as k, orders, lines, cast((coalesce(a, b) + coalesce(b, a)) // 2 as bigint) centre from o full join l on o.k = l.k""")
def dual_centre_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "orders").groupBy(F.expr("o_custkey % 100").alias("k")).agg(F.count("*").alias("orders"), F.sum("o_orderkey").alias("a"))
    b = table(spark, sf_dir, "lineitem").groupBy(F.expr("l_suppkey % 150").alias("k")).agg(F.count("*").alias("lines"), F.sum("l_orderkey").alias("b"))
    return a.join(b, "k", "full").select("k", "orders", "lines", F.expr("(coalesce(a, b) + coalesce(b, a)) div 2").alias("centre"))


@query("""with s as (select s_nationkey nation, sum(cast(floor(s_acctbal * 100::double + 0.5::double) as bigint)) v from supplier group by all)
select nation, cast(floor(exp((v - max(v) over ())::double / 1000000::double) / sum(exp((v - (select max(v) from s))::double / 1000000::double)) over () * 1000000::double + 0.5::double) as bigint) weight from s""")
def softmax_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(F.sum(F.floor(F.col("s_acctbal") * 100 + 0.5).cast("long")).alias("v"))
    top = scores.agg(F.max("v").alias("top"))
    raised = scores.join(F.broadcast(top)).withColumn("e", F.exp((F.col("v") - F.col("top")).cast("double") / 1e6))
    whole = raised.agg(F.sum("e").alias("whole"))
    return raised.join(F.broadcast(whole)).select("nation", F.floor(F.col("e") / F.col("whole") * 1e6 + 0.5).cast("long").alias("weight"))


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event, keyed by role and day: candidates of the hour's layer as the path kernels take them."""
    return events(spark, sf_dir).select("role", F.expr("hour div 24").alias("day"), "hour", "event_id", "t", (F.col("value") / (F.col("value") + 10)).alias("confidence"), (F.expr(f"t % {HOUR_US}") / 1e7).alias("residual_ms"))


@query()
def viterbi_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.viterbi_path(_candidates(spark, sf_dir), ["role", "day"], "hour", "event_id")


@query()
def beam_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.beam_path(_candidates(spark, sf_dir).withColumnRenamed("t", "position"), ["role", "day"], "hour", "event_id", float(HOUR_US))


@query()
def chain_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _candidates(spark, sf_dir).select("role", "day", "event_id", (F.col("hour") * HOUR_US).alias("x"), F.col("t").alias("y"), F.col("confidence").alias("score"))
    return sequence.chain_path(points, ["role", "day"], "event_id")


@query()
def banded_dtw(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = events(spark, sf_dir).groupBy(F.expr("hour div 24").alias("day"), "hour").agg(F.count(F.when(F.col("role") == "view", 1)).alias("views"), F.count(F.when(F.col("role") == "click", 1)).alias("clicks"))
    return sequence.warp_series(hours, ["day"], "hour", "views", "clicks", 4.0, 0.5, 0.25)


@query()
def ordered_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    heard = events(spark, sf_dir).where("role in ('view', 'click')").groupBy(F.expr("hour div 24").alias("day"), "hour", F.expr("cast(role = 'click' as int)").alias("side"))
    return sequence.align_sets(heard.agg(F.sort_array(F.collect_set(F.expr("user_id % 128"))).alias("members")), ["day"], "hour", "side", "members")


@query("""with c as (select cast((t // 86400000000) * 86400000000 as double) x, any_value(t // 86400000000 % 7) d from EVENTS group by all), k as (select x, x + d * 1000000::double y from c),
p as (select *, lead(x) over (order by x) x2, lead(y) over (order by x) y2 from k),
i as (select event_id, t::double a, t::double + floor(value * 1000000::double) b from EVENTS),
m as (select i.event_id, coalesce(p.y + (i.a - p.x) * (p.y2 - p.y) / (p.x2 - p.x), p.y + i.a - p.x, i.a) s, i.b from i asof left join p on i.a >= p.x),
n as (select m.event_id, s, coalesce(p.y + (m.b - p.x) * (p.y2 - p.y) / (p.x2 - p.x), p.y + m.b - p.x, m.b) e from m asof left join p on m.b >= p.x)
select event_id, cast(floor(s) as bigint) start_us, cast(floor(greatest(30000::double, e - s)) as bigint) sustain_us from n""")
def warp_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("event_id", F.col("t").cast("double").alias("a"), (F.col("t").cast("double") + F.floor(F.col("value") * 1e6).cast("double")).alias("b"))
    days = events(spark, sf_dir).select(F.expr("t div 86400000000").alias("d")).distinct()
    controls = days.select((F.col("d") * 86_400_000_000).cast("double").alias("x")).withColumn("y", F.col("x") + F.expr("cast(x as bigint) div 86400000000 % 7") * F.lit(1e6))
    begun = joins.apply_map(rows, "a", controls, "s", 24 * HOUR_US)
    both = joins.apply_map(begun, "b", controls, "e", 24 * HOUR_US)
    return both.select("event_id", F.floor("s").cast("long").alias("start_us"), F.floor(F.greatest(F.lit(30000.0), F.col("e") - F.col("s"))).cast("long").alias("sustain_us"))


@query(f"""with h as (select role, hour, hour * {HOUR_US} n, min(t) w from EVENTS group by all),
d as (select *, (lead(w) over o - w)::double len, (lead(n) over o - n)::double plan from h window o as (partition by role order by n)),
f as (select *, coalesce(len <= 0 or len < 200000 or len / plan < 0.3::double or len / plan > 2::double or 240000000::double / len > 400, false) flag from d),
b as (select *, flag or coalesce(lag(flag) over (partition by role order by n), false) bad from f),
p as (select *, last_value(case when not bad then {{'n': n::double, 'w': w::double}} end ignore nulls) over (partition by role order by n rows between unbounded preceding and 1 preceding) l,
 first_value(case when not bad then {{'n': n::double, 'w': w::double}} end ignore nulls) over (partition by role order by n rows between 1 following and unbounded following) r from b)
select role, hour, cast(bad as int) bad, cast(floor(case when bad and r.w > l.w then l.w + (n::double - l.n) / (r.n - l.n) * (r.w - l.w) else w::double end) as bigint) clean_us from p""")
def sanitize_downbeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = events(spark, sf_dir).groupBy("role", "hour").agg(F.min("t").alias("w")).withColumn("n", F.col("hour") * HOUR_US)
    got = gates.sanitize_intervals(first, ["role"], "n", "w", F.lit(4), 1e6)
    return got.select("role", "hour", F.col("bad").cast("int").alias("bad"), F.floor("clean").cast("long").alias("clean_us"))


@query(f"""with v as (select event_id id, t from EVENTS where role = 'view'), c as (select event_id other_id, t u from EVENTS where role = 'click'),
n as (select v.id, v.t, c.u - v.t residual, row_number() over (partition by v.id order by abs(c.u - v.t), c.u, c.other_id) r from v join c on c.u between v.t - 600000000 and v.t + 600000000),
k as (select (t + {HOUR_US // 2}) // {HOUR_US} checkpoint, residual from n where r = 1), s as (select * from k where checkpoint % 4 = 0),
m as (select checkpoint, count(*) n, median(residual) med from s group by checkpoint),
g as (select checkpoint, any_value(n) n, any_value(med) med, median(abs(residual - med)) mad from s join m using (checkpoint) group by checkpoint)
select checkpoint, n, case when n >= 3 then cast(floor(med) as bigint) end as median_us, case when n >= 3 then cast(floor(mad) as bigint) end as mad_us, cast(n >= 3 and abs(med) <= 600000000 and mad <= 240000000 as int) accepted from g""")
def checkpoint_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir)
    views = rows.where("role = 'view'")
    near = joins.nearest_within(views, rows.where("role = 'click'"), "event_id", "t", "event_id", "t", 600_000_000)
    placed = near.join(views.select(F.col("event_id").alias("id"), F.expr(f"(t + {HOUR_US // 2}) div {HOUR_US}").alias("checkpoint")).where("checkpoint % 4 = 0"), "id")
    got = gates.checkpoint_gate(placed, ["checkpoint"], "residual", 600e6, 240e6)
    return got.select("checkpoint", "n", F.floor("median").cast("long").alias("median_us"), F.floor("mad").cast("long").alias("mad_us"), F.col("accepted").cast("int").alias("accepted"))


@query(f"""with r as (select role, value >= 5::double ok, (t % {HOUR_US})::double / 10000000::double res, value / (value + 10::double) c from EVENTS),
m as (select role, median(res) m from r where ok group by role), d as (select role, median(abs(res - m)) mad from r join m using (role) where ok group by role),
a as (select role, count(*) n, count(*) filter (ok) n_accepted, coalesce(median(c) filter (ok), 0::double) confidence from r group by role)
select role, n, n_accepted, {_sql_scaled("n_accepted::double / n::double * 0.35::double + confidence * 0.4::double + 1::double / (1::double + (case when mad <> 0 then mad else 250::double end) / 75::double) * 0.25::double", 1000000)} reliability from a left join d using (role)""")
def role_reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("role", (F.col("value") >= 5).alias("ok"), (F.expr(f"t % {HOUR_US}") / 1e7).alias("res"), (F.col("value") / (F.col("value") + 10)).alias("c"))
    got = evidence.role_reliability(rows, ["role"], "ok", "res", "c")
    return got.select("role", "n", "n_accepted", _scaled("reliability", 1_000_000).alias("reliability"))


@query(f"""with s as (select hour // 24 as day, role, count(*) n, count(distinct hour)::double / 24::double cov, (max(t) - min(t))::double / ((max(hour) - min(hour)) * {HOUR_US})::double scale from EVENTS group by all having max(hour) > min(hour)),
g as (select *, n >= 12 and cov >= 0.3::double and scale between 0.95::double and 1.05::double ok from s),
b as (select day, max_by(role, {{'c': cov, 'e': n, 's': scale, 'r': role}}) filter (ok) best, max_by(scale, {{'c': cov, 'e': n, 's': scale, 'r': role}}) filter (ok) bs from g group by day),
w as (select g.day, best, bs, scale, case when ok and abs(scale - bs) <= 0.005::double then greatest(1::double, cov * n::double) end w from g join b on g.day = b.day)
select day, best, count(w) agreeing, {_sql_scaled("case when count(w) >= 2 then sum(scale * w) / sum(w) else coalesce(any_value(bs), 1::double) end", 1000000)} scale from w group by day, best""")
def scale_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = events(spark, sf_dir).groupBy(F.expr("hour div 24").alias("day"), "role").agg(F.count("*").alias("n"), (F.count_distinct("hour") / 24).alias("cov"), (F.max("t") - F.min("t")).cast("double").alias("d"), ((F.max("hour") - F.min("hour")) * HOUR_US).cast("double").alias("p"))
    rows = seen.where("p > 0").withColumn("scale", F.col("d") / F.col("p")).withColumn("same", F.lit(0))
    gated = gates.with_reasons(rows, {"insufficient_events": F.col("n") < 12, "insufficient_coverage": F.col("cov") < 0.3, "implausible_scale": ~F.col("scale").between(0.95, 1.05)})
    got = evidence.choose_scale(gated, ["day"], "role", "scale", "cov", "n", "same", "accepted")
    return got.select("day", "best", "agreeing", _scaled("scale", 1_000_000).alias("scale"))


@query("""with w as (select role, hour, min(t) a from EVENTS where user_id % 2 = 0 group by all), x as (select *, lead(a) over (partition by role order by a) z from w),
e as (select event_id, role, t + cast(floor(value * 1000000::double) as bigint) // 2 as mid from EVENTS where user_id % 2 = 1)
select e.event_id, x.hour as word, row_number() over (partition by e.role, x.hour order by e.mid, e.event_id) - 1 as ordinal from e asof join x on e.role = x.role and e.mid >= x.a where e.mid < x.z""")
def midpoint_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir)
    words = rows.where("user_id % 2 = 0").groupBy("role", F.col("hour").alias("word")).agg(F.min("t").alias("a"))
    words = words.withColumn("z", F.lead("a").over(Window.partitionBy("role").orderBy("a")))
    notes = rows.where("user_id % 2 = 1").select("event_id", "role", (F.col("t") + F.expr("cast(floor(value * 1e6D) as bigint) div 2")).alias("mid"))
    inside = joins.asof(notes, words, ["role"], "mid", "a", ["word", "z"], 24 * HOUR_US).where("mid < z")
    by = Window.partitionBy("role", "word").orderBy("mid", "event_id")
    return inside.select("event_id", "word", (F.row_number().over(by) - 1).cast("long").alias("ordinal"))


@query(f"""with s as (select unnest([role, 'any']) grp, user_id, hour // 24 as day, t x, cast(floor(value * 100::double + 0.5::double) as bigint) y from EVENTS),
m as (select grp, user_id, day, count(*) n, max(x) - min(x) span_us, median(y) med from s group by all),
d as (select grp, user_id, day, median(abs(y - med)) mad from s join m using (grp, user_id, day) group by all),
l as (select a.grp, a.user_id, a.day, median((b.y - a.y)::double / (b.x - a.x)::double) slope from s a join s b on a.grp = b.grp and a.user_id = b.user_id and a.day = b.day and b.x > a.x group by all)
select grp, user_id, day, n, span_us, {_sql_scaled("med")} median, {_sql_scaled("mad")} mad, {_sql_scaled("slope * 3600000000::double")} slope_hour from m join d using (grp, user_id, day) left join l using (grp, user_id, day)""")
def trend_by_exploded_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select(F.explode(F.array("role", F.lit("any"))).alias("grp"), "user_id", F.expr("hour div 24").alias("day"), F.col("t").alias("x"), F.floor(F.col("value") * 100 + 0.5).cast("long").alias("y"))
    got = evidence.trend(rows, ["grp", "user_id", "day"], "x", "y").withColumn("slope_hour", F.col("slope") * 3.6e9)
    return got.select("grp", "user_id", "day", "n", F.col("span").alias("span_us"), _scaled("median").alias("median"), _scaled("mad").alias("mad"), _scaled("slope_hour").alias("slope_hour"))


@query(f"""with r as (select role, hour // 24 as day, (t % 400000000)::double / 1000000::double - 200::double x from EVENTS),
m as (select role, day, median(x) c, median(abs(x)) a from r group by all), k as (select role, day, any_value(c) c, any_value(a) a, median(abs(x - c)) d from r join m using (role, day) group by all),
p as (select role, day, 'baseline' as method, 0::double total from k union all
select role, day, 'offset', a - d - 10::double - case when abs(c) >= 60 then 15::double else 0::double end - case when abs(c) >= 180 then 1000::double else 0::double end - greatest(0::double, abs(c) - 60::double) * 0.25::double from k)
select role, day, method, {_sql_scaled("total")} total, row_number() over (partition by role, day order by total desc, method) as rank from p""")
def proposal_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("role", F.expr("hour div 24").alias("day"), (F.expr("t % 400000000").cast("double") / 1e6 - 200).alias("x"))
    keys = ["role", "day"]
    fits = robust.median_and_mad(rows, keys, "x").join(rows.groupBy(*keys).agg(F.median(F.abs("x")).alias("a")), keys)
    size = F.abs("median")
    zero = {c: F.lit(0.0) for c in ("improvement", "base_mad", "mad", "controls", "warnings", "errors", "jump")}
    moved = zero | {"improvement": F.col("a") - F.col("mad"), "controls": F.lit(2.0), "warnings": F.when(size >= 60, 1.0).otherwise(0.0), "errors": F.when(size >= 180, 1.0).otherwise(0.0), "jump": size}
    made = [fits.select(*keys, F.lit(method).alias("method"), *(c.alias(n) for n, c in columns.items())) for method, columns in (("baseline", zero), ("offset", moved))]
    got = evidence.rank_proposals(made[0].unionByName(made[1]), keys, "method")
    return got.select(*keys, "method", _scaled("total").alias("total"), F.col("rank").cast("long").alias("rank"))


@query(f"""with h as (select role, hour, case when count(*) >= 4 then 'strong' when count(*) = 3 then 'good' when count(*) = 2 then 'average' else 'weak' end q, max(t) - min(t) + 1 as len from EVENTS group by all),
s as (select role, q, sum(len) n from h group by all),
c as (select role, sum((case q when 'strong' then 0.91::double when 'good' then 0.76::double when 'average' then 0.59::double else 0.42::double end) * n::double) / sum(n)::double c from s group by role)
select role, {_sql_scaled("c")} confidence, case when c >= 0.82::double then 'strong' when c >= 0.67::double then 'good' when c >= 0.5::double then 'average' else 'weak' end overall from c""")
def quality_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.count("*")
    quality = F.when(n >= 4, "strong").when(n == 3, "good").when(n == 2, "average").otherwise("weak")
    hours = events(spark, sf_dir).groupBy("role", "hour").agg(quality.alias("q"), (F.max("t") - F.min("t") + 1).alias("len"))
    got = evidence.quality_rollup(hours, ["role"], "q", "len", evidence.QUALITY_SCORE)
    return got.select("role", _scaled("confidence").alias("confidence"), "overall")


@query("""with g as (select *, case when t - lag(t) over w <= 1200000000 then 0 else 1 end s from EVENTS window w as (partition by role order by t, event_id)),
n as (select *, sum(s) over (partition by role order by t, event_id) group_no from g)
select role, min(t) first_us, max(t) last_us, count(*) n from n group by role, group_no""")
def onset_group_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream of files, replayed to its end."""
    schema = table(spark, sf_dir, "events").schema
    files = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(f"{sf_dir}/*.parquet")
    rows = files.select(F.col("event_type").alias("role"), F.expr(f"timestamp_micros({micros('ts')})").alias("at"))
    return onsets.replay(spark, onsets.chain_groups(rows, ["role"], "at", 1_200_000_000, "1 hour"))
