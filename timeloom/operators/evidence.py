"""Evidence: how far a role can be relied on, which scale to take, how proposals rank, what a piece's sections are worth."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timeloom.functions import robust, scoring
from timeloom.operators import gates

#: Fixed values.
QUALITY_SCORE = {"pre_roll": 0.72, "terminal_tail": 0.65, "unsupported": 0.08, "conflicting": 0.22, "structurally_uncertain": 0.34, "weak": 0.42, "average": 0.59, "good": 0.76, "strong": 0.91}


def role_reliability(rows: DataFrame, keys: list[str], accepted: str, residual: str, confidence: str) -> DataFrame:
    """Share of accepted rows, their median confidence and residual MAD (milliseconds), and the reliability made of them.

    A MAD that is null or 0 counts as 250.
    """
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.count(F.when(F.col(accepted), 1)).alias("n_accepted"), F.coalesce(F.median(F.when(F.col(accepted), F.col(confidence))), F.lit(0.0)).alias("confidence"))
    spread = robust.median_and_mad(rows.where(F.col(accepted)), keys, residual).drop("median")
    joined = counts.join(spread, keys, "left")
    wide = F.when(F.col("mad") != 0, F.col("mad")).otherwise(250.0)
    coverage = F.col("n_accepted") / F.col("n")
    return joined.withColumn("reliability", coverage * 0.35 + F.col("confidence") * 0.40 + F.lit(1.0) / (F.lit(1.0) + wide / 75.0) * 0.25)


def choose_scale(rows: DataFrame, keys: list[str], source: str, scale: str, coverage: str, events: str, priority: str, accepted: str, tolerance: float = 0.005) -> DataFrame:
    """One scale per key: that of the accepted source with most coverage, then events, then least priority.

    Where other accepted sources lie within ``tolerance`` of it, the mean of
    all these, weighted by coverage times events (1 at least); where none is
    accepted, 1. A key has as many rows as there are sources.
    """
    rank = F.struct(F.col(coverage).alias("c"), F.col(events).alias("e"), (-F.col(priority)).alias("p"), F.col(scale).alias("s"), F.col(source).alias("source"))
    best = F.max(F.when(F.col(accepted), rank)).over(Window.partitionBy(*keys))
    near = F.col(accepted) & (F.abs(F.col(scale) - F.col("_b.s")) <= tolerance)
    weighed = rows.withColumn("_b", best).withColumn("_w", F.when(near, F.greatest(F.lit(1.0), F.col(coverage) * F.col(events))))
    got = weighed.groupBy(*keys).agg(F.first("_b").alias("_b"), F.count("_w").alias("agreeing"), (F.sum(F.col(scale) * F.col("_w")) / F.sum("_w")).alias("_m"))
    return got.select(*keys, "agreeing", F.col("_b.source").alias("best"), F.when(F.col("agreeing") >= 2, F.col("_m")).otherwise(F.coalesce("_b.s", F.lit(1.0))).alias("scale"))


def rank_proposals(proposals: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Adds ``total`` and ``rank`` (1: best; then by name) to proposals.

    They hold improvement, base_mad, mad, controls, warnings, errors and jump:
    milliseconds and counts. Growth of the MAD, 5 a control, 15 a warning,
    1000 an error and a quarter of the jump over 60 are taken off the
    improvement; nulls count as 0.
    """
    value = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    worse = F.greatest(F.lit(0.0), value("mad") - value("base_mad"))
    total = value("improvement") - worse - value("controls") * 5 - value("warnings") * 15 - value("errors") * 1000 - F.greatest(F.lit(0.0), value("jump") - 60) * 0.25
    return proposals.withColumn("total", total).withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("total"), name)))


def quality_rollup(sections: DataFrame, keys: list[str], quality: str, length: str, scores: dict[str, float], steps: tuple[float, float, float] = (0.82, 0.67, 0.50)) -> DataFrame:
    """Per key the length-weighted mean of the scores of its sections' classes, and the class of that mean."""
    points: Column = F.element_at(F.create_map(*(F.lit(x) for pair in scores.items() for x in pair)), F.col(quality))
    parts = sections.groupBy(*keys, quality).agg(F.sum(length).alias("_n"))
    mean = F.sum(points * F.col("_n")) / F.sum("_n")
    got = parts.groupBy(*keys).agg(F.coalesce(mean, F.lit(0.0)).alias("confidence"))
    c = F.col("confidence")
    return got.withColumn("overall", F.when(c >= steps[0], "strong").when(c >= steps[1], "good").when(c >= steps[2], "average").otherwise("weak"))


def trend(rows: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """Per key n, span, median, mad and Theil-Sen slope (null: no two x differ); a key should hold a bounded number of points."""
    whole = rows.groupBy(*keys).agg(F.count("*").alias("n"), (F.max(x) - F.min(x)).alias("span"))
    return whole.join(robust.median_and_mad(rows, keys, y), keys).join(robust.theil_sen(rows, keys, x, y).drop("pairs"), keys, "left")


def half_shapes(rows: DataFrame, keys: list[str], x: str, y: str, fewest: int = 6) -> DataFrame:
    """Per key the trends of its first and second half in order of x, and whether both drift significantly in opposite directions.

    The first half has the smaller half of an odd number; a key with fewer than ``fewest`` rows does not reverse.
    """
    by = Window.partitionBy(*keys).orderBy(x, y)
    numbered = rows.withColumn("_i", F.row_number().over(by)).withColumn("_n", F.count("*").over(Window.partitionBy(*keys)))
    halves = numbered.withColumn("half", F.when(F.col("_i") <= F.floor(F.col("_n") / 2), 1).otherwise(2))
    made = trend(halves, [*keys, "half"], x, y).withColumn("_s", gates.significant_drift(F.col("n"), F.col("span"), F.col("slope")))
    one = lambda h, c: F.max(F.when(F.col("half") == h, F.col(c)))
    got = made.groupBy(*keys).agg(F.sum("n").alias("n"), one(1, "slope").alias("first_slope"), one(2, "slope").alias("second_slope"), (F.min("_s") & (F.count("*") == 2)).alias("_both"))
    turns = F.col("_both") & (F.col("first_slope") * F.col("second_slope") < 0) & (F.col("n") >= fewest)
    return got.withColumn("direction_reversal", F.coalesce(turns, F.lit(False))).drop("_both")


def fit_metrics(rows: DataFrame, keys: list[str], residual: str, correction: str) -> DataFrame:
    """Per proposal n, median absolute residual and MAD before and after its correction, and the improvement."""
    placed = rows.withColumn("_after", F.col(residual) - F.col(correction))
    sizes = placed.groupBy(*keys).agg(F.count("*").alias("n"), F.median(F.abs(F.col(residual))).alias("base_median"), F.median(F.abs(F.col("_after"))).alias("median_after"))
    before = robust.median_and_mad(placed, keys, residual).select(*keys, F.col("mad").alias("base_mad"))
    after = robust.median_and_mad(placed, keys, "_after").select(*keys, "mad")
    return sizes.join(before, keys).join(after, keys).withColumn("improvement", F.col("base_median") - F.col("median_after"))


def softmax(rows: DataFrame, keys: list[str], score: str) -> DataFrame:
    """Adds ``weight``: the share of exp(score) among the rows of the key, safe for large scores."""
    by = Window.partitionBy(*keys)
    raised = rows.withColumn("_e", F.exp(F.col(score) - F.max(score).over(by)))
    return raised.withColumn("weight", F.col("_e") / F.sum("_e").over(by)).drop("_e")


def choose_source(scored: DataFrame, agreement: DataFrame, keys: list[str], source: str, score: str, selected: float = 0.55, limits: tuple[float, float, float] = (75.0, 200.0, 400.0)) -> DataFrame:
    """Rows with softmax ``weight`` and, per key, ``mode``: one source is selected if it leads, is alone or sources disagree; else all are fused by weight.

    ``agreement``: median_ms, p95_ms and max_ms of each pair of sources.
    """
    weighed = softmax(scored, keys, score)
    fits = agreement.groupBy(*keys).agg(F.min((F.col("median_ms") <= limits[0]) & (F.col("p95_ms") <= limits[1]) & (F.col("max_ms") <= limits[2])).alias("_agree"))
    by = Window.partitionBy(*keys)
    top = F.row_number().over(by.orderBy(F.desc("weight"), source)) == 1
    joined = weighed.join(fits, keys, "left").withColumn("_agree", F.coalesce("_agree", F.lit(True))).withColumn("_n", F.count("*").over(by)).withColumn("_top", top)
    alone = (F.col("_n") == 1) | (F.max("weight").over(by) >= selected)
    mode = F.when((F.col("_n") == 1) | F.col("_agree"), F.when(alone, "selected").otherwise("probability_fusion")).otherwise("selected_due_to_disagreement")
    return joined.withColumn("mode", mode).withColumn("share", F.when(F.col("mode") == "probability_fusion", F.col("weight")).otherwise(F.col("_top").cast("double"))).drop("_agree", "_n", "_top")


def role_activity(rows: DataFrame, keys: list[str], role: str, time: str, fewest: int = 3, within: float = 8.0) -> DataFrame:
    """Per role count, first and last time, and whether it may speak for the opening of its song."""
    made = rows.groupBy(*keys, role).agg(F.count(time).alias("n"), F.min(time).alias("first"), F.max(time).alias("last"))
    return made.withColumn("opening_eligible", (F.col("n") >= fewest) & (F.col("first") <= F.min("first").over(Window.partitionBy(*keys)) + within))


def opening_role(groups: DataFrame, keys: list[str], role: str, time: str, symbols: str, horizon: float = 8.0, fewest: int = 5) -> DataFrame:
    """Per song the role that opens it and how: solo, dominant, ensemble or uncertain, by onset groups within the horizon."""
    opening = groups.withColumn("_o", F.min(time).over(Window.partitionBy(*keys))).where(F.col(time) <= F.col("_o") + horizon)
    counts = opening.groupBy(*keys, role).agg(F.count("*").alias("_n"), F.sum(F.size(symbols)).alias("_p"))
    by = Window.partitionBy(*keys).orderBy(F.desc("_n"), F.desc("_p"), role)
    ranked = counts.withColumn("_r", F.row_number().over(by)).withColumn("_second", F.coalesce(F.lead("_n").over(by), F.lit(0))).where("_r = 1")
    n, second = F.col("_n"), F.col("_second")
    kind = F.when(n < fewest, "uncertain").when((second == 0) | (n >= F.greatest(F.lit(3), second * 2)), "solo").when(n >= F.greatest(F.lit(1), second) * 1.35, "dominant").otherwise("ensemble")
    return ranked.select(*keys, kind.alias("classification"), F.when(kind.isin("solo", "dominant"), F.col(role)).alias(role), n.alias("groups"), second.alias("runner_up"))


def incipit_consensus(rows: DataFrame, keys: list[str], ident: str, radius: float = 8.0, limit: float = 20.0, most: int = 12) -> DataFrame:
    """The ``most`` best opening placements with ``consensus`` and ``rank``.

    Rows: score_time, audio_time, expected, observed (null: as expected), confidence, distinctiveness, margin, eligible, song_first.
    """
    apart = F.least(F.abs(F.col("audio_time") - F.col("expected")), F.abs(F.col("audio_time") - F.coalesce("observed", "expected")))
    unique = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.col("margin"), F.lit(0.0)) / 0.15))
    near = F.greatest(F.lit(0.0), 1.0 - apart / max(1.0, radius))
    made = rows.where(F.col("score_time") <= F.coalesce("song_first", F.lit(0.0)) + limit).withColumn("consensus", F.col("confidence") * 0.45 + F.col("distinctiveness") * 0.22 + unique * 0.18 + near * 0.15 - F.when(F.col("eligible"), 0.0).otherwise(0.12))
    return made.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("consensus"), ident))).where(F.col("rank") <= most)


def interpret_regions(regions: DataFrame) -> DataFrame:
    """Regions with classification, strategy and confidence, from aggregates of their trends.

    Columns: n, span, slope, median, eligible_families, significant_families, families_disagree, sources_disagree, scales_conflict,
    direction_reversal, mad.
    """
    drift = F.col("slope") * F.col("span")
    minor = F.coalesce(F.abs(drift) < 75, F.lit(False))
    strong = gates.significant_drift(F.col("n"), F.col("span"), F.col("slope"))
    clash = F.col("families_disagree") | F.col("sources_disagree")
    kind = (
        F.when(F.col("eligible_families") == 0, F.when((F.col("n") >= 4) & minor, "minor_local_variation").otherwise("insufficient_evidence")).when(F.col("direction_reversal"), "possible_nonlinear_timing").when(clash, "conflicting_evidence")
        .when((F.col("significant_families") > 0) | strong, "possible_drift").when(F.abs("median") >= 80, "possible_offset").when(minor, "minor_local_variation").otherwise("stable")
    )
    out = regions.withColumn("classification", kind)
    weak = F.col("classification").isin("conflicting_evidence", "insufficient_evidence")
    way = F.when(F.col("scales_conflict"), "test_regional_source_fusion").when(F.col("direction_reversal"), "test_structural_jump_then_regional_alignment").when(F.col("classification") == "possible_drift", "test_piecewise_regional_warp").when(weak, "manual_anchor_assisted").otherwise("retain_global_map")
    warned = clash | F.col("scales_conflict") | F.coalesce(F.col("mad") > 250, F.lit(False))
    return out.withColumn("strategy", way).withColumn("confidence", F.when((F.col("significant_families") >= 2) & ~warned, "high").when(~weak, "moderate").otherwise("low"))


def phase_rollup(episodes: DataFrame, keys: list[str], section: str, kind: str, priority: dict[str, int]) -> DataFrame:
    """Per section the kind of highest priority (least number) and how many episodes each kind has there."""
    order = F.element_at(F.create_map(*(F.lit(x) for pair in priority.items() for x in pair)), F.col(kind))
    return episodes.groupBy(*keys, section).agg(F.min_by(kind, F.struct(F.coalesce(order, F.lit(1 << 20)), kind)).alias("state"), F.count("*").alias("n"), *(F.count_if(F.col(kind) == k).alias(k) for k in priority))


def proposals(samples: DataFrame, keys: list[str], residual: str, time: str, measure: str, least_ms: float = 40.0, least_slope: float = 0.35, span: float = 8.0, fewest: int = 4) -> DataFrame:
    """Regional proposals (keys, method, offset_ms, slope): retain, a constant offset, a linear scale; a region gets those its samples justify.

    Correct a time by ``correction_of``.
    """
    size = samples.where(F.col(residual).isNotNull()).groupBy(*keys).agg(F.count("*").alias("n"), F.median(residual).alias("offset_ms"), (F.max(time) - F.min(time)).alias("_span"))
    line = robust.theil_sen_line(samples, keys, time, residual).select(*keys, "slope", "intercept")
    base = samples.select(*keys).distinct().select(*keys, F.lit("retain_baseline").alias("method"), F.lit(0.0).alias("offset_ms"), F.lit(0.0).alias("slope"))
    flat = size.where((F.col("n") >= fewest) & (F.abs("offset_ms") >= least_ms)).select(*keys, F.lit("regional_constant_offset").alias("method"), "offset_ms", F.lit(0.0).alias("slope"))
    tilted = size.where((F.col("n") >= fewest) & (F.col("_span") >= span)).join(line, keys).where(F.abs("slope") >= least_slope).select(*keys, F.lit("regional_linear_scale").alias("method"), F.col("intercept").alias("offset_ms"), "slope")
    return base.unionByName(flat).unionByName(tilted)


def correction_of(offset: Column, slope: Column, time: Column, measure: Column, first: Column, last: Column) -> Column:
    """Milliseconds by which a proposal moves a time: its line, tapered to nothing at the region's edges."""
    return (offset + slope * time) * scoring.taper(measure, first, last)


def eligibility(method: Column, status: Column, coverage: Column, long_gaps: Column) -> Column:
    """What a proposal may do for the whole song."""
    return F.when(method == "retain_baseline", "retain_baseline").when(status == "error", "rejected_by_safety_validation").when(coverage < 0.20, "partial_local_improvement_only").when(long_gaps > 0, "underconstrained_by_coverage_gaps").otherwise("carry_forward_for_piecewise_validation")


def normalise_observations(families: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """All evidence in one schema (keys, family, method, measure, accepted, residual_ms, roles, confidence); columns a family lacks are null."""
    kinds = {"method": "string", "measure": "bigint", "accepted": "boolean", "residual_ms": "double", "roles": "array<string>", "confidence": "double"}
    shaped = [df.select(*keys, F.lit(name).alias("family"), *((F.col(c).cast(k) if c in df.columns else F.lit(None).cast(k)).alias(c) for c, k in kinds.items())) for name, df in families.items()]
    return reduce(DataFrame.unionByName, shaped).withColumn("accepted", F.coalesce("accepted", F.lit(False)))


def one_vote(observations: DataFrame, keys: list[str], measure: str, residual: str, role: str) -> DataFrame:
    """One vote a measure: the median residual of its accepted rows and the roles behind it."""
    return observations.where("accepted").groupBy(*keys, measure).agg(F.median(residual).alias(residual), F.array_sort(F.collect_set(role)).alias("roles"), F.count("*").alias("n"))


def reversals(rows: DataFrame, keys: list[str], order: str, residual: str, least: float = 80.0) -> DataFrame:
    """Neighbouring measures whose residuals have opposite signs and lie at least ``least`` apart."""
    by = Window.partitionBy(*keys).orderBy(order)
    led = rows.withColumn("next", F.lead(order).over(by)).withColumn("next_residual", F.lead(residual).over(by))
    return led.where((F.col(residual) * F.col("next_residual") < 0) & (F.abs(F.col(residual) - F.col("next_residual")) >= least))


def annotate_measures(measures: DataFrame, observations: DataFrame, keys: list[str], measure: str) -> DataFrame:
    """Measures with the number of observations, accepted ones and their roles: supported, observed or not observed."""
    got = observations.groupBy(*keys, measure).agg(F.count("*").alias("observations"), F.count_if("accepted").alias("accepted_observations"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("roles")))).alias("roles"))
    joined = measures.join(got, [*keys, measure], "left").na.fill(0, ["observations", "accepted_observations"])
    return joined.withColumn("status", F.when(F.col("accepted_observations") > 0, "supported").when(F.col("observations") > 0, "observed").otherwise("not_observed"))
