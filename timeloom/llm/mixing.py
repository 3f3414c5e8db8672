"""Mixing sources to target weights by systematic sampling.

A document's size is its number of words. Sources, in order of code points
with null last, take the weights in turn and share the whole; no source gives
more than ``most`` times its size, and what it can't take goes to the others
by weight.

Within a source every document expects the same number of copies, target over
size. Documents stand by falling size, so that each run of similar documents
is sampled alike; the running sum of the expected copies, moved by one random
offset of the source, gives a copy for each integer that it crosses. The
copies of any run of documents are then within one of what it expects, so
what a source gives misses its target by less than its largest document.

Ranks come from one range shuffle of (source, size, doc_id), so a source that
holds most rows is dealt out as any other. Sums and copies are exact integers.

Defined results: a null text has no words; a null source is a source of its
own; rows with the same doc_id are documents of their own; an empty table
gives no rows; documents of size 0 take part and give 0 words; other columns
are not read.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timeloom.llm.runtime import cut

WORDS = r"[^\x20\x09-\x0D]+"
PARTS = 65_536  # of one copy, in which the offset is drawn
SMALL = 100_000  # sources up to which their table is broadcast
KEY = ("source", "size", "doc_id", "text_hash")


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Rows with their place (from 0) in the order, counted by range partitions rather than in one task."""
    dealt = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33)
    sizes = dealt.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    joined = dealt.withColumn("_part", part).join(F.broadcast(before), "_part")  # one row per partition
    return joined.select(*rows.columns, (F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).alias(name))


def _exact(value: int | Column) -> Column:
    return (F.lit(Decimal(value)) if isinstance(value, int) else value).cast("decimal(38,0)")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """``source``, ``source_size``, ``target`` and a document's expected copies as ``up`` / ``down``."""
    summed = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = numbered(summed, [F.col("source").asc_nulls_last()], "rank")
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = cut(ranked.select("source", "source_size", turn.cast("long").alias("weight"), (F.col("source_size") * most).alias("ceiling")))
    whole = sources.agg(F.sum("source_size").alias("all"), F.sum("weight").alias("weights")).first()
    left, shares = int(whole["all"] or 0), int(whole["weights"] or 1)
    while True:
        above = _exact(F.col("weight")) * _exact(left) > _exact(F.col("ceiling")) * _exact(shares)
        now = sources.agg(F.sum(F.when(above, F.col("ceiling"))).alias("held"), F.sum(F.when(~above, F.col("weight"))).alias("weights")).first()
        again = int(whole["all"] or 0) - int(now["held"] or 0), int(now["weights"] or 1)
        if again == (left, shares):
            break
        left, shares = again
    part = _exact(F.col("weight")) * _exact(left)
    target = F.when(above, F.col("ceiling").cast("double")).otherwise(part.cast("double") / F.lit(float(shares)))
    empty = F.col("source_size") == 0
    up = F.when(empty, _exact(0)).when(above, _exact(most)).otherwise(part)
    down = F.when(above | empty, _exact(1)).otherwise(_exact(F.col("source_size")) * _exact(shares))
    return sources.select("source", "source_size", target.alias("target"), up.alias("up"), down.alias("down"))


def _offset(seed: str) -> Column:
    """A 16-bit number drawn for each source: the first digits of an MD5 of seed and source."""
    named = F.when(F.col("source").isNull(), F.lit(seed)).otherwise(F.concat(F.lit(seed + ":"), F.col("source").cast("string")))
    return F.conv(F.substring(F.md5(named), 1, 4), 16, 10).cast("decimal(38,0)")


def mix_counts(documents: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: str = "mix") -> DataFrame:
    """One row per document: its key, ``source_size``, ``target``, ``copies`` and ``taken`` = copies * size."""
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORDS)), F.lit(0)).cast("long")
    slim = cut(documents.select("doc_id", "source", size.alias("size"), F.xxhash64("text").alias("text_hash")))
    targets = cut(source_targets(slim, weights, most))
    order = [F.col("source").asc_nulls_last(), F.col("size").desc(), F.col("doc_id").asc_nulls_last(), F.col("text_hash")]
    rows = numbered(slim, order, "place")
    first = rows.groupBy("source").agg(F.min("place").alias("first"))
    facts = targets.withColumnRenamed("source", "_source").join(first.withColumnRenamed("source", "_source2"), F.col("_source").eqNullSafe(F.col("_source2")))
    if targets.count() <= SMALL:
        facts = F.broadcast(facts)
    joined = rows.join(facts, F.col("source").eqNullSafe(F.col("_source"))).withColumn("offset", _offset(seed))
    joined = joined.withColumn("at", _exact(F.col("place") - F.col("first")))
    crossed = F.expr(f"((at + 1) * up * {PARTS} + offset * down) div (down * {PARTS}) - (at * up * {PARTS} + offset * down) div (down * {PARTS})")
    return joined.select(*KEY, "source_size", "target", crossed.alias("copies")).withColumn("taken", F.col("copies") * F.col("size"))


def mix_documents(documents: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: str = "mix") -> DataFrame:
    """The mix itself: doc_id, source, text and ``copy`` (from 0), a row for each copy taken."""
    counts = mix_counts(documents, weights, most, seed).groupBy(*KEY).agg(F.sum("copies").alias("copies")).where("copies > 0")
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORDS)), F.lit(0)).cast("long")
    texts = documents.select("doc_id", "source", size.alias("size"), F.xxhash64("text").alias("text_hash"), "text").dropDuplicates([*KEY])
    named = counts.select(*(F.col(k).alias(f"_{k}") for k in KEY), "copies")
    same = F.col("size").eqNullSafe(F.col("_size")) & F.col("text_hash").eqNullSafe(F.col("_text_hash")) & F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.col("source").eqNullSafe(F.col("_source"))
    return texts.join(named, same).select("doc_id", "source", "text", F.explode(F.sequence(F.lit(0), (F.col("copies") - 1).cast("int"))).alias("copy"))


#: DuckDB SQL of the mix with weights 5, 2, 1, three copies at most and the seed ``mix``.
MIX_SQL = """
WITH sized AS (
  SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
sources AS (
  SELECT source, sum(size)::HUGEINT AS source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::HUGEINT AS weight FROM sized GROUP BY source),
steps AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
    coalesce(sum(3 * source_size) OVER w, 0) AS held, coalesce(sum(weight) OVER w, 0) AS gone
  FROM sources WINDOW w AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT arg_min(total - held, held)::HUGEINT AS left_over, arg_min(weights - gone, held)::HUGEINT AS shares FROM steps WHERE weight * (total - held) <= 3 * source_size * (weights - gone)),
targets AS (
  SELECT source, source_size, weight * left_over > 3 * source_size * shares AS above,
    CASE WHEN weight * left_over > 3 * source_size * shares THEN (3 * source_size)::DOUBLE ELSE (weight * left_over)::DOUBLE / shares::DOUBLE END AS target,
    CASE WHEN source_size = 0 THEN 0 WHEN weight * left_over > 3 * source_size * shares THEN 3 ELSE weight * left_over END::HUGEINT AS up,
    CASE WHEN source_size = 0 OR weight * left_over > 3 * source_size * shares THEN 1 ELSE source_size * shares END::HUGEINT AS down,
    CAST('0x' || substr(md5(CASE WHEN source IS NULL THEN 'mix' ELSE 'mix:' || source END), 1, 4) AS HUGEINT) AS off
  FROM sources, level),
placed AS (
  SELECT *, (row_number() OVER (PARTITION BY source ORDER BY size DESC, doc_id NULLS LAST) - 1)::HUGEINT AS place FROM sized)
SELECT p.doc_id, p.size, t.source_size::BIGINT AS source_size, t.target,
  ((((place + 1) * up * 65536 + off * down) // (down * 65536)) - ((place * up * 65536 + off * down) // (down * 65536)))::BIGINT * p.size AS taken,
  ((((place + 1) * up * 65536 + off * down) // (down * 65536)) - ((place * up * 65536 + off * down) // (down * 65536)))::BIGINT AS copies
FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source
"""
