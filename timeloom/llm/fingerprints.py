"""Canonical exact fingerprints, in DataFrame operations only.

A text is brought to a canonical form (NFKC, full case folding, white space
folded to one blank, trimmed) and hashed by two differently seeded 64-bit
xxhashes. Bytes of texts that share a digest are compared; should they ever
differ, the SHA-256 of the bytes is appended, so that equal fingerprints mean
equal canonical texts. Likeness of two fingerprints is 1 if they are equal
and 0 if not.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timeloom.llm.runtime import cut, text_of

BITMAP_BITS = 1 << 23  # of the bitmap of repeated digests: 1 MB, whatever the input
BUCKET_BITS = 32_768  # that Spark's bitmap functions hold in one row
FIRST = -(1 << 63)  # stands for a null doc_id, which sorts first


def canonical(text: Column) -> Column:
    """NFKC, case folding (both twice, as one can undo the other), white space folded and trimmed."""
    normal = lambda c: F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(True))
    folded = lambda c: F.reflect(F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), c, F.lit(True))
    once = normal(folded(normal(text)))
    return F.trim(F.regexp_replace(once, r"(?U)[\s\p{Z}]+", " "))


def digest(canon: Column) -> Column:
    """128 bits in lower-case hexadecimal."""
    halves = (F.xxhash64(canon), F.xxhash64(F.lit("second"), canon))
    return F.lower(F.concat(*(F.lpad(F.hex(h), 16, "0") for h in halves)))


def repeated_bitmap(digests: DataFrame) -> DataFrame:
    """Bitmap rows (bucket, bits) of the digests that occur more than once; at most 1 MB in all."""
    repeated = digests.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1")
    place = F.pmod(F.xxhash64("digest"), F.lit(BITMAP_BITS))
    return repeated.select(F.floor(place / BUCKET_BITS).alias("bucket"), (place % BUCKET_BITS).alias("bit")).groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def clashes(texts: DataFrame, digests: DataFrame) -> list[str]:
    """Digests under which different canonical texts meet; among 128-bit hashes none is expected.

    Only texts that pass a bitmap of repeated digests are compared, byte by
    byte, each bucket by its least and greatest text, which combine before
    the shuffle.
    """
    bitmap = F.broadcast(repeated_bitmap(digests))  # its size is bounded by BITMAP_BITS
    made = texts.select(canonical(F.col("text")).alias("canon")).select("canon", digest(F.col("canon")).alias("digest"))
    place = F.pmod(F.xxhash64("digest"), F.lit(BITMAP_BITS))
    made = made.withColumn("bucket", F.floor(place / BUCKET_BITS)).withColumn("bit", (place % BUCKET_BITS).cast("int"))
    byte = F.conv(F.hex(F.expr("substring(bits, cast(bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    mask = F.expr("shiftleft(1, cast(bit % 8 as int))")
    held = made.join(bitmap, "bucket").where(byte.bitwiseAND(mask) != 0)
    bounds = held.groupBy("digest").agg(F.min("canon").alias("least"), F.max("canon").alias("greatest"))
    return sorted(r["digest"] for r in bounds.where("least <> greatest").select("digest").collect())


def settled(digest_: Column, canon: Column, clashing: list[str]) -> Column:
    """The fingerprint: the digest, told apart by the bytes where the digest is shared by different texts."""
    if not clashing:
        return digest_
    return F.when(digest_.isin(clashing), F.concat(digest_, F.lit("-"), F.sha2(canon, 256))).otherwise(digest_)


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every row; a null text is empty."""
    texts = text_of(documents)
    digests = texts.select(digest(canonical(F.col("text"))).alias("digest"))
    clashing = clashes(texts, digests)
    made = texts.select("doc_id", canonical(F.col("text")).alias("canon")).select("doc_id", "canon", digest(F.col("canon")).alias("digest"))
    return made.select("doc_id", settled(F.col("digest"), F.col("canon"), clashing).alias("fingerprint"))


def successors(keys: DataFrame) -> DataFrame:
    """Adds to each distinct key the key after it (``next``), the first after the last.

    Keys are dealt by range; a window runs within each range and a table of
    one row per range closes the gaps, so no task sees all keys.
    """
    fields = ["id", "k", "n", "digest"]
    parts = max(1, int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = cut(keys.repartitionByRange(parts, "id", "k").withColumn("part", F.spark_partition_id()))
    whole = F.struct(*fields)
    firsts = dealt.groupBy("part").agg(F.min(whole).alias("first"))
    order = Window.orderBy("part")  # one row per range
    top = firsts.agg(F.min("first").alias("top"))
    after = firsts.select("part", F.lead("first").over(order).alias("later")).crossJoin(F.broadcast(top)).select("part", F.coalesce("later", "top").alias("after"))
    within = dealt.withColumn("within", F.lead(whole).over(Window.partitionBy("part").orderBy("id", "k")))
    return within.join(after, "part").select(*fields, F.coalesce("within", "after").alias("next"))


def compare_edited(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text has its last quarter replaced by as much (or all) of the
    start of the next document in order of doc_id, the first after the last.
    Null texts are empty, a null doc_id sorts first. Rows that repeat both
    doc_id and text count as one document, each repeat with the same result;
    different texts under one doc_id follow each other in a fixed order.
    """
    # the low bit of k says whether doc_id is null, so that no other column travels with a text and one shuffle of the texts serves both joins
    no_id = F.col("doc_id").isNull().cast("long")
    texts = text_of(documents).select(F.coalesce("doc_id", F.lit(FIRST)).alias("id"), F.xxhash64("text").bitwiseAND(F.lit(-2)).bitwiseOR(no_id).alias("k"), "text")
    digested = texts.select("id", "k", F.length("text").cast("long").alias("n"), digest(canonical(F.col("text"))).alias("digest"))
    per_row = cut(digested)
    clashing = clashes(texts, per_row.select("digest"))
    links = cut(successors(per_row.dropDuplicates(["id", "k"])))
    quarter = F.floor(F.col("n") / 4)
    heads = links.select(F.col("id").alias("to_id"), F.col("k").alias("to_k"), F.col("next.id").alias("id"), F.col("next.k").alias("k"), F.least(quarter, F.col("next.n")).cast("int").alias("take"))
    taken = texts.join(heads, ["id", "k"]).select("to_id", "to_k", F.expr("substring(text, 1, take)").alias("head"), F.col("text").alias("next_text") if clashing else F.lit(None).cast("string").alias("next_text"))
    taken = taken.dropDuplicates(["to_id", "to_k"]).select(F.col("to_id").alias("id"), F.col("to_k").alias("k"), "head", "next_text")
    joined = reduce(lambda a, b: a.join(b, ["id", "k"]), (links.select("id", "k", "n", "digest", F.col("next.digest").alias("next_digest")), taken), texts)
    edited = joined.withColumn("edited", F.concat(F.expr("substring(text, 1, cast(n - floor(n / 4) as int))"), F.col("head")))
    canon = edited.withColumn("edited_canon", canonical(F.col("edited"))).withColumn("edited_digest", digest(F.col("edited_canon")))
    own = settled(F.col("digest"), canonical(F.col("text")), clashing) if clashing else F.col("digest")
    following = settled(F.col("next_digest"), canonical(F.col("next_text")), clashing) if clashing else F.col("next_digest")
    doc_id = F.when(F.col("k").bitwiseAND(F.lit(1)) == 0, F.col("id")).alias("doc_id")
    made = canon.select(doc_id, F.col("n").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), own.alias("fingerprint"), settled(F.col("edited_digest"), F.col("edited_canon"), clashing).alias("edited_fingerprint"), following.alias("next_fingerprint"))
    alike = lambda other: (F.col("fingerprint") == F.col(other)).cast("double")
    return made.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", alike("edited_fingerprint").alias("near_edited"), alike("next_fingerprint").alias("near_next"))
