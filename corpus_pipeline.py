"""Corpus pipeline over ``documents``: five stages, each by one operator of the llm subpackage.

A stage takes (spark, docs, sf_dir) and returns the documents that it keeps,
or, in the last stage, the packed pieces. ``run`` writes each stage's result
as Parquet in the shared checkpoint folder and reads it again for the next.
No stage samples or caps its documents; stages that fit a classifier do so on
a bounded sample of rows, as their operators document.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.llm import langid, ngram_jaccard, packing, runtime, secret_scan, toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _fold(modulus: int):
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that score below 0.7; the model learns from labelled rows that are not held out."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), _fold(3) != 1)
    return toxicity.with_score(docs.select(*COLUMNS), model).where("score < 0.7").select(*COLUMNS)


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is accepted."""
    model = langid.fit(docs, _fold(5) != 0)
    return langid.with_language(docs.select(*COLUMNS), model).where("accepted").select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near duplicates a row of the least doc_id, and of rows with the same doc_id and text one.

    Rows are told apart by a 64-bit hash of doc_id and text, so different
    texts under one doc_id are decided each on its own.
    """
    rows = docs.select(*COLUMNS, F.xxhash64("doc_id", "text").alias("row"))
    groups = ngram_jaccard.group_documents(rows.select(F.col("row").alias("doc_id"), "text"), 5, 75)
    named = rows.select("row", "doc_id").distinct().join(groups.select(F.col("doc_id").alias("row"), "component_id").distinct(), "row")
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "row")).alias("first"))
    gone = named.join(first, "component_id").where("row <> first.row").select("row")
    repeated = rows.groupBy("row").agg(F.count("*").alias("n")).where("n > 1").select("row")
    left = rows.join(gone, "row", "left_anti")
    one = left.join(repeated, "row", "left_semi").dropDuplicates(["row"])
    return left.join(repeated, "row", "left_anti").select(*COLUMNS).unionByName(one.select(*COLUMNS))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces each finding by ``[secret]``; n_chars follows the text."""
    return secret_scan.mask(docs.select(*COLUMNS), secret_scan.fit(docs)).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), 2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", keep_languages),
    ("near_duplicates", one_of_each_group),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]

#: SQL can't express the trained stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each read from the table that the one before wrote."""
    runtime.ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
