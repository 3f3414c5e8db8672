"""The queries of this subpackage: each operator over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.llm import collocations, embedding_dedup, html_extract, langid, mixing, secret_scan, spelling, toxicity
from timeloom.llm.fingerprints import compare_edited
from timeloom.llm.ngram_jaccard import group_documents
from timeloom.llm.packing import pack_documents
from timeloom.llm.sentencepiece_codec import encode_documents
from timeloom.llm.token_counts import count_tokens


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = encode_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


def _fold(modulus: int) -> Column:
    """crc32 of doc_id as text, modulo ``modulus``."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return secret_scan.scan(documents, secret_scan.fit(documents))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, _table(spark, sf_dir, "labels"), _fold(3) != 1)
    scored = toxicity.score(documents, model)
    return scored.select("doc_id", F.coalesce(_fold(3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "offending")


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.link_vectors(_table(spark, sf_dir, "embeddings"), 0.95)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048)


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edited(_table(spark, sf_dir, "documents"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_documents(_table(spark, sf_dir, "documents"), 5, 75)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2048)


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    found = langid.identify(documents, langid.fit(documents, _fold(5) != 0))
    return found.select("doc_id", F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score", "accepted")


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_sentencepiece, op2_secret_scan, op3_toxicity, op4_embedding_dedup, op5_token_counts, op6_fingerprints, op7_ngram_jaccard, op8_packing, op9_html_extract, op10_language_id, op11_mixing, op12_collocations, op13_spelling)}

ORACLE_SQL: dict[str, str] = {"op11_mixing": mixing.MIX_SQL, "op12_collocations": collocations.COLLOCATION_SQL}
