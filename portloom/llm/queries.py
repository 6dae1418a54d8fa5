"""The registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portloom.llm import (
    bpe,
    classifier,
    importance,
    linededup,
    minhash,
    packing,
    pii,
    quality,
    simhash,
    tokenfiles,
    topk,
    variants,
    warc,
)
from portloom.session import workspace

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BYTE_LEVEL = "byte_bpe_50k.json"
WORD_LEVEL = "word_bpe_49k.json"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_bpe")
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BYTE_LEVEL)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, path).select("doc_id", "ids")
    decoded = bpe.decode(coded, path, into="decoded")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


#: A deployment passes its own secret; this one only makes the query's result reproducible.
PSEUDONYM_KEY = "corpus-pseudonyms"


@query("op2_pii")
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, PSEUDONYM_KEY, count="n_found")


@query("op3_line_dedup")
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup_lines(docs, min_words=1).select("doc_id", "n_lines", "n_removed", "text")


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that people marked as good."""
    return table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


@query("op4_quality_rules")
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality.judged(docs, trusted_ids(spark, sf_dir))
    return found.select("doc_id", *quality.BASE_COLUMNS, "base_failed", "kept", "score")


@query("op5_packing")
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_LEVEL))


@query("op6_simhash")
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@query("op7_token_files")
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = workspace(spark, "token-files")
    docs = table(spark, sf_dir, "documents")
    tokenfiles.write_token_files(docs, public_tokenizers.path(BYTE_LEVEL), folder, end_id=2)
    found = tokenfiles.read_token_files(spark, folder)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op8_quality_classifier")
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = classifier.in_fold(F.col("doc_id"), 4, 2)
    known = table(spark, sf_dir, "labels").where(~held_out).select("doc_id", "quality")
    found = classifier.scored(table(spark, sf_dir, "documents"), known)
    return found.select(
        "doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted")
    )


@query("op9_warc")
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = workspace(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), folder, min_bytes=0)
    return warc.read_archives(spark, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query("op10_topk")
def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the whole numbers of floor() hide what is not finite, so that is looked for before
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    scaled = F.transform("embedding", lambda v: F.floor(64 * v.cast("double")).cast("double"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.when(finite, scaled).alias("x"))
    asked = vectors.where(F.col("vec_id") % 20 == 0).select("vec_id")
    found = topk.top_k(vectors, asked, k=20, id_col="vec_id")
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), F.col("score").cast("long").alias("score"))


@query("op13_importance")
def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = importance.resample(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc.doc_id", "n_features", "weight", "score", "rank")


@query("op11_spelling_variants")
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return variants.group_variants(docs, rewrite=variants.letter_lost(199))


@query("op12_minhash")
def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs, shingle=2)
