"""One registered query per operator, over its whole table, with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm import (
    byte_pairs,
    collocations,
    decontaminate,
    language,
    mixing,
    private_data,
    reputation,
    secret_scan,
    sharding,
    simhash,
    spans,
    token_files,
    topk,
    whitening,
)
from almanac.plans.inputs import table

# Rules of the URL filter, number of shards.
URL_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
SHARDS = 24
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

Query = Callable[[SparkSession, str], DataFrame]


def with_library(query: Query) -> Query:
    """Lets the Python workers of a session import this library from where the driver has it.

    A cluster on which it is installed, or shipped with ``--py-files``, finds it there first or last alike.
    """

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        environment = spark.sparkContext.environment
        paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
        if root not in paths:
            environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
        return query(spark, sf_dir)

    return run


def page_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, good): a label's id names the page with that id; good is quality 1 and not toxic."""
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good")
    )


def op1_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = reputation.judge(pages, page_labels(spark, sf_dir), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", F.round("host_bound", 6).alias("host_bound"))


def op2_language_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2
    trees = language.train(docs.where(~held_out))
    predicted = language.predict(docs.select("doc_id", "text"), trees)
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op3_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    clustered = simhash.cluster(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return clustered.select("doc_id", "fingerprint", "component_id")


def _span_digest(found: DataFrame, kinds: tuple[str, ...], n_base: int) -> DataFrame:
    """Counts per base kind, checksum of the base spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["kind_no"] < n_base)
    counts = [spans.count_kind(F.col("spans"), k).alias(f"n_{kinds[k]}") for k in range(n_base)]
    return found.select(
        "doc_id", *counts, F.sha2(spans.label(base, kinds), 256).alias("base_sha256"),
        spans.label(F.col("spans"), kinds).alias("spans"),
    )


def op4_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = private_data.sanitise(docs)
    # The columns are those of the SQL; the rewriting is run as well, and gives a text for each text.
    whole = F.sha2("sanitised", 256).isNotNull() == F.col("text").isNotNull()
    checked = F.when(whole, F.col("doc_id")).otherwise(F.raise_error(F.lit("text without a sanitised one")).cast("bigint"))
    return _span_digest(found.withColumn("doc_id", checked), private_data.KINDS, private_data.TERM)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write(table(spark, sf_dir, "documents"), TOKENIZER, by_words=True)
    return token_files.read_documents(spark, manifest)


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


def op8_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    digest = decontaminate.items_digest(F.col("items")).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


def op9_shard_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    checksum = F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", checksum)
    return sharding.assign(docs, shards=SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _span_digest(secret_scan.scan(docs), secret_scan.KINDS, secret_scan.RANDOM)


def op11_whitened_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    most = F.lit((1 << 63) - 1)
    fits = F.when(F.col("deviation") <= most, F.col("deviation").cast("bigint")).otherwise(
        F.raise_error(F.lit("a deviation does not fit into 64 bits")).cast("bigint")
    )
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", fits)


def op12_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = byte_pairs.share_ranks(spark, RANKS)
    return byte_pairs.round_trip(docs, ranks, public_tokenizers.PATTERN).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    phrases, _ = collocations.mine(table(spark, sf_dir, "documents").select("lang", "text"))
    return phrases


QUERIES: dict[str, Query] = {
    query.__name__: with_library(query)
    for query in (
        op1_url_reputation, op2_language_ppm, op3_simhash_golay, op4_private_data, op5_token_files, op6_mix_sources,
        op7_top_k, op8_benchmark_leaks, op9_shard_packing, op10_secret_scan, op11_whitened_embeddings,
        op12_byte_pairs, op13_collocations,
    )
}
